"""The star schema as Parquet tables below one folder.

Dimensions only ever grow, so loads append to them. Facts are kept by month and sorted by day; where a
day is loaded again from the quotes kept as they came, the files that hold its rows are replaced. Months that are over can be laid
out by series, for reads of whole series. Next to the fact stands its
summary per month, market and commodity, brought up to date with every change. One writer at a time. The
model tables are upserted: each upsert writes a new generation next to the last finished one.
"""

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.schemas import STAR_TABLES
from harvestlens.sources.summary import USAGE_KEYS, dated, merged, month_number, summarise

FACT, USAGE = "fact_market_prices", "usage_summary"
SERIES_ORDER = ["year", "month", "market_id", "commodity_id", "date_id"]
#: Begins the names of fact files laid out by series.
BY_SERIES = "by-series-"


@dataclass
class Star:
    """The frames every analytic operator works on."""

    state_dim: DataFrame
    market_dim: DataFrame
    commodity_dim: DataFrame
    date_dim: DataFrame
    fact: DataFrame
    model_evaluation: DataFrame | None = None
    feature_importance: DataFrame | None = None
    usage: DataFrame | None = None


class StarStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _folder(self, table: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, table: str) -> bool:
        path, files = self._folder(table)
        return files.exists(path)

    def read(self, table: str) -> DataFrame:
        """A table, empty if nothing was written yet."""
        schema = STAR_TABLES[table]
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def append(self, table: str, rows: DataFrame) -> None:
        rows.select(*STAR_TABLES[table].fieldNames()).write.mode("append").parquet(self.path(table))

    def append_fact(self, fact: DataFrame) -> None:
        """Append fact rows to folders by year and month, and add them to the summary.

        The range shuffle gives every task neighbouring rows: few files per month, tight
        min/max statistics on the keys, and a busy month split over several tasks. The rows are written aside and
        moved, so either all of them or none arrive.
        """
        self.finish_replacing(FACT)
        self._write_aside(FACT, fact_layout(fact), [])
        self.finish_replacing(FACT)
        self.refresh_usage()

    def land(self, quotes: DataFrame) -> str:
        """Keep typed quotes as they came, by month of arrival and load; returns the load's name.

        AQE sizes the files by month and splits a busy month over several tasks.
        """
        load = uuid.uuid4().hex
        day = F.col("arrival_date")
        dated = quotes.withColumns({"year": F.year(day), "month": F.month(day), "load": F.lit(load)})
        columns = STAR_TABLES["landed_quotes"].fieldNames()
        (
            dated.select(*columns).hint("rebalance", "year", "month")
            .write.mode("append").partitionBy("year", "month", "load").parquet(self.path("landed_quotes"))
        )
        return load

    def folders_of(self, load: str) -> list[str]:
        """The month folders (year=.../month=...) that a landed load has rows in; no folder of another load is listed."""
        path, files = self._folder("landed_quotes")
        found = files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(path, f"*/*/load={load}"))
        return sorted("/".join(str(entry.getPath()).split("/")[-3:-1]) for entry in found or [])

    def read_folders(self, table: str, folders: list[str]) -> DataFrame:
        """The rows of a table in some of its folders; only these are listed."""
        schema, there = STAR_TABLES[table], [f for f in folders if self.exists(f"{table}/{f}")]
        if not there:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        return reader.parquet(*[f"{self.path(table)}/{f}" for f in there])

    def replace_days(self, table: str, rows: DataFrame, days: DataFrame, folders: list[str]) -> None:
        """Replace the rows of `days` (arrival_date), which lie in the given month folders, in a table kept by year and month.

        Only files that hold a row of these days are read and rewritten; all others stay as they are, and of a
        day without new rows nothing is left. The new files are written aside first, with the list of those that they
        replace: from then on `finish_replacing` can complete the change, also after a crash.
        """
        self.finish_replacing(table)
        names, ids = STAR_TABLES[table].fieldNames(), days.select(F.unix_date("arrival_date").alias("date_id"))
        old, kept = [], self.spark.createDataFrame([], STAR_TABLES[table])
        if any(self.exists(f"{table}/{f}") for f in folders):
            stored = self.read_folders(table, folders).select("date_id", F.col("_metadata.file_path").alias("file"))
            old = [r.file for r in stored.join(ids, "date_id", "left_semi").select("file").distinct().collect()]
        if old:
            reader = self.spark.read.schema(STAR_TABLES[table]).option("basePath", self.path(table))
            kept = reader.parquet(*old).join(ids, "date_id", "left_anti")
        day = F.date_from_unix_date("date_id")
        fresh = rows.withColumns({"year": F.year(day), "month": F.month(day)})
        order = ["year", "month", "date_id", *[c for c in ("market_id", "commodity_id") if c in names]]
        changed = kept.select(*names).unionByName(fresh.select(*names))
        self._write_aside(table, changed.repartitionByRange(*order).sortWithinPartitions(*order), old)
        self.finish_replacing(table)
        if table == FACT:
            self.refresh_usage()

    def arrange_by_series(self, months: list[str] | None = None, page_rows: int = 20_000) -> list[str]:
        """Lay months of the fact out by market, commodity and day; returns the month folders that changed.

        By default all months but the last, which loads still add to. A month whose files are all laid out so is left
        alone; one that got other files since (late quotes, a reload) is done again. Files, row groups and pages then hold few
        series each, so a read of one series decodes about a page of at most `page_rows` rows of a month, where the layout by day
        makes it read the whole month. The price: a read of single days of these months, and a reload of such a day, touches the whole
        month. Rows don't change, so neither does the summary, and a crash is completed by the next use.
        """
        self.finish_replacing(FACT)
        over = sorted(self.months(FACT), key=lambda m: [int(part.split("=")[1]) for part in m.split("/")])[:-1]
        path, files = self._folder(FACT)
        changed, old = [], []
        for month in over if months is None else months:
            found = files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(path, f"{month}/*.parquet")) or []
            here = [entry.getPath() for entry in found]
            if any(not file.getName().startswith(BY_SERIES) for file in here):
                changed.append(month)
                old += [file.toUri().toString() for file in here]
        if changed:
            rows = self.read_folders(FACT, changed).repartitionByRange(*SERIES_ORDER).sortWithinPartitions(*SERIES_ORDER)
            self._write_aside(FACT, rows, old, BY_SERIES, **{"parquet.page.row.count.limit": page_rows})
            self.finish_replacing(FACT)
        return changed

    def _write_aside(self, table: str, rows: DataFrame, old: list[str], named: str = "", **options) -> None:
        """Write laid out rows next to the table, with the list of the files that they replace; `named` begins the new files' names."""
        aside = f"_replacing/{table}/{named}{uuid.uuid4().hex}"
        self.spark.createDataFrame([(f,) for f in old], "file string").coalesce(1).write.parquet(self.path(f"{aside}/old"))
        laid_out = rows.select(*STAR_TABLES[table].fieldNames())
        laid_out.write.options(**options).partitionBy("year", "month").parquet(self.path(f"{aside}/rows"))

    def finish_replacing(self, table: str) -> None:
        """Complete replacements whose rows are all written aside, drop those that are not; each step can be repeated.

        Months of the fact are marked before their files change. Rows that only come in addition are merged into the summary of
        their months, which removes the marks; marks left by a replacement or a crash are for `refresh_usage`. Rows that are only
        laid out anew need none.
        """
        root, files = self._folder(f"_replacing/{table}")
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        for entry in files.listStatus(root) if files.exists(root) else []:
            aside = entry.getPath()
            if files.exists(Path(aside, "rows/_SUCCESS")):
                old = [r.file for r in self.spark.read.parquet(str(Path(aside, "old"))).collect()]
                sources, written = [], files.listFiles(Path(aside, "rows"), True)
                while written.hasNext():
                    source = written.next().getPath()
                    if source.getName().endswith(".parquet"):
                        sources.append(source)
                months = sorted({"/".join(f.split("/")[-3:-1]) for f in [*old, *map(str, sources)]})
                named = BY_SERIES if aside.getName().startswith(BY_SERIES) else ""
                mark = self._mark(months) if table == FACT and not named else None
                merging = mark and sources and not old
                if merging:
                    self._merge_usage(str(Path(aside, "rows")), months)
                for f in old:
                    files.delete(Path(self.spark._jvm.java.net.URI(f)), False)
                for source in sources:
                    folder, name = "/".join(str(source).split("/")[-3:-1]), f"{named}{source.getName()}"
                    target = Path(f"{self.path(table)}/{folder}/{name}")
                    files.mkdirs(target.getParent())
                    files.rename(source, target)
                if merging:
                    files.delete(mark, False)
            files.delete(aside, True)

    # -- the usage summary ----------------------------------------------------------------

    def months(self, table: str) -> list[str]:
        """The month folders (year=.../month=...) of a table."""
        path, files = self._folder(table)
        found = files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(path, "year=*/month=*"))
        return sorted("/".join(str(entry.getPath()).split("/")[-2:]) for entry in found or [])

    def _marks(self) -> list:
        path, files = self._folder("_usage_stale")
        return [entry.getPath() for entry in files.listStatus(path)] if files.exists(path) else []

    def stale_months(self) -> list[str]:
        """Months whose summary has to be built again from the fact."""
        marks = [str(path) for path in self._marks()]
        lines = self.spark.read.text(marks).distinct().collect() if marks else []
        return sorted(r.value for r in lines if re.fullmatch(r"year=\d+/month=\d+", r.value))

    def _mark(self, months: list[str]):
        """Mark months; returns the mark if their summaries can be merged with new rows.

        They can't if one of them was marked before, or if the fact is older than the summary: then all its months are marked.
        """
        stale, older = self.stale_months(), [] if self.exists(USAGE) else self.months(FACT)
        mark, files = self._folder(f"_usage_stale/{uuid.uuid4().hex}")
        file = files.create(mark, True)
        file.write(bytearray("\n".join({*months, *older}), "utf-8"))
        file.close()
        return None if older or {*stale} & {*months} else mark

    def _write_usage(self, summary: DataFrame) -> None:
        """Replace the summary of the months that occur, sorted by series: one series is in few row groups of a month."""
        (
            summary.repartitionByRange(*USAGE_KEYS).sortWithinPartitions(*USAGE_KEYS)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("year", "month").parquet(self.path(USAGE))
        )

    def _merge_usage(self, added: str, months: list[str]) -> None:
        delta = summarise(self.spark.read.schema(STAR_TABLES[FACT]).parquet(added))
        self._write_usage(merged(self.read_folders(USAGE, months).unionByName(delta)))

    def refresh_usage(self) -> None:
        """Build the summary of marked months again, from the facts of these months only."""
        if not self.exists(USAGE) and self.exists(FACT):
            self._mark([])
        marks, (_, files) = self._marks(), self._folder(USAGE)
        stale = self.stale_months()
        for month in stale:
            files.delete(self._folder(f"{USAGE}/{month}")[0], True)
        if any(self.exists(f"{FACT}/{month}") for month in stale):
            self._write_usage(summarise(self.read_folders(FACT, stale)))
        for mark in marks:
            files.delete(mark, False)

    def _generations(self, table: str) -> list[int]:
        """Finished generations, oldest first."""
        path, files = self._folder(table)
        if not files.exists(path):
            return []
        done = [
            int(entry.getPath().getName().split("=")[1])
            for entry in files.listStatus(path)
            if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))
        ]
        return sorted(done)

    def read_latest(self, table: str) -> DataFrame:
        generations = self._generations(table)
        if not generations:
            return self.spark.createDataFrame([], STAR_TABLES[table])
        return self.spark.read.schema(STAR_TABLES[table]).parquet(
            f"{self.path(table)}/generation={generations[-1]}"
        )

    def upsert(self, table: str, updates: DataFrame, keys: list[str]) -> None:
        """bulk_upsert into a new generation; what is being read is never overwritten."""
        schema = STAR_TABLES[table]
        generations = self._generations(table)
        merged = bulk_upsert(self.read_latest(table), updates, keys)
        (
            merged.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
            .write.mode("overwrite")
            .parquet(f"{self.path(table)}/generation={(generations or [0])[-1] + 1}")
        )

    def star(self) -> Star:
        self.finish_replacing(FACT)
        self.refresh_usage()
        return Star(
            state_dim=self.read("state_dim"),
            market_dim=self.read("market_dim"),
            commodity_dim=self.read("commodity_dim"),
            date_dim=self.read("date_dim"),
            fact=self.read(FACT),
            model_evaluation=self.read_latest("model_evaluation"),
            feature_importance=self.read_latest("feature_importance"),
            usage=self.read(USAGE),
        )


def fact_layout(fact: DataFrame) -> DataFrame:
    """Fact rows with year and month, laid out by range of (year, month, day, market, commodity)."""
    order = ["year", "month", "date_id", "market_id", "commodity_id"]
    return dated(fact).repartitionByRange(*order).sortWithinPartitions(*order)


def between_days(rows: DataFrame, low: DataFrame, high: DataFrame | None = None) -> DataFrame:
    """Rows dated from `low` to `high`, each a one-row frame with one date.

    All arithmetic stays inside the scalar subqueries: Spark pushes `column >= subquery` into
    a Parquet scan, but not a comparison with an expression around it. A table kept by
    year and month gets the limits on those too, so that only the folders of the months in
    question are opened.
    """
    by_month = {"year", "month"} <= set(rows.columns)
    number = month_number(F.col("year"), F.col("month")) if by_month else None
    found = rows
    for day, beyond in ((low, "__ge__"), (high, "__le__")):
        if day is None:
            continue
        one = day.toDF("day")
        if by_month:
            found = found.filter(getattr(number, beyond)(one.select(month_number(F.year("day"), F.month("day"))).scalar()))
        found = found.filter(getattr(F.col("date_id"), beyond)(one.select(F.unix_date("day")).scalar()))
    return found


def within_ids(rows: DataFrame, wanted: DataFrame, *ids: str) -> DataFrame:
    """Rows whose ids lie between the smallest and the largest wanted ones.

    The limits are bare scalar subqueries, which reach a Parquet scan. They take the first row of an order: Spark would merge several
    minima of one frame into one subquery with a struct, whose fields a scan doesn't get.
    """
    for c in ids:
        known = wanted.select(c).filter(F.col(c).isNotNull())
        low, high = (known.orderBy(order).limit(1).scalar() for order in (F.asc(c), F.desc(c)))
        rows = rows.filter((F.col(c) >= low) & (F.col(c) <= high))
    return rows


def bulk_upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not updated, plus the updates."""
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def table_scan(table: DataFrame, predicate: Column | None = None, columns=None) -> DataFrame:
    """Whole-table or filtered read; filter and columns reach the Parquet scan."""
    rows = table if predicate is None else table.filter(predicate)
    return rows.select(*columns) if columns else rows
