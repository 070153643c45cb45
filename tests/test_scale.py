"""What the work of the load's steps grows with: the plans and files behind the results."""

import datetime
import glob
import time

from pyspark.sql import functions as F

from harvestlens.constants import QUOTE_COLUMNS
from harvestlens.functions import dates, text
from harvestlens.operators import cleaning
from harvestlens.plans import ingest
from harvestlens.sources import daily_files
from harvestlens.sources.star_store import StarStore


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw_rows(spark, n, days=2):
    rows = [
        ("Kerala", "north", f"market {i % 3}", "Rice", "Local", "FAQ", f"0{1 + i % days}/01/2024", str(100 + i), str(300 + i), str(200 + i))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, QUOTE_COLUMNS_DDL)


QUOTE_COLUMNS_DDL = ", ".join(f"{c} string" for c in QUOTE_COLUMNS)


def test_fences_of_days_are_sent_to_the_quotes(spark, no_names):
    plan = plan_of(cleaning.clean_quotes(raw_rows(spark, 40), no_names))
    outer = plan[: plan.index("quartile")] if "quartile" in plan else plan
    joined = [line for line in outer.splitlines() if "Join" in line and "arrival_date" in line]
    assert "BroadcastHashJoin" in joined[0]


def test_quotes_and_their_fences_share_one_shuffle_of_the_quotes(spark, no_names):
    plan = plan_of(cleaning.clean_quotes(raw_rows(spark, 40), no_names))
    below = [line.split("Filter ", 1)[1] for line in plan.splitlines() if "Filter " in line and "atleastnnonnulls" in line]
    # The price order test came down to the quotes and made their shuffle another one than that of the fences.
    assert below and not any("min_price" in line and "<= " in line for line in below)


def test_day_files_are_written_without_sampling_a_range(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    quotes = raw_rows(spark, 60).withColumn("folder_day", F.lit(datetime.date(2024, 1, 1)))
    daily_files.write_daily_quotes(quotes.mapInArrow(counted, quotes.schema), "folder_day", str(tmp_path / "plain"))
    assert made.value == 60


def test_several_files_a_day_come_from_more_tasks_than_files_a_day(spark, tmp_path):
    """In each folder as many files as asked for, cheapest quotes first; no task holds a third of all rows."""
    path = str(tmp_path / "parts")
    day = F.date_add(F.lit(datetime.date(2024, 1, 1)), F.col("Min_Price").cast("int") % 5 * 31)
    quotes = raw_rows(spark, 200).withColumn("folder_day", day)
    daily_files.write_daily_quotes(quotes, "folder_day", path, daily_files.PRICES, 3)
    names = glob.glob(f"{path}/**/*.csv", recursive=True)
    assert len(names) == 15
    assert len({name.split("part-")[1][:5] for name in names}) > 3
    got = daily_files.read_quote_files(spark, path, file_order=True).orderBy("file_day", "sequence").collect()
    assert len(got) == 200
    for low, high in zip(got, got[1:]):
        assert low.file_day != high.file_day or float(low.Min_Price) <= float(high.Min_Price)


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for folder in folders for name in glob.glob(f"{folder}/**/shuffle_*.data", recursive=True)}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_shuffle_files_of_day_files_go_when_these_are_written(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    quotes = raw_rows(spark, 60).withColumn("folder_day", F.lit(datetime.date(2024, 1, 1)))
    daily_files.write_daily_quotes(quotes, "folder_day", str(tmp_path / "days"), daily_files.PRICES, 3)
    for _ in range(50):  # they are deleted behind the query's back
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(CLEANUP, None) == setting


def test_a_load_drops_the_shuffle_files_of_its_steps(spark, tmp_path, no_names, monkeypatch):
    found, before = {}, spark.conf.get(CLEANUP, None)
    for name in ("land", "append", "append_fact", "replace_days"):
        step = getattr(StarStore, name)
        monkeypatch.setattr(StarStore, name, lambda store, *a, step=step, name=name: (found.setdefault(name, spark.conf.get(CLEANUP)), step(store, *a))[1])
    for reload in (False, True):
        ingest.load_quotes(StarStore(spark, str(tmp_path / "star")), raw_rows(spark, 60), no_names, reload)
    assert len(found) == 4 and {*found.values()} == {"true"}
    assert spark.conf.get(CLEANUP, None) == before


def test_day_files_can_be_gzipped(spark, tmp_path):
    """The same rows in the same order of the files, and fewer bytes."""
    quotes = raw_rows(spark, 400).withColumn("folder_day", F.date_add(F.lit(datetime.date(2024, 1, 30)), F.col("Min_Price").cast("int") % 3))
    found = {}
    for kind in (None, "gzip"):
        path = str(tmp_path / str(kind))
        daily_files.write_daily_quotes(quotes, "folder_day", path, daily_files.PRICES, 2, compression=kind)
        names = glob.glob(f"{path}/**/part-*", recursive=True)
        rows = daily_files.read_quote_files(spark, path, file_order=True).orderBy("file_day", "sequence").drop("sequence").collect()
        found[kind] = (len(names), sum(len(open(name, "rb").read()) for name in names), rows)
        assert all(name.endswith(".csv.gz" if kind else ".csv") for name in names)
    assert found[None][2] == found["gzip"][2] and len(found["gzip"][2]) == 400
    assert found["gzip"][0] == found[None][0] and found["gzip"][1] * 2 < found[None][1]


def test_pages_are_compressed(spark, tmp_path):
    path = str(tmp_path / "pages")
    quotes = raw_rows(spark, 30).withColumn("day", F.lit(datetime.date(2024, 1, 1)))
    daily_files.write_record_pages(quotes, "day", path, 2)
    assert glob.glob(f"{path}/*") and all(name.endswith(".gz") for name in glob.glob(f"{path}/part-*"))
    back = daily_files.flatten_record_pages(daily_files.read_record_pages(spark, path))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, quotes.drop("day").collect()))


def test_plain_texts_and_dates_take_the_short_way_to_the_same_result(spark):
    names = spark.createDataFrame([(x,) for x in ["  pUNE city ", "africa-1", "BRAND#13", "lady's", "a-b", "x  y", "", None, "\u00e9t\u00e9 x", "a\n"]], "x string")
    got = [r.x for r in names.select(text.clean_text(F.col("x")).alias("x")).collect()]
    assert got == ["Pune City", "Africa-1", "Brand#13", "Lady'S", "A-B", "X  Y", "", None, "\u00c9t\u00e9 X", "A"]
    days = spark.createDataFrame([(x,) for x in ["5/6/2021", "2021-6-5", "05-06-2021 10:20", "31/02/2025", "5-6-2021\n", "5-6-21", None]], "x string")
    got = [r.x for r in days.select(dates.parse_day_first(F.col("x")).alias("x")).collect()]
    assert got == [datetime.date(2021, 6, 5)] * 3 + [None] * 4
