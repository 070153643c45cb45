import dataclasses
import datetime
from collections import Counter
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from harvestlens import schemas, session
from harvestlens.operators import audit, dimensions, explorer, fact, features, filters, forecast, overview
from harvestlens.operators.usage import distinct_ids
from harvestlens.plans import ingest
from harvestlens.sources import daily_files
from harvestlens.sources.star_store import Star, StarStore, bulk_upsert
from harvestlens.sources.summary import summarise
from harvestlens.streaming.ingest import stream_daily_ingest
from test_cleaning import write_csv

EPOCH = datetime.date(1970, 1, 1)
ROWS = [
    ("Orissa", "m1", "Paddy(Dhan)", "01/01/2024", 9, 10, 11),
    ("Orissa", "m1", "Paddy(Dhan)", "01/01/2024", 8, 10, 12),
    ("Orissa", "m2", "Wheat", "01/01/2024", 13, 14, 15),
    ("Goa", "m1", "Wheat", "02/01/2024", 9, 10, 11),
    ("Atlantis", "m9", "Wheat", "02/01/2024", 13, 14, 15),
]


def loaded(store):
    view = fact.denormalised_view(store.star())
    return Counter(
        (r.arrival_date, r.state, r.market, r.commodity, r.min_price) for r in view.collect()
    )


def test_number_keys_are_dense_and_stable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    ids = {r.k: r.i for r in dimensions.number_keys(rows, ["k"], "i").collect()}
    assert sorted(ids.values()) == list(range(1, 5001))
    again = {r.k: r.i for r in dimensions.number_keys(rows.repartition(9), ["k"], "i").collect()}
    assert ids == again


def test_upsert_keeps_known_ids(spark):
    dim = spark.createDataFrame([(7, "a"), (3, "b")], "id int, k string")
    main = spark.createDataFrame([("a",), (" c ",), ("b",), ("c",), (None,)], "k string")
    updated, attached = dimensions.upsert_dim(main, dim, ["k"], "id")
    assert sorted(map(tuple, updated.collect())) == [(3, "b"), (7, "a"), (8, "c")]
    assert attached.count() == 5


def test_load_twice_is_load_once(spark, quotes_of, no_names, tmp_path):
    store = StarStore(spark, str(tmp_path / "store"))
    first = ingest.load_quotes(store, quotes_of(ROWS), no_names)
    assert {(r.arrival_date.day, r.inserted) for r in first["inserted"].collect()} == {(1, 2), (2, 1)}
    assert [r.state for r in first["rejects"].collect()] == ["Atlantis"]
    assert {r.column: r.missing for r in first["missing_keys"].collect()} == dict.fromkeys(fact.FOREIGN_KEYS, 0)
    before = loaded(store)
    assert (datetime.date(2024, 1, 1), "Odisha", "M1", "Paddy", Decimal("8.00")) in before
    second = ingest.load_quotes(store, quotes_of(ROWS), no_names)
    assert second["inserted"].count() == 0
    assert loaded(store) == before
    later = [("Goa", "m3", "Ragi", "03/01/2024", 10, 10, 10), *ROWS]
    ingest.load_quotes(store, quotes_of(later), no_names)
    assert sum(loaded(store).values()) == 4
    assert all(r.n == 0 for r in audit.constraint_audit(store.star()).collect())


def test_first_quote_in_the_file_wins(spark, no_names, tmp_path):
    line = "Goa,D,M,Rice,V,G,01/01/2024,{},50,10"
    write_csv(tmp_path / "in/prices_01-01-2024.csv", [line.format(9), line.format(7), line.format(8)])
    store = StarStore(spark, str(tmp_path / "store"))
    ingest.load_quotes(store, daily_files.scan_daily_quotes(spark, str(tmp_path / "in"), file_order=True), no_names)
    assert [float(r.min_price) for r in store.star().fact.collect()] == []  # 50 lies beyond the fences
    line = "Goa,D,M,Rice,V,G,02/01/2024,{},{},10"
    write_csv(tmp_path / "in2/prices_02-01-2024.csv", [line.format(10, 10), line.format(9.5, 10.5), line.format(10, 10)])
    more = StarStore(spark, str(tmp_path / "store2"))
    scanned = daily_files.scan_daily_quotes(spark, str(tmp_path / "in2"), file_order=True)
    quotes = scanned.drop("file_day")
    keyed = quotes.select(
        F.lit(1).alias("date_id"), F.lit(1).alias("market_id"), F.lit(1).alias("commodity_id"), "sequence",
        *[F.col(c).cast("decimal(20,6)").alias(c.lower()) for c in ("Min_Price", "Max_Price", "Modal_Price")],
    )
    first = fact.build_fact(keyed, ["sequence"]).first()
    assert float(first.min_price) == 10 and not more.exists("fact_market_prices")


def test_fact_of_a_hot_key(spark):
    """Half of all rows share one key; the plan combines them before the shuffle."""
    rows = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("int").alias("date_id"),
        F.lit(1).alias("market_id"), F.lit(1).alias("commodity_id"),
        *[(F.col("id") + 5).cast("decimal(20,6)").alias(c) for c in ("min_price", "max_price", "modal_price")],
    )
    built = fact.build_fact(rows, ["min_price"])
    assert "partial_min" in built._jdf.queryExecution().toString()
    assert built.count() == 10000
    assert float(built.filter("date_id = 1").first().min_price) == 5


def test_audit_reports_violations(spark, quotes_of, no_names, tmp_path):
    store = StarStore(spark, str(tmp_path / "store"))
    ingest.load_quotes(store, quotes_of(ROWS), no_names)
    star = store.star()
    star.fact = star.fact.unionByName(star.fact).unionByName(star.fact.limit(1).withColumn("market_id", F.lit(99)))
    report = {(r.table_name, r.rule): r.n for r in audit.constraint_audit(star).collect()}
    assert report["fact_market_prices", "unique(date_id, market_id, commodity_id)"] == 3
    assert report["fact_market_prices", "references(market_id)"] == 1


def test_upsert_generations(spark, tmp_path):
    store = StarStore(spark, str(tmp_path))
    keys = ["market_id", "commodity_id"]
    rows = lambda *r: spark.createDataFrame(r, "market_id int, commodity_id int, mape double, rmse double, r2_score double")
    store.upsert("model_evaluation", rows((1, 1, 5.0, 6.0, 0.5), (1, 2, 5.0, 6.0, 0.5)), keys)
    store.upsert("model_evaluation", rows((1, 2, 7.0, 8.0, None), (2, 2, 1.0, 1.0, 1.0)), keys)
    got = {(r.market_id, r.commodity_id): r.mape for r in store.read_latest("model_evaluation").collect()}
    assert got == {(1, 1): Decimal("5.00"), (1, 2): Decimal("7.00"), (2, 2): Decimal("1.00")}
    assert bulk_upsert(rows((1, 1, 1.0, 1.0, 1.0)), rows((1, 1, 2.0, 2.0, 2.0)), keys).first().mape == 2.0


def test_filter_branches(spark, quotes_of, no_names, tmp_path):
    store = StarStore(spark, str(tmp_path / "store"))
    ingest.load_quotes(store, quotes_of(ROWS), no_names)
    star = store.star()
    options = lambda **selected: {k: [tuple(r) for r in v.collect()] for k, v in filters.filter_options(star, **selected).items()}
    assert set(options()) == {"states", "commodities"} and options()["commodities"] == [("Paddy",), ("Wheat",)]
    assert options(state_id=23) == {"districts": [("District",)]}
    assert options(state_id=23, market_id=1) == {"districts": [("District",)]}
    assert [m for _, m in options(state_id=23, all_markets=True)["markets"]] == ["M1", "M2"]
    assert [m for _, m in options(state_id=10, district="District")["markets"]] == ["M1"]
    market = store.star().market_dim.filter("state_id = 10").first().market_id
    assert options(market_id=market) == {"commodities": [("Wheat",)]}
    assert options(market_id=market, district="District") == {"commodities": [("Wheat",)]}
    with pytest.raises(ValueError):
        filters.filter_options(star, district="District")


def test_stream_equals_batch_and_replay_adds_nothing(spark, quotes_of, no_names, tmp_path):
    source = tmp_path / "in"
    line = "{},D,{},{},V,G,{},{},{},{}"
    for name, day in (("a", "01/01/2024"), ("b", "02/01/2024")):
        rows = [line.format(s, m, c, day, low, high, modal) for s, m, c, d, low, modal, high in ROWS if d == day]
        write_csv(source / f"{name}_{day.replace('/', '-')}.csv", rows)
    streamed = StarStore(spark, str(tmp_path / "streamed"))

    def run(checkpoint):
        query = stream_daily_ingest(streamed, str(source), no_names, str(tmp_path / checkpoint), files_per_batch=1)
        query.awaitTermination()
        assert query.exception() is None

    run("checkpoint")
    batch = StarStore(spark, str(tmp_path / "batch"))
    ingest.load_quotes(batch, daily_files.scan_daily_quotes(spark, str(source), file_order=True), no_names)
    assert (datetime.date(2024, 1, 1), "Odisha", "M1", "Paddy", Decimal("9.00")) in loaded(batch)  # first, not cheapest
    assert loaded(streamed) == loaded(batch) and sum(loaded(batch).values()) == 3
    run("checkpoint")  # nothing new
    run("another checkpoint")  # all files again: the same quotes land twice
    assert loaded(streamed) == loaded(batch)
    assert [r.state for r in streamed.read("rejects").collect()] == ["Atlantis"]


def test_files_of_a_day_in_several_batches(spark, no_names, tmp_path):
    """Neither small batches nor a late file change the facts; other days of the month stay."""
    line = "Goa,D,Market {},Rice,V,G,{},{},{},{}"
    rows = lambda day, markets: [line.format(m, day, 10 + m, 12 + m, 11 + m) for m in markets]
    source = tmp_path / "in"
    write_csv(source / "a_01-01-2024.csv", rows("01/01/2024", range(4)))
    write_csv(source / "b_01-01-2024.csv", rows("01/01/2024", range(4, 8)))
    write_csv(source / "a_02-01-2024.csv", rows("02/01/2024", range(8)))
    store = StarStore(spark, str(tmp_path / "store"))

    def run(**options):
        query = stream_daily_ingest(store, str(source), no_names, str(tmp_path / "checkpoint"), **options)
        query.awaitTermination()
        assert query.exception() is None

    run(files_per_batch=1)
    assert sum(loaded(store).values()) == 16
    write_csv(source / "c_01-01-2024.csv", rows("01/01/2024", range(6, 10)))
    run()
    whole = StarStore(spark, str(tmp_path / "whole"))
    scanned = daily_files.scan_daily_quotes(spark, str(source), file_order=True)
    ingest.load_quotes(whole, scanned, no_names)
    assert loaded(store) == loaded(whole) and sum(loaded(whole).values()) == 18
    again = ingest.load_quotes(whole, scanned, no_names)
    assert {(r.arrival_date.day, r.rows) for r in again["late"].collect()} == {(1, 12), (2, 8)}
    assert loaded(store) == loaded(whole)


def test_a_reload_builds_days_a_crash_left_out(spark, quotes_of, no_names, tmp_path):
    """A day that landed, but whose facts are gone, comes back with the next load of its month."""
    store = StarStore(spark, str(tmp_path / "store"))
    store.land(ingest.typed_batch(quotes_of([("Goa", "m1", "Wheat", "05/01/2024", 10, 10, 10)])))
    ingest.load_quotes(store, quotes_of(ROWS), no_names, reload=True)
    assert sorted(r.arrival_date.day for r in store.read("date_dim").collect()) == [1, 2, 5]
    assert sum(loaded(store).values()) == 4


def fact_files(store):
    """Day of month and write time of every fact file."""
    stored = store.read("fact_market_prices").select("date_id", F.col("_metadata.file_path").alias("file")).distinct().collect()
    found = {}
    for r in stored:
        path = Path(r.file.removeprefix("file:"))
        days = found.setdefault(path.name, (path.stat().st_mtime_ns, set()))[1]
        days.add((EPOCH + datetime.timedelta(r.date_id)).day)
    return found


def test_a_reload_replaces_its_days_only_and_empties_days(spark, quotes_of, no_names, tmp_path):
    """A late file moves the fence of a day beyond its only quote: the fact goes, and files of other days stay as they are."""
    store = StarStore(spark, str(tmp_path / "store"))
    for day in ("05/01/2024", "06/01/2024", "01/02/2024"):
        ingest.load_quotes(store, quotes_of([("Goa", "m1", "Wheat", day, 10, 10, 10)]), no_names, reload=True)
    before = fact_files(store)
    wrong_order = [("Goa", f"m{i}", "Wheat", "05/01/2024", 1009, 1000 + i, 1010) for i in range(9)]
    got = ingest.load_quotes(store, quotes_of(wrong_order), no_names, reload=True)
    log = {r.reason: r.rows for r in got["log"].collect()}
    assert log["read"] == 10 and "inserted" not in log and log["outlier"] == 1
    assert sorted(r.arrival_date.day for r in loaded_days(store)) == [1, 6]
    assert fact_files(store) == {name: there for name, there in before.items() if there[1] != {5}}
    alone = [(s, m.replace("m", "n"), c, "01/02/2024", *p) for s, m, c, _, *p in wrong_order]
    ingest.load_quotes(store, quotes_of(alone), no_names, reload=True)
    assert [r.arrival_date.day for r in loaded_days(store)] == [6]  # a month without any fact
    assert store.star().fact.count() == 1


def loaded_days(store):
    return store.read("fact_market_prices").select(F.date_from_unix_date("date_id").alias("arrival_date")).distinct().collect()


def test_a_replacement_survives_a_crash(spark, quotes_of, no_names, tmp_path, monkeypatch):
    """What was written aside completely is put in place by the next use; what was not changes nothing."""
    store = StarStore(spark, str(tmp_path / "store"))
    ingest.load_quotes(store, quotes_of([("Goa", "m1", "Wheat", "05/01/2024", 10, 10, 10)]), no_names)
    torn = tmp_path / "store" / "_replacing" / "fact_market_prices" / "torn" / "rows"
    torn.mkdir(parents=True)
    with monkeypatch.context() as patch:
        patch.setattr(StarStore, "finish_replacing", lambda self, table: None)
        late = [("Goa", m, "Wheat", "05/01/2024", 11, 11, 11) for m in ("m2", "m3")]
        ingest.load_quotes(store, quotes_of(late), no_names, reload=True)
        assert store.read("fact_market_prices").count() == 1
    assert store.star().fact.count() == 3 and not torn.exists()
    assert store.star().fact.count() == 3


def test_a_reload_lists_the_months_of_its_days_only(spark, quotes_of, no_names, tmp_path):
    store = StarStore(spark, str(tmp_path / "store"))
    for m in range(1, 5):
        load = ingest.load_quotes(store, quotes_of([("Goa", "m1", "Wheat", f"05/{m:02d}/2024", 10, 10, 10)]), no_names, reload=True)
    assert load["log"].count() == 2
    (newest,) = [r.load for r in store.read("load_log").filter("arrival_date = date'2024-04-05'").select("load").distinct().collect()]
    assert store.folders_of(newest) == ["year=2024/month=4"]
    assert store.read_folders("fact_market_prices", ["year=2024/month=4", "year=1999/month=1"]).count() == 1


def test_overview_opens_the_last_month_only(spark, quotes_of, no_names, tmp_path):
    """The stored fact is pruned by year and month, and the day limit reaches the scan."""
    store = StarStore(spark, str(tmp_path / "store"))
    days = [f"{d:02d}/{m:02d}/2024" for m in range(1, 7) for d in (10, 11)]
    ingest.load_quotes(store, quotes_of([("Goa", "m1", "Wheat", day, 10, 10, 10) for day in days]), no_names)
    star = store.star()
    for table in (
        overview.state_pricing(star), overview.price_trend(star),
        overview.price_movers(star), overview.top_commodities(star),
    ):
        table.collect()
        scans = [s for s in scans_of(table) if "fact_market_prices" in s.relation().location().rootPaths().mkString()]
        assert scans
        for scan in scans:
            assert scan.partitionFilters().nonEmpty() and "month" in scan.partitionFilters().toString()
            assert any("date_id" in f and "subquery" in f for f in scan.dataFilters().mkString("|").split("|"))
        assert max(scan.metrics().apply("numPartitions").value() for scan in scans) <= 2  # the trend begins in May
        assert max(scan.metrics().apply("numOutputRows").value() for scan in scans) <= 2


def scans_of(table):
    """The file scans of an executed plan."""
    found, left = [], [table._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node)
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            left.append(node.plan())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


HEADER = "State,District,Market,Commodity,Variety,Grade,Arrival_Date,Min_Price,Max_Price,Modal_Price"


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_columns_are_found_by_name_and_bad_lines_are_counted(spark, no_names, tmp_path):
    """Files in another order, with further columns, lines too short and too long, a blank in a file's name."""
    source = tmp_path / "in"
    write_lines(source / "plain 01-01-2024.csv", [HEADER, "Goa,D,M,Rice,V,G,01/01/2024,10,10,10", "Goa,D,M,Rye,V,G,01/01/2024,9"])
    names = ["Commodity_Code", *reversed(HEADER.split(",")), '"Note, free"']
    rows = [
        ["7", "12", "12", "12", "02/01/2024", "G", "V", "Maize", "M", "D", "Goa", '"a, b"'],
        ["7", "12", "12", "12", "02/01/2024", "G", "V", "Oats", "M", "D", "Goa", "a", "too many"],
        ["7", "12", "12", "12", "no day", "G", "V", "Oats", "M", "D", "Goa", "a"],
    ]
    write_lines(source / "coded_02-01-2024.csv", [",".join(row) for row in [names, *rows]])
    write_lines(source / "empty_03-01-2024.csv", [HEADER])
    scanned = daily_files.scan_daily_quotes(spark, str(source), file_order=True, corrupt=True)
    assert {(r.Commodity, r.file_day.day, r.corrupt is None) for r in scanned.collect()} == {
        ("Rice", 1, True), ("Rye", 1, False), ("Maize", 2, True), ("Oats", 2, False), ("Oats", 2, True),
    }
    assert daily_files.scan_daily_quotes(spark, str(source), start="2024-01-02").count() == 3
    store = StarStore(spark, str(tmp_path / "store"))
    log = {(r.arrival_date and r.arrival_date.day, r.reason): r.rows for r in ingest.load_quotes(store, scanned, no_names)["log"].collect()}
    assert log == {
        (1, "read"): 2, (1, "inserted"): 1, (1, "corrupt line"): 1,
        (2, "read"): 2, (2, "inserted"): 1, (2, "corrupt line"): 1,
        (None, "read"): 1, (None, "bad date"): 1,
    }
    streamed = StarStore(spark, str(tmp_path / "streamed"))
    query = stream_daily_ingest(streamed, str(source), no_names, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None and loaded(streamed) == loaded(store) and sum(loaded(store).values()) == 2
    write_lines(source / "headless_04-01-2024.csv", ["Goa,D,M,Rice,V,G,01/01/2024,9,11,10"])
    with pytest.raises(ValueError, match="no column"):
        daily_files.scan_daily_quotes(spark, str(source))


def test_a_load_accounts_for_every_row_and_leaves_no_scratch(spark, quotes_of, no_names, tmp_path, monkeypatch):
    used = []
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: used.append(tmp_path / f"{name}{len(used)}") or str(used[-1]))
    store = StarStore(spark, str(tmp_path / "store"))
    rows = [
        *ROWS, ROWS[0],
        ("Goa", "m1", None, "02/01/2024", 9, 10, 11), ("Goa", "m1", "Wheat", "02/01/2024", -9, 10, 11),
        ("Goa", "m1", "Rice", "02/01/2024", 900, 1000, 1100), ("Goa", "m1", "Rice", "02/01/2024", 11, 10, 12),
        ("Goa", "m1", "Wheat", "31/02/2024", 9, 10, 11),
    ]
    for reload in (False, False, True):
        out = ingest.load_quotes(store, quotes_of(rows), no_names, reload=reload)
        per_day = Counter()
        for r in out["log"].collect():
            per_day[r.arrival_date] += r.rows if r.reason == "read" else -r.rows
        assert set(per_day.values()) == {0} and len(per_day) == 3
    last = {(r.arrival_date and r.arrival_date.day, r.reason): r.rows for r in out["log"].collect()}
    assert last[2, "negative price"] == last[2, "outlier"] == last[2, "price order"] == last[2, "unknown state"] == last[2, "missing value"] == 1
    assert last[1, "repeated key"] == 1 and last[1, "inserted"] == 2 and last[1, "repeated row"] == 9 and last[None, "bad date"] == 1
    assert [r.state for r in out["rejects"].collect()] == ["Atlantis"]
    assert used and not any(path.exists() for path in used)


def summary_of(store):
    """The kept summary, and the one that the stored facts give."""
    star = store.star()
    return Counter(map(tuple, star.usage.collect())), Counter(map(tuple, summarise(star.fact).collect()))


def test_the_usage_summary_follows_every_change(spark, quotes_of, no_names, tmp_path, monkeypatch):
    """Appends, a repeated load, reloads that change and empty days, a crash before and after the files moved, an older store."""
    store = StarStore(spark, str(tmp_path / "store"))
    assert store.star().usage.count() == 0
    quote = lambda day, price, market="m1": ("Goa", market, "Wheat", day, price, price, price)
    for day, price in (("05/01/2024", 10), ("06/01/2024", 12), ("07/02/2024", 11)):
        ingest.load_quotes(store, quotes_of([quote(day, price)]), no_names)
        kept, anew = summary_of(store)
        assert kept == anew and store.stale_months() == []
    (january,) = [r for r in store.star().usage.collect() if r.month == 1]
    assert (january.n, january.total, january.low, january.high) == (2, Decimal("22.00"), Decimal("10.00"), Decimal("12.00"))
    february = {p: p.stat().st_mtime_ns for p in (tmp_path / "store/usage_summary/year=2024/month=2").iterdir()}
    ingest.load_quotes(store, quotes_of([quote("05/01/2024", 9)]), no_names)  # loaded before: late
    wrong_order = [("Goa", f"m{i}", "Wheat", "06/01/2024", 1009, 1000 + i, 1010) for i in range(9)]
    ingest.load_quotes(store, quotes_of(wrong_order), no_names, reload=True)
    kept, anew = summary_of(store)
    assert kept == anew and sum(r[2] for r in kept) == 2
    assert {p: p.stat().st_mtime_ns for p in february} == february
    alone = [(s, m.replace("m", "n"), c, "07/02/2024", *p) for s, m, c, _, *p in wrong_order]
    ingest.load_quotes(store, quotes_of(alone), no_names, reload=True)
    kept, anew = summary_of(store)
    assert kept == anew and {r[7] for r in kept} == {1}
    with monkeypatch.context() as patch:  # dies before the rows are summed
        patch.setattr(StarStore, "_merge_usage", lambda self, rows, months: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.load_quotes(store, quotes_of([quote("08/01/2024", 7)]), no_names)
    kept, anew = summary_of(store)
    assert kept == anew and sum(r[2] for r in kept) == 2
    with monkeypatch.context() as patch:  # dies when the files have moved
        patch.setattr(StarStore, "refresh_usage", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.load_quotes(store, quotes_of([quote("08/01/2024", 6)]), no_names, reload=True)
    assert store.stale_months() == ["year=2024/month=1"]
    kept, anew = summary_of(store)
    assert kept == anew and store.stale_months() == []
    (tmp_path / "store/usage_summary").rename(tmp_path / "before")  # written by a version without summaries
    ingest.load_quotes(store, quotes_of([quote("01/03/2024", 7, "m2")]), no_names)
    kept, anew = summary_of(store)
    assert kept == anew and {r[7] for r in kept} == {1, 3}


def rows_read(table, name):
    """Files and rows that the scans of a stored table read."""
    scans = [s for s in scans_of(table) if name in s.relation().location().rootPaths().mkString()]
    of = lambda metric: sum(s.metrics().apply(metric).value() for s in scans)
    return of("numFiles") if scans else 0, of("numOutputRows") if scans else 0


def many_months(spark, quotes_of, no_names, tmp_path):
    store = StarStore(spark, str(tmp_path / "store"))
    days = [f"{d:02d}/{m:02d}/{y}" for y in (2023, 2024) for m in range(1, 13) for d in (10, 11)]
    markets = [("Goa", "m1", 1), ("Goa", "m2", 2), ("Odisha", "m3", 4)]
    rows = [(state, m, c, day, p, p, p) for day in days for state, m, p in markets for c in ("Wheat", "Rice")]
    sold_before = [("Goa", "m1", "Ragi", f"{d:02d}/03/2023", 3, 3, 3) for d in range(1, 9)]
    ingest.load_quotes(store, quotes_of(rows + sold_before), no_names)
    return store


def test_counts_and_newest_rows_come_without_the_whole_fact(spark, quotes_of, no_names, tmp_path):
    store = many_months(spark, quotes_of, no_names, tmp_path)
    star = store.star()
    bare = dataclasses.replace(star, usage=None)
    facts = "fact_market_prices"
    for table in (
        overview.kpi_total_records(star), overview.kpi_total_records(star, "Goa"), overview.kpi_market_count(star, "Goa"),
        overview.kpi_commodity_count(star, "Goa"), overview.priciest_commodities(star), overview.monthly_trend(star),
        filters.commodities_in_market(star, 1), explorer.variety_comparison_by_market(star),
    ):
        table.collect()
        assert rows_read(table, facts) == (0, 0) and rows_read(table, "usage_summary")[0] > 0
    kpis = overview.overview_kpis(star, "Goa")
    assert kpis.collect() == overview.overview_kpis(bare, "Goa").collect()
    assert rows_read(kpis, facts)[1] <= 6  # the latest day, for its average
    in_order = lambda table: sorted(map(repr, table.collect()))
    for same in (
        overview.overview_by_state, overview.monthly_trend, overview.priciest_commodities, filters.commodities_by_market,
        explorer.variety_comparison_by_market, lambda s: overview.kpi_commodity_count(s, "Nowhere"),
        lambda s: overview.kpi_market_count(s, "Goa"), lambda s: overview.kpi_total_records(s, "Kerala"),
    ):
        assert in_order(same(star)) == in_order(same(bare))
    for rows, selection, months in (
        (5, {"market_id": 1, "commodity": "Wheat"}, 3), (4, {"commodity": "Rice", "state_id": 6}, None),
        (5, {}, 1), (90, {"market_id": 2}, 24), (3, {"commodity": "Ragi"}, 22), (3, {"commodity": "none"}, 0),
    ):
        history = explorer.history_of(star, rows, **selection)
        assert history.collect() == explorer.price_history(explorer.dynamic_filter(bare, **selection), rows).collect()
        if months is not None:
            assert rows_read(history, facts)[0] <= months * 3  # a month has at most as many files as days and a cut range


def test_forecast_requests_read_the_newest_months(spark, quotes_of, no_names, tmp_path):
    star = many_months(spark, quotes_of, no_names, tmp_path).star()
    keys = star.usage.select("market_id", "commodity_id").distinct()
    series = features.recent_series(star, keys.join(star.commodity_dim.filter("commodity = 'Wheat'"), "commodity_id").select(*keys.columns), 14)
    assert {r["count"] for r in series.groupBy("market_id").count().collect()} == {14}
    series.collect()
    assert rows_read(series, "fact_market_prices")[1] <= 7 * 2 * 6
    whole = dataclasses.replace(star, usage=None)
    buffers = lambda s: sorted(map(repr, forecast.latest_buffer(features.recent_series(s, keys, 14)).collect()))
    assert buffers(star) == buffers(whole)


def test_distinct_ids_beyond_one_bitmap(spark):
    """Ids of several bitmaps, 0 among them, repeated, of a hot market, and of a market that no place has."""
    schema = "market_id int, commodity_id int, n long, total decimal(28,2), low decimal(12,2), high decimal(12,2), year int, month int"
    ids = [0, 1, 32767, 32768, 32769, 65536, 65537, 100000]
    rows = [(m, c, 2, Decimal(1), Decimal(1), Decimal(1), 2024, month) for m in (0, 1, 40000, 9) for c in ids[m % 3:] for month in (1, 2)]
    star = Star(None, None, None, None, None, usage=spark.createDataFrame(rows, schema))
    places = spark.createDataFrame([(0, 1), (1, 1), (40000, 2)], "market_id int, state_id int")
    got = {r.state_id: tuple(r)[1:] for r in distinct_ids(star, places, "state_id").collect()}
    assert got == {1: (2 * 2 * 15, 8, 2), 2: (2 * 2 * 7, 7, 1)}


def test_the_audit_is_one_shuffle_and_finds_every_kind_of_fault(spark):
    """Repeats, orphans and NULLs of each table; NULL keys repeat like values and refer to nothing; empty tables give zeros."""
    make = lambda table, *rows: spark.createDataFrame(
        rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.STAR_TABLES[table].fields if f.name not in ("year", "month") or table == "date_dim")
    )
    day = lambda i: (i, EPOCH + datetime.timedelta(i), 1, 1, 1970, None if i == 2 else "Fri")
    p = Decimal(1)
    star = Star(
        make("state_dim", (1, "a"), (2, "a"), (2, None)),
        make("market_dim", (1, "m", "d", 1), (2, "m", "d", 1), (3, "m", "d", 9), (4, None, "d", None), (5, "m\x1fd", "", 1), (6, "m", "\x1fd", 1)),
        make("commodity_dim", (1, "c", "v", "g"), (2, "c", "v", None), (3, "c", "v", None)),
        make("date_dim", day(1), day(2), day(2)),
        make("fact_market_prices", *[(1, 1, 1, p, p, p)] * 3, (1, 7, 1, p, p, p), (5, 7, 8, p, None, p), (None, 1, 1, p, p, None), (None, 1, 1, p, p, p)),
        make("model_evaluation", (1, 1, p, p, p), (1, 9, p, p, p)),
        make("feature_importance"),
    )
    report = audit.constraint_audit(star)
    rows = report.collect()
    assert len(rows) == 33 and {(r.table_name, r.rule): r.n for r in rows if r.n} == {
        ("state_dim", "unique(state_id)"): 1, ("state_dim", "unique(state)"): 1, ("state_dim", "not null(state)"): 1,
        ("market_dim", "unique(market, district, state_id)"): 1, ("market_dim", "references(state_id)"): 1, ("market_dim", "not null(market)"): 1,
        ("commodity_dim", "unique(commodity, variety, grade)"): 1, ("commodity_dim", "not null(grade)"): 2,
        ("date_dim", "unique(date_id)"): 1, ("date_dim", "unique(arrival_date)"): 1, ("date_dim", "not null(weekday)"): 2,
        ("fact_market_prices", "unique(date_id, market_id, commodity_id)"): 2, ("fact_market_prices", "references(date_id)"): 1,
        ("fact_market_prices", "references(market_id)"): 2, ("fact_market_prices", "references(commodity_id)"): 1,
        ("fact_market_prices", "not null(max_price)"): 1, ("fact_market_prices", "not null(modal_price)"): 1,
        ("model_evaluation", "references(commodity_id)"): 1,
    }
    plan = audit.constraint_audit(star)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 3  # the keys; two sums of a row per key's number and task
    star.model_evaluation = star.feature_importance = None
    assert audit.constraint_audit(star).count() == 27


def busy_store(spark, tmp_path):
    """Two months and a day of daily prices of 40 markets and 5 commodities."""
    store = StarStore(spark, str(tmp_path / "store"))
    first = (datetime.date(2024, 1, 1) - EPOCH).days
    days, markets, commodities = (spark.range(*span).toDF(name) for span, name in (
        ((first, first + 61), "date_id"), ((1, 41), "market_id"), ((1, 6), "commodity_id"),
    ))
    price = (F.col("market_id") * 100 + F.col("commodity_id")).cast(schemas.PRICE)
    rows = days.join(F.broadcast(markets)).join(F.broadcast(commodities)).select(
        *[F.col(c).cast("int") for c in ("date_id", "market_id", "commodity_id")],
        *[price.alias(c) for c in ("min_price", "max_price", "modal_price")],
    )
    store.append_fact(rows)
    return store


def test_months_laid_out_by_series(spark, tmp_path, monkeypatch):
    """A series' read decodes about a page of a month; rows, summary and reloads are those of the other layout, crashes are completed."""
    store = busy_store(spark, tmp_path)
    wanted = spark.createDataFrame([(7, 3), (7, 4)], "market_id int, commodity_id int")
    facts = lambda: sorted(map(repr, store.star().fact.collect()))
    before, summary = facts(), summary_of(store)
    by_day = features.whole_series(store.star(), wanted)
    assert len(by_day.collect()) == 122 and rows_read(by_day, "fact_market_prices")[1] > 6000
    with monkeypatch.context() as patch:  # dies when the files are written aside
        finish, calls = StarStore.finish_replacing, []
        patch.setattr(StarStore, "finish_replacing", lambda self, table: calls.append(1) or (finish(self, table) if len(calls) < 2 else 1 / 0))
        with pytest.raises(ZeroDivisionError):
            store.arrange_by_series(page_rows=100)
    assert facts() == before and summary_of(store) == summary
    assert store.stale_months() == [] and store.arrange_by_series() == []
    by_series = features.whole_series(store.star(), wanted)
    assert sorted(map(repr, by_series.collect())) == sorted(map(repr, by_day.collect()))
    assert rows_read(by_series, "fact_market_prices")[1] <= 2 * 3 * 100 + 200  # the last month, one day, stays as it was
    late = spark.createDataFrame([((datetime.date(2024, 1, 5) - EPOCH).days, 99, 9, *[Decimal("5.00")] * 3)], "date_id int, market_id int, commodity_id int, " + ", ".join(f"{c} decimal(12,2)" for c in ("min_price", "max_price", "modal_price")))
    store.replace_days("fact_market_prices", late, spark.createDataFrame([(datetime.date(2024, 1, 5),)], "arrival_date date"), ["year=2024/month=1"])
    assert len(facts()) == len(before) - 200 + 1
    kept, anew = summary_of(store)
    assert kept == anew
    assert store.arrange_by_series() == ["year=2024/month=1"] and len(facts()) == len(before) - 199
    assert features.whole_series(store.star(), wanted.limit(0)).count() == 0
    assert StarStore(spark, str(tmp_path / "none")).arrange_by_series() == []
