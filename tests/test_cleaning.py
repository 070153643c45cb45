import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from harvestlens.operators import cleaning
from harvestlens.schemas import RAW_QUOTE
from harvestlens.sources import daily_files, lookups

DAY = "10/06/2026"


def dirty(spark):
    rows = [
        (" orissa", "cuttack ", "MARKET one", "Paddy(Dhan)(Common)", "common", "FAQ", DAY, "1990", "2010", "2000"),
        (" orissa", "cuttack ", "MARKET one", "Paddy(Dhan)(Common)", "common", "FAQ", DAY, "1990", "2010", "2000"),
        ("NCT of Delhi", "d", "m", "lady's finger", None, "FAQ", DAY, "1800", "2200", "2000"),
        ("NCT of Delhi", "d", "m", "T.V. Cumbu", "x", "FAQ", "31/02/2025", "1800", "2200", "2000"),
        ("Jammu & Kashmir", "d", "m", "Same/Savi", "x", "FAQ", DAY, "-5", "2200", "2000"),
        ("Jammu & Kashmir", "d", "m", "Same/Savi", "x", "FAQ", DAY, "1900", "1950", "2000"),
        ("Kerala", "d", "m", "Saffron", "x", "FAQ", DAY, "190000", "210000", "200000"),
        ("Atlantis", "d", "m", "Rice", "x", "faq", DAY, "1950", "2150", "2050"),
        ("Kerala", "d", "m", "Rice", "x", "faq", DAY, "abc", "2100", "2000"),
        ("Kerala", "d", "m", "Rice", "y", "faq", DAY, "1890", "1910", "1900"),
        ("Kerala", "d", "m", "Rice", "z", "faq", DAY, "2090", "2110", "2100"),
    ]
    return spark.createDataFrame(rows, RAW_QUOTE)


@pytest.fixture(scope="module")
def names(spark):
    pairs = [("Paddy", "Rice"), ("Rice", "Fine Rice")]
    return spark.createDataFrame(pairs, "raw_name string, english_name string")


def test_all_steps(spark, names):
    cleaned = cleaning.clean_quotes(dirty(spark), names)
    got = sorted((r.state, r.market, r.commodity, r.variety, r.grade) for r in cleaned.collect())
    assert got == [
        ("Atlantis", "M", "Fine Rice", "X", "Faq"),
        ("Kerala", "M", "Fine Rice", "Y", "Faq"),
        ("Kerala", "M", "Fine Rice", "Z", "Faq"),
        # mapped once: Paddy -> Rice, not on to Fine Rice
        ("Odisha", "Market One", "Rice", "Common", "Faq"),
    ]


def test_row_order_and_partitions_do_not_matter(spark, names):
    raw = dirty(spark)
    rows = lambda df: Counter(map(tuple, cleaning.clean_quotes(df, names).collect()))
    assert rows(raw.repartition(5)) == rows(raw.orderBy(F.desc("Modal_Price")).coalesce(1))


def test_rowwise_steps_are_idempotent(spark):
    typed = cleaning.type_quotes(cleaning.rename_quotes(dirty(spark)))
    for step in (
        cleaning.drop_bad_dates, cleaning.dedup_rows, cleaning.dropna_any, cleaning.nonneg_prices,
        cleaning.price_order_check, cleaning.clean_text,
    ):
        once = step(typed)
        assert Counter(map(tuple, step(once).collect())) == Counter(map(tuple, once.collect()))


def test_type_quotes_is_the_two_steps(spark):
    renamed = cleaning.rename_quotes(dirty(spark))
    both = cleaning.type_prices(cleaning.parse_arrival_date(renamed))
    assert Counter(map(tuple, cleaning.type_quotes(renamed).collect())) == Counter(map(tuple, both.collect()))


def test_outlier_fences_are_per_day(spark, quotes_of):
    rows = [("Goa", f"m{i}", "Rice", "01/01/2024", p, p, p) for i, p in enumerate([1, 2, 3, 4, 100])]
    rows += [("Goa", f"m{i}", "Rice", "02/01/2024", p, p, p) for i, p in enumerate([100, 101, 102])]
    typed = cleaning.type_quotes(cleaning.rename_quotes(quotes_of(rows)))
    kept = cleaning.iqr_outlier_filter(typed)
    by_day = Counter(r.arrival_date for r in kept.collect())
    assert by_day == {datetime.date(2024, 1, 1): 4, datetime.date(2024, 1, 2): 3}
    grouped = cleaning.iqr_outlier_filter(typed, ["commodity"])
    assert grouped.count() == 8


def test_dedup_keeps_the_first_position(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "x string, sequence int")
    assert sorted(map(tuple, cleaning.dedup_rows(df, "sequence").select("x", "sequence").collect())) == [("a", 1), ("b", 2)]


def test_state_aliases_reach_the_seed(spark):
    spellings = ["Orissa", "NCT of Delhi", "keralam", "Jammu & Kashmir", "dadra & nagar haveli", "Goa", "Nowhere"]
    df = spark.createDataFrame([(s, "d", "m", "v", "g") for s in spellings], "state string, district string, market string, variety string, grade string")
    states = [r.state for r in cleaning.canonical_state(cleaning.clean_text(df)).collect()]
    assert states == [
        "Odisha", "Delhi", "Kerala", "Jammu and Kashmir", "Dādra and Nagar Haveli and Damān and Diu", "Goa", "Nowhere",
    ]
    assert lookups.seed_states(spark).count() == 36


def test_skip_loaded_days(spark, quotes_of):
    rows = [("Goa", "m", "Rice", day, 1, 1, 1) for day in ("01/01/2024", "02/01/2024", "03/01/2024")]
    typed = cleaning.type_quotes(cleaning.rename_quotes(quotes_of(rows)))
    fact = spark.createDataFrame([(19724,)], "date_id int")  # 2024-01-02
    kept = cleaning.skip_loaded_days(typed, fact)
    assert sorted(r.arrival_date.day for r in kept.collect()) == [1, 3]
    assert cleaning.skip_loaded_days(typed, fact.limit(0)).count() == 3


def write_csv(path, rows, header="State,District,Market,Commodity,Variety,Grade,Arrival_Date,Min_Price,Max_Price,Modal_Price"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n")


def test_scan_with_fallback_missing_tokens_and_order(spark, tmp_path):
    line = "Goa,D,M,{},V,G,{},1,2,{}"
    write_csv(tmp_path / "a/prices_01-01-2024.csv", [line.format("Rice", "01/01/2024", 1), line.format("NA", "01/01/2024", 2)])
    write_csv(tmp_path / "b/prices_01-01-2024.csv", [line.format("Old", "01/01/2024", 9)])
    write_csv(tmp_path / "b/prices_02-01-2024.csv", [line.format("Wheat", "02/01/2024", 3)])
    scanned = daily_files.scan_daily_quotes(
        spark, str(tmp_path / "a"), str(tmp_path / "b"), "2024-01-01", "2024-01-31", file_order=True
    )
    rows = [(r.Commodity, r.Modal_Price, r.file_day.day) for r in scanned.orderBy("sequence").collect()]
    assert rows == [("Rice", "1", 1), (None, "2", 1), ("Wheat", "3", 2)]
    assert daily_files.scan_daily_quotes(spark, str(tmp_path / "b"), end="2024-01-01").count() == 1
    spine = daily_files.date_spine(spark, "2024-01-01", "2024-01-03")
    loaded = scanned.select(F.col("file_day").alias("arrival_date"))
    report = daily_files.missing_days(spine, loaded, loaded.filter("arrival_date = '2024-01-02'"))
    assert sorted((r.arrival_date.day, r.reason) for r in report.collect()) == [(2, "fetch failed midway"), (3, "no data")]
    assert [r.day_text for r in spine.orderBy("arrival_date").collect()] == ["01/01/2024", "02/01/2024", "03/01/2024"]


def test_record_pages(spark, tmp_path):
    (tmp_path / "pages.json").write_text('{"records":[{"State":"Goa","Modal_Price":"5"},{"State":"Assam"}]}\n{"records":[]}\n')
    records = daily_files.flatten_record_pages(daily_files.read_record_pages(spark, str(tmp_path)))
    assert sorted((r.State, r.Modal_Price) for r in records.collect()) == [("Assam", None), ("Goa", "5")]


def test_name_map_file(spark, tmp_path, quotes_of):
    (tmp_path / "names.json").write_text('{\n  "Paddy": "Rice",\n  "Jowar": "Sorghum"\n}')
    names = lookups.load_name_map(spark, str(tmp_path / "names.json"))
    assert sorted(map(tuple, names.collect())) == [("Jowar", "Sorghum"), ("Paddy", "Rice")]
    quotes = spark.createDataFrame([("Paddy",), ("Ragi",), ("Ragi",)], "commodity string")
    assert [tuple(r) for r in lookups.unmapped_names(quotes, names).collect()] == [("Ragi", "Ragi")]
    assert lookups.extend_name_map(quotes, names).count() == 3
