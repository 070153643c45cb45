import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestlens.functions import dates, numeric, quantiles, text


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_title_case_matches_python(spark):
    names = [
        "lady's finger", "T.V. cumbu", "SAME/SAVI", "pea pod/pea cod/हरी मटर", "ridgeguard(tori)",
        "dādra and nagar", "2nd grade", "a-b c_d", "ÉCLAIR", "o'neil 3x", "",
    ]
    assert values(spark, names, text.title_case(F.col("x"))) == [n.title() for n in names]


def test_strip_matches_python(spark):
    names = ["  a ", "\ta b\n", " x ", "none", " 　 ", "\x1cq\x1f"]
    assert values(spark, names, text.strip(F.col("x"))) == [n.strip() for n in names]


def test_base_name(spark):
    names = ["Arecanut(Betelnut/Supari)", "Paddy(Dhan)(Common)", "  green  gram (moong)", "(x)", "rice"]
    assert values(spark, names, text.base_name(F.col("x"))) == ["Arecanut", "Paddy", "Green  Gram", "", "Rice"]


def test_parse_day_first(spark):
    texts = ["10/06/2026", "1/6/2026", "05-04-2020", "2020-04-05", "31/02/2025", "x", None, " 01/02/2021 "]
    d = datetime.date
    expected = [
        d(2026, 6, 10), d(2026, 6, 1), d(2020, 4, 5), d(2020, 4, 5), None, None, None, d(2021, 2, 1),
    ]
    assert values(spark, texts, dates.parse_day_first(F.col("x"))) == expected


def test_weekday_and_label(spark):
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(n) for n in range(9)]
    assert values(spark, days, dates.weekday_number(F.col("x")), "date") == [d.weekday() for d in days]
    assert values(spark, days, dates.weekday_name(F.col("x")), "date") == [d.strftime("%A") for d in days]
    assert values(spark, days, dates.short_date(F.col("x")), "date") == [d.strftime("%b %d") for d in days]


@pytest.mark.parametrize("places", [1, 2, 4])
def test_rounding_matches_python(spark, places):
    rng = random.Random(7)
    numbers = [2.675, 0.125, 0.375, 1.005, 100.015, -2.675, -0.125, 0.0, 1e9 + 0.005, 2.5, 0.05]
    numbers += [rng.randrange(10**9) / 1000 for _ in range(3000)]
    numbers += [rng.uniform(-1e6, 1e6) for _ in range(2000)]
    numbers += [rng.randrange(10**8) / rng.randrange(1, 50) for _ in range(2000)]
    got = values(spark, numbers, numeric.round_half_even(F.col("x"), places), "double")
    assert got == [round(x, places) for x in numbers]


def test_exact_avg_of_nothing(spark):
    df = spark.createDataFrame([], "x decimal(12,2)")
    assert df.agg(numeric.exact_avg(F.col("x")).alias("a")).first().a is None


@pytest.mark.parametrize(
    "prices, q1, q3", [([1, 2, 3, 4], 1.75, 3.25), ([1, 2, 3, 4, 100], 2, 4), ([5], 5, 5), ([7, 7, 7], 7, 7)]
)
def test_quartiles_by_hand(spark, prices, q1, q3):
    df = spark.createDataFrame([("a", p) for p in prices], "g string, p int").select(
        "g", F.col("p").cast("decimal(20,6)").alias("p")
    )
    row = quantiles.group_quartiles(df, ["g"], "p").first()
    assert (float(row.q1), float(row.q3)) == (q1, q3)
    fences = quantiles.iqr_fences(quantiles.group_quartiles(df, ["g"], "p"), ["g"]).first()
    assert float(fences.lower_fence) == q1 - 1.5 * (q3 - q1)
    assert float(fences.upper_fence) == q3 + 1.5 * (q3 - q1)


def test_quartiles_with_a_hot_group(spark):
    """One group holds most rows; values repeat, are negative, and span many ranges."""
    rng = random.Random(3)
    sizes = {"hot": 4000, "a": 11, "b": 2, "c": 401}
    rows = [
        (g, round(rng.choice([1, 10, 1000, 100000]) * rng.uniform(-1, 1), rng.choice([0, 2])))
        for g, n in sizes.items() for _ in range(n)
    ]
    df = spark.createDataFrame(rows, "g string, p double").select("g", F.col("p").cast("decimal(20,6)").alias("p"))
    got = {r.g: (float(r.q1), float(r.q3)) for r in quantiles.group_quartiles(df.repartition(7), ["g"], "p").collect()}
    for g in sizes:
        expected = np.quantile([p for name, p in rows if name == g], [0.25, 0.75])
        assert got[g] == pytest.approx(tuple(expected), abs=1e-9)


def test_sample_std(spark):
    df = spark.createDataFrame([(7, 28, 140)], "n int, s int, q int").select(
        *[F.col(c).cast("decimal(18,0)").alias(c) for c in "nsq"]
    )
    got = df.select(numeric.sample_std(F.col("n"), F.col("s"), F.col("q")).alias("x")).first().x
    assert math.isclose(got, np.std([1, 2, 3, 4, 5, 6, 7], ddof=1))


def test_dates_with_a_time_of_day(spark):
    from pyspark.sql import functions as F

    from harvestlens.functions import dates

    rows = spark.createDataFrame([("2026-06-10T00:00:00",), ("10/06/2026 00:00",), ("10-06-2026 7:05:09.5Z",), ("10/06/2026 x",)], "t string")
    found = [str(r[0]) for r in rows.select(dates.parse_day_first(F.col("t"))).collect()]
    assert found == ["2026-06-10"] * 3 + ["None"]


def test_usual_dates_are_taken_apart_by_place(spark):
    from datetime import date

    texts = ["05/11/2024", "05-11-2024", "05/11-2024", "31/02/2025", " 05/11/2024 ", "5/11/2024", "2024-11-05", "05/11/20245", "05/11/2024\n", None]
    wanted = [date(2024, 11, 5)] * 3 + [None] + [date(2024, 11, 5)] * 3 + [None] * 3
    assert values(spark, texts, dates.parse_day_first(F.col("x"))) == wanted
    plan = spark.createDataFrame([("05/11/2024",)], "x string").select(dates.parse_day_first(F.col("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert dates._TEN_DAY_FIRST in plan


def test_names_whose_words_begin_at_blanks_need_no_marks(spark):
    plain = ["jammu & kashmir", "NCT of delhi (1)", "a-  - B", "", "1 a", "ab & " * 60000 + "z"]
    other = ["lady's", "a-b", "(x) y", " x", "x ", "a  &b", "1a"]
    matched = values(spark, plain + other, F.col("x").rlike(text._PLAIN_STRIPPED))
    assert matched == [True] * len(plain) + [False] * len(other)
    assert values(spark, plain + other, text.clean_text(F.col("x"))) == [x.strip().title() for x in plain + other]
    rng = random.Random(8)
    many = ["".join(rng.choice("aB zQ -&'(1") for _ in range(rng.randrange(9))) for _ in range(3000)]
    assert values(spark, many, text.clean_text(F.col("x"))) == [x.strip().title() for x in many]
