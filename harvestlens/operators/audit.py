"""What the star schema's constraints would refuse, as a report of violations."""

from dataclasses import dataclass, field
from functools import reduce
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _report(table: str, rule: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "n"
    )


def unique_violations(table: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return _report(table, f"unique({', '.join(keys)})", repeated)


TRIPLE, PLACE, SERIES = ["commodity", "variety", "grade"], ["market", "district", "state_id"], ["market_id", "commodity_id"]
OF_SERIES = {"market_id": "market_dim", "commodity_id": "commodity_dim"}


@dataclass
class Rules:
    """Unique keys, references (column: table with that key) and NOT NULL columns of a table."""

    unique: list[list[str]]
    references: dict[str, str] = field(default_factory=dict)
    not_null: list[str] = field(default_factory=list)


STAR_RULES = {
    "state_dim": Rules([["state_id"], ["state"]], not_null=["state"]),
    "commodity_dim": Rules([["commodity_id"], TRIPLE], not_null=TRIPLE),
    "market_dim": Rules([["market_id"], PLACE], {"state_id": "state_dim"}, ["market", "district"]),
    "date_dim": Rules([["date_id"], ["arrival_date"]], not_null=["arrival_date", "day", "month", "year", "weekday"]),
    "fact_market_prices": Rules(
        [["date_id", *SERIES]], {"date_id": "date_dim"} | OF_SERIES, ["min_price", "max_price", "modal_price"]
    ),
    "model_evaluation": Rules([SERIES], OF_SERIES),
    "feature_importance": Rules([[*SERIES, "feature_name"]], OF_SERIES),
}
_NUMBERS, _TEXTS = ["i0", "i1", "i2"], ["s0", "s1", "s2"]


def _slots(df: DataFrame, keys: list[str]) -> list[Column]:
    """A key of up to three numbers (days count as such) and three texts, in typed columns that all keys share."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [F.col(k) for k in keys if isinstance(kinds[k], T.StringType)]
    numbers = [
        F.unix_date(k) if isinstance(kinds[k], T.DateType) else F.col(k) for k in keys if not isinstance(kinds[k], T.StringType)
    ]
    filled = [
        *[(n.cast("long"), name) for n, name in zip_longest(numbers, _NUMBERS, fillvalue=F.lit(None))],
        *[(t.cast("string"), name) for t, name in zip_longest(texts, _TEXTS, fillvalue=F.lit(None))],
    ]
    return [value.alias(name) for value, name in filled]


def violations(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """(table_name, rule, n) for every rule, from one shuffle of all tables' keys.

    Every row becomes one entry per key it has and per key it refers to. Entries are counted by (key's number, key): a key that
    its own table holds twice is a repeat, one that only other tables hold has orphans. Tasks combine entries before the
    shuffle, so a key that a third of all rows refer to is one entry per task. NULL is a value of a unique key, and refers to nothing.
    NULLs in columns that may not have any are entries as well, one number per column.
    """
    rules = {name: rule for name, rule in rules.items() if name in tables}
    numbers = {key: i for i, key in enumerate([
        *[(name, *key) for name, rule in rules.items() for key in rule.unique],
        *[(name, "not null", c) for name, rule in rules.items() for c in rule.not_null],
    ])}
    users = {}  # of a key: the tables that refer to it
    for name, rule in rules.items():
        for c, parent in rule.references.items():
            users.setdefault((parent, c), []).append(name)
    counts = ["own", *[f"user_{i}" for i in range(max(map(len, users.values())))]]

    def entry(df: DataFrame, number: int, key: list[str], count: str) -> Column:
        filled = [F.lit(int(c == count)).cast("long").alias(c) for c in counts]
        return F.struct(F.lit(number).alias("key"), *_slots(df, key), *filled)

    entries = []
    for name, rule in rules.items():
        df = tables[name]
        all_keys = [entry(df, numbers[name, *key], key, "own") for key in rule.unique]
        all_keys += [entry(df, numbers[p, c], [c], f"user_{users[p, c].index(name)}") for c, p in rule.references.items()]
        found = F.array(*all_keys)
        if rule.not_null:
            missing = [F.when(F.col(c).isNull(), entry(df, numbers[name, "not null", c], [], "own")) for c in rule.not_null]
            some_missing = reduce(Column.__or__, [F.col(c).isNull() for c in rule.not_null])
            found = F.when(some_missing, F.concat(found, F.array(*missing))).otherwise(found)
        entries.append(df.select(F.inline(found)).filter("key IS NOT NULL"))
    by_key = reduce(DataFrame.unionByName, entries).groupBy("key", *_NUMBERS, *_TEXTS).agg(*[F.sum(c).alias(c) for c in counts])
    some = F.coalesce(*[F.col(c).cast("string") for c in _NUMBERS + _TEXTS]).isNotNull()
    orphans = [F.sum(F.when((F.col("own") == 0) & some, F.col(c)).otherwise(0)).alias(c) for c in counts[1:]]
    per_key = by_key.groupBy("key").agg(F.sum("own").alias("own"), F.count_if(F.col("own") > 1).alias("repeats"), *orphans)

    report = []
    for name, rule in rules.items():
        report += [(name, f"unique({', '.join(key)})", numbers[name, *key], "repeats") for key in rule.unique]
        report += [
            (name, f"references({c})", numbers[p, c], f"user_{users[p, c].index(name)}") for c, p in rule.references.items()
        ]
        report += [(name, f"not null({c})", numbers[name, "not null", c], "own") for c in rule.not_null]
    totals = per_key.agg(*[
        F.coalesce(F.max(F.when(F.col("key") == number, F.col(count))), F.lit(0)).cast("long").alias(f"n{i}")
        for i, (_, _, number, count) in enumerate(report)
    ])
    rows = [
        F.struct(F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), F.col(f"n{i}").alias("n"))
        for i, (name, rule, _, _) in enumerate(report)
    ]
    return totals.select(F.inline(F.array(*rows)))


def constraint_audit(star) -> DataFrame:
    """(table_name, rule, n) for every key, reference and NOT NULL of the star."""
    tables = {
        "state_dim": star.state_dim, "commodity_dim": star.commodity_dim, "market_dim": star.market_dim,
        "date_dim": star.date_dim, "fact_market_prices": star.fact,
        "model_evaluation": star.model_evaluation, "feature_importance": star.feature_importance,
    }
    return violations({name: table for name, table in tables.items() if table is not None}, STAR_RULES)
