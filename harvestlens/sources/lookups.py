"""Lookup tables: the state seed, state aliases and the commodity name map."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.constants import STATE_ALIASES, STATE_SEED
from harvestlens.schemas import STATE_DIM


def seed_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATE_SEED, STATE_DIM)


def state_aliases(spark: SparkSession) -> DataFrame:
    """(state, canonical): the 16 known spellings."""
    return spark.createDataFrame(list(STATE_ALIASES.items()), "state string, canonical string")


def name_pairs(json_text: Column) -> Column:
    """JSON object text -> rows (raw_name, english_name), to be used in a select."""
    return F.explode(F.from_json(json_text, "map<string,string>")).alias("raw_name", "english_name")


def load_name_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object {raw name: English name} as rows.

    The object is one document, so it is parsed by one task; a map beyond the size of a
    lookup belongs in a table, which every operator here takes just as well.
    """
    return spark.read.text(path, wholetext=True).select(name_pairs(F.col("value")))


def unmapped_names(quotes: DataFrame, name_map: DataFrame) -> DataFrame:
    """Distinct commodity names the map lacks, as new pairs that map to themselves."""
    known = name_map.select(F.col("raw_name").alias("commodity"))
    return (
        quotes.select("commodity").distinct()
        .join(known, "commodity", "left_anti")
        .select(F.col("commodity").alias("raw_name"), F.col("commodity").alias("english_name"))
    )


def extend_name_map(quotes: DataFrame, name_map: DataFrame) -> DataFrame:
    return name_map.unionByName(unmapped_names(quotes, name_map))
