"""Types that change from message to message, by path.

Messages are read as variants, which keep every key and the type each value was sent with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record(text: Column | str) -> Column:
    """A JSON text as a variant; null where it is none."""
    return F.try_parse_json(text)


def _type(value: Column) -> Column:
    """``OBJECT``, ``ARRAY`` or the type of a scalar; numbers with a fraction by what they need."""
    named = F.schema_of_variant(value)
    return F.regexp_extract(named, "^[A-Z ]+", 0)


def type_counts(records: DataFrame, column: str = "record", *, depth: int = 3) -> DataFrame:
    """``path``, ``type`` and ``n``: how often a value of each type was sent at each path.

    Paths go ``depth`` levels down, ``$.key`` for a key and ``[*]`` for the elements of an array;
    deeper values count as what holds them. Counted before the shuffle.
    """
    spark = records.sparkSession
    level = records.select(F.lit("$").alias("path"), F.col(column).alias("value")).where("value IS NOT NULL")
    levels = []
    for down in range(depth + 1):
        levels.append(level.select("path", _type(F.col("value")).alias("type")))
        if down < depth:
            nested = level.where(_type(F.col("value")).isin("OBJECT", "ARRAY")).withColumnRenamed("value", "outer_")
            parts = nested.lateralJoin(spark.tvf.variant_explode(F.col("outer_").outer()))
            step = F.when(F.col("key").isNull(), F.lit("[*]")).otherwise(F.concat(F.lit("."), "key"))
            level = parts.select(F.concat("path", step).alias("path"), "value")
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    return every.groupBy("path", "type").agg(F.count("*").alias("n"))


def drifting(counts: DataFrame) -> DataFrame:
    """The paths at which values of several types were sent; null has no type of its own."""
    some = F.col("type") != "VOID"
    several = counts.where(some).groupBy("path").agg(F.count("*").alias("types")).where("types > 1")
    return counts.join(several.select("path"), "path", "left_semi")


def merged_type(records: DataFrame, column: str = "record") -> DataFrame:
    """One row, ``type``: the least type that holds all records."""
    return records.agg(F.schema_of_variant_agg(column).alias("type"))
