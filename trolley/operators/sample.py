"""Looking at a table before it is written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, n: int = 5, *order: str) -> DataFrame:
    """The first ``n`` rows; which ones is only defined with ``order``."""
    return (df.orderBy(*order) if order else df).limit(n)


def lot(key: Sequence[str], seed: int = 0) -> Column:
    """What decides whether a row is sampled: ``md5(seed|key|...)``, ``\\N`` for null."""
    parts = (F.coalesce(F.col(name).cast("string"), F.lit("\\N")) for name in key)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def bottom_k(df: DataFrame, k: int, key: Sequence[str], *, by: Sequence[str] = (), seed: int = 0) -> DataFrame:
    """The ``k`` rows whose keys draw the least lots, of the table or of every group of ``by``.

    The same keys give the same rows however the table is partitioned, and the sample of a table is
    part of those of its parts, so samples of batches merge by sampling them again. A task ships at
    most ``k`` rows per group. Of rows with one key any may come.
    """
    order = [lot(key, seed), *key]
    if not by:
        return df.orderBy(*order).limit(k)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """``(table_name, n_rows)`` of a frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
