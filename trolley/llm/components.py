"""Connected components of a graph that is too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``edges``
    (columns ``a`` and ``b``) but the roots themselves.

    Large-star and small-star steps in turn: every node hooks its larger, then its smaller
    neighbours to the smallest one, until each component is a star. Rounds grow with the
    logarithm of the size; neighbours of a node are never gathered, only their minimum is.
    """
    a, b = F.col("a"), F.col("b")
    stars = (
        edges.where(a != b)
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
        .checkpoint()
    )
    before = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64(a, b).cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return stars.select(a.alias("node"), b.alias("root"))
        before = state
        both = stars.unionByName(stars.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = (
            both.join(least, "a")
            .where(b > a)
            .select(b.alias("a"), F.least("least", a).alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where(b != F.col("least")).select(b.alias("a"), F.col("least").alias("b"))
        stars = small.unionByName(least.select(a, F.col("least").alias("b"))).distinct().checkpoint()
