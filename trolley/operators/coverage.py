"""Which offsets were read, how often, and which were not: intervals per topic partition.

Offsets are gathered into bitmaps of 32,768, which are as many rows as the offsets have blocks and
are combined before the shuffle; a topic partition with all rows is no hot key. Blocks become the
ends of intervals, and a sweep over these ends gives maximal spans that were read equally often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.operators.keys import broadcast_if_small

BLOCK = 1 << 15
_PLACE = ("topic", "partition")

#: Offsets ``first`` to ``last`` were read ``times`` times each; spans of a partition are disjoint.
SPANS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("times", T.LongType()),
    ]
)


def _is_set(i: Column) -> Column:
    byte = F.substring("bits", F.shiftright(i, 3) + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), i.bitwiseAND(F.lit(7))) == 1


def _event(at: Column, change: Column) -> Column:
    return F.struct(at.cast("long").alias("at"), change.cast("long").alias("change"))


def observed(messages: DataFrame) -> DataFrame:
    """Spans of the offsets of ``messages`` (``topic``, ``partition``, ``offset``, not null). Blocks
    in which an offset repeats are measured first, so that as a rule only blocks are shuffled."""
    rows = messages.select("topic", F.col("partition").cast("int").alias("partition"), "offset")
    in_blocks = rows.withColumn("block", F.shiftright("offset", 15))
    blocks = in_blocks.groupBy(*_PLACE, "block").agg(
        F.bitmap_construct_agg(F.col("offset").bitwiseAND(F.lit(BLOCK - 1))).alias("bits"),
        F.count("*").alias("n"),
    )
    held = F.bitmap_count("bits")
    start = F.col("block") * BLOCK
    whole = F.array(_event(start, F.lit(1)), _event(start + BLOCK, F.lit(-1)))
    places = F.sequence(F.lit(0), F.lit(BLOCK - 1))
    begins = F.filter(places, lambda i: _is_set(i) & ((i == 0) | ~_is_set(i - 1)))
    ends = F.filter(places, lambda i: _is_set(i) & ((i == BLOCK - 1) | ~_is_set(i + 1)))
    runs = F.concat(
        F.transform(begins, lambda i: _event(start + i, F.lit(1))),
        F.transform(ends, lambda i: _event(start + i + 1, F.lit(-1))),
    )
    events = blocks.select(*_PLACE, F.inline(F.when(held == BLOCK, whole).otherwise(runs)))

    # offsets that occur more than once are looked for in the blocks that have some
    odd = broadcast_if_small(blocks.where(F.col("n") > held).select(*_PLACE, "block"))
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"o.{name}")) for name in (*_PLACE, "block")]
    again = in_blocks.alias("r").join(odd.alias("o"), same, "left_semi")
    again = again.groupBy(*_PLACE, "offset").agg((F.count("*") - 1).alias("more")).where(F.col("more") > 0)
    at = F.col("offset")
    repeats = F.array(_event(at, F.col("more")), _event(at + 1, -F.col("more")))
    return _swept(events.unionByName(again.select(*_PLACE, F.inline(repeats))))


def combined(spans: DataFrame) -> DataFrame:
    """Spans of what several sets of spans cover together."""
    ends = F.array(
        _event(F.col("first"), F.col("times")), _event(F.col("last") + 1, -F.col("times"))
    )
    return _swept(spans.select(*_PLACE, F.inline(ends)))


def _swept(events: DataFrame) -> DataFrame:
    """Where the number of readings changes, a span ends and the next one starts."""
    changes = events.groupBy(*_PLACE, "at").agg(F.sum("change").alias("change")).where("change <> 0")
    order = Window.partitionBy(*_PLACE).orderBy("at")
    steps = changes.select(
        *_PLACE,
        F.col("at").alias("first"),
        (F.lead("at").over(order) - 1).alias("last"),
        F.sum("change").over(order).alias("times"),
    )
    return steps.where(F.col("times") > 0).select(*SPANS.fieldNames())


def gaps(spans: DataFrame) -> DataFrame:
    """``first`` and ``last`` of what was not read between offsets that were."""
    following = F.lead("first").over(Window.partitionBy(*_PLACE).orderBy("first"))
    missing = spans.select(
        *_PLACE, (F.col("last") + 1).alias("first"), (following - 1).alias("last")
    )
    return missing.where(F.col("last") >= F.col("first"))


def overlaps(spans: DataFrame) -> DataFrame:
    """Spans that were read more than once."""
    return spans.where(F.col("times") > 1)
