"""Document fingerprints: Merkle trees over sections and paragraphs, in SQL functions alone.

A text is cut into sections at line breaks, and a section into paragraphs after a blank that
follows a punctuation mark or an s, or after 64 code points without one, so that where a cut
falls depends on nearby text only. Leaves are hashes of paragraphs, a section's node is the digest of its leaves,
and the root that of the nodes.

A fingerprint reads ``root:leaf,leaf;leaf,...``: leaves by section, shortened to 8 hex digits.
Equal texts have equal fingerprints; unequal roots mean unequal texts. ``differing_sections``
names the branches that differ, and ``likeness`` is the share of leaves that two trees have in
common (Dice). A null text counts as the empty text, which is one section without a leaf.

``edited`` makes the texts the contract compares: each document's last quarter is replaced by
the beginning of the next document in the order of ``doc_id`` (null first), then of a hash of
the text; rows that are equal in both count as one document, and the last is followed by the
first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.arrow_maps import narrow

_PARAGRAPH = r"(?s).{1,64}?(?:[.!?,;:|s] |\z)|.{64}"


def _leaves(section: Column) -> Column:
    return F.transform(
        F.regexp_extract_all(section, F.lit(_PARAGRAPH), F.lit(0)),
        lambda part: F.lpad(F.hex(F.xxhash64(part)), 16, "0"),
    )


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of column ``text`` as ``name``."""
    leaves, sections = f"{name} leaves", f"{name} sections"
    return (
        rows.withColumn(leaves, F.transform(F.split(text, "\n"), _leaves))
        .withColumn(
            sections,
            F.transform(
                leaves,
                lambda section: F.struct(
                    F.md5(F.array_join(section, "")).alias("node"),
                    F.array_join(F.transform(section, lambda leaf: F.right(leaf, F.lit(8))), ",").alias("short"),
                ),
            ),
        )
        .withColumn(
            name,
            F.concat(
                F.left(F.sha2(F.array_join(f"{sections}.node", "").cast("binary"), 256), F.lit(32)),
                F.lit(":"),
                F.array_join(f"{sections}.short", ";"),
            ),
        )
        .drop(leaves, sections)
    )


def root(fingerprint: Column) -> Column:
    return F.left(fingerprint, F.lit(32))


def _leaf_set(fingerprint: Column) -> Column:
    return F.array_distinct(F.split(F.substring(fingerprint, 34, 1 << 30), "[,;]"))


def with_likeness(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``rows`` with the share of leaves that fingerprints ``a`` and ``b`` have in common; 1 for
    equal roots."""
    left, right = f"{name} a", f"{name} b"
    common = F.size(F.array_intersect(left, right))
    return (
        rows.withColumn(left, _leaf_set(F.col(a)))
        .withColumn(right, _leaf_set(F.col(b)))
        .withColumn(
            name,
            F.when(root(F.col(a)) == root(F.col(b)), F.lit(1.0)).otherwise(
                2 * common / (F.size(left) + F.size(right))
            ),
        )
        .drop(left, right)
    )


def differing_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections in which two fingerprints differ."""
    short = [F.split(F.substring(x, 34, 1 << 30), ";") for x in (a, b)]
    places = F.sequence(F.lit(0), F.greatest(F.size(short[0]), F.size(short[1])) - 1)
    return F.filter(places, lambda i: ~F.get(short[0], i).eqNullSafe(F.get(short[1], i)))


def _following(keys: DataFrame) -> DataFrame:
    """Distinct (doc_id, digest, n_chars) keys with the key that follows, in ranges: a range
    needs the next range's first key only, so no task sees more than a range."""
    key = F.struct("doc_id", "digest")
    ranged = (
        keys.repartitionByRange("doc_id", "digest")
        .select(F.spark_partition_id().alias("range"), "doc_id", "digest", "n_chars")
        .checkpoint()
    )
    within = Window.partitionBy("range").orderBy("doc_id", "digest")
    firsts = ranged.groupBy("range").agg(F.min(key).alias("first"))  # one row per range
    across = Window.orderBy("range")
    ahead = firsts.select(
        "range",
        F.coalesce(
            F.lead("first").over(across),
            F.min("first").over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        ).alias("ahead"),
    )
    return ranged.withColumn("next", F.lead(key).over(within)).join(F.broadcast(ahead), "range").select(
        F.col("doc_id").alias("before_id"),
        F.col("digest").alias("before_digest"),
        F.floor(F.col("n_chars") / 4).cast("int").alias("quarter"),
        F.coalesce("next.doc_id", "ahead.doc_id").alias("after_id"),
        F.coalesce("next.digest", "ahead.digest").alias("after_digest"),
    )


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars`` and ``fingerprint``, one row per row of ``docs``."""
    rows = narrow(docs, doc_id, text).withColumn("text", F.coalesce("text", F.lit("")))
    return with_fingerprint(rows, "text", "fingerprint").select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "fingerprint"
    )


def edited(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``, one row per row of ``docs``.

    The text is shuffled once, by its key; the two joins read the same exchange. What moves to
    the document before is the beginning that it needs and the fingerprint.
    """
    rows = (
        narrow(docs, doc_id, text)
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .select("doc_id", F.xxhash64("text").alias("digest"), "text")
    )
    keyed = rows.select("doc_id", "digest", F.char_length("text").alias("n_chars"))
    keys = keyed.distinct()
    links = _following(keys)
    after = rows.join(
        links,
        rows["doc_id"].eqNullSafe(links["after_id"]) & (rows["digest"] == links["after_digest"]),
    )
    heads = with_fingerprint(after, "text", "next_fingerprint").select(
        "before_id", "before_digest", F.left("text", F.col("quarter")).alias("head"), "next_fingerprint"
    )
    if keyed.count() != keys.count():  # repeated rows bring their head more than once
        heads = heads.dropDuplicates(["before_id", "before_digest"])
    whole = rows.join(
        heads,
        rows["doc_id"].eqNullSafe(heads["before_id"]) & (rows["digest"] == heads["before_digest"]),
    )
    n = F.char_length("text")
    changed = whole.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "text",
        F.concat(F.left("text", n - F.floor(n / 4).cast("int")), "head").alias("edited"),
        "next_fingerprint",
    )
    printed = with_fingerprint(with_fingerprint(changed, "text", "fingerprint"), "edited", "edited_fingerprint")
    near = with_likeness(printed, "fingerprint", "edited_fingerprint", "near_edited")
    near = with_likeness(near, "fingerprint", "next_fingerprint", "near_next")
    return near.drop("text", "next_fingerprint")
