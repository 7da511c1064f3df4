"""The registered queries of the operators, each with its SQL where SQL can express it.

Queries bring an operator's result into the form of its contract: counts, and digests of texts,
ids and spans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import (
    decontamination,
    fingerprints,
    line_dedup,
    ngram_join,
    page_queries,
    quality,
    secrets_scan,
    sentencepiece_codec,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from trolley.llm.arrow_maps import ready, sha256_of

def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.contaminations(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha256_of(F.array_join("item_ids", ",")).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_spans(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", sha256_of(F.col("kept")).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", sha256_of(F.col("kept")).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup_bytes(read(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = sentencepiece_codec.encode(read(spark, sf_dir, "documents"), sentencepiece_codec.MODEL_FILE)
    return sentencepiece_codec.decode(ids, sentencepiece_codec.MODEL_FILE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_of(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256_of(F.col("decoded")).alias("decoded_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = toxicity.train(documents, read(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(read(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.secrets(read(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in secrets_scan.BASE),
        sha256_of(secrets_scan.joined(secrets_scan.base_only("spans"))).alias("base_sha256"),
        secrets_scan.joined("spans").alias("spans"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return quality.resample(documents, quality.fit(documents, read(spark, sf_dir, "labels")))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited(read(spark, sf_dir, "documents"))
    return found.withColumn("edited_sha256", sha256_of(F.col("edited"))).drop("edited")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_join": op7_ngram_join,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_fingerprints": op10_fingerprints,
    **page_queries.QUERIES,
}

SQL: dict[str, str] = {
    "op1_decontaminate": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (
          SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        pattern AS (
          SELECT DISTINCT item, least(13, len(w)) AS n,
            array_to_string(list_slice(w, CAST(s AS INT), CAST(s AS INT) + least(13, len(w)) - 1), ' ') AS p
          FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(s) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT n FROM pattern),
        cut AS (
          SELECT doc_id, n, s, array_to_string(list_slice(w, CAST(s AS INT), CAST(s + n AS INT) - 1), ' ') AS p
          FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(s) WHERE len(w) >= n),
        found AS (SELECT doc_id, cut.n, s, item FROM cut JOIN pattern ON cut.p = pattern.p AND cut.n = pattern.n),
        words AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit
          FROM found, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
        items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
            array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM found GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
          CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
          coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
    """,
    "op3_line_dedup": r"""
        WITH lines AS (
          SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) AS d,
            LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS i)),
        repeated AS (
          SELECT key, min(doc_id) AS smallest FROM lines WHERE length(key) >= 10
          GROUP BY key HAVING count(DISTINCT doc_id) > 1)
        SELECT doc_id, count(*) AS n_lines,
          count(*) FILTER (smallest IS NOT NULL AND doc_id <> smallest) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (smallest IS NULL OR doc_id = smallest), ''))
            AS kept_sha256
        FROM lines LEFT JOIN repeated ON lines.key = repeated.key GROUP BY doc_id
    """,
    "op7_ngram_join": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingle AS (
          SELECT DISTINCT doc_id, array_to_string(list_slice(w, CAST(s AS INT), CAST(s AS INT) + 2), ' ') AS g
          FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(s) WHERE len(w) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
        pairs AS (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
          FROM shingle AS x JOIN shingle AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
        links AS (
          SELECT a, b FROM pairs JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
          WHERE 100 * common >= 90 * (x.n + y.n - common)),
        reach(doc_id, root) AS (
          SELECT doc_id, doc_id FROM d UNION SELECT links.b, root FROM reach JOIN links ON reach.doc_id = links.a)
        SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(root) AS component_id
        FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id JOIN reach ON reach.doc_id = d.doc_id
        GROUP BY d.doc_id, n
    """,
    "op2_substring_dedup": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        cut AS (
          SELECT doc_id, s, array_to_string(list_slice(w, CAST(s AS INT), CAST(s AS INT) + 34), ' ') AS g
          FROM d, unnest(range(1, len(w) - 33)) AS t(s) WHERE len(w) >= 35),
        again AS (SELECT g FROM cut GROUP BY g HAVING count(*) > 1),
        gone AS (
          SELECT DISTINCT doc_id, s + k AS i
          FROM cut JOIN again ON cut.g = again.g, unnest(range(0, 35)) AS t(k)),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
        kept AS (
          SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS kept, count(*) AS n
          FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
          sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
    """,
}

SQL |= page_queries.SQL
