"""Registered queries over pages, phrases and conversations, each with its SQL where SQL can
express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import conversation_repair, phrases, url_filters
from trolley.llm.arrow_maps import ready

# The rules of the contract.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = ready(spark).read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(pages, rules).drop("url")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    return phrases.collocations(documents, top=2000)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut, repeated and given to the user, by a checksum of their place."""

    def spaced(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fate = F.crc32(F.encode(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")), "UTF-8")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    times = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = ready(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.digests(damaged(conversations), known=conversations)


QUERIES = {
    "op11_url_filters": op11_url_filters,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {
    "op11_url_filters": r"""
        WITH cut AS (
          SELECT page_id, instr(coalesce(url, ''), '://') AS i, coalesce(url, '') AS url FROM pages),
        rest AS (SELECT page_id, CASE WHEN i > 0 THEN substr(url, i + 3) ELSE '' END AS r FROM cut),
        parts AS (
          SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^([^/?#]*)([^?#]*)', 2) AS path FROM rest),
        rules(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        fits AS (
          SELECT page_id, h || p AS rule, verdict, row_number() OVER (
            PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC) AS n
          FROM parts JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p))
        SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parts LEFT JOIN fits ON fits.page_id = parts.page_id AND n = 1
    """,
    "op12_collocations": r"""
        WITH d AS (
          SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
        w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
        cut AS (
          SELECT lang, m, array_to_string(list_slice(w, CAST(s AS INT), CAST(s + m - 1 AS INT)), ' ') AS g
          FROM w, unnest(range(1, 5)) AS a(m), unnest(range(1, len(w) - m + 2)) AS b(s) WHERE len(w) >= m),
        f AS (SELECT lang, m, g, count(*) AS a FROM cut GROUP BY lang, m, g HAVING count(*) >= 30),
        total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        found AS (SELECT lang, m, g, a, string_split(g, ' ') AS w FROM f WHERE m > 1),
        outer_ AS (
          SELECT lang, array_to_string(list_slice(w, CAST(s AS INT), CAST(s + k - 1 AS INT)), ' ') AS g, max(a) AS b
          FROM found, unnest(range(2, m)) AS x(k), unnest(range(1, m - k + 2)) AS y(s) GROUP BY 1, 2),
        cuts AS (
          SELECT found.lang, found.g, found.a, k, x.a AS l, y.a AS r,
            (2000000::HUGEINT * found.a) // (x.a::HUGEINT + y.a) AS score
          FROM found, unnest(range(1, found.m)) AS c(k)
          JOIN f AS x ON x.lang = found.lang AND x.g = array_to_string(list_slice(w, 1, CAST(k AS INT)), ' ')
          JOIN f AS y ON y.lang = found.lang AND y.g = array_to_string(list_slice(w, CAST(k + 1 AS INT), CAST(found.m AS INT)), ' ')),
        lowest AS (
          SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS i FROM cuts),
        ranked AS (
          SELECT lowest.*, row_number() OVER (
            PARTITION BY lowest.lang ORDER BY score DESC, a DESC, encode(lowest.g)) AS rank
          FROM lowest LEFT JOIN outer_ ON outer_.lang = lowest.lang AND outer_.g = lowest.g
          WHERE i = 1 AND (b IS NULL OR 100::HUGEINT * b < 80::HUGEINT * a))
        SELECT ranked.lang, rank, g AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
    """,
}
