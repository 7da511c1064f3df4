"""URL filters: a trie over reversed host labels and path segments, longest match first.

A rule is a host, a path and a verdict. It fits a url whose host is the rule's or a subdomain of it
and whose path starts with the rule's. The walk goes down the labels of the host from the last one,
then from the deepest of these nodes down the segments of the path; the deepest rule found decides:
more host labels first, then the longer path. An allow entry beats a block entry of the same host
and path. Where no rule fits, the verdict is ``default``.

The host of a url is what lies between its first ``://`` and the next ``/``, ``?``, ``#`` or the end,
with A-Z in lower case; the path goes from there to the next ``?``, ``#`` or the end. A url that is
null or has no ``://`` has neither, and only rules without a host and path fit it. Rules with a null or empty host
fit every host, a null path is an empty one, and repeated rules are one rule.

Rules are measured. The trie of at most ``part_bytes`` of them is broadcast; more rules are dealt by
hash into parts of that size, and each part is one more pass over the urls that carries the best
match so far along. No url is shuffled, so a host with a third of all urls is as good as any.
"""

from __future__ import annotations

import re
from bisect import insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.arrow_maps import Batches, _importable, fresh, saved

VERDICTS = ("allow", "block")
#: Rules of one trie: their characters, and so much for the nodes of each.
PART_BYTES, _RULE_BYTES = 16 << 20, 64

_URL = re.compile(r"(.*?)://([^/?#]*)([^?#]*)", re.DOTALL)
_LOWER = {code: code + 32 for code in range(65, 91)}

#: Keys of a node that no label or segment equals: its rule, the rules that end inside the next
#: segment, how long these ends are, the node of the first segment.
_RULE, _STARTS, _LENGTHS, _PATHS = range(4)
Depth = tuple[int, int]


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host in lower case, and path; both empty where there is no ``://``."""
    match = _URL.match(url or "")
    return (match[2].translate(_LOWER), match[3]) if match else ("", "")


class Trie:
    """Rules by reversed host labels, then by path segments."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in sorted(rules, key=lambda rule: rule[2] == "allow"):
            node = self.root
            labels = host.split(".")[::-1] if host else []
            for label in labels:
                node = node.setdefault(label, {})
            if path:
                *whole, last = path.split("/")
                node = node.setdefault(_PATHS, {})
                for segment in whole:
                    node = node.setdefault(segment, {})
                lengths = node.setdefault(_LENGTHS, [])
                if len(last) not in lengths:
                    insort(lengths, len(last), key=int.__neg__)
                node = node.setdefault(_STARTS, {}).setdefault(last, {})
            node[_RULE] = ((len(labels), len(path)), host + path, verdict)

    def hosts(self, host: str) -> list[dict]:
        """Nodes on the way down ``host`` that hold rules, the deepest first."""
        node, found = self.root, []
        for label in [None, *host.split(".")[::-1]] if host else [None]:
            node = node if label is None else node.get(label)
            if node is None:
                break
            if _RULE in node or _PATHS in node:
                found.append(node)
        return found[::-1]

    @staticmethod
    def longest(nodes: list[dict], path: str) -> tuple[Depth, str, str] | None:
        """The deepest rule of ``nodes`` (by ``hosts``) whose path starts ``path``."""
        segments = path.split("/")
        for top in nodes:
            best, node = top.get(_RULE), top.get(_PATHS)
            for segment in segments:
                if node is None:
                    break
                for length in node.get(_LENGTHS, ()):  # the longest first
                    end = node[_STARTS].get(segment[:length]) if length <= len(segment) else None
                    if end is not None:
                        best = end[_RULE]
                        break
                node = node.get(segment)
            if best is not None:
                return best
        return None


class _Judge:
    """Adds, or improves, the best rule of every row; ``trie`` is a broadcast list of rules."""

    def __init__(self, rules, url: str, names: tuple[str, ...], first: bool):
        self.rules, self.url, self.names, self.first = rules, url, names, first

    def __call__(self, batches: Batches) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(self.rules.value), {}
        for batch in batches:
            urls = batch.column(batch.schema.get_field_index(self.url)).to_pylist()
            old = [None] * len(urls)
            if not self.first:
                old = batch.column(batch.num_columns - 1).to_pylist()
            parts, matches = [], []
            for url, before in zip(urls, old):
                host, path = host_and_path(url)
                nodes = known.get(host)
                if nodes is None:
                    if len(known) >= 1 << 16:  # hosts met lately; they are looked up again
                        known.clear()
                    nodes = known[host] = trie.hosts(host)
                found = trie.longest(nodes, path)
                if before is not None:
                    depth = (before["labels"], before["chars"])
                    if found is None or (found[0], found[2] == "allow") <= (depth, before["verdict"] == "allow"):
                        found = (depth, before["rule"], before["verdict"])
                parts.append((host, path))
                matches.append(
                    found and {"labels": found[0][0], "chars": found[0][1], "rule": found[1], "verdict": found[2]}
                )
            kept = batch.num_columns if self.first else batch.num_columns - 3
            hosts, paths = (pa.array([part[i] for part in parts], pa.string()) for i in (0, 1))
            arrays = [*batch.columns[:kept], hosts, paths, pa.array(matches, _MATCH_ARROW)]
            yield pa.record_batch(arrays, [*batch.schema.names[:kept], *self.names])


_MATCH = T.StructType(
    [
        T.StructField("labels", T.IntegerType()),
        T.StructField("chars", T.IntegerType()),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)
_MATCH_ARROW = pa.struct(
    [("labels", pa.int32()), ("chars", pa.int32()), ("rule", pa.string()), ("verdict", pa.string())]
)


def lower_ascii(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def _parts(rules: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    """Distinct rules with the ``part`` each belongs to, and the number of parts."""
    cleaned = rules.select(
        lower_ascii(F.coalesce(F.col("host").cast("string"), F.lit(""))).alias("host"),
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
        F.col("verdict").cast("string").alias("verdict"),
    ).distinct()
    size = F.octet_length("host") + F.octet_length("path") + _RULE_BYTES
    seen = cleaned.agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
        F.count_if(~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))).alias("odd"),
    ).first()
    if seen.odd:
        raise ValueError(f"{seen.odd} rules have a verdict that is not one of {VERDICTS}")
    n = max(1, -(-seen.bytes // part_bytes))
    return cleaned.withColumn("part", F.pmod(F.xxhash64("host", "path"), F.lit(n))), n


def judge(
    pages: DataFrame,
    rules: DataFrame,
    *,
    url: str = "url",
    default: str = "allow",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the deciding rule, or null) and
    ``verdict``; the new columns come last, renamed where ``pages`` has such names. ``rules`` has
    ``host``, ``path`` and ``verdict`` (``allow`` or ``block``)."""
    if default not in VERDICTS:
        raise ValueError(f"default must be one of {VERDICTS}, not {default!r}")
    _importable(pages)
    names = tuple(fresh(pages, name) for name in ("host", "path", "match"))
    types = [T.StringType(), T.StringType(), _MATCH]
    schema = T.StructType([*pages.schema.fields, *map(T.StructField, names, types)])
    dealt, n = _parts(rules, part_bytes)
    if n > 1:
        dealt = saved(dealt, "url-rules")
    judged = pages
    for part in range(n):
        held = dealt.where(F.col("part") == part).select("host", "path", "verdict").collect()
        shared = pages.sparkSession.sparkContext.broadcast([tuple(row) for row in held])
        judged = judged.mapInArrow(_Judge(shared, url, names, part == 0), schema)
        if n > 1:
            judged = saved(judged, "url-verdicts")  # one trie at a time is in memory
            shared.unpersist()
    match = F.col(names[2])
    return judged.select(
        *pages.columns,
        *names[:2],
        match.rule.alias(fresh(pages, "rule")),
        F.coalesce(match.verdict, F.lit(default)).alias(fresh(pages, "verdict")),
    )


def allowed(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``pages`` whose url may be used, as they are."""
    judged = judge(pages, rules, url=url, default=default)
    return judged.where(F.col(judged.columns[-1]) == "allow").select(*pages.columns)
