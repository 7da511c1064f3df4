"""Secret scans with structural confirmation.

Patterns find assignments, access keys and hex runs; they are reported as they are. Beyond them,
runs of base64 or hex are decoded and reported as what their bytes turn out to be:

``der``  a key or certificate: one DER sequence whose nested lengths all fit
``ssh``  an OpenSSH key: fields with length prefixes that fill the value
``jwt``  a signed token: header and claims are JSON objects, the header names an algorithm
``pem``  an encrypted key: its frame names a cipher and a vector, and the body is whole blocks

A frame (``-----BEGIN``) counts from its first to its last dash as what its body is. Keys without a
frame may start anywhere in a run of base64 and go over several lines (``key_structures``). Spans are
code points of the whole text, end exclusive; null and empty texts have none. Scanning takes time in
proportion to the length of a text.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm.key_structures import LEAST_BYTES, frames, is_der, is_ssh, keys_in, token_start
from trolley.llm.arrow_maps import Batches, column, map_batches, narrow, small, texts_of

# The patterns and least lengths of the contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "jwt", "der", "ssh", "pem")

_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)
# Possessive runs, each tried from its first character only. A token can follow other parts ("end.eyJ..."),
# and no fourth part may follow it.
_TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+)(?!\.[A-Za-z0-9_-]))"
)
_LEAST_BASE64 = 4 * LEAST_BYTES // 3
#: Base64 that may go on over line breaks; words that are too short and do not are passed by.
_BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{%d,}+|[A-Za-z0-9+/_-]++(?=[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]))"
    r"(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+={0,2}" % _LEAST_BASE64
)
_ANY_HEX = re.compile(r"(?<![0-9A-Za-z])(?:0[xX])?((?:[0-9a-fA-F]{2}){16,})(?![0-9A-Za-z])")

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _kind_of(data: bytes) -> str | None:
    return "der" if is_der(data) else "ssh" if is_ssh(data) else None


def _confirmed(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose decoded bytes are a key or a token."""
    covered = []
    if "-----BEGIN" in text:
        for kind, start, end in frames(text):
            covered.append((start, end))
            yield kind, start, end
    for match in _TOKEN.finditer(text):
        start = token_start(match[1], match[2], match[3])
        if start is not None:
            span = (match.start(1) + start, match.end(3))
            covered.append(span)
            yield "jwt", *span
    covered.sort()
    starts = [start for start, _ in covered]
    ends = list(accumulate((end for _, end in covered), max))
    for match in _BASE64.finditer(text):
        if match.end() - match.start() < _LEAST_BASE64:
            continue
        for kind, a, b in keys_in(match[0]):
            a, b = match.start() + a, match.start() + b
            before = bisect_right(starts, a)
            if not before or ends[before - 1] < b:
                yield kind, a, b
    for match in _ANY_HEX.finditer(text):
        if match[1].startswith(("30", "00", "6f", "6F")):
            kind = _kind_of(bytes.fromhex(match[1]))
            if kind:
                yield kind, *match.span(1)


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind in the order of ``KINDS``."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    # a match of [0-9a-f]+ is a maximal run, so that asking for the least length first changes nothing
    found += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    found += _confirmed(text)
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def _scan(batches: Batches) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        spans = [
            [{"kind": kind, "start": start, "end": end} for kind, start, end in spans_of(text)]
            for text in texts_of(batch)
        ]
        yield pa.record_batch([column(batch, "doc_id"), pa.array(spans, _SPANS)], ["doc_id", "spans"])


def secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end), one row per row of ``docs``."""
    return map_batches(narrow(docs, doc_id, text), [T.StructField("spans", SPANS)], _scan)


def joined(spans) -> Column:
    """Spans as comma-joined ``kind:start:end``."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ","
    )


def base_only(spans) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*BASE))
