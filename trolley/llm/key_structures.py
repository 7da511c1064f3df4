"""Structures of encoded keys and tokens, read from their text.

Every check looks at each place a bounded number of times, whatever the text: lengths are read from
the few characters that hold them, and a place where reading failed is not read again.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

#: The shortest sequence that is looked at: no key is shorter.
LEAST_BYTES = 16


def decode64(text: str) -> bytes | None:
    """Bytes of base64 text in either alphabet, with or without padding."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


# --- DER ------------------------------------------------------------------------------------


def der_extent(head: bytes, at: int = 0) -> tuple[int, int] | None:
    """Where the content of the DER value at ``at`` starts and ends, from its first bytes; None if
    tag or length are not as DER has them."""
    if len(head) - at < 2:
        return None
    tag, first = head[at], head[at + 1]
    if tag & 0x1F == 0x1F or tag == 0:
        return None
    at += 2
    if first < 0x80:
        return at, at + first
    n = first & 0x7F
    length = int.from_bytes(head[at : at + n], "big")
    if not 1 <= n <= 8 or len(head) - at < n or length < 0x80 or length >> 8 * (n - 1) == 0:
        return None
    return at + n, at + n + length


def der_failure(data: bytes) -> list[int] | None:
    """None if ``data`` is one sequence of several members with lengths that nest and fill it, else
    the starts of the values that were being read."""
    open_ends, open_starts, at, members = [len(data)], [], 0, 0
    while True:
        extent = der_extent(data, at)
        if extent is None or extent[1] > open_ends[-1] or (not open_starts and (data[at] != 0x30 or extent[1] != len(data))):
            return [*open_starts, at]
        members += len(open_starts) == 1
        if data[at] & 0x20:
            open_starts.append(at)
            open_ends.append(extent[1])
            at = extent[0]
        else:
            at = extent[1]
        while open_starts and at == open_ends[-1]:
            open_ends.pop()
            first = open_starts.pop()
            if not open_starts:
                return None if members > 1 else [first]


def is_der(data: bytes) -> bool:
    """One sequence that fills ``data``, with more than one member and lengths that nest."""
    return len(data) >= LEAST_BYTES and der_failure(data) is None


# --- SSH ------------------------------------------------------------------------------------

_MAGIC = b"openssh-key-v1\0"
_SSH_NAME = re.compile(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+")


class Bytes:
    """Bytes of an encoded run from some character on, decoded where they are asked for."""

    def __init__(self, run: str, start: int):
        self.run, self.start = run, start
        self.size = (len(run) - start) * 3 // 4

    def __getitem__(self, span: slice) -> bytes:
        first, end = span.start // 3, -(-span.stop // 3)
        part = self.run[self.start + 4 * first : self.start + 4 * end]
        part = part[: len(part) // 4 * 4 + (0 if len(part) % 4 == 1 else len(part) % 4)]
        return (decode64(part) or b"")[span.start - 3 * first : span.stop - 3 * first]

    def number(self, at: int) -> int | None:
        data = self[at : at + 4]
        return int.from_bytes(data, "big") if len(data) == 4 else None

    def place(self, at: int) -> tuple[int, int]:
        """The character that byte ``at`` starts in, and how far into its group."""
        return self.start + 4 * (at // 3), at % 3


def ssh_private_end(data) -> int | None:
    """Where an OpenSSH private key ends: magic, cipher, key derivation and its options, the number
    of keys, that many public ones, and the private part."""
    if data[0 : len(_MAGIC)] != _MAGIC:
        return None
    at = len(_MAGIC)

    def fields(n: int) -> bool:
        nonlocal at
        for _ in range(n):
            length = data.number(at)
            if length is None or at + 4 + length > data.size:
                return False
            at += 4 + length
        return True

    if not fields(3):
        return None
    keys = data.number(at)
    at += 4
    return at if keys and fields(keys) and fields(1) else None


def ssh_public_ends(data, failed: set[tuple[int, int]]) -> Iterator[int]:
    """Where a public key may end: after its name and one or more fields that are not empty.
    ``failed`` has places that lead nowhere, and gets those of this key."""
    length = data.number(0)
    if length is None or not 7 <= length <= 64 or not _SSH_NAME.fullmatch(data[4 : 4 + length]):
        return
    at = 4 + length
    while at < data.size and data.place(at) not in failed:
        failed.add(data.place(at))
        length = data.number(at)
        if not length or at + 4 + length > data.size:
            return
        at += 4 + length
        yield at


def is_ssh(data: bytes) -> bool:
    """An OpenSSH private key, or a public one: length-prefixed fields up to the end."""
    run = Bytes(base64.b64encode(data).decode().rstrip("="), 0)
    return ssh_private_end(run) == len(data) or len(data) in ssh_public_ends(run, set())


# --- runs of base64 -------------------------------------------------------------------------

# 0x30 and the first byte of a length: the length itself, or 0x80 plus one to eight bytes of it
_DER_START = re.compile("M(?=([A-H][A-Za-z0-9+/_-])|I[E-Za-j])")
_DIGITS = {c: i for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")}
_DIGITS |= {"-": 62, "_": 63}
_SSH_START = re.compile("b(?=3BlbnNzaC1rZXktdjEA)|A(?=AAA[B-Q])")  # the magic, or a length of 7 to 64
_BREAK = re.compile(r"[ \t]*\r?\n[ \t]*")


def _chars(n_bytes: int) -> int:
    """Characters that so many bytes take, without padding."""
    return (4 * n_bytes + 2) // 3


def keys_in(text: str, padded: bool = True) -> Iterator[tuple[str, int, int]]:
    """``der`` and ``ssh`` keys in a run of base64, which may go over several lines: where a key
    starts is up to its bytes, and it ends with a line or the run."""
    parts, starts, lengths, at = [], [], [], 0
    for line in _BREAK.finditer(text):
        parts.append(text[at : line.start()]), starts.append(at)
        at = line.end()
    parts.append(text[at:].rstrip("=")), starts.append(at)
    padding = len(text) - at - len(parts[-1])
    run = "".join(parts)
    total = 0
    for part in parts:
        lengths.append(total)
        total += len(part)
    ends = {first + len(part) for first, part in zip(lengths, parts)}

    def place(char: int) -> int:
        line = bisect_right(lengths, char) - 1
        return starts[line] + char - lengths[line]

    def span(kind: str, start: int, end: int) -> tuple[str, int, int]:
        return kind, place(start), place(end - 1) + 1 + (padding if end == total else 0)

    over, failed = 0, set()
    for match in _DER_START.finditer(run):
        start = match.start()
        if start < over or start in failed:
            continue
        if match[1]:  # a short value, mostly not one that ends where it should
            size = 2 + (_DIGITS[match[1][0]] << 4 | _DIGITS[match[1][1]] >> 2)
            if start + _chars(size) not in ends:
                continue
        extent = der_extent(Bytes(run, start)[0:10])
        end = extent and start + _chars(extent[1])
        if not extent or extent[1] < LEAST_BYTES or end not in ends:
            continue
        broken = der_failure(decode64(run[start:end])[: extent[1]])
        if broken is None:
            over = end
            yield span("der", start, end)
        else:
            failed.update(start + 4 * (byte // 3) for byte in broken if byte % 3 == 0)
    over, known = 0, set()
    for match in _SSH_START.finditer(run):
        start = match.start()
        if start >= over:
            data = Bytes(run, start)
            found = [ssh_private_end(data)] if match[0] == "b" else ssh_public_ends(data, known)
            fitting = [start + _chars(n) for n in found if n and start + _chars(n) in ends]
            if fitting:
                over = fitting[-1]
                yield span("ssh", start, over)


# --- tokens ---------------------------------------------------------------------------------


#: How bytes of an object begin, as far as they go: a brace, and a key with its colon if there is one.
_OPENING = re.compile(rb'\s*+(?:\{\s*+(?:\}|"(?:[^"\\]|\\.)*+(?:"\s*+(?::|\Z)|\\?\Z)|\Z)|\Z)', re.DOTALL)


def _object(text: str, start: int = 0) -> dict | None:
    """The JSON object that base64 text holds from ``start`` on; what cannot be one is left as soon
    as that shows."""
    size, n = 64, len(text) - start
    opening = decode64(text[start : start + min(size, n)])
    if opening is None or not _OPENING.match(opening):
        return None
    while size < n:
        data = decode64(text[start : start + size])
        if data is None:
            return None
        try:
            json.loads(data.decode("utf-8", "ignore"))
            return None  # ends early
        except json.JSONDecodeError as wrong:
            # an error well before the end stays one, but for a string that is not over yet
            if not wrong.msg.startswith("Unterminated") and wrong.pos < size // 2:
                return None
        except RecursionError:
            return None
        size *= 4
    try:
        value = json.loads((decode64(text[start:]) or b"").decode())
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


#: Where a header can start: after dashes too, with a brace or a blank before it.
_HEADER = re.compile(r"(?<![^-])[eICD]")


def token_start(header: str, claims: str, signature: str) -> int | None:
    """Where in ``header`` a signed token starts: header and claims are JSON objects, the header
    names its algorithm, and there is a signature unless that is ``none``."""
    for match in _HEADER.finditer(header):
        found = _object(header, match.start())
        if found is not None and isinstance(found.get("alg"), str):
            if not signature and found["alg"].lower() != "none":
                return None
            return match.start() if _object(claims) is not None else None
    return None


# --- frames ---------------------------------------------------------------------------------

_MARKER = re.compile("-----(BEGIN|END) ([A-Z0-9 ]+)-----")
_HEADER_LINE = re.compile(r"([A-Za-z0-9-]+):(.*)")
_BODY = re.compile("[A-Za-z0-9+/]+={0,2}")
_DEK = re.compile(r"\s*[A-Za-z0-9-]+,([0-9A-Fa-f]{16,})\s*")


def _framed(body: str) -> str | None:
    """What the lines between two markers are."""
    headers, lines, last = {}, [], None
    for line in body.split("\n"):
        named = _HEADER_LINE.fullmatch(line.strip()) if not lines else None
        if named:
            last = named[1]
            headers[last] = named[2]
        elif not lines and last and line[:1] in (" ", "\t") and line.strip():
            headers[last] += line
        else:
            lines += line.split()
    joined = "".join(lines)
    data = decode64(joined) if _BODY.fullmatch(joined) else None
    if data is None:
        return None
    if is_der(data):
        return "der"
    if is_ssh(data):
        return "ssh"
    vector = _DEK.fullmatch(headers.get("DEK-Info", ""))
    whole = vector and data and len(data) % (len(vector[1]) // 2) == 0
    return "pem" if whole and "ENCRYPTED" in headers.get("Proc-Type", "") else None


def frames(text: str) -> Iterator[tuple[str, int, int]]:
    """Blocks from a BEGIN marker to the END marker of the same label that follows it, whose body is
    a key: ``der``, ``ssh``, or ``pem`` for an encrypted one (a cipher and an initialisation vector
    are named and the body is as many whole blocks)."""
    begin = None
    for marker in _MARKER.finditer(text):
        if marker[1] == "BEGIN":
            begin = marker
        elif begin is not None:
            if marker[2] == begin[2]:
                kind = _framed(text[begin.end() : marker.start()])
                if kind:
                    yield kind, begin.start(), marker.end()
            begin = None
