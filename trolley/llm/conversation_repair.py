"""Repair of the structure of conversations.

A conversation is the rows of one ``conv_id`` by turn, null turns first. Rows of the same turn are
ordered by a digest of role and text, so that the result does not depend on the order of the table;
rows that are equal in all of these are copies in any order. Roles count by their first character.
A row's first fault counts: ``blank`` (nothing but white space), ``duplicate`` (role and text seen
earlier in the conversation), ``truncated`` (does not end a sentence). Blank and duplicate rows have
to go. The cheapest edits that leave ``(s?(ua)+)?`` are found by ``edit_lattice``; of equally cheap
ones, the least audit.

Null roles and texts read as one space. Rows without a ``conv_id`` are one conversation. An empty
table gives an empty report.

Equal rows of a turn are counted before anything is shuffled, and conversations are dealt out by
ranges of (conversation, turn), so that a hot one is cut into runs. Each run becomes a matrix of
costs and audits, and only these are brought together. Texts are shuffled once, to be written, or
digested, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.llm import edit_lattice as lattice
from trolley.llm.arrow_maps import Batches, _importable

_BLANKS = " \t\n\x0b\x0c\r"
#: Steps of a lattice that is searched at once.
PIECE = 128

REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The columns that a repair reads: ``conv``, ``turn``, ``role``, ``text``."""
    return rows.select(
        rows[conv_id].alias("conv"),
        rows[turn].cast("long").alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit(" ")).alias("text"),
    )


def _digest() -> Column:
    """Equal for equal pairs of role and text only."""
    return F.unhex(F.sha2(F.encode(F.concat_ws(":", F.length("role"), "role", "text"), "UTF-8"), 256))


def _order() -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in ("conv", "turn", "digest")]


def _runs(table: DataFrame, known: DataFrame | None) -> DataFrame:
    """Equal rows of a turn as one, with their number; every conversation of ``known`` has a row
    without copies besides."""
    end = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    counted = table.select(
        "conv",
        "turn",
        _digest().alias("digest"),
        F.left("role", F.lit(1)).alias("initial"),
        (end == "").alias("blank"),
        (~end.isin(".", "!", "?")).alias("truncated"),
        F.lit(1).cast("long").alias("copies"),
    )
    if known is not None:
        nulls = (F.lit(None).cast(counted.schema[name].dataType).alias(name) for name in counted.columns[1:-1])
        counted = counted.unionByName(known.select("conv", *nulls, F.lit(0).cast("long").alias("copies")))
    return counted.groupBy(*counted.columns[:-1]).agg(F.sum("copies").alias("copies"))


def _with_repeats(runs: DataFrame) -> DataFrame:
    """``runs`` with ``first``: whether it is the first of its role and text in the conversation."""
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = (
        runs.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min(place).alias("least"))
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("digest").eqNullSafe(F.col("d"))
    return runs.join(firsts, same).select(*runs.columns, place.eqNullSafe(F.col("least")).alias("first"))


_PATHS = pa.list_(pa.struct([("s", pa.int8()), ("t", pa.int8()), ("cost", pa.int64()), ("audit", pa.string())]))
_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")
_SUMMARY = ", ".join(
    ["place struct<known boolean, turn bigint, digest binary>", *(f"{name} bigint" for name in _COUNTS),
     "head string, tail string, low bigint, high bigint",
     "paths array<struct<s tinyint, t tinyint, cost bigint, audit string>>"]
)


class _Summary:
    """Facts of a run of rows that follow one another in one conversation."""

    def __init__(self, row: dict):
        self.conv = row["conv"]
        self.place = {"known": row["turn"] is not None, "turn": row["turn"], "digest": row["digest"]}
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.head = self.tail = self.low = self.high = None
        self.steps: list[lattice.Step] = []
        self.pieces = lattice.Run()

    def add(self, row: dict) -> None:
        copies, counts = row["copies"], self.counts
        if not copies:
            return
        initial, turn = row["initial"], row["turn"]
        counts["rows"] += copies
        if turn is not None:
            self.low = turn if self.low is None else self.low
            counts["turns"] += turn != self.high
            self.high = turn
        counts["illegal"] += copies - 1  # no role may follow itself
        if self.tail is not None:
            counts["illegal"] += self.tail + initial not in ("su", "ua", "au")
        self.head, self.tail = initial if self.head is None else self.head, initial
        if row["blank"]:
            counts["blank"] += copies
            self.steps.append(copies)
        elif not row["first"]:
            counts["duplicate"] += copies
            self.steps.append(copies)
        else:
            counts["truncated"] += row["truncated"]
            counts["duplicate"] += copies - 1
            self.steps.append((initial, row["truncated"]))
            if copies > 1:
                self.steps.append(copies - 1)
        if len(self.steps) >= PIECE:
            self.cut()

    def cut(self) -> None:
        if self.steps:
            self.pieces.add(lattice.matrix(self.steps))
            self.steps = []

    def finished(self, whole: bool) -> dict:
        """As a row; ``whole`` if no other run belongs to the conversation."""
        if whole and not self.pieces.pieces:
            paths = {(lattice.START, lattice.START): lattice.search(self.steps, lattice.START, lattice.ENDS)}
        else:
            self.cut()
            paths = self.pieces.whole()
        return {
            "conv": self.conv, "place": self.place, **self.counts,
            "head": self.head, "tail": self.tail, "low": self.low, "high": self.high,
            "paths": [{"s": s, "t": t, "cost": c, "audit": a} for (s, t), (c, a) in paths.items()],
        }


def _rows(batches: Batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, n: int = 512, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(value) for value in row.values() if isinstance(value, (str, bytes)))
        if len(held) >= n or weight >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _conv_type(batches: Batches) -> tuple[pa.DataType, Batches]:
    """Type of the first column, and all batches."""
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return pa.null(), iter(())

    def again():
        yield first
        yield from batches

    return first.schema.field(0).type, again()


def _summarise(batches: Batches) -> Iterator[pa.RecordBatch]:
    kind, batches = _conv_type(batches)

    def summaries() -> Iterator[dict]:
        run, n = None, 0
        for row in _rows(batches):
            if run is None or row["conv"] != run.conv:
                if run is not None:
                    yield run.finished(whole=n > 1)  # neither the first nor the last here
                run, n = _Summary(row), n + 1
            run.add(row)
        if run is not None:
            yield run.finished(whole=False)

    places = pa.struct([("known", pa.bool_()), ("turn", pa.int64()), ("digest", pa.binary())])
    fields = [("conv", kind), ("place", places), *((name, pa.int64()) for name in _COUNTS),
              ("head", pa.string()), ("tail", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("paths", _PATHS)]
    yield from _batches(summaries(), pa.schema(fields))


def _combine(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Runs of a conversation, in order, into its report."""
    kind, batches = _conv_type(batches)

    def reports() -> Iterator[dict]:
        total, run = None, None
        for row in _rows(batches):
            if total is None or row["conv"] != total["conv"]:
                if total is not None:
                    yield closed(total, run)
                run = lattice.Run()
                total = {"conv": row["conv"], **dict.fromkeys(_COUNTS, 0), "tail": None, "low": None, "high": None}
            total["turns"] -= row["low"] is not None and row["low"] == total["high"]
            if None not in (total["tail"], row["head"]):
                total["illegal"] += total["tail"] + row["head"] not in ("su", "ua", "au")
            for name in _COUNTS:
                total[name] += row[name]
            total["tail"] = row["tail"] if row["tail"] is not None else total["tail"]
            total["low"] = row["low"] if total["low"] is None else total["low"]
            total["high"] = row["high"] if row["high"] is not None else total["high"]
            run.add({(p["s"], p["t"]): (p["cost"], p["audit"]) for p in row["paths"]})
        if total is not None:
            yield closed(total, run)

    def closed(total: dict, run: lattice.Run) -> dict:
        cost, audit = lattice.repair(run.whole())
        gaps = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["turns"]
        named = {name: total[name] for name in ("conv", "blank", "duplicate", "truncated", "illegal")}
        return named | {"gaps": gaps, "cost": cost, "audit": audit}

    fields = [("conv", kind), *((name, pa.int64()) for name in REPORT[:-1]), ("audit", pa.string())]
    yield from _batches(reports(), pa.schema(fields))


def _diagnosed(table: DataFrame, known: DataFrame | None) -> DataFrame:
    _importable(table)
    marked = _with_repeats(_runs(table, known))
    dealt = marked.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    conv = T.StructType([table.schema["conv"]])
    summary = T.StructType([*conv.fields, *T.StructType.fromDDL(_SUMMARY).fields])
    runs = dealt.mapInArrow(_summarise, summary)
    together = runs.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "place")
    report = [*(T.StructField(name, T.LongType()) for name in REPORT[:-1]), T.StructField("audit", T.StringType())]
    return together.mapInArrow(_combine, T.StructType([*conv.fields, *report]))


def diagnose(
    rows: DataFrame,
    *,
    known: DataFrame | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``gaps`` (turns missing between the first and the last
    one), rows that are ``blank``, ``duplicate`` and ``truncated``, ``illegal`` neighbours, and ``cost``
    and ``audit`` of the repair. ``known`` has the ``conv_id`` of conversations to be reported even if
    ``rows`` has nothing of them."""
    others = None if known is None else known.select(known[conv_id].alias("conv"))
    report = _diagnosed(turns(rows, conv_id, turn, role, text), others)
    return report.withColumnRenamed("conv", conv_id)


def _in_order(rows: DataFrame, report: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    """Every conversation in one piece: its report, then its rows in order."""
    conv_id = names[0]
    table = turns(rows, *names).withColumn("digest", _digest())
    table = table.select("conv", F.lit(1).alias("kind"), "turn", "digest", "role", "text", *(
        F.lit(None).cast("long").alias(name) for name in REPORT[:-1]))
    heads = report.select(
        F.col(conv_id).alias("conv"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("role"),
        F.col("audit").alias("text"), *REPORT[:-1],
    )
    conv, *places = _order()
    return heads.unionByName(table).repartition("conv").sortWithinPartitions(conv, "kind", *places)


class _Writer:
    """Follows the audit of one conversation and says what each edit leaves."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, lattice.START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, lattice.GIVEN[self.state]
            yield "I", lattice.ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = lattice.NEXT[self.state][role[:1]]
            yield edit, role, text
        elif edit == "R":
            self.state = lattice.GIVEN[self.state]
            yield edit, lattice.ROLES[self.state], text


def _repaired(batches: Batches) -> Iterator[pa.RecordBatch]:
    kind, batches = _conv_type(batches)

    def rows() -> Iterator[dict]:
        writer, conv, place = None, None, 0

        def numbered(edits) -> Iterator[dict]:
            nonlocal place
            for edit, role, text in edits:
                yield {"conv": conv, "place": place, "edit": edit, "role": role, "text": text}
                place += 1

        for row in _rows(batches):
            if row["kind"] == 0:
                if writer is not None:
                    yield from numbered(writer.inserted())
                writer, conv, place = _Writer(row["text"]), row["conv"], 0
            else:
                yield from numbered(writer.row(row["role"], row["text"]))
        if writer is not None:
            yield from numbered(writer.inserted())

    fields = [("conv", kind), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    yield from _batches(rows(), pa.schema(fields))


def repaired(
    rows: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The turns of all conversations after repair: ``conv_id``, ``place`` (from 0), ``edit`` (K, R or
    I), ``role`` and ``text``."""
    _importable(rows)
    report = diagnose(rows, conv_id=conv_id, turn=turn, role=role, text=text)
    ordered = _in_order(rows, report, (conv_id, turn, role, text))
    schema = [ordered.schema["conv"], T.StructField("place", T.LongType())]
    schema += [T.StructField(name, T.StringType()) for name in ("edit", "role", "text")]
    return ordered.mapInArrow(_repaired, T.StructType(schema)).withColumnRenamed("conv", conv_id)


def _digested(batches: Batches) -> Iterator[pa.RecordBatch]:
    kind, batches = _conv_type(batches)

    def reports() -> Iterator[dict]:
        writer, head, digest, empty = None, None, None, True

        def take(edits) -> None:
            nonlocal empty
            for _, role, text in edits:
                digest.update(f"{role}:{text}".encode() if empty else f"\n{role}:{text}".encode())
                empty = False

        def closed() -> dict:
            take(writer.inserted())
            named = {name: head[name] for name in ("conv", *REPORT[:-1])}
            return named | {"audit": head["text"], "repaired_sha256": digest.hexdigest()}

        for row in _rows(batches):
            if row["kind"] == 0:
                if writer is not None:
                    yield closed()
                writer, head, digest, empty = _Writer(row["text"]), row, hashlib.sha256(), True
            else:
                take(writer.row(row["role"], row["text"]))
        if writer is not None:
            yield closed()

    fields = [("conv", kind), *((name, pa.int64()) for name in REPORT[:-1]), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    yield from _batches(reports(), pa.schema(fields))


def digests(
    rows: DataFrame,
    *,
    known: DataFrame | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """What ``diagnose`` reports, with the digest of the repaired ``role:text`` lines. A digest has to
    see its text in order, so a conversation goes through one task here, as a stream."""
    _importable(rows)
    names = (conv_id, turn, role, text)
    report = diagnose(rows, known=known, conv_id=conv_id, turn=turn, role=role, text=text)
    ordered = _in_order(rows, report, names)
    schema = [ordered.schema["conv"], *(T.StructField(name, T.LongType()) for name in REPORT[:-1])]
    schema += [T.StructField(name, T.StringType()) for name in ("audit", "repaired_sha256")]
    return ordered.mapInArrow(_digested, T.StructType(schema)).withColumnRenamed("conv", conv_id)
