"""Conversation repair against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from trolley.llm import conversation_repair, edit_lattice, page_queries


def enumerated(steps, longest):
    """All edit sequences up to a length, tried one by one."""
    best = None
    for n in range(longest + 1):
        for audit in product("DIKR", repeat=n):
            rows, out, cost = iter(steps), "", 0
            try:
                for edit in audit:
                    last = out[-1:]
                    if edit == "I":
                        out, cost = out + ("a" if last == "u" else "u"), cost + 5
                        continue
                    initial, truncated, must_go = next(rows)
                    if edit == "D":
                        cost += 2
                    elif must_go:
                        raise StopIteration
                    else:
                        out += initial if edit == "K" else "a" if last == "u" else "u"
                        cost += (edit == "R") + 5 * truncated
            except StopIteration:
                continue
            if next(rows, None) is None and re.fullmatch("(s?(ua)+)?", out):
                path = (cost, "".join(audit))
                best = path if best is None or path < best else best
    return best


def stepped(steps):
    return [1 if must_go else (initial, truncated) for initial, truncated, must_go in steps]


def swept(steps):
    """Forward sweep over the lattice without heaps, insertions at most three at a place."""
    states = {"": (0, "")}  # by what was emitted last

    def insertions(states):
        for _ in range(3):
            for last, (cost, audit) in list(states.items()):
                role = "a" if last == "u" else "u"
                path = (cost + 5, audit + "I")
                if role not in states or path < states[role]:
                    states[role] = path
        return states

    states = insertions(states)
    for initial, truncated, must_go in steps:
        after = {}

        def put(last, cost, audit):
            if last not in after or (cost, audit) < after[last]:
                after[last] = (cost, audit)

        for last, (cost, audit) in states.items():
            put(last, cost + 2, audit + "D")
            if must_go:
                continue
            put("a" if last == "u" else "u", cost + 1 + 5 * truncated, audit + "R")
            if (last, initial) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                put(initial, cost + 5 * truncated, audit + "K")
        states = insertions(after)
    return min(states[last] for last in ("", "a") if last in states)


def random_steps(rnd, n):
    return [(rnd.choice("suaat x"), rnd.random() < 0.2, rnd.random() < 0.2) for _ in range(n)]


def test_search_gives_what_enumeration_gives():
    rnd = random.Random(5)
    for _ in range(60):
        steps = random_steps(rnd, rnd.randint(0, 4))
        found = edit_lattice.search(stepped(steps), edit_lattice.START, edit_lattice.ENDS)
        assert found == enumerated(steps, len(steps) + 2) == swept(steps)


def test_matrices_of_pieces_give_what_one_search_gives():
    rnd = random.Random(6)
    for _ in range(60):
        steps = random_steps(rnd, rnd.randint(0, 40))
        run = edit_lattice.Run()
        for i in range(0, len(steps), 7):
            run.add(edit_lattice.matrix(stepped(steps[i : i + 7])))
        whole = edit_lattice.search(stepped(steps), edit_lattice.START, edit_lattice.ENDS)
        assert edit_lattice.repair(run.whole()) == whole == swept(steps)


def digest_of(role, text):
    return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()


def brute(known, rows):
    """Reports by conversation; ``rows`` are (conv, turn, role, text)."""
    conversations = {conv: [] for conv in known}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        conversations.setdefault(conv, []).append((turn is not None, turn or 0, digest_of(role, text), turn, role, text))
    for conv, listed in conversations.items():
        listed.sort(key=lambda row: row[:3])
        seen, faults, steps, counts = set(), [], [], defaultdict(int)
        for *_, role, text in listed:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            steps.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
        initials = [step[0] for step in steps]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        numbers = {row[3] for row in listed} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = swept(steps)
        left, out = iter(listed), []
        for edit in audit:
            last = out[-1][0][:1] if out else ""
            given = "assistant" if last == "u" else "user"
            if edit == "I":
                out.append((given, ""))
            else:
                *_, role, text = next(left)
                out += {"D": [], "K": [(role, text)], "R": [(given, text)]}[edit]
        lines = "\n".join(f"{role}:{text}" for role, text in out)
        digest = hashlib.sha256(lines.encode()).hexdigest()
        yield (conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest), out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    texts = ["Yes.", "No!", "Well?", "and so", "", "  \n", "Long " * 50 + "end.", "half …", None, "Yes."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    made = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randint(0, 9)):
            turn = None if rnd.random() < 0.1 else turn + (rnd.random() < 0.1) * 5
            made.append((conv, turn, rnd.choice(roles), rnd.choice(texts)))
    for turn in range(1500):  # a long one
        made.append((1000, turn, roles[turn % 2], f"{turn % 700}" + rnd.choice(".!?…")))
    made += [(2000, 3, "user", "the same."), (2000, 3, "user", "the same.")] * 300
    made += [(3000, i, "user", "x" * 500_000 + ".") for i in range(2)] + made[:30]
    return made


def as_rows(result):
    names = ("conv_id", *conversation_repair.REPORT, "repaired_sha256")
    return sorted((tuple(row[name] for name in names) for row in result.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, kind string, place long, digest string"


def test_reports_and_repaired_rows(spark, rows):
    frame = spark.createDataFrame([(*row, "k", 1, "d") for row in rows], SCHEMA).repartition(5)
    expected = list(brute([], rows))
    assert as_rows(conversation_repair.digests(frame)) == sorted((report for report, _ in expected), key=repr)
    got = defaultdict(list)
    for row in conversation_repair.repaired(frame).orderBy("conv_id", "place").collect():
        assert row.place == len(got[row.conv_id])
        got[row.conv_id].append((row.role, row.text))
    assert dict(got) == {report[0]: out for report, out in expected if out}


def test_a_hot_conversation_is_cut(spark, rows):
    frame = spark.createDataFrame([(*row, "k", 1, "d") for row in rows if row[0] == 1000], SCHEMA)
    before = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = as_rows(conversation_repair.digests(frame.repartition(4)))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == [report for report, _ in brute([], [row for row in rows if row[0] == 1000])]


def test_damage_and_query(spark, rows, tmp_path):
    frame = spark.createDataFrame([(*row, "k", 1, "d") for row in rows], SCHEMA)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    damaged = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        row = (conv, turn, "user" if fate == 4 else role, text)
        damaged += [row] * {0: 0, 3: 2}.get(fate, 1)
    expected = brute({row[0] for row in rows}, damaged)
    got = page_queries.op13_conversation_repair(spark, str(tmp_path))
    assert as_rows(got) == sorted((report for report, _ in expected), key=repr)
    gone = [report for report, out in brute({row[0] for row in rows}, damaged) if not report[7]]
    assert gone


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_repair.digests(empty).count() == conversation_repair.repaired(empty).count() == 0
    known = spark.createDataFrame([("a",), (None,)], "conv_id string")
    rows = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    report = conversation_repair.digests(rows, known=known).collect()
    assert {(r.conv_id, r.gaps, r.cost, r.audit, r.repaired_sha256) for r in report} == {
        (conv, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv in ("a", None)
    }
