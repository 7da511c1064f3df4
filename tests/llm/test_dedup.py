"""Operators 2, 3, 4 and 7 against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plan_text import plan_of
from result_rows import by_row
from trolley.llm import line_dedup, ngram_join, repeats, substring_dedup, suffix_dedup
from trolley.llm.cuckoo import CuckooFilter
from trolley.llm.line_dedup import LineIndex
from trolley.llm.repeats import Windows
from trolley.llm.trie import SetTrie
from trolley.session import scratch_dir

LAST = 1 << 62
SMALL = {"block_bytes": 3000, "shard_bytes": 4000}
BLANK = " \t\n\x0b\x0c\r"


def order_of(doc_id):
    return LAST if doc_id is None else doc_id


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def spans_removed(rows, width):
    counts = Counter(
        tuple(w[i : i + width]) for _, text in rows for w in [words_of(text)] for i in range(len(w) - width + 1)
    )
    expected = []
    for doc_id, text in rows:
        w = words_of(text)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        expected.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(expected, key=repr)


@pytest.mark.parametrize("options", [{}, SMALL, {**SMALL, "hot_blocks": 1}])
def test_substring_dedup(docs, rows, options):
    found = by_row(substring_dedup.dedup_spans(docs, **options), "n_words", "n_removed", "kept")
    assert found == spans_removed(rows, 35)


@pytest.mark.parametrize("options", [{}, SMALL, {**SMALL, "hot_blocks": 1}])
def test_suffix_dedup(docs, rows, options):
    width, first, expected = 50, {}, []
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            window = data[i : i + width]
            first[window] = min(first.get(window, LAST), order_of(doc_id))
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < order_of(doc_id):
                gone[i : i + width] = True
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        expected.append((doc_id, len(data), int(gone.sum()), spans, kept))
    result = suffix_dedup.dedup_bytes(docs, **options).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in result]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def sent_texts(texts, width=50):
    """Contexts whose texts leave their blocks, when each of ``texts`` is a block, and bytes of those."""
    windows = Windows(width, 16, suffix_dedup.byte_units, count_docs=True)
    blocks = [
        {"doc_id": i, "ids": [i], "bounds": [0, len(x)], "text": repeats._compress(np.frombuffer(x, np.uint8))}
        for i, x in enumerate(texts)
    ]

    def step(function, *options):
        made = list(function([pa.RecordBatch.from_pylist(blocks)], windows, 1, *options))
        return pa.Table.from_batches(made) if made else None

    def take(name, shard, made):
        answers = shard(made).to_pylist() if made else []
        for block in blocks:
            block[name] = [x for x in answers if x["doc_id"] == block["doc_id"]]

    take("replies", repeats._repeated(1_024), step(repeats._named))
    take("verdicts", repeats._judged(True), step(repeats._outlined, 1))
    sent = step(repeats._sent, 1)
    return (sum(sent["n"].to_pylist()), sum(map(len, sent["text"].to_pylist()))) if sent else (0, 0)


def test_only_contexts_that_differ_send_their_text():
    chance = np.random.default_rng(5)
    one, two, gram = (bytes(chance.integers(97, 123, n, dtype=np.uint8)) for n in (20_000, 20_000, 30))
    assert sent_texts([one, one, one]) == (0, 0)  # whole copies
    assert sent_texts([one, two]) == (0, 0)
    scattered = [b"".join(x[i : i + 300] + gram for i in range(0, 20_000, 300)) for x in (one, two)]
    assert sent_texts(scattered) == (0, 0)  # anchors in common, no window
    n, size = sent_texts([one, two[:9_000] + one[5_000:7_000] + two[9_000:]])
    assert 0 < n <= 8 and 0 < size < 1_000  # where the passage begins and ends


def test_suffix_dedup_of_patched_texts(spark):
    rnd = random.Random(8)
    pieces = ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(10, 300))) for _ in range(25)] + ["ab" * 90]
    rows = [
        (rnd.choice([None, -(1 << 63), -5, *range(100)]), "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 9))))
        for _ in range(120)
    ]
    first, expected = {}, []
    for doc_id, text in rows:
        data = text.encode()
        for i in range(len(data) - 49):
            first[data[i : i + 50]] = min(first.get(data[i : i + 50], LAST), order_of(doc_id))
    for doc_id, text in rows:
        data, gone = text.encode(), set()
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < order_of(doc_id):
                gone.update(range(i, i + 50))
        expected.append((doc_id, len(data), len(gone), bytes(x for i, x in enumerate(data) if i not in gone)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for options in ({}, SMALL, {**SMALL, "hot_blocks": 2}):
        result = suffix_dedup.dedup_bytes(table, **options).collect()
        found = [(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in result]
        assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_blocks_are_not_shuffled(spark, docs):
    chosen = ("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.shuffle.partitions", "3")
    before = {name: spark.conf.get(name) for name, _ in chosen}
    try:
        for name, value in chosen:
            spark.conf.set(name, value)
        plan = plan_of(suffix_dedup.dedup_bytes(docs, **SMALL))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    joined = [x for x in plan.split("FileScan")[1:] if "bounds#" in x.split("\n")[0]]
    assert len(joined) == 2 and all("SelectedBucketsCount: 3" in x.split("\n")[0] for x in joined)
    assert not spark.sql("SHOW TABLES LIKE 'trolley_blocks*'").count()


def test_empty_tables(nothing):
    assert substring_dedup.dedup_spans(nothing).count() == 0
    assert suffix_dedup.dedup_bytes(nothing).count() == 0
    assert line_dedup.dedup_lines(nothing).count() == 0
    assert line_dedup.rewritten(nothing).count() == 0
    assert ngram_join.near_components(nothing).count() == 0
    assert ngram_join.firsts(nothing).count() == 0


def lines_kept(rows):
    holders = defaultdict(set)

    def key(line):
        found = line.strip(BLANK)
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in found)

    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(order_of(doc_id))
    expected = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(holders[key(line)]) < 2 or min(holders[key(line)]) == order_of(doc_id)
        ]
        expected.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(expected, key=repr)


def test_line_dedup(docs, rows):
    found = by_row(line_dedup.dedup_lines(docs), "n_lines", "n_dropped", "kept")
    assert found == lines_kept(rows)


def test_rewritten_keeps_columns(docs, rows):
    result = line_dedup.rewritten(docs)
    assert result.schema == docs.schema
    found = by_row(result, "text", "n_chars")
    assert found == sorted(((i, text, len(text)) for i, _, _, text in lines_kept(rows)), key=repr)


def test_line_index_in_batches_and_back(spark, docs, rows):
    some = docs.where("doc_id <= 6")
    rest = docs.where("doc_id > 6 OR doc_id IS NULL")
    index = LineIndex.empty(spark, shards=3).insert(some)
    both = index.insert(rest)
    found = by_row(line_dedup.cut_lines(docs, both), "n_lines", "n_dropped", "kept")
    assert found == lines_kept(rows)
    undone = both.delete(rest.select("doc_id"))
    assert by_row(undone.references().withColumnRenamed("smallest", "doc_id"), "documents") == by_row(
        index.references().withColumnRenamed("smallest", "doc_id"), "documents"
    )
    found = by_row(line_dedup.cut_lines(some, undone), "n_dropped", "kept")
    kept = [r for r in rows if r[0] is not None and r[0] <= 6]
    assert found == sorted(((i, n, text) for i, _, n, text in lines_kept(kept)), key=repr)
    again = undone.insert(rest)
    assert by_row(line_dedup.cut_lines(docs, again), "n_lines", "n_dropped", "kept") == lines_kept(rows)


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.data())
@settings(max_examples=40, deadline=None)
def test_cuckoo_filter(members, data):
    hashes = np.array(sorted(members), np.uint64)
    filter_ = CuckooFilter(data.draw(st.integers(1, 100)))  # grows beyond its capacity
    filter_.insert(hashes)
    assert filter_.contains(hashes).all()
    gone = hashes[: len(hashes) // 2]
    filter_.remove(gone)
    assert filter_.contains(hashes[len(hashes) // 2 :]).all()
    filter_.remove(hashes[len(hashes) // 2 :])
    assert filter_.size + (filter_.after.size if filter_.after else 0) == 0


def test_cuckoo_filter_removes_from_a_chain_what_looks_alike():
    rng = np.random.default_rng(5)
    prints, places = rng.integers(1, 6, 4000).astype(np.uint64), rng.integers(0, 1 << 9, 4000).astype(np.uint64)
    hashes = np.unique(prints << np.uint64(48) | places)
    rng.shuffle(hashes)
    filter_ = CuckooFilter(40)
    for some in np.array_split(hashes, 9):
        filter_.insert(some)
    filter_.remove(hashes[::2])
    assert filter_.after and filter_.contains(hashes[1::2]).all()


def alike():
    """Two lines with the same print and bucket in the least filter."""
    seen, n = {}, len(CuckooFilter(64).table)
    for i in range(100_000):
        line = f"a line with the number {i}"
        value = int.from_bytes(line_dedup.key_of(line.encode(), 10)[:8], "little")
        place = (max(value >> 48, 1), value % n)
        if place in seen:
            return seen[place], line
        seen[place] = line


@pytest.mark.parametrize("kept", [0, 1])
def test_line_index_keeps_keys_that_look_alike(spark, kept):
    lines = alike()
    docs = [spark.createDataFrame([(i, line)], "doc_id long, text string") for i, line in enumerate(lines)]
    index = LineIndex.empty(spark, shards=1).insert(docs[0]).insert(docs[1])
    index = index.delete(docs[1 - kept])
    last = spark.createDataFrame([(7, lines[kept])], "doc_id long, text string")
    (row,) = index.insert(last).references().collect()
    assert (row.key, row.documents, row.smallest) == (line_dedup.key_of(lines[kept].encode(), 10), 2, kept)
    both = LineIndex.empty(spark, shards=1).insert(docs[0].union(docs[1])).delete(docs[1 - kept]).insert(last)
    assert [(r.documents, r.smallest) for r in both.references().collect()] == [(2, kept)]


@pytest.mark.parametrize("kept", [0, 1])
def test_probe_and_forget_with_equal_hashes(kept):
    keys = [b"12345678" + bytes([i] * 8) for i in range(2)]
    nothing = line_dedup._NO_FILTER.empty_table()

    def new(*own):
        return line_dedup.pa.table(
            {"shard": line_dedup.pa.array([0] * len(own), "int32"), "key": list(own), "again": [False] * len(own)}
        )

    once = line_dedup._probe(nothing, new(*keys))
    apart = line_dedup._probe(line_dedup._probe(nothing, new(keys[0])), new(keys[1]))
    assert apart.column("asked").to_pylist() == [True, False]
    for table in (once, line_dedup._add(apart, new(keys[1]))):
        left = line_dedup._forget(table, new(keys[1 - kept]))
        assert keys[kept] in line_dedup._probe(left, new(keys[kept])).column("key").to_pylist()


def shingles(text, n):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words_of(text)]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def groups_of(rows, n, percent):
    """Set size and component of each row."""
    sets = [shingles(text, n) for _, text in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    ids = defaultdict(set)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].add(doc_id)
    least = {root: min((x for x in found if x is not None), default=None) for root, found in ids.items()}
    return [(doc_id, len(sets[i]), least[find(i)] if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


def test_blocks_are_told_how_often_shingles_occur(spark, docs, rows):
    """Each block gets the number of rows that hold each of its shingles, whatever the shards."""
    by_hash = Counter()
    for shards in (1, 7):
        blocks = ngram_join.blocks_of(docs, scratch_dir(spark, "blocks"))
        assert blocks.count() >= 3
        told = ngram_join._questions(blocks, 3, shards).groupBy("shard").applyInArrow(ngram_join._answer, ngram_join._ANSWER)
        answers = defaultdict(dict)
        for r in told.collect():
            answers[r.block][r.shard] = np.frombuffer(pa.decompress(bytes(r.counts), r.n, "zstd", asbytes=True), np.uint8)
        held, said = Counter(), {}
        for r in blocks.collect():
            _, hashes = ngram_join._block_sets(r.n_bounds, r.n_bytes, bytes(r.texts), 3)
            held.update(hashes.tolist())
            _, _, order = ngram_join._dealt(hashes, shards)
            parts = np.concatenate([answers[r.block][k] for k in sorted(answers[r.block])])
            for h, n in zip(hashes[order].tolist(), parts.tolist()):
                assert said.setdefault(h, n) == n
        assert said == {h: min(n, 255) for h, n in held.items()}
        by_hash = by_hash or held
        assert held == by_hash


def test_ngram_join_over_many_shards(docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "_SHARD_SHINGLES", 200)
    got = by_row(ngram_join.near_components(docs), "n_shingles", "component_id")
    assert got == sorted(groups_of(rows, 3, 90), key=repr)


@pytest.mark.parametrize("n, percent, tile", [(3, 90, 1000), (3, 90, 1), (5, 80, 1000), (2, 30, 2)])
def test_ngram_join(docs, rows, n, percent, tile):
    result = ngram_join.near_components(docs, n=n, percent=percent, tile=tile)
    assert by_row(result, "n_shingles", "component_id") == sorted(groups_of(rows, n, percent), key=repr)


def test_firsts(docs, rows):
    result = ngram_join.firsts(docs, n=5, percent=80)
    assert result.schema == docs.schema
    expected = {
        (doc_id, text)
        for (doc_id, text), (_, size, component) in zip(rows, groups_of(rows, 5, 80))
        if size == 0 or component in (doc_id, None)
    }
    assert by_row(result, "text") == sorted(expected, key=repr)


@given(st.lists(st.frozensets(st.integers(0, 12), min_size=1), min_size=1, max_size=12, unique=True), st.integers(20, 100))
@settings(max_examples=150, deadline=None)
def test_trie_finds_every_link(sets, percent):
    arrays = [np.array(sorted(s), np.int64) for s in sets]
    trie = SetTrie(arrays, 13)
    for i, a in enumerate(sets):
        expected = [j for j, b in enumerate(sets) if 100 * len(a & b) >= percent * len(a | b)]
        assert sorted(trie.probe(arrays[i], percent).tolist()) == expected
