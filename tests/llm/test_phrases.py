"""Phrase mining against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from trolley.llm import phrases
from trolley.llm.suffix_sort import prefix_counts


def test_prefix_counts():
    rnd = np.random.default_rng(3)
    for trial in range(30):
        n = int(rnd.integers(0, 400))
        keys = rnd.integers(1, rnd.integers(2, 12), (n, 4)).astype(np.uint64)
        for row, end in zip(keys, rnd.integers(1, 6, n)):
            row[end:] = 0
        weights = rnd.integers(1, 5, n)
        least = int(rnd.integers(1, 20))
        expected = Counter()
        for row, weight in zip(keys.tolist(), weights.tolist()):
            for end in range(2, 5):
                if row[end - 1]:
                    expected[tuple(row[:end])] += weight
        found, counts = prefix_counts(keys, weights, least)
        got = {tuple(k for k in row if k): c for row, c in zip(found.tolist(), counts.tolist())}
        assert got == {gram: c for gram, c in expected.items() if c >= least}
        assert len(got) == len(counts)


def brute(rows, least, percent, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        inside = defaultdict(int)
        for g, a in found.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    inside[g[i : i + m]] = max(inside[g[i : i + m]], a)
        listed = []
        for g, a in found.items():
            if 100 * inside[g] >= percent * a:
                continue
            score, _, l, r = min(
                (2_000_000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]])
                for k in range(1, len(g))
            )
            listed.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, g, l, r) in enumerate(sorted(listed)[:top], 1):
            yield (lang, rank, g.decode(), -a, l, r, n[lang], -score)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "THE", "the", "Of", "▁", "日本"]
    marks = [" ", " ", " ", "  ", "\t", " ", ". ", ",", "\n", "\r\n", "\x0b", "? "]

    def text(n):
        return "".join(rnd.choice(words[: rnd.choice([4, 47])]) + rnd.choice(marks) for _ in range(n))

    made = [(text(rnd.randint(0, 60)), rnd.choice(["en", "de", None, "und", ""])) for _ in range(150)]
    made += [("hot pair " + text(3), "en") for _ in range(300)] + [("the same old song.", "en")] * 200
    made += [(None, "en"), ("", None), (" \t\n", "fr"), ("only.pieces,of;one", "fr"), (text(3000).replace("\n", " "), "de")]
    return made


@pytest.mark.parametrize("least, top, shard, block", [(3, 40, 1 << 18, 8 << 20), (6, 1000, 64, 700), (1, 5, 1 << 18, 300)])
def test_collocations(spark, rows, least, top, shard, block):
    frame = spark.createDataFrame(
        [(i, text, lang, 0, "g") for i, (text, lang) in enumerate(rows)], "a long, text string, lang string, n long, g string"
    ).repartition(3)
    got = phrases.collocations(frame, least=least, top=top, shard=shard, block=block)
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert got.columns == list(names)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, least, 80, top))


def test_all_phrases_and_no_phrases(spark, rows):
    frame = spark.createDataFrame(rows, "text string, lang string")
    got = {tuple(r) for r in phrases.collocations(frame, least=5, percent=50).collect()}
    expected = {(lang, *rest) for lang, _, *rest in brute(rows, 5, 50, 10**9)}
    assert got == expected
    assert phrases.collocations(frame.limit(0), top=3).count() == 0
    assert phrases.collocations(frame, least=10**6, top=3).count() == 0


def test_words_with_one_hash_are_noticed(spark):
    schema = "lang string, hash long, key long, word string, n long"
    words = [("en", 1, 1, "a", 50), ("en", 2, 2, "b", 3), ("de", 2, 2, "c", 90), ("en", 3, 3, "d", 1), ("en", 3, 3, "e", 2)]
    assert not phrases.clashes(spark.createDataFrame(words, schema), 30)
    assert phrases.clashes(spark.createDataFrame(words + [("en", 1, 1, "f", 1)], schema), 30)


def test_another_seed_gives_the_same(spark, rows):
    frame = spark.createDataFrame(rows, "text string, lang string")
    first, second = (sorted(map(tuple, phrases.collocations(frame, least=4, top=9, seed=s).collect())) for s in (0, 7))
    assert first == second


def test_a_bitmap_lets_all_its_entries_pass(spark):
    keys = np.random.default_rng(4).integers(-(1 << 63), (1 << 63) - 1, 5000)
    entries = spark.createDataFrame([(int(k),) for k in keys[:3000]], "key long")
    whole = phrases.bitmap(entries, 3000)
    held = phrases._in(whole, keys.view(np.uint64))
    assert held[:3000].all() and held[3000:].mean() < 0.1
