import random

import pytest

# Columns named like what operators add; none of them may break one.
CLASHING = "n_words string, n_hit long, spans string, keys string, key string, log_weight string, digest string, " \
    "n_shingles string, node string, component_id string, ids string, dropping string, shard string, replies string"


def corpus():
    """(doc_id, text): copies, near copies, shared passages, blanks, nulls, and a long text."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abdeiklmnorstué") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, line = text(60), "A  line that many documents share"
    base = text(120)
    rows = [
        (1, base),
        (2, base),
        (3, base.replace(base.split()[5], "changed", 1)),
        (4, base + " one two"),
        (5, text(30) + " " + passage + " " + text(20)),
        (6, passage + "\n" + line + "\n" + text(15)),
        (7, line.upper() + "  \n" + text(10) + "\n" + line),
        (8, ""),
        (9, None),
        (10, "  \n\t "),
        (11, "one"),
        (12, "One"),
        (13, "ab cd"),
        (14, "a " * 300),
        (15, "é" * 130 + " ü " + "é" * 130),
        (16, text(3000) + "\n" + passage + "\n" + text(3000)),
        (17, passage.replace(" ", "\n")),
        (18, text(34)),
        (19, text(35)),
        (None, base),
        (None, "a row without an id\n" + line),
        (20, "▁ strange  <s> \U0001f642 text\r\nhere  "),
        (20, "another text under the same id\n" + line),
        (2, base),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    extra = (None,) * (len(CLASHING.split(",")))
    data = [(i, text, "en", "s", None if text is None else len(text), *extra) for i, text in rows]
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
