from __future__ import annotations

import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that documents may have besides, named like ones that operators use inside.
EXTRA = ("n", "key", "node", "runs", "mark", "score", "spans", "n_words", "_row", "_kept", "component", "group", "part", "x0")

WORDS = [a + b for a in ("al", "be", "co", "du", "era", "fi", "go", "hé", "ist", "ja") for b in ("n", "ra", "st", "mo", "vé", "ki", "lu")]


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    words = [draw.choice(WORDS) for _ in range(n)]
    for i in range(11, n, 12):
        words[i] += draw.choice(([".\n"], [","], ["."])).pop()
    return " ".join(words)


def edited(text: str, seed: int, n: int) -> str:
    draw, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[draw.randrange(len(words))] = draw.choice(WORDS) + "x"
    return " ".join(words)


@pytest.fixture(scope="session")
def rows():
    """Ordinary, null, empty, blank, short, very long, equal, near and repeated documents, and ones that
    share a passage; an id that two texts have, and null ids, come last."""
    passage, base = prose(1, 60), prose(2, 120)
    texts = [prose(100 + i, 30 + 17 * i) for i in range(12)]
    texts += [None, "", " \n\t ", "one", "two words", "One", base, base, base.upper(), prose(3, 9000)]
    texts += [edited(base, 10 + i, 1 + i % 3) for i in range(12)]
    texts += [f"{prose(200 + i, 50)} {passage} {prose(300 + i, 40)}" for i in range(8)]
    texts += ["a " * 300, "na\u0000me   x y " * 20, "the the the " * 40, prose(3, 9000)[:30000]]
    out = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*out, out[5], out[5], (7, prose(400, 80), None, None, 1), (None, prose(401, 90), "en", None, 2), (None, base, "en", "s1", 3)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCUMENT).repartition(3).cache()


@pytest.fixture(scope="session")
def wide(spark, rows):
    """The same documents with further columns."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, DOCUMENT).select("*", *(F.lit("z").alias(c) for c in EXTRA))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENT)


def counted(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda r: [(x is not None, x) for x in r])
