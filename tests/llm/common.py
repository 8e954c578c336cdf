"""Texts, and tables with odd rows, that the tests share."""

import random

import pytest

SF = "/root/testdata/sf0.001"
SYLLABLES = "an er in th re st on ha ti sh ou ly".split()


def sentence(seed, count):
    """Invented words, the same for the same seed."""
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 4))) for _ in range(count))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, blank, short, repeated and very long texts, near copies,
    shared passages, equal ids, and columns that operators use themselves."""
    base, passage = sentence(1, 300), sentence(2, 60)
    near = base.split(" ")
    near[150] = "other"
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "a b c d"), (7, base), (8, base),
        (9, " ".join(near)), (10, sentence(3, 80) + "\n" + passage + "\n" + sentence(4, 80)),
        (11, passage + " " + sentence(5, 70)), (12, sentence(6, 70) + " " + passage),
        (13, "the end " * 4000), (14, sentence(7, 60000)), (15, sentence(7, 60000)),
        (16, "ünï 日本語 " * 40 + " x"), (17, "x" * 5000), (18, "  lead\r\n\ttail  "),
        (20, sentence(8, 120)), (20, sentence(8, 120)), (None, sentence(8, 120)), (None, None),
        (21, "Copy! " * 3), (22, "word_chars % $ # | < > " * 12),
    ]
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "src0", None if k % 5 == 0 else k, "mine")
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, `rk` string")


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with columns named like those that operators make or use inside."""
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("mine").alias(c) for c in (
        "repeats", "hits", "items", "n_words", "ids", "decoded", "tree", "edits", "kept", "id", "class_id",
        "shard", "seed", "word", "row", "w", "s", "x", "c0", "links", "licenses", "encoded_chars", "distance",
        "base_failed", "grp", "Text2")])


def empty(df):
    return df.limit(0)
