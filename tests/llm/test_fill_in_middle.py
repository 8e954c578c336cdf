import hashlib

import pytest
import regex

from common import SF, clashing, empty, odd, sentence  # noqa: F401
from quotelake.llm import fill_in_middle as op
from pyspark.sql import functions as F


def _plain(i, text):
    """The contract word by word, without regex."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if n == 0 or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_contract(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op.op13_fill_in_middle(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, prefix, middle, output = _plain(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (_sha(output), _sha(docs[r.doc_id] or ""))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_odd_rows(spark, clashing):
    taken = clashing.select("*", *[F.lit("mine").alias(c) for c in ("n", "form", "output", "h0", "y1")])
    made = op.with_fill_in_middle(taken).withColumn("back", op.restored(F.col("output"), F.col("form")))
    rows = made.collect()
    assert len(rows) == taken.count()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == _plain(r.doc_id, r.text)
        assert r.back == (r.text or "") and r.h0 == r.y1 == r.rk == r.Text2 == "mine"
    assert op.with_fill_in_middle(empty(taken)).count() == 0


@pytest.mark.parametrize("text", [
    "a<", "<S", "S>M>P>", "<<<>>>", "x<P", "ab<P>cd", "<M>", "é日本\U0001F600\n", "<" * 9 + "S" + ">" * 9])
def test_marks_at_the_cuts(spark, text):
    """Parts of marks next to the cuts are no marks."""
    docs = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string")
    made = op.with_fill_in_middle(docs).withColumn("back", op.restored(F.col("output"), F.col("form")))
    for r in made.collect():
        assert r.back == text and (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == _plain(r.doc_id, text)


def test_long_texts_and_other_units():
    text = "aé日\n " * 300_001
    points = regex.compile(f"({op.CODE_POINT})*")
    assert op.unit_ends(points, text).tolist() == list(range(1, len(text) + 1))
    words = regex.compile(r"(\s*\S+\s*$|\s*\S+)*")
    text = sentence(1, 500)
    whole = op.unit_ends(words, text).tolist()
    assert len(whole) == 500 and whole == op.unit_ends(words, text, 40).tolist()
    assert op.unit_ends(words, "x" * 999 + " y z", 10).tolist() == [999, 1001, 1003]
    assert op.unit_ends(points, "").tolist() == []
    with pytest.raises(ValueError, match="do not cover"):
        op.unit_ends(regex.compile("(a)*"), "aab")
