import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from common import SF, clashing, empty, odd, sentence  # noqa: F401
from quotelake.llm import line_dedup as op
from quotelake.llm import words as W
from pyspark.sql import functions as F

UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def _key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(UPPER)


def _plain(docs, min_chars=40, min_docs=5):
    """(id, text) rows -> (n_lines, n_dropped, kept text), by dictionaries."""
    holders = defaultdict(list)
    for i, text in docs:
        for key in {_key(line) for line in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders[key].append(i)
    last = {k: max((i for i in ids if i is not None), default=None)
            for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if _key(x) not in last or last[_key(x)] == i]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_the_contract(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op.op11_line_dedup(spark, SF).collect()}
    expected = {i: (n, gone, _sha(kept)) for (i, _), (n, gone, kept) in zip(docs, _plain(docs))}
    assert found == expected and sum(x[1] for x in found.values()) > 0


def _lines(spark):
    """Lines at every limit: documents, characters, case, white space, repeats inside one text."""
    a, b, c = (sentence(k, 20) for k in (1, 2, 3))
    assert min(map(len, (a, b, c))) >= 40
    short, edge = "x" * 39, "é" * 40
    texts = [f"{a}\n{b}\n{short}\n{edge}", f"\t{a.upper()} \r\n{b}\n{short}\n{edge}\n", f"{a}\n{a}\n{b}\n{edge}", f"{a}\n{b}",
             f"\n{a}\n{short}\n{edge}", f"{short}\n{edge}", f"{short}\n{a} {c}", c, c, c, c + "\n" + c, None, "", "\n\n"]
    rows = [*enumerate(texts), (3, f"{a}\n{b}"), (None, f"{a}\n{c}\nown line"), (None, c), (99, sentence(4, 5000))]
    rows += [(100 + k, f"{sentence(5, 30)}\n{k}\n{sentence(6, 30)}") for k in range(40)]
    return spark.createDataFrame([(i, t, "mine") for i, t in rows], "doc_id long, text string, line string")


@pytest.mark.parametrize("filter_bytes", [op.FILTER_BYTES, op.BLOCK_BITS // 8])
def test_limits_and_a_full_filter(spark, monkeypatch, filter_bytes):
    monkeypatch.setattr(op, "HASHES", 7)
    docs = _lines(spark).repartition(5)
    made = op.without_repeated_lines(docs, filter_bytes=filter_bytes).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = [(i, n, gone, kept) for (i, _), (n, gone, kept) in zip(rows, _plain(rows))]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in made), key=repr) == sorted(expected, key=repr)
    assert {r.line for r in made} == {"mine"}


def test_odd_rows(spark, clashing):
    taken = clashing.unionByName(clashing).unionByName(clashing).select("*", *[
        F.lit("mine").alias(c) for c in ("lines", "doc", "key", "n_lines", "n_dropped", "gone_rk", "first")])
    made = op.without_repeated_lines(taken, min_docs=3).collect()
    rows = [(r.doc_id, r.text) for r in taken.select("doc_id", "text").collect()]
    expected = [(i, n, gone, kept) for (i, _), (n, gone, kept) in zip(rows, _plain(rows, min_docs=3))]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in made), key=repr) == sorted(expected, key=repr)
    assert {r.lines for r in made} == {r.gone_rk for r in made} == {r.rk for r in made} == {"mine"}
    assert op.without_repeated_lines(empty(taken)).count() == 0


def test_lines_of_a_run():
    texts = ["a\nb", "", "\n", "x", "\n\nü\n"]
    run, = W.runs(pa.array(texts))
    start, end, bounds = op.lines_of(run)
    body = run.data.tobytes()
    lines = [body[a:b].decode() for a, b in zip(start, end)]
    assert [lines[a:b] for a, b in zip(bounds, bounds[1:])] == [t.split("\n") for t in texts]


def test_filters_miss_no_repeat_and_drop_most_others(spark):
    """Every line of two documents is suspected; of the others hardly any."""
    rng = np.random.default_rng(5)
    alone = [bytes(rng.integers(97, 123, 60, np.uint8)).decode() for _ in range(4000)]
    both = [bytes(rng.integers(97, 123, 60, np.uint8)).decode() for _ in range(50)]
    docs = spark.createDataFrame(
        [(k, "\n".join(alone[k * 100:k * 100 + 100] + (both if k in (3, 30) else []))) for k in range(40)],
        "doc_id long, text string").repartition(6)
    seen, blocks = op.twice_seen(docs, "text")
    run, = W.runs(pa.array(["\n".join(both + alone)]))
    hashes = op.long_lines(run, 40)[4]
    bits = op.bits_of(hashes, blocks)
    whole = np.frombuffer(seen, np.uint8)
    hit = ((whole[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1).all(0)
    assert hit[:50].all() and hit[50:].mean() < 0.01
