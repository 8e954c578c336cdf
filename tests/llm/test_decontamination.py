import random

import numpy as np

import brute
from common import SF, clashing, empty, odd, sentence  # noqa: F401
from quotelake.llm import decontamination as op
from quotelake.llm.fm_index import FMIndex


def test_query_equals_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {r.doc_id: r for r in op.op4_decontamination(spark, SF).collect()}
    some = 0
    for (i, _), (n, hit, names) in zip(docs, brute.hits(docs, items)):
        r = found[i]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), hit > 0)
        assert r.items_sha256 == brute.sha([x.encode() for x in names], b",")
        some += hit > 0
    assert some and len(found) == len(docs)


def _items(spark):
    return spark.createDataFrame(
        [(1, sentence(1, 300)), (2, "Two, words"), (3, None), (None, sentence(2, 30)), (4, ""), (2, "one"),
         (5, "LEAD tail"), (6, "x" * 5000)], "item_id long, text string")


def test_odd_rows_in_one_and_in_many_blocks(spark, clashing, monkeypatch):
    items = [(r.item_id, r.text) for r in _items(spark).collect()]
    docs = [(r.doc_id, r.text) for r in clashing.collect()]
    expected = sorted(map(str, brute.hits(docs, items)))
    for size in (op.PHRASE_BYTES, 700):
        monkeypatch.setattr(op, "PHRASE_BYTES", size)
        found = op.with_hits(clashing, _items(spark))
        assert sorted(found.columns) == sorted(clashing.columns)
        got = [(r.n_words, sum(x.high - x.low for x in r.hits), r["items"]) for r in found.collect()]
        assert sorted(map(str, got)) == expected


def test_cut_leaves_clean_texts(spark, clashing):
    left = op.without_hits(clashing, _items(spark))
    assert left.columns == clashing.columns and left.count() == clashing.count()
    texts = {r.doc_id: r.text for r in left.collect() if r.doc_id}
    assert texts[7] == "" and texts[18] == "  " + "  " and texts[1] is None
    assert texts[17] == "" and texts[6] == "a b c d" and texts[14] == sentence(7, 60000)


def test_empty_tables(spark, odd):
    assert op.with_hits(empty(odd), _items(spark)).count() == 0
    clean = op.with_hits(odd, empty(_items(spark)))
    assert clean.where("size(hits) > 0").count() == 0 and clean.count() == odd.count()


def test_index_finds_every_occurrence():
    rnd = random.Random(1)
    for _ in range(60):
        text = []
        for _ in range(rnd.randint(1, 8)):
            text += [rnd.randint(1, 4) for _ in range(rnd.randint(1, 40))] + [0]
        index = FMIndex(np.array(text), 4)
        for size in (1, 2, 5):
            phrases = np.array([[rnd.randint(1, 4) for _ in range(size)] for _ in range(20)])
            for phrase, low, high in zip(phrases.tolist(), *index.search(phrases)):
                places = sorted(index.locate(np.arange(low, max(low, high))).tolist())
                assert places == [p for p in range(len(text)) if text[p:p + size] == phrase]
