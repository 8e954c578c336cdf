import brute
from common import SF, clashing, empty, odd, sentence  # noqa: F401
from quotelake.llm import jaccard_join as op
from quotelake.llm.components import components


def _got(df):
    return {r.id: (r.class_id, r.text_id, r.n_copies, r.n_links) for r in df.collect()}


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = op.op2_jaccard_join(spark, SF).withColumnRenamed("doc_id", "id")
    assert _got(found) == brute.classes(docs)


def test_odd_rows(spark, clashing):
    docs = [(r.doc_id, r.text) for r in clashing.collect()]
    distinct = {i: t for i, t in docs if i is not None}
    expected = brute.classes(list(distinct.items()))
    expected[20] = (20, 20, 2, 0)
    got = op.near_duplicates(clashing)
    assert _got(got) == expected and got.count() == sum(i is not None for i, _ in docs)
    left = op.representatives(clashing)
    assert left.columns == clashing.columns
    assert {r.doc_id for r in left.collect()} == {None, *(c for c, *_ in expected.values())}
    assert op.near_duplicates(empty(clashing)).count() == 0


def test_groups_larger_than_a_block(spark, monkeypatch):
    base = sentence(1, 120).split(" ")
    docs = []
    for i in range(60):
        own = list(base)
        for k in range(i % 5):
            own[(i * 7 + k * 31) % 120] = f"w{i}x{k}"
        docs.append((i, " ".join(own)))
    docs += [(100 + i, sentence(50 + i, 40)) for i in range(20)]
    expected = brute.classes(docs)
    monkeypatch.setattr(op, "BLOCK", 16)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _got(op.near_duplicates(df)) == expected
    assert sum(x[3] for x in expected.values()) > 500


def test_tail_of_the_posterior():
    least = op.least_matches(4, 8, tolerance=0.3)
    # Beta(m + 1, n - m + 1) above 0.8: n = 4 gives 0.0067 (m=2: 0.058, m=3: 0.263, m=4: 0.672).
    assert least[4] == 4


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(1, 70)] + [(200, 100), (100, 150), (300, 300)]
    found = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 71)}, 100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
