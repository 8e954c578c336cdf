import time
from pathlib import Path

import brute
from common import SF, clashing, empty, odd, sentence  # noqa: F401
from quotelake.llm import substring_dedup as op
from pyspark.sql import functions as F


def _rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_query_equals_brute_force(spark):
    docs = sorted(_rows(spark.read.parquet(f"{SF}/documents.parquet")))
    found = {r.doc_id: r for r in op.op3_substring_dedup(spark, SF).collect()}
    assert len(found) == len(docs)
    for (i, text), gone in zip(docs, brute.repeats(docs)):
        own = brute.words(text)
        kept = brute.sha([w for w, g in zip(own, gone) if not g])
        assert (found[i].n_words, found[i].n_removed, found[i].kept_sha256) == (len(own), sum(gone), kept)


def test_query_on_runs_without_kept_words(spark, odd, tmp_path):
    """Runs of texts that keep no word: a long copy is a run of its own, 15 repeats 14."""
    whole = odd.where("doc_id is not null and doc_id <> 20")
    for name, docs in (("odd", whole), ("blank", odd.where("doc_id in (2, 3)")), ("none", odd.where("doc_id in (1, 2)"))):
        docs.select("doc_id", "text").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        rows = _rows(docs)
        found = {r.doc_id: r for r in op.op3_substring_dedup(spark, f"{tmp_path}/{name}").collect()}
        assert len(found) == len(rows)
        for (i, text), gone in zip(rows, brute.repeats(rows)):
            own = brute.words(text)
            kept = brute.sha([w for w, g in zip(own, gone) if not g])
            assert (found[i].n_words, found[i].n_removed, found[i].kept_sha256) == (len(own), sum(gone), kept)
        assert name != "odd" or found[15].n_removed == found[15].n_words == 60000


def test_odd_rows(spark, clashing):
    docs = _rows(clashing)
    expected = sorted((str(i), str(t), sum(g)) for (i, t), g in zip(docs, brute.repeats(docs)))
    found = op.with_repeats(clashing)
    assert sorted(found.columns) == sorted(clashing.columns)
    size = F.coalesce(F.aggregate("repeats", F.lit(0), lambda n, x: n + x["high"] - x["low"]), F.lit(0))
    assert sorted((str(r.doc_id), str(r.text), r.n) for r in
                  found.select("doc_id", "text", size.alias("n")).collect()) == expected


def test_small_windows_against_brute_force(spark):
    docs = [(i, " ".join(sentence(i % 7 * 10 + k, 6) for k in range(i % 4, i % 4 + 4))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: [(x.low, x.high) for x in r.repeats or ()] for r in op.with_repeats(df, window=8, seed=3).collect()}
    for (i, _), gone in zip(docs, brute.repeats(docs, 8)):
        assert [any(a <= p < b for a, b in got[i]) for p in range(len(gone))] == gone


def test_cut_keeps_layout_rows_and_columns(spark, clashing):
    left = op.without_repeats(clashing)
    assert left.columns == clashing.columns and left.count() == clashing.count()
    docs = _rows(clashing)
    kept = [[w for w, g in zip(brute.words(t), gone) if not g] for (_, t), gone in zip(docs, brute.repeats(docs))]
    assert sorted(map(str, kept)) == sorted(str(brute.words(t)) for _, t in _rows(left))
    texts = {r.doc_id: r.text for r in left.where("doc_id in (7, 11, 18, 1)").collect()}
    assert texts[18] == "  lead\r\n\ttail  " and texts[1] is None and texts[11] == sentence(5, 70)


def test_empty_table(spark, odd):
    assert op.with_repeats(empty(odd)).count() == 0 and op.without_repeats(empty(odd)).count() == 0


def test_shuffle_files_go_with_the_step_that_wrote_them(spark):
    """All steps are written when the spans come back; only their tables are left."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    left = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*.data")}
    before, key = left(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    op.repeated_spans(spark.read.parquet(f"{SF}/documents.parquet"))
    end = time.time() + 10
    while left() - before and time.time() < end:  # executors remove them a little later
        time.sleep(0.1)
    assert not left() - before and spark.conf.get(key) == was
