import math
import random

import brute
import pytest
from common import SF, clashing, empty, odd  # noqa: F401
from pyspark.sql import functions as F
from quotelake.llm import quality as op


def _check(rows, docs):
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    expected = []
    for text in docs:
        c = brute.counts(text)
        expected.append((*c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(expected)
    assert not any(r.kept for r in rows if r.base_failed)


def _check_verdicts(rows, places):
    """Distances and verdicts against plain numpy; ``places``: doc_id -> (lang, source)."""
    rows = [r for r in rows if not r.base_failed]
    features = [(math.log(r.n_words), r.word_chars / r.n_words, math.sqrt(r.n_symbols / r.word_chars),
                 math.log1p(r.n_dup_lines), r.n_repeat_words / r.n_words) for r in rows]
    expected = brute.distances(
        [(*places[r.doc_id], f) for r, f in zip(rows, features)], op.LEAST, floors=op.FLOORS,
        spread=op.SPREAD, near=op.NEAR, near_spread=op.NEAR_SPREAD, fall=op.FALL)
    for r, d in zip(rows, expected):
        assert r.distance == pytest.approx(d, rel=1e-6, abs=1e-9), r.doc_id
        assert r.kept == (d <= op.CUTOFF)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = op.op10_quality_rules(spark, SF).collect()
    _check(rows, [r.text for r in docs])
    _check_verdicts(rows, {r.doc_id: (r.lang, r.source) for r in docs})


def test_rows_of_a_group_without_an_estimate_stay(spark, monkeypatch):
    rows = [(i, t, lang, s) for i, t, lang, s in _group(random.Random(9), "en", 8, 0, False, 0, _symbols)]
    df = spark.createDataFrame([*rows, (9, "few words", "en", "s")],
                               "doc_id long, text string, lang string, source string")
    made = op.robust_estimates
    monkeypatch.setattr(op, "robust_estimates", lambda rows: made(rows).limit(0))
    got = {r.doc_id: r for r in op.verdicts(df, {"doc_id": F.col("doc_id")}).collect()}
    assert len(got) == 9 and all(got[i].kept and got[i].distance is None for i in range(8))
    assert not got[9].kept


def test_odd_rows(spark, clashing):
    rows = op.verdicts(clashing, {"doc_id": F.col("doc_id")}).collect()
    _check(rows, [r.text for r in clashing.collect()])
    kept = op.kept_rows(clashing)
    assert kept.columns == clashing.columns and kept.count() == sum(r.kept for r in rows)
    assert op.kept_rows(empty(clashing)).count() == 0


def test_outliers_of_their_group_go_and_no_others(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(900):
        far = i % 30 == 0
        n = int(200 * 2.718 ** rnd.gauss(0, 0.5)) + 60
        unit = ["###" if far and k % 2 else "w" * rnd.randint(3, 6) + str(rnd.random()) for k in range(n)]
        rows.append((i, " ".join(unit), "en", f"s{i % 3}"))
    rows += [(1000 + i, t, "xx", None) for i, (_, t, _, _) in enumerate(rows[1:20])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    verdicts = op.verdicts(df, {"doc_id": F.col("doc_id")}).collect()
    _check_verdicts(verdicts, {i: (lang, source) for i, _, lang, source in rows})
    got = {r.doc_id: r.kept for r in verdicts}
    assert all(got[i] == (i % 30 != 0) for i in range(900)) and all(got[1000 + i] for i in range(19))


def test_only_dataframe_operations(spark):
    plan = op.op10_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def _group(rnd, lang, good, junk, copied, first, bad):
    """``good`` ordinary texts of one language and source, and ``junk`` made by ``bad``."""
    rows, hot = [], bad(rnd)
    for k in range(good + junk):
        n = int(200 * 2.718 ** rnd.gauss(0, 0.5)) + 60
        text = " ".join("w" * rnd.randint(3, 6) + str(rnd.random()) for _ in range(n))
        rows.append((first + k, text if k < good else hot if copied else bad(rnd), lang, "s"))
    return rows


def _symbols(rnd):
    """A text with symbols for a third of its characters."""
    return " ".join("######" if k % 2 else "w" * rnd.randint(3, 6) + f"{rnd.random():.6f}"
                    for k in range(rnd.randint(150, 500)))


def test_junk_of_more_than_a_quarter_of_a_group_goes(spark):
    rnd, rows = random.Random(4), []
    cases = [(200 - j, j, copied) for j in (60, 80) for copied in (False, True)] + [(140, 300, True)]
    for c, (good, junk, copied) in enumerate(cases):
        rows += _group(rnd, f"l{c}", good, junk, copied, 1000 * c, _symbols)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in op.verdicts(df, {"doc_id": F.col("doc_id")}).collect()}
    for c, (good, junk, _) in enumerate(cases):
        assert not any(got[1000 * c + good + k] for k in range(junk)), cases[c]
        assert sum(got[1000 * c + k] for k in range(good)) >= 0.99 * good, cases[c]


def test_repeats_and_symbols_of_a_clean_group(spark):
    rnd = random.Random(6)
    rows = _group(rnd, "en", 300, 0, False, 0, _symbols)

    def words(n):
        return ["w" * rnd.randint(3, 6) + str(rnd.random()) for _ in range(n)]

    for k in range(20):
        n = rnd.randint(150, 600)
        passage, line = words(n * 45 // 200), words(13)
        rows.append((1000 + k, " ".join(passage + words(n - 2 * len(passage)) + passage), "en", "s"))
        rows.append((2000 + k, "\n".join(" ".join(x) for x in (line, words(50), line)), "en", "s"))
        rows.append((3000 + k, " ".join("####" + w if i % 4 == 0 else w for i, w in enumerate(words(n))), "en", "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in op.verdicts(df, {"doc_id": F.col("doc_id")}).collect()}
    assert not any(got[1000 + k] for k in range(20))    # 45 per cent of the words repeated
    assert all(got[2000 + k] for k in range(20))        # a short text with one line twice
    assert sum(got[k] for k in range(300)) >= 297
    assert not any(got[3000 + k] for k in range(20))


def test_a_null_source_is_a_group_of_its_own(spark):
    rnd = random.Random(8)
    rows = [(i, t, "en", None) for i, t, _, _ in _group(rnd, "en", 300, 0, False, 0, _symbols)]
    rows += [(i, t, "en", f"small{i % 6}") for i, t, _, _ in _group(rnd, "en", 0, 120, False, 1000, _symbols)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    verdicts = op.verdicts(df, {"doc_id": F.col("doc_id")}).collect()
    _check_verdicts(verdicts, {i: (lang, source) for i, _, lang, source in rows})
    got = {r.doc_id: r.kept for r in verdicts}
    assert sum(got[i] for i in range(300)) >= 297 and sum(got[1000 + i] for i in range(120)) >= 118
