import random
import re
import time
import types

import numpy as np
import pyarrow as pa

from common import SF, clashing, empty, odd, sentence  # noqa: F401
from quotelake.llm import licenses as op

SHORT = {text: name for name, text in op.TEMPLATES.items() if len(text) < 90}


def _plain(template, text, low, high):
    rows = [[0] * (len(text) + 1) for _ in range(len(template) + 1)]
    for i in range(1, len(template) + 1):
        for j in range(1, len(text) + 1):
            best = max(rows[i - 1][j], rows[i][j - 1])
            if template[i - 1] == text[j - 1] and low <= j - i <= high:
                best = max(best, rows[i - 1][j - 1] + 1)
            rows[i][j] = best
    return rows[-1][-1]


def test_alignment_equals_the_plain_one():
    rnd = random.Random(5)
    for _ in range(600):
        template = [rnd.randint(0, 5) for _ in range(rnd.randint(1, 12))]
        text = [rnd.randint(0, 5) for _ in range(rnd.randint(0, 20))]
        low = rnd.randint(-6, 6)
        high = low + rnd.randint(0, 8)
        matched, first, last = op.align(np.array(template, np.uint64), np.array(text, np.uint64), low, high)
        assert matched == _plain(template, text, low, high)
        assert not matched or 0 <= first < last <= len(text)


def test_query_finds_the_lines(spark):
    rows = {r.doc_id: r for r in op.op7_license_scan(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for r in docs:
        assert rows[r.doc_id].names == ",".join(sorted({n for text, n in SHORT.items() if text in r.text}))


def test_changed_texts_and_spans(spark):
    mit = op.TEMPLATES["MIT-text"].split()
    changed = mit[:10] + ["and", "more"] + mit[10:40] + mit[42:]
    docs = [(1, sentence(1, 30) + " " + " ".join(changed) + " " + sentence(2, 9)), (2, " ".join(mit[:30])),
            (3, (op.TEMPLATES["MIT"] + "\n") * 300), (4, op.TEMPLATES["Apache-2.0-header"].upper())]
    found = {r.doc_id: r.licenses for r in op.with_licenses(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    (one,) = found[1]
    assert one.license == "MIT-text" and one.low == 30 and 0.97 < one.coverage < 1
    assert found[2] == [] and len(found[3]) == 300 and [x.license for x in found[4]] == ["Apache-2.0-header"]
    assert [(x.low, x.high) for x in found[3]] == [(5 * i, 5 * i + 5) for i in range(300)]


def test_odd_rows(spark, clashing):
    templates = {"one": "one", "none": "", "base": sentence(1, 300), "twin": sentence(1, 300)}
    out = op.with_licenses(clashing, templates)
    assert sorted(out.columns) == sorted(c for c in clashing.columns if c != "text")
    names = {r.doc_id: [x.license for x in r.licenses] for r in out.collect() if r.doc_id}
    assert names[4] == names[5] == ["one"] and names[7] == names[9] == ["base", "twin"] and names[1] == names[14] == []
    assert op.with_licenses(empty(clashing)).count() == 0
    assert op.with_licenses(clashing, {}).where("size(licenses) > 0").count() == 0


def _names(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {texts[r.doc_id]: {x.license for x in r.licenses} for r in op.with_licenses(df).collect()}


def test_versions_and_variants_are_told_apart(spark):
    expected = {op.TEMPLATES[n]: {n} for n in op.TEMPLATES}
    gpl = op.TEMPLATES["GPL-3.0-header"]
    expected |= {gpl.replace("version 3", "version 1"): set(), gpl.replace("GNU General", "GNU Other General"): set(),
                 "Licensed under CC BY-XX 4.0.": set(), "Licensed under CC BY-NC 3.0.": set(),
                 "Released under the Other License.": set(), "Licensed under the Apache License, Version 1.1.": set()}
    assert _names(spark, list(expected)) == expected


def test_every_edit_of_a_word_of_a_short_template(spark):
    texts = {}
    for name, text in op.TEMPLATES.items():
        words = text.split()
        if len(words) > op.SHORT:
            continue
        must = {w for x in op.REQUIRED.get(name, ()) for w in re.findall("[a-z0-9]+", x.lower())}
        for k, word in enumerate(words):
            if must.isdisjoint(re.findall("[a-z0-9]+", word.lower())):
                if len(re.findall("[a-z0-9]+", word.lower())) == 1:
                    texts[" ".join(words[:k] + words[k + 1:])] = name
                    texts[" ".join(words[:k] + ["xyz"] + words[k + 1:])] = name
                texts[" ".join(words[:k] + ["xyz"] + words[k:])] = name
    found = _names(spark, list(texts))
    assert [t for t, name in texts.items() if found[t] != {name}] == []


def test_many_licenses_in_one_text_take_time_in_proportion(spark):
    names = sorted(SHORT.values())
    index, times = op.Index(op.TEMPLATES), []
    for lines in (500, 5_000):
        text = "\n".join(f"{op.TEMPLATES[names[i % len(names)]]} and line {i} of others" for i in range(lines))
        batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([1])], names=["x", "c0"])
        started = time.process_time()
        out = next(op._scan(types.SimpleNamespace(value=index), ["c0", "found"])([batch]))
        times.append(time.process_time() - started)
        assert [x["license"] for x in out.column(1).to_pylist()[0]] == [names[i % len(names)] for i in range(lines)]
    assert times[1] < 25 * times[0]
