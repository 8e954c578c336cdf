import random
import time

import public_tokenizers

from common import SF, clashing, empty, odd  # noqa: F401
from pyspark.sql import functions as F
from quotelake.llm import token_counts as op

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
COUNTER = op.Counter(open(PATH, "rb").read(), PATTERN)


def _full(text):
    return len(COUNTER.encoding.encode_ordinary(text or ""))


def test_random_edits_keep_the_count(spark):
    rnd = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'", "'ll", "'re", "é", "1", "22", ".", "!", " word", "\t", "'s", "日"]
    for _ in range(500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.choice((0, 3, 40, 700))))
        tree = op.Tree.of_text(text, COUNTER)
        for _ in range(6):
            start = rnd.randint(0, len(text) + 2)
            stop = start + rnd.choice((0, 0, 1, 3, 50))
            new = "".join(rnd.choice(parts) for _ in range(rnd.choice((0, 1, 3, 30, 900))))
            text, tree, _ = op.edit(text, tree, start, stop, new, COUNTER)
            assert (tree.chars[1], tree.tokens[1]) == (len(text), _full(text))
            leaves = tree.tokens[tree.width:]
            assert leaves.sum() == tree.tokens[1]


def test_a_small_edit_encodes_little(spark):
    text = "some words and more of them " * 2000
    _, tree, again = op.edit(text, op.Tree.of_text(text, COUNTER), 30000, 30004, "other", COUNTER)
    assert again < 2000


def test_many_edits_of_one_draft():
    rnd = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "'", "'ll", "é", "1", "22", ".", " word", "\t", "日", "long" * 40, " " * 70]
    for _ in range(12):
        text = "".join(rnd.choice(parts) for _ in range(rnd.choice((0, 50, 3000))))
        draft = op.Draft(text, op.Tree.of_text(text, COUNTER), COUNTER)
        for _ in range(40):
            start = rnd.randint(0, len(text) + 2)
            stop = start + rnd.choice((0, 1, 40, 2000))
            new = "".join(rnd.choice(parts) for _ in range(rnd.choice((0, 1, 30, 2500))))
            draft.edit(start, stop, new)
            cut = min(start, len(text))
            text = text[:cut] + new + text[min(max(stop, cut), len(text)):]
            tree = draft.tree
            assert draft.text() == text and (tree.chars[1], tree.tokens[1]) == (len(text), _full(text))
            assert [len(p) for p in draft.parts] == tree.chars[tree.width:].tolist()


def test_edits_of_a_very_long_text_cost_what_they_touch():
    times = []
    for lines in (1_500, 15_000):
        text = "".join(f"{i} mail to user{i}@mail.example.org from 10.0.{i % 256}.7 and go on with what comes\n"
                       for i in range(lines))
        counter = op.Counter(open(PATH, "rb").read(), PATTERN)
        draft = op.Draft(text, op.Tree.of_text(text, counter), counter)
        started, shift = time.process_time(), 0
        for match in op.REDACTIONS.finditer(text):
            new = f"<{match.lastgroup}> of somebody or other"
            draft.edit(match.start() + shift, match.end() + shift, new)
            shift += len(new) - (match.end() - match.start())
        times.append(time.process_time() - started)
        assert draft.text() == op.REDACTIONS.sub(lambda m: f"<{m.lastgroup}> of somebody or other", text)
        assert draft.tree.tokens[1] == _full(draft.text())
    assert times[1] < 25 * times[0]


def test_query_equals_full_encoding(spark):
    rows = {r.doc_id: r for r in op.op1_token_counts(spark, SF).collect()}
    some = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        masked = op.REDACTIONS.sub(lambda m: f"<{m.lastgroup}>", r.text)
        got = rows[r.doc_id]
        assert (got.tokens_before, got.tokens_after, got.chars_after) == (_full(r.text), _full(masked), len(masked))
        some += got.n_edits
    assert some


def test_odd_rows(spark, clashing):
    trees = op.with_trees(clashing, PATH, PATTERN)
    assert sorted(trees.columns) == sorted(clashing.columns)
    edits = F.expr("""array(named_struct('start', 0, 'stop', 1, 'text', 'X y'),
        named_struct('start', cast(null as int), 'stop', cast(null as int), 'text', cast(null as string)),
        named_struct('start', 2, 'stop', 9999999, 'text', '!'))""")
    done = op.edited(trees.withColumn("edits", F.when(F.col("doc_id") != 4, edits)), PATH, PATTERN)
    rows = done.select("doc_id", "text", op.n_tokens().alias("n")).collect()
    assert len(rows) == clashing.count()
    for r in rows:
        assert r.text == ("one" if r.doc_id == 4 else r.text) and r.n == _full(r.text)
    assert {r.text for r in rows if r.doc_id not in (4, None)} == {"X !"}
    assert op.with_trees(empty(clashing), PATH, PATTERN).count() == 0
