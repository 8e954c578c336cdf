import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from common import SF, clashing, empty, odd, sentence  # noqa: F401
from quotelake.llm import alignment as op
from pyspark.sql import functions as F

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _groups(text, library):
    """Groups of a text, token by token."""
    a, b, spell_a, spell_b = library
    if not text:
        return []
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bodies = [[spell_a[i] for i in ids[0]], [spell_b[i] for i in ids[1]]]
    whole = (" " + text).encode()
    if any(b"".join(x) != whole for x in bodies):
        return []
    ends = [np.cumsum([len(x) for x in body]).tolist() for body in bodies]
    common = sorted(set(ends[0]) & set(ends[1]))
    out, at = [], [0, 0]
    for end in common:
        group = []
        for side in (0, 1):
            start = at[side]
            while at[side] < len(ids[side]) and ends[side][at[side]] <= end:
                at[side] += 1
            group.append(ids[side][start:at[side]])
        out.append(group)
    return out


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = op.byte_alphabet()
    spell_a = {i: bytes(alphabet[c] for c in x) for x, i in a.get_vocab(with_added_tokens=False).items()
               if all(c in alphabet for c in x)}
    spell_b = {i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.get_piece_size())}
    return a, b, spell_a, spell_b


def _plain(docs, library):
    """(id, text) rows -> rows of the contract, by dictionaries."""
    linked = []
    for _, text in docs:
        links = Counter()
        groups = _groups(text, library)
        for own_a, own_b in groups:
            links.update((x, y) for x in own_a for y in own_b)
        linked.append((groups, links))
    counts = Counter(pair for _, links in linked for pair in links)
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = []
    for (i, _), (groups, links) in zip(docs, linked):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, counts, highest


def test_query_equals_the_contract(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = [tuple(r) for r in op.op12_tokenizer_alignment(spark, SF).collect()]
    assert sorted(found) == sorted(_plain(docs, library)[0])


def test_small_buffers_and_many_buckets(spark, library):
    """Runs of a few links, blocks of a few records, buckets of a few blocks."""
    sizes = op.Sizes(bucket_bytes=2000, spill_links=300, step_links=50, block=16, drain=40)
    rows = [(k, sentence(k % 7, 40) + f" {k}, the end.") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = op.Alignment(docs, A, B, sizes=sizes)
    expected, counts, highest = _plain(rows, library)
    assert sorted(map(tuple, found.documents.collect())) == sorted(expected)
    assert {(r.a, r.b): (r.n_docs, r.best) for r in found.pairs.collect()} == {
        p: (n, n == highest[p[0]]) for p, n in counts.items()}


ODD_TEXTS = ["a▁b", "▁", "<s> </s> <0x41> <|endoftext|>", "\x00\x01 tab\tnew\nline\r\n", "日本語テキスト", "🙂👩‍👩‍👧 é é ﬁ", " ", "  two  ",
             "x" * 3000, " " * 2500, "\n" * 1500 + "end", "a1b2c3" * 300, "ก็ไทย ภาษา", "don't I'LL we've", "  　wide"]


def test_odd_rows(spark, clashing, library):
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    more = spark.createDataFrame([(500 + k, t) for k, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    taken = clashing.unionByName(more, allowMissingColumns=True).select("*", *[
        F.lit("mine").alias(c) for c in ("run", "slot", "radix", "n_a", "pair")])
    rows += [(500 + k, t) for k, t in enumerate(ODD_TEXTS)]
    found = op.Alignment(taken, A, B).documents
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(_plain(rows, library)[0], key=repr)
    assert op.Alignment(empty(taken), A, B).documents.count() == 0
    groups = {r.doc_id: r.groups for r in op.with_groups(more, A, B).collect()}
    assert groups[500] == "" and groups[504].count(";") + 1 == len(_groups(ODD_TEXTS[4], library))


def test_the_fast_encoder_is_the_library(library):
    with open(A, encoding="utf-8") as file:
        made = op.ByteLevel(file.read())
    assert made.fast is not None
    texts = [*ODD_TEXTS, "\t" * 999 + "x", sentence(3, 4000), "l'été où ça" * 50, "".join(map(chr, range(1, 0x3000)))]
    for text in texts:
        assert made.ids(text) == library[0].encode(text, add_special_tokens=False).ids


def test_blocks():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 1 << bits, 777) for bits in (40, 24)]
    frame = op.pack(columns, (5, 3))
    assert all(np.array_equal(a, b) for a, b in zip(op.unpack(frame, (5, 3)), columns))
    ids = np.arange(60000)
    order = op.by_radix(ids)
    assert np.array_equal(op.from_radix(order), ids) and len(np.unique(order)) == len(ids)
    assert np.array_equal(op.radix_of(order << op.ID_BITS), ids % op.RADIX)
