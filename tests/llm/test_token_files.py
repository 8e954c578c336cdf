import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from common import SF, clashing, empty, odd  # noqa: F401
from quotelake.llm import token_files as op

PATH = public_tokenizers.path("word_bpe_49k.json")


def _check(rows, docs):
    """docs: (id, text) in file order."""
    tokenizer, at, expected = Tokenizer.from_file(PATH), 0, []
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((i, at, ids, zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(rows, key=lambda r: r[1]) == expected


def test_query_equals_the_library(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    tokenizer, at = Tokenizer.from_file(PATH), 0
    found = {r.doc_id: r for r in op.op8_token_files(spark, SF).collect()}
    for i, text in docs:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        r = found[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_odd_rows(spark, clashing, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "READ_DOCS", 3)
    manifest = op.write_tokens(clashing, PATH, str(tmp_path / "files"), 1)
    rows = [(r.doc_id, r.start, r.ids, r.ids_crc32) for r in op.read_tokens(manifest).collect()]
    docs = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or ""))
    _check(rows, order)
    none = op.write_tokens(empty(clashing), PATH, str(tmp_path / "none"), 1)
    assert op.read_tokens(none).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 24, 31])
def test_bits_and_random_access(bits, tmp_path):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 3 * op.BLOCK_IDS + 77).astype(np.uint32)
    sizes = np.array([0, 5, op.BLOCK_IDS, len(ids) - op.BLOCK_IDS - 5, 0])
    path = str(tmp_path / "x.bin")
    writer = op.Writer(path, bits)
    writer.add(ids[:5], sizes[:2], np.array([4, 5]))
    writer.add(ids[5:], sizes[2:], np.array([6, 7, 8]))
    assert writer.close() == (5, len(ids))
    reader = op.Reader(path)
    doc_ids, bounds = reader.documents(1, 4)
    assert doc_ids.tolist() == [5, 6, 7] and bounds.tolist() == [0, 5, op.BLOCK_IDS + 5, len(ids)]
    for low, high in ((0, len(ids)), (op.BLOCK_IDS - 1, op.BLOCK_IDS + 1), (len(ids) - 1, len(ids)), (9, 9), (3, 70001)):
        assert np.array_equal(reader.ids(low, high), ids[low:high])
    reader.close()


def test_fewest_bits():
    assert [op.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_many_words_are_one_text_for_the_library():
    """Words that hold the mark or special tokens are encoded as if alone."""
    import pyarrow as pa

    from quotelake.llm import words as W

    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as file:
        encoder = op.WordEncoder(file.read(), 1)
    assert encoder.mark is not None
    asked = []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked.append(len(texts))
            return tokenizer.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counted()
    plain = " ".join(f"w{n}" for n in range(5000))
    odd = ["x\x01y \x01 z\x01\x01", "\x01", "x<|startoftext|>y <|endoftext|>", "<|startoftext|> <|startoftext|><|startoftext|>", "<|startof text|> <|", "", "\u0301a e\u0301", None]
    for texts in ([plain], odd):
        ids, sizes = encoder.encode(next(W.runs(pa.array(texts))))
        expected = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
        assert ids.tolist() == [i for x in expected for i in x] and sizes.tolist() == [len(x) for x in expected]
        assert texts is odd or sum(asked) <= 5000 / op.JOINED_WORDS + 1
