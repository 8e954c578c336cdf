import random
import zlib

import public_tokenizers
import pyarrow as pa
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from common import SF, clashing, empty, odd  # noqa: F401
from quotelake.llm import sentencepieces as op
from quotelake.llm import words as W

PATH = public_tokenizers.path("piece_bpe_32k.model")


def _same(blob, texts):
    library = sentencepiece.SentencePieceProcessor(model_proto=blob)
    encoder = op.Encoder(op.PieceModel(blob))
    for run in W.runs(pa.array(texts), 500):
        ids, bounds = encoder.encode(run)
        decoded = op.decoded(encoder.model, ids, bounds)
        for i in range(run.count):
            text = texts[run.first + i]
            assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(text), text
            assert decoded[i].decode() == library.decode(library.encode(text))


def _random_texts(alphabet, count=400):
    rnd = random.Random(4)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(count)]


def test_merges_equal_the_library(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    odd = ["", " ", "  a  b ", "\n\n x\ty", "ü𝄞日本語  ", "x" * 3000, "ab" * 400 + " " * 300 + "q", "the" * 40]
    _same(open(PATH, "rb").read(), odd + docs + _random_texts("abt he\nn ü日1.,'"))


def test_viterbi_equals_the_library():
    rnd = random.Random(7)
    for fallback in (False, True):
        model = proto.ModelProto()
        model.trainer_spec.model_type = 1
        model.trainer_spec.byte_fallback = fallback
        model.normalizer_spec.name = "identity"
        model.normalizer_spec.add_dummy_prefix = True
        model.normalizer_spec.remove_extra_whitespaces = False
        model.normalizer_spec.escape_whitespaces = True

        def put(piece, score, kind):
            entry = model.pieces.add()
            entry.piece, entry.score, entry.type = piece, score, kind

        put("<unk>", 0, 2)
        if fallback:
            for b in range(256):
                put(f"<0x{b:02X}>", 0, 6)
        seen = set()
        for _ in range(120):
            piece = ("▁" if rnd.random() < 0.3 else "") + "".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 5)))
            if piece not in seen:
                seen.add(piece)
                put(piece, -rnd.random() * 8 - len(seen) * 1e-3, 1)
        for c in ("▁", "a", "b"):
            if c not in seen:
                put(c, -9.5 - ord(c[0]) * 1e-4, 1)
        _same(model.SerializeToString(), _random_texts("abcé  zz日"))


def _best_path(model, text):
    """Ids of the path with the highest sum of scores over the whole text: a plain search."""
    if text is None or not text:
        return []
    text = " " + text.replace("▁", " ")
    pieces = {p.piece.replace("▁", " "): (p.score, i) for i, p in enumerate(model.pieces) if p.type == 1}
    longest, lowest = max(map(len, pieces)), min(score for score, _ in pieces.values()) - 10
    spare = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
    best = [(0.0, 0)]
    for j in range(1, len(text) + 1):
        own = []
        for i in range(max(0, j - longest), j):
            score = pieces.get(text[i:j], (lowest if i == j - 1 else None,))[0]
            if score is not None:
                own.append((best[i][0] + score, -i))
        top = max(own)
        best.append((top[0], -top[1]))
    out, j = [], len(text)
    while j:
        i = best[j][1]
        piece = pieces.get(text[i:j])
        out[:0] = [piece[1]] if piece else [spare[b] for b in text[i:j].encode()]
        j = i
    return out


def _proto():
    model = proto.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    return model


def test_best_path_of_a_bpe_model_equals_a_plain_search():
    model = _proto()
    encoder = op.Encoder(op.PieceModel(open(PATH, "rb").read()), best_path=True)
    texts = ["", " ", "  a  b ", "\n\n x\ty", "ü𝄞日本語  ", "x" * 300, "ab" * 100 + " " * 90 + "q",
             "the" * 40, *_random_texts("abt he\nn ü日1.,'", 200)]
    for run in W.runs(pa.array(texts), 500):
        ids, bounds = encoder.encode(run)
        for i in range(run.count):
            text = texts[run.first + i]
            assert ids[bounds[i]:bounds[i + 1]].tolist() == _best_path(model, text), text


def test_query_has_the_best_path(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    model = _proto()
    rows = op.op6_best_path(spark, SF).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    for r in rows[::5]:
        expected = _best_path(model, texts[r.doc_id])
        assert r.n_tokens == len(expected)
        assert texts[r.doc_id] is None or r.ids_crc32 == zlib.crc32(",".join(map(str, expected)).encode())


def test_query_round_trips(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op.op6_sentencepiece(spark, SF).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    assert all(r.n_tokens == len(library.encode(texts[r.doc_id])) for r in rows)


def test_odd_rows(spark, clashing):
    for both in (op.with_text(op.with_ids(clashing, PATH), PATH), op.with_ids_and_text(clashing, PATH)):
        assert sorted(both.columns) == sorted(clashing.columns)
        rows = both.collect()
        assert len(rows) == clashing.count() and all(r.text == r.decoded for r in rows)
        assert all((r.ids is None) == (r.text is None) for r in rows)
    assert op.with_text(op.with_ids(empty(clashing), PATH), PATH).count() == 0
