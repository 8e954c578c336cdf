"""SentencePiece encoding and decoding in numpy, many words at once.

Texts are cut where no piece can reach across: before blanks that follow other characters,
and around characters that only stand alone in pieces. Each different word of a run is
encoded once. Words of equal length advance together: the hashes of all their substrings
probe the sorted keys of the pieces, and

* unigram models take the best path by Viterbi: for each end the vectorised maximum over all
  starts, with its start as backpointer;
* BPE models, whose ids are defined by merges and not by a best path, take in each step the
  vectorised best merge of every word. Their best path by Viterbi, the pieces of the highest
  sum of scores, is made on request; of equal sums the one with the longest last piece.

Ids equal those of the sentencepiece library. Covered are models with identity
normalisation, whose white space is kept, and a dummy prefix or none.

Defined results: the white space sign of pieces in a text counts as a blank and is decoded
as one, as the library does; a null text has null ids, an empty one none; null ids decode to null.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.store import freeing, prepared

LONG = 48                   # characters of a word that is merged on its own
CELLS = 1 << 19             # substrings probed at once
CACHE_WORDS = 1 << 18
_NONE = np.int32(2 ** 31 - 1)


class PieceModel:
    """Tables of a model; pieces as bytes with blanks for their white space sign."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(blob)
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that keep their text as it is are covered")
        self.bpe = model.trainer_spec.model_type == 2
        if model.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models are covered")
        self.prefix = spec.add_dummy_prefix
        self.byte_fallback = model.trainer_spec.byte_fallback
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == 2)
        self.bytes_ = np.full(256, self.unknown, np.int32)
        spelled, keys, ids, scores = [], [], [], []
        for i, piece in enumerate(model.pieces):
            body = piece.piece.replace("▁", " ").encode()
            if piece.type == 6:
                self.bytes_[int(piece.piece[3:5], 16)] = i
                body = bytes([int(piece.piece[3:5], 16)])
            elif piece.type == 1:
                keys.append(body)
                ids.append(i)
                scores.append(piece.score)
            elif piece.type == 2:
                body = " ⁇ ".encode()
            else:
                body = b""
            spelled.append(body)
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.r_[0, np.cumsum([len(x) for x in spelled])]
        hashes = np.array([_hash(x) for x in keys], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array(ids, np.int32)[order]
        # Most substrings are no pieces; their first 20 bits tell nearly all of those.
        self.filter = np.zeros(1 << 20, bool)
        self.filter[self.keys >> np.uint64(44)] = True
        score = np.array(scores)[order]
        self.scores = score
        # Merges with the highest score come first; equal scores share a place.
        self.ranks = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        self.by_bytes = {x: (int(r), int(i)) for x, r, i in zip(
            (keys[k] for k in order), self.ranks, self.ids)}
        self.longest = max(len(x.decode()) for x in keys)
        self.unknown_score = float(score.min()) - 10.0
        inside = {c for x in keys if len(x.decode()) > 1 for c in x}
        # ASCII characters that no longer piece holds are words of their own.
        self.alone = np.array([c < 0x80 and c not in inside for c in range(256)])

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the pieces, or -1."""
        out = np.full(len(hashes), -1)
        some = np.flatnonzero(self.filter[hashes >> np.uint64(44)])
        own = hashes[some]
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        out[some] = np.where(self.keys[at] == own, at, -1)
        return out


def _hash(body: bytes) -> int:
    data = np.frombuffer(body, np.uint8)
    sums = W.prefix_sums(W._BYTE_VALUES[data])
    return int(W.span_hash(sums, np.array([0]), np.array([len(data)]))[0])


class Encoder:
    """Encodes runs of texts and remembers the words it has met, up to a bound; with
    ``best_path`` by Viterbi for any model, else by merges where the model is BPE."""

    def __init__(self, model: PieceModel, best_path: bool = False):
        self.model = model
        self.merges = model.bpe and not best_path
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.known_at = np.zeros(0, np.int64)
        self.known_size = np.zeros(0, np.int32)
        self.known_ids = np.zeros(0, np.int32)

    def encode(self, run: W.Run) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the run's texts, and bounds per text."""
        data, offsets = run.data, run.offsets
        if self.model.prefix:
            filled = np.diff(offsets) > 0
            shift = np.r_[0, np.cumsum(filled)]
            wide = np.full(len(data) + int(shift[-1]), 0x20, np.uint8)
            wide[np.arange(len(data)) + np.repeat(shift[1:], np.diff(offsets))] = data
            data, offsets = wide, offsets + shift
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(run.count + 1, np.int64)
        blank, alone = data == 0x20, self.model.alone[data]
        cut = np.ones(n, bool)
        cut[1:] = (blank[1:] & ~blank[:-1]) | alone[1:] | alone[:-1]
        cut[offsets[:-1][offsets[:-1] < n]] = True
        start = np.flatnonzero(cut)
        end = np.r_[start[1:], n]
        sums = W.prefix_sums(W._BYTE_VALUES[data])
        hashes = W.span_hash(sums, start, end)
        unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, unique), max(len(self.known) - 1, 0))
        new = np.ones(len(unique), bool) if not len(self.known) else self.known[at] != unique
        if new.any():
            if len(self.known) + int(new.sum()) > CACHE_WORDS:
                self._forget()
                new[:] = True
            ids, sizes = self._words(data, sums, start[first[new]], end[first[new]])
            place = len(self.known_ids) + np.cumsum(sizes) - sizes
            self.known_ids = np.r_[self.known_ids, ids]
            slot = np.searchsorted(self.known, unique[new])
            self.known_at = np.insert(self.known_at, slot, place)
            self.known_size = np.insert(self.known_size, slot, sizes.astype(np.int32))
            self.known = np.insert(self.known, slot, unique[new])
        slot = np.searchsorted(self.known, unique)[which]
        sizes = self.known_size[slot].astype(np.int64)
        stop = np.cumsum(sizes)
        place = np.repeat(self.known_at[slot] - (stop - sizes), sizes) + np.arange(int(stop[-1]))
        ids = self.known_ids[place]
        bounds = np.r_[0, stop][np.searchsorted(start, offsets)]
        if not self.model.byte_fallback:
            ids, bounds = self._joined_unknown(ids, bounds)
        return ids, bounds

    def _joined_unknown(self, ids, bounds):
        """Unknown characters next to each other are one unknown piece."""
        unknown = ids == self.model.unknown
        drop = np.zeros(len(ids), bool)
        drop[1:] = unknown[1:] & unknown[:-1]
        drop[bounds[:-1][bounds[:-1] < len(ids)]] = False
        return ids[~drop], np.r_[0, np.cumsum(~drop)][bounds]

    def _words(self, data, sums, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words data[start:end], one after the other, and their sizes."""
        head = (data & 0xC0) != 0x80
        chars = np.flatnonzero(head)
        first, stop = np.searchsorted(chars, start), np.searchsorted(chars, end)
        edges = np.r_[chars, len(data)]
        length = stop - first
        out_word, out_from, out_to = [], [], []
        for size in np.unique(length).tolist():
            rows = np.flatnonzero(length == size)
            step = max(1, CELLS // (size * min(size, self.model.longest)))
            for part in range(0, len(rows), step):
                own = rows[part:part + step]
                if self.merges and size > LONG:
                    for r in own.tolist():
                        pieces = _merged_alone(self.model, data[start[r]:end[r]].tobytes())
                        out_word.append(np.full(len(pieces), r))
                        out_from.append(start[r] + np.array([a for a, _ in pieces]))
                        out_to.append(start[r] + np.array([b for _, b in pieces]))
                    continue
                place = edges[first[own][:, None] + np.arange(size + 1)]
                cuts = (self._merge if self.merges else self._best)(sums, place)
                row, a = np.nonzero(cuts[:, :-1])
                # The next cut of the same word ends the piece.
                flat = np.flatnonzero(cuts.ravel())
                ends = np.r_[flat[1:], 0]
                keep = flat % (size + 1) != size
                out_word.append(own[row])
                out_from.append(place[row, a])
                out_to.append(place.ravel()[ends[keep]])
        word, a, b = (np.concatenate(x) for x in (out_word, out_from, out_to))
        order = np.lexsort((a, word))
        word, a, b = word[order], a[order], b[order]
        found = self.model.probe(W.span_hash(sums, a, b))
        if not self.model.byte_fallback:
            ids = np.where(found >= 0, self.model.ids[found], self.model.unknown).astype(np.int32)
            return ids, np.bincount(word, minlength=len(start))
        # A piece that is not known is one character: its bytes stand for it.
        size = np.where(found >= 0, 1, b - a)
        stop = np.cumsum(size)
        inner = np.arange(int(stop[-1])) - np.repeat(stop - size, size)
        ids = np.where(np.repeat(found >= 0, size), np.repeat(self.model.ids[found], size),
                       self.model.bytes_[data[np.minimum(np.repeat(a, size) + inner, len(data) - 1)]])
        return ids.astype(np.int32), np.bincount(np.repeat(word, size), minlength=len(start))

    def _best(self, sums, place) -> np.ndarray:
        """Cuts of the best path of each word (a line of places): Viterbi."""
        m, size = len(place), place.shape[1] - 1
        best = np.full((m, size + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((m, size + 1), np.int32)
        for j in range(1, size + 1):
            low = max(0, j - self.model.longest)
            starts = place[:, low:j]
            found = self.model.probe(W.span_hash(
                sums, starts.ravel(), np.repeat(place[:, j], j - low)).reshape(-1)).reshape(m, -1)
            score = np.where(found >= 0, self.model.scores[found], -np.inf)
            score[:, -1] = np.where(found[:, -1] >= 0, score[:, -1], self.model.unknown_score)
            score = score + best[:, low:j]
            arg = score.argmax(1)
            best[:, j] = score[np.arange(m), arg]
            back[:, j] = low + arg
        cuts = np.zeros((m, size + 1), bool)
        at = np.full(m, size)
        cuts[:, size] = True
        while (at > 0).any():
            at = back[np.arange(m), at]
            cuts[np.arange(m), at] = True
        return cuts

    def _merge(self, sums, place) -> np.ndarray:
        """Cuts of each word (a line of places) after all merges, the best one first."""
        m, size = len(place), place.shape[1] - 1
        width = min(size, self.model.longest)
        rank = np.full((m, size, width + 1), _NONE)
        for span in range(2, width + 1):
            starts, ends = place[:, :size - span + 1], place[:, span:]
            found = self.model.probe(W.span_hash(sums, starts.ravel(), ends.ravel()))
            value = np.where(found >= 0, self.model.ranks[found], _NONE)
            rank[:, :size - span + 1, span] = value.reshape(m, -1)
        cuts = np.ones((m, size + 1), bool)
        if size < 2:
            return cuts
        # For each inner cut the cuts before and after it, and the rank of merging there.
        before = np.tile(np.arange(-1, size, dtype=np.int32), (m, 1))
        after = np.tile(np.arange(1, size + 2, dtype=np.int32), (m, 1))
        gain = np.full((m, size + 1), _NONE)
        gain[:, 1:size] = rank[:, :size - 1, 2]
        live = np.arange(m)
        while len(live):
            at = gain[live].argmin(1)
            some = gain[live, at] != _NONE
            live, at = live[some], at[some]
            if not len(live):
                break
            left, right = before[live, at], after[live, at]
            cuts[live, at] = False
            gain[live, at] = _NONE
            after[live, left] = right
            before[live, right] = left
            for cut, a, b in ((left, before[live, left], right), (right, left, np.minimum(after[live, right], size))):
                inner = (cut > 0) & (cut < size)
                span = b - a
                ok = inner & (span <= width)
                value = rank[live, np.maximum(a, 0), np.where(ok, span, 0)]
                gain[live, cut] = np.where(ok, value, _NONE)
        return cuts


def _merged_alone(model: PieceModel, body: bytes) -> list[tuple[int, int]]:
    """Spans of a long word after all merges; a heap holds the merges that are possible."""
    starts = [i for i, c in enumerate(body) if c & 0xC0 != 0x80]
    n = len(starts)
    ends = [*starts[1:], len(body)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            found = model.by_bytes.get(body[starts[i]:ends[j]])
            if found:
                heapq.heappush(heap, (found[0], i, ends[i], ends[j]))

    for i in range(n):
        offer(i)
    gone = [False] * n
    while heap:
        _, i, middle, end = heapq.heappop(heap)
        if gone[i] or ends[i] != middle or after[i] >= n or ends[after[i]] != end:
            continue
        j = after[i]
        gone[j], ends[i], after[i] = True, end, after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [(starts[i], ends[i]) for i in range(n) if not gone[i]]


def decoded(model: PieceModel, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Texts of the ids between neighbouring bounds."""
    size = np.diff(model.spelled_at)[ids]
    stop = np.cumsum(size)
    place = np.repeat(model.spelled_at[ids] - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)
    body = model.spelled[place].tobytes()
    edges = np.r_[0, stop][bounds].tolist()
    lead = 1 if model.prefix else 0
    return [body[a + (lead if body[a:a + 1] == b" " else 0):b] for a, b in zip(edges[:-1], edges[1:])]


_made: dict[tuple[int, bool], Encoder] = {}


def _encoder(blob, best_path: bool = False) -> Encoder:
    """The encoders of a broadcast model, one of a kind for each Python worker."""
    if (blob.id, best_path) not in _made:
        other = _made.get((blob.id, not best_path))
        if not other:
            _made.clear()
        _made[blob.id, best_path] = Encoder(other.model if other else PieceModel(blob.value), best_path)
    return _made[blob.id, best_path]


class _Shared:
    """A broadcast model with an id to know it by in the workers."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            self._broadcast = spark.sparkContext.broadcast(file.read())
        self.id = id(self._broadcast) ^ hash(path)

    @property
    def value(self) -> bytes:
        return self._broadcast.value


def _encode(blob, names, decode: bool = False, best_path: bool = False):
    """Adds the ids of each text, and with ``decode`` the text of these ids."""
    def batch_encode(batches):
        encoder = _encoder(blob, best_path)
        for batch in batches:
            ids, sizes, texts = [], [], []
            # The white space sign itself counts as a blank.
            for run in W.runs(pc.replace_substring(batch.column(0), "▁", " ")):
                own, bounds = encoder.encode(run)
                ids.append(own)
                sizes.append(np.diff(bounds))
                if decode:
                    texts += decoded(encoder.model, own, bounds)
            sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()),
                pa.array(np.concatenate(ids) if ids else [], pa.int32()),
                mask=batch.column(0).is_null())
            made = [lists]
            if decode:
                made.append(pa.array(texts, pa.binary(), mask=np.asarray(batch.column(0).is_null())).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return batch_encode


def _decode(blob, names):
    def batch_decode(batches):
        model = _encoder(blob).model
        for batch in batches:
            column = batch.column(0)
            bounds = np.r_[0, np.cumsum(np.asarray(column.value_lengths().fill_null(0)))]
            texts = decoded(model, np.asarray(column.flatten()), bounds)
            texts = pa.array(texts, pa.binary(), mask=np.asarray(column.is_null())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=names)

    return batch_decode


def _mapped(df: DataFrame, column: str, made: dict[str, str], function) -> DataFrame:
    """``df`` with the columns ``made`` (name -> type) from ``column``; input columns of these
    names are replaced."""
    kept = [c for c in df.columns if c not in made or c == column]
    inner = df.select(F.col(f"`{column}`").alias("x"), *[
        F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept) if c != column])
    new = [F.lit(None).cast(kind).alias(f"y{i}") for i, kind in enumerate(made.values())]
    schema = inner.select("*", *new).schema
    out = inner.mapInArrow(freeing(function(schema.names)), schema)
    return out.select(*[
        F.col("x").alias(c) if c == column else F.col(f"c{i}").alias(c)
        for i, c in enumerate(kept) if c not in made],
        *[F.col(f"y{i}").alias(name) for i, name in enumerate(made)])


def with_ids(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds the ids of each text (array<int>)."""
    blob = _Shared(prepared(df.sparkSession), model_path)
    return _mapped(df, text_col, {ids_col: "array<int>"}, lambda names: _encode(blob, names))


def with_text(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of each list of ids."""
    blob = _Shared(prepared(df.sparkSession), model_path)
    return _mapped(df, ids_col, {text_col: "string"}, lambda names: _decode(blob, names))


def with_ids_and_text(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids",
                      decoded_col: str = "decoded", best_path: bool = False) -> DataFrame:
    """Adds the ids of each text and the text that they decode to, in one pass; with
    ``best_path`` the ids of the highest sum of scores, which a unigram model's are anyway."""
    blob = _Shared(prepared(df.sparkSession), model_path)
    return _mapped(df, text_col, {ids_col: "array<int>", decoded_col: "string"},
                   lambda names: _encode(blob, names, True, best_path))


def _digests(spark, sf_dir: str, best_path: bool) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = with_ids_and_text(docs, path, best_path=best_path)
    return both.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.crc32(F.array_join("ids", ",")).alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"))


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Per document: its ids counted and digested, and whether they decode to its text."""
    return _digests(spark, sf_dir, False)


def op6_best_path(spark, sf_dir: str) -> DataFrame:
    """As op6_sentencepiece, for the ids of the best path by Viterbi over the model's scores."""
    return _digests(spark, sf_dir, True)
