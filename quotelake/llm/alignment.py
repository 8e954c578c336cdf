"""Alignment of two tokenizers over a corpus, by external counting.

Each text is encoded by tokenizer A, a byte-level BPE, and by B, a SentencePiece model. Byte
offsets at which tokens of both end cut the tokens into groups; every A token of a group is
linked with every B token of it. A pair of ids counts in how many documents it is linked.

1. Tasks encode their texts and collect records (pair, document, times). A full buffer is
   spilled: records are sorted with the A id first, parted by a radix of the A id, and put
   out as zstd blocks, the runs of the count.
2. The blocks of a bucket (a radix, or a share of the runs of one that is large) come to one
   task in the order of their first pairs. A heap merges the open ones and sums the documents
   of each pair.
3. The sums of all buckets meet in the order of the pairs, so that the pairs of one A id pass
   one after the other; their maximum marks the best ones. The counts are zstd blocks again.
4. Blocks of counts and of records are merged in the same way, and what each document gets
   from its pairs is sent back: one row per document and bucket.

No task holds more than the blocks that are open at one pair, whatever the number of
documents. A hot id is spread over buckets by its runs. Blocks lie in the shared folder, and
Spark's shuffle does the sorting on disk.

Defined results: each row is a document of its own, rows with equal ids included; texts that
are null, empty, or do not come back from the bytes of their tokens have no tokens; only id and
text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.store import freeing, prepared, stored

RADIX = 32
ID_BITS, SLOT_BITS = 19, 24    # a link is a positive 64-bit number
# Fixed value: the pattern by which the byte-level pre-tokenizer parts words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WIDE_BLANK = re.compile(r"\s{1000}")


@dataclass(frozen=True)
class Sizes:
    """What is held at once: they bound memory and change no result."""

    bucket_bytes: int = 1 << 25     # compressed records of a bucket
    spill_links: int = 1 << 21      # links held before they are sorted and spilled
    step_links: int = 1 << 19       # links made at once
    block: int = 1 << 15            # records of a block
    drain: int = 1 << 19            # open records before the heap is drained


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """Tokenizer A: ids of texts, and the bytes of each id."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        before = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or before.get("type") != "ByteLevel":
            raise ValueError("A is to be a byte-level BPE")
        self.library = Tokenizer.from_str(definition)
        self.library.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = spec["model"]["vocab"]
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.spelled[i] = bytes(alphabet[c] for c in entry)
        if len(self.spelled) > 1 << ID_BITS:
            raise ValueError(f"A has more than 2**{ID_BITS} ids")
        # With ids in the order of their merges, the ids are the ranks of a faster encoder.
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        merged = [vocabulary[a + b] for a, b in pairs]
        self.fast = None
        if (sorted(merged) == merged and len(merged) + 256 == len(vocabulary) and before.get("use_regex")
                and not before.get("add_prefix_space") and not spec["normalizer"] and not spec["model"]["dropout"]):
            import tiktoken

            self.fast = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
                body: i for i, body in enumerate(self.spelled) if body})

    def ids(self, text: str) -> list[int]:
        # Very long white space overflows the stack of the faster encoder's pattern.
        if self.fast is None or _WIDE_BLANK.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """Tokenizer B: ids of texts, and the bytes of each id."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.spelled = []
        if self.library.get_piece_size() > 1 << ID_BITS:
            raise ValueError(f"B has more than 2**{ID_BITS} ids")
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.spelled.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i)
                                else piece.replace("▁", " ").encode())

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, num_threads=1)


class Aligned:
    """Texts of a chunk that both tokenizers give back: their tokens, groups and links."""

    def __init__(self, a: ByteLevel, b: Pieces, texts: list[bytes]):
        ids_a, ids_b, sizes, rows = [], [], [], []
        for row, body in enumerate(texts):
            if not body:
                continue
            text, whole = body.decode(), b" " + body
            own_a, own_b = a.ids(" " + text), b.ids(text)
            if (b"".join(map(a.spelled.__getitem__, own_a)) == whole
                    and b"".join(map(b.spelled.__getitem__, own_b)) == whole):
                ids_a.append(own_a)
                ids_b.append(own_b)
                sizes.append(len(whole))
                rows.append(row)
        self.rows = np.array(rows, np.int64)
        self.n_a, self.n_b = (np.array(list(map(len, x)), np.int64) for x in (ids_a, ids_b))
        self.a, self.b = (np.fromiter(itertools.chain.from_iterable(x), np.int64, int(n.sum()))
                          for x, n in ((ids_a, self.n_a), (ids_b, self.n_b)))
        ends = np.cumsum(np.array(sizes, np.int64))
        end_a, end_b = (np.cumsum(np.array(list(map(len, x.spelled)), np.int64)[ids])
                        for x, ids in ((a, self.a), (b, self.b)))
        mark = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, bool)
        mark[end_a] = True
        common = end_b[mark[end_b]]
        self.group_a, self.group_b = (np.searchsorted(common, x) for x in (end_a, end_b))
        self.of_a, self.of_b = (np.bincount(x, minlength=len(common)) for x in (self.group_a, self.group_b))
        doc = np.searchsorted(ends, common)
        self.n_groups = np.bincount(doc, minlength=len(rows))
        per_group = np.r_[0, np.cumsum(self.of_a * self.of_b)]
        self.n_links = np.diff(per_group[np.r_[0, np.cumsum(self.n_groups)]])

    def groups(self, names: list[str]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text; ``names`` as made by ``group_names``."""
        before_a, before_b = (np.r_[0, np.cumsum(x)] for x in (self.of_a, self.of_b))
        at_a = np.arange(len(self.a)) + before_b[self.group_a]
        at_b = np.arange(len(self.b)) + before_a[self.group_b + 1]
        last_a = np.arange(1, len(self.a) + 1) == before_a[self.group_a + 1]
        last_b = np.arange(1, len(self.b) + 1) == before_b[self.group_b + 1]
        which = np.empty(len(self.a) + len(self.b), np.int64)
        which[at_a] = 4 * self.a + last_a
        which[at_b] = 4 * self.b + 2 + last_b
        spelled = list(map(names.__getitem__, which.tolist()))
        cuts = np.r_[0, np.cumsum(self.n_a + self.n_b)].tolist()
        return ["".join(spelled[low:high])[:-1] for low, high in zip(cuts, cuts[1:])]

    def links(self, first_slot: int, step: int) -> Iterator[np.ndarray]:
        """Every link as one number: A id by radix, B id, slot of the document."""
        per_token = self.of_b[self.group_a]
        before = np.r_[0, np.cumsum(per_token)]
        first_b = (np.cumsum(self.of_b) - self.of_b)[self.group_a]
        slot = first_slot + np.repeat(np.arange(len(self.n_a)), self.n_a)
        low = 0
        while low < len(self.a):
            high = max(int(np.searchsorted(before, before[low] + step, "right")) - 1, low + 1)
            times = per_token[low:high]
            inner = np.arange(int(times.sum())) - np.repeat(before[low:high] - before[low], times)
            b = self.b[np.repeat(first_b[low:high], times) + inner]
            yield (np.repeat(by_radix(self.a[low:high]) << (ID_BITS + SLOT_BITS) | slot[low:high], times)
                   | b << SLOT_BITS)
            low = high


def group_names(most: int) -> list[str]:
    """Id with the sign that follows it: of A inside and at the end of a group, then of B."""
    return [f"{i}{sign}" for i in range(most) for sign in ",|,;"]


def by_radix(a: np.ndarray) -> np.ndarray:
    """A ids in an order that has those of equal radix together."""
    width = ID_BITS - (RADIX - 1).bit_length()
    return (a % RADIX) << width | a // RADIX


def from_radix(order: np.ndarray) -> np.ndarray:
    width = ID_BITS - (RADIX - 1).bit_length()
    return (order & ((1 << width) - 1)) * RADIX + (order >> width)


def radix_of(pair: np.ndarray) -> np.ndarray:
    return pair >> (2 * ID_BITS - (RADIX - 1).bit_length())


def pack(columns: list[np.ndarray], widths: tuple[int, ...]) -> bytes:
    """Whole numbers of equal count, byte plane by byte plane, as a zstd frame."""
    planes = [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes()
              for c, w in zip(columns, widths)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(frame: bytes, widths: tuple[int, ...]) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), np.uint8)
    count = len(planes) // sum(widths)
    planes, out, at = planes.reshape(sum(widths), count), [], 0
    for width in widths:
        wide = np.zeros((count, 8), np.uint8)
        wide[:, :width] = planes[at:at + width].T
        out.append(wide.view("<i8").ravel())
        at += width
    return out


PAIRS, RECORDS, COUNTS = (5, 3), (3, 4), (5, 6, 1)   # delta of pair and documents; slot and times; delta, n, best


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(values, new) if len(keys) else values


class Spill:
    """Links of whole documents, spilled as sorted runs of blocks."""

    def __init__(self, task: int, sizes: Sizes):
        self.run, self.slots, self.sizes = task << 24, 0, sizes
        self.raw, self.made = [], 0
        self.keys, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, links: Iterator[np.ndarray]) -> None:
        for part in links:
            self.raw.append(part)
            self.made += len(part)
            if self.made >= self.sizes.spill_links:
                self._compact()

    def _compact(self) -> None:
        if self.raw:
            keys, times = np.unique(np.concatenate(self.raw), return_counts=True)
            self.keys, self.times = summed(np.r_[self.keys, keys], np.r_[self.times, times])
            self.raw, self.made = [], 0

    def full(self) -> bool:
        return self.made + len(self.keys) >= self.sizes.spill_links or self.slots >= 1 << (SLOT_BITS - 1)

    def rows(self) -> dict[str, list]:
        """The blocks of the run; a new run starts."""
        self._compact()
        out: dict[str, list] = {"radix": [], "run": [], "first": [], "pairs": [], "records": []}
        pair = self.keys >> SLOT_BITS
        edges = np.searchsorted(radix_of(pair), np.arange(RADIX + 1))
        for radix, (start, stop) in enumerate(itertools.pairwise(edges.tolist())):
            for low in range(start, stop, self.sizes.block):
                high = min(low + self.sizes.block, stop)
                unique, counts = np.unique(pair[low:high], return_counts=True)
                out["radix"].append(radix)
                out["run"].append(self.run)
                out["first"].append(int(unique[0]))
                out["pairs"].append(pack([np.diff(unique, prepend=unique[0]), counts], PAIRS))
                out["records"].append(pack(
                    [self.keys[low:high] & ((1 << SLOT_BITS) - 1), self.times[low:high]], RECORDS))
        self.run += 1
        self.slots, self.keys, self.times = 0, self.keys[:0], self.times[:0]
        return out


DOC_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, slot int"
RUN_COLUMNS = "radix int, first long, pairs binary, records binary"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


_made: dict[int, tuple] = {}


def _tokenizers(shared, key: int) -> tuple[ByteLevel, Pieces, list[str]]:
    """The tokenizers of a broadcast pair of definitions, one of each in a Python worker."""
    if key not in _made:
        _made.clear()
        a, b = ByteLevel(shared.value[0]), Pieces(shared.value[1])
        _made[key] = a, b, group_names(max(len(a.spelled), len(b.spelled)))
    return _made[key]


def _chunks(shared, key: int, batches):
    """Runs of texts, aligned: (names of groups, ids of the rows, Aligned)."""
    a, b, names = _tokenizers(shared, key)
    for batch in batches:
        for run in W.runs(batch.column(1)):
            body, cuts = run.data.tobytes(), run.offsets.tolist()
            texts = [body[low:high] for low, high in itertools.pairwise(cuts)]
            yield names, batch.column(0).slice(run.first, run.count), Aligned(a, b, texts)


def _filled(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros(count, np.int64)
    out[rows] = values
    return out


def _spilled(shared, key: int, sizes: Sizes):
    schema = _schema(f"{DOC_COLUMNS}, run long, {RUN_COLUMNS}")

    def batch_of(columns: dict) -> pa.RecordBatch:
        count = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in schema],
            schema=schema)

    def spilled(batches):
        from pyspark import TaskContext

        spill = Spill(TaskContext.get().partitionId(), sizes)
        for names, ids, made in _chunks(shared, key, batches):
            count = len(ids)
            texts = [""] * count
            for row, text in zip(made.rows.tolist(), made.groups(names)):
                texts[row] = hashlib.sha256(text.encode()).hexdigest()
            slots = np.full(count, -1)
            slots[made.rows] = spill.slots + np.arange(len(made.rows))
            yield batch_of({
                "doc_id": ids, "groups_sha256": texts, "run": np.full(count, spill.run), "slot": slots,
                **{name: _filled(made.rows, getattr(made, name), count)
                   for name in ("n_a", "n_b", "n_groups", "n_links")}})
            spill.add(made.links(spill.slots, sizes.step_links))
            spill.slots += len(made.rows)
            if spill.full():
                yield batch_of(spill.rows())
        if spill.slots:
            yield batch_of(spill.rows())

    return spilled


class Open:
    """Open blocks of sorted keys; a heap tells which have something below a limit."""

    def __init__(self):
        self.heap, self.held, self.serial = [], 0, itertools.count()

    def add(self, keys: np.ndarray, *columns) -> None:
        if len(keys):
            heapq.heappush(self.heap, (int(keys[0]), next(self.serial), keys, columns))
            self.held += len(keys)

    def drain(self, limit: int | None = None) -> Iterator[tuple[np.ndarray, tuple]]:
        """What is at most ``limit`` of every open block, smallest keys first."""
        while self.heap and (limit is None or self.heap[0][0] <= limit):
            _, _, keys, columns = heapq.heappop(self.heap)
            cut = len(keys) if limit is None else int(np.searchsorted(keys, limit, "right"))
            self.held -= len(keys)
            yield keys[:cut], tuple(c[:cut] if isinstance(c, np.ndarray) else c for c in columns)
            self.add(keys[cut:], *(c[cut:] if isinstance(c, np.ndarray) else c for c in columns))


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _counted(sizes: Sizes):
    """Documents of each pair of a bucket. Blocks come in the order of bucket and first pair."""
    def counted(batches):
        def sums(limit=None):
            parts = list(heap.drain(limit))
            if parts:
                keys, values = summed(*(np.concatenate(x) for x in zip(*((k, c[0]) for k, c in parts))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(from_radix(keys >> ID_BITS), pa.int32()), pa.array(keys), pa.array(values)],
                    names=["a", "pair", "n"])

        heap, bucket = Open(), None
        for own, first, frame in _rows(batches):
            if own != bucket:
                yield from sums()
                bucket = own
            elif heap.held >= sizes.drain:
                yield from sums(first)
            deltas, counts = unpack(frame, PAIRS)
            heap.add(first + np.cumsum(deltas), counts)
        yield from sums()

    return counted


def _best(sizes: Sizes):
    """Sums of equal pairs, marked where no pair of their A id has more, in blocks. Rows come in
    the order of the pairs; those of the last A id wait for the next batch."""
    def best(batches):
        def blocks(pair, n):
            if not len(pair):
                return
            pair, n = summed(pair, n)
            a = pair >> ID_BITS
            new = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            best = n == np.repeat(np.maximum.reduceat(n, new), np.diff(np.r_[new, len(n)]))
            edges = np.flatnonzero(np.r_[True, np.diff(radix_of(pair)) != 0, True]).tolist()
            cuts = [low for start, stop in itertools.pairwise(edges) for low in range(start, stop, sizes.block)]
            out = [(int(radix_of(pair[low])), int(pair[low]), pack(
                [np.diff(pair[low:high], prepend=pair[low]), n[low:high], best[low:high]], COUNTS))
                for low, high in itertools.pairwise([*cuts, len(pair)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary()))],
                names=["radix", "first", "counts"])

        pairs, ns, held, last = [], [], 0, None
        for batch in batches:
            pair, n = (np.asarray(column) for column in batch.columns)
            if not len(pair):
                continue
            cut = int(np.searchsorted(pair, (pair[-1] >> ID_BITS) << ID_BITS))
            if held + cut >= sizes.drain and (cut or last != pair[-1] >> ID_BITS):
                yield from blocks(np.concatenate([*pairs, pair[:cut]]), np.concatenate([*ns, n[:cut]]))
                pairs, ns, held = [pair[cut:]], [n[cut:]], len(pair) - cut
            else:
                pairs.append(pair)
                ns.append(n)
                held += len(pair)
            last = pair[-1] >> ID_BITS
        if pairs:
            yield from blocks(np.concatenate(pairs), np.concatenate(ns))

    return best


def _returned(sizes: Sizes):
    """What documents get from the pairs of a bucket: links that are best, and the sum of counts.
    Blocks of counts come before those of records with the same first pair."""
    def returned(batches):
        def settle(limit=None):
            for keys, columns in list(counts.drain(limit)):
                for store, part in zip(known, (keys, *columns)):
                    store.append(part)
            parts = list(records.drain(limit))
            if not parts:
                return
            pair, n, best = (np.concatenate(x) for x in known)
            order = np.argsort(pair)
            pair, n, best = pair[order], n[order], best[order]
            for keys, (slot, times, run) in parts:
                at = np.searchsorted(pair, keys)
                np.add.at(gains[run][0], slot, times * best[at])
                np.add.at(gains[run][1], slot, times * n[at])
            keep = len(pair) if limit is None else int(np.searchsorted(pair, limit))
            for store, part in zip(known, (pair, n, best)):
                store[:] = [part[keep:]]

        def rows():
            for run, (best, total) in gains.items():
                slot = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slot), run)), pa.array(slot, pa.int32()), pa.array(best[slot]), pa.array(total[slot])],
                    names=["run", "slot", "n_best", "count_sum"])

        counts, records, known, gains, bucket = Open(), Open(), ([], [], []), {}, None
        for own, first, run, docs, pairs, frame, sums in _rows(batches):
            if own != bucket:
                settle()
                yield from rows()
                known, gains, bucket = ([], [], []), {}, own
            elif records.held >= sizes.drain:
                # Counts of this very pair are here when records of it come.
                settle(first if sums is None else first - 1)
            if sums is not None:
                deltas, n, best = unpack(sums, COUNTS)
                counts.add(first + np.cumsum(deltas), n, best)
                continue
            if run not in gains:
                gains[run] = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
            deltas, held = unpack(pairs, PAIRS)
            slot, times = unpack(frame, RECORDS)
            records.add(np.repeat(first + np.cumsum(deltas), held), slot, times, run)
        settle()
        yield from rows()

    return returned


def _definitions(spark: SparkSession, path_a: str, path_b: str):
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))


class Alignment:
    """The alignment of a table: ``documents`` and ``pairs``, both lazy over written tables."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                 sizes: Sizes = Sizes()):
        spark = prepared(docs.sparkSession)
        shared = _definitions(spark, path_a, path_b)
        spilled = stored(_texts(docs, id_col, text_col).mapInArrow(
            freeing(_spilled(shared, hash((path_a, path_b)), sizes)), f"{DOC_COLUMNS}, run long, {RUN_COLUMNS}"), "runs")
        self.rows = spilled.where("radix is null").drop("radix", "first", "pairs", "records")
        self._count(spilled.where("radix is not null").select("radix", "run", "first", "pairs", "records"), sizes)

    def _count(self, runs: DataFrame, sizes: Sizes) -> None:
        # One row per radix.
        held = dict(runs.groupBy("radix").agg(F.sum(F.length("pairs") + F.length("records"))).collect())
        shares = [max(1, -(-held.get(radix, 0) // sizes.bucket_bytes)) for radix in range(RADIX)]
        starts = np.cumsum([0, *shares[:-1]]).tolist()

        def of_radix(values: list[int]):
            return F.element_at(F.array(*map(F.lit, values)), F.col("radix") + 1)

        bucket = of_radix(starts) + F.pmod(F.xxhash64("run"), of_radix(shares)).cast("int")
        sums = (runs.select(bucket.alias("bucket"), "first", "pairs")
                .repartition("bucket").sortWithinPartitions("bucket", "first")
                .mapInArrow(freeing(_counted(sizes)), "a int, pair long, n long"))
        self.counts = stored(
            sums.repartition("a").sortWithinPartitions("pair").select("pair", "n")
            .mapInArrow(freeing(_best(sizes)), "radix int, first long, counts binary"), "counts")
        docs = self.rows.where("slot >= 0").groupBy("run").agg((F.max("slot") + 1).alias("docs"))
        blocks = (
            runs.join(docs, "run").select(
                bucket.alias("bucket"), "first", "run", "docs", "pairs", "records", F.lit(None).cast("binary").alias("counts"))
            .unionByName(self.counts.select(
                F.explode(F.sequence(of_radix(starts), of_radix(starts) + of_radix(shares) - 1)).alias("bucket"),
                "first", "counts"), allowMissingColumns=True))
        # A null run, that of counts, is sorted first.
        self.gains = stored(
            blocks.repartition("bucket").sortWithinPartitions("bucket", "first", "run")
            .mapInArrow(freeing(_returned(sizes)), "run long, slot int, n_best long, count_sum long"), "gains")

    @property
    def documents(self) -> DataFrame:
        """One row per row of the table."""
        gains = self.gains.groupBy("run", "slot").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        zero = F.lit(0).cast("long")
        return self.rows.join(gains, ["run", "slot"], "left").select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
            F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")

    @property
    def pairs(self) -> DataFrame:
        """Ids linked in some document: a, b, n_docs, best."""
        def read(batches):
            for first, frame in _rows(batches):
                deltas, n, best = unpack(frame, COUNTS)
                pair = first + np.cumsum(deltas)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(from_radix(pair >> ID_BITS)), pa.array(pair & ((1 << ID_BITS) - 1)), pa.array(n),
                     pa.array(best.astype(bool))], names=["a", "b", "n_docs", "best"])

        return self.counts.select("first", "counts").mapInArrow(
            freeing(read), "a long, b long, n_docs long, best boolean")


def with_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The groups of each text, ``a1,a2|b1;a3|b2,b3``: (doc_id, groups)."""
    shared = _definitions(prepared(docs.sparkSession), path_a, path_b)

    def grouped(batches):
        for names, ids, made in _chunks(shared, hash((path_a, path_b)), batches):
            texts = [""] * len(ids)
            for row, text in zip(made.rows.tolist(), made.groups(names)):
                texts[row] = text
            yield pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.string())], names=["doc_id", "groups"])

    return _texts(docs, id_col, text_col).mapInArrow(freeing(grouped), "doc_id long, groups string")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens, groups and links of both tokenizers, and the counts of its links."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return Alignment(docs, public_tokenizers.path("byte_bpe_50k.json"),
                     public_tokenizers.path("piece_bpe_32k.model")).documents
