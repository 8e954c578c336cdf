"""Token ids in files of fixed-width bits.

A file holds the ids of consecutive documents, each in the fewest bits that the vocabulary
needs, in blocks of ``BLOCK_IDS`` ids. Since a block's bits fill whole bytes, its offset is
known, any id is read without the ones before it, and a range is unpacked at once.

    blocks   packed ids, least significant bit first
    tables   end of each document in ids, id of each document, offset of each block
    foot     magic, bits, ids per block, ids, documents, place of the tables

Tables and foot have eight bytes, little-endian, for each entry.

Documents are written in ascending order of their ids, equal ids in order of their texts and
null first: range partitions are sorted, and every task writes one file under a name that
only its attempt has. Names and sizes of finished files make the manifest, so a file that a
lost task left behind is never read. Files lie in the shared folder.

Different words of a run of texts are encoded once, by the tokenizers library; white space
always parts tokens of the tokenizer used here. Many words go to the library as one text, with a
mark between any two: a word of one id. Where that id is found more often than the mark was set, the
words are encoded one by one. Defined results: a null text is an empty
one; each document ends with the end id, so an empty one has one id.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.store import folder, prepared, stored

MAGIC = int.from_bytes(b"QTOKENS1", "little")
FOOT = 6 * 8
BLOCK_IDS = 1 << 15
READ_DOCS = 2048            # documents that one task row reads
CACHE_WORDS = 1 << 21     # of about 30 bytes each
JOINED_WORDS = 64         # words that the library gets as one text
MARK = "\x01"             # between them


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, the last byte filled with zeros."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    lines = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(lines[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(body: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from bit ``first * bits`` of the body on."""
    if bits == 16:
        return np.frombuffer(body, "<u2", count, first * 2).astype(np.uint32)
    data = np.frombuffer(body + bytes(8), np.uint8)
    wide = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    at = (np.arange(first, first + count)) * bits
    return ((wide[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _files(place: str):
    return pa.fs.FileSystem.from_uri(place) if "://" in place or place.startswith("file:") \
        else (pa.fs.LocalFileSystem(), place)


class Writer:
    """Writes one file, block by block."""

    def __init__(self, place: str, bits: int):
        files, path = _files(place)
        files.create_dir(os.path.dirname(path), recursive=True)
        self.out = files.open_output_stream(path)
        self.files, self.path, self.bits = files, path, bits
        self.rest = np.zeros(0, np.uint32)
        self.count, self.ends, self.ids, self.offsets = 0, [], [], []
        self.at = 0

    def _put(self, body: bytes) -> None:
        self.out.write(body)
        self.at += len(body)

    def add(self, ids: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray) -> None:
        self.ends.append(self.count + np.cumsum(sizes))
        self.ids.append(doc_ids)
        self.count += len(ids)
        ids = np.concatenate((self.rest, ids))
        whole = len(ids) // BLOCK_IDS * BLOCK_IDS
        for at in range(0, whole, BLOCK_IDS):
            self.offsets.append(self.at)
            self._put(pack(ids[at:at + BLOCK_IDS], self.bits))
        self.rest = ids[whole:]

    def close(self) -> tuple[int, int]:
        if len(self.rest):
            self.offsets.append(self.at)
            self._put(pack(self.rest, self.bits))
        tables = self.at
        ends = np.concatenate(self.ends) if self.ends else np.zeros(0)
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0)
        for table, kind in ((ends, "<u8"), (ids, "<i8"), (np.array(self.offsets), "<u8")):
            self._put(table.astype(kind).tobytes())
        self._put(np.array([MAGIC, self.bits, BLOCK_IDS, self.count, len(ends), tables], "<u8").tobytes())
        self.out.close()
        return len(ends), self.count


class Reader:
    """Random access to one file."""

    def __init__(self, place: str):
        files, path = _files(place)
        self.file = files.open_input_file(path)
        self.file.seek(self.file.size() - FOOT)
        magic, self.bits, self.block, self.count, self.docs, self.tables = np.frombuffer(
            self.file.read(FOOT), "<u8").tolist()
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")

    def _table(self, offset: int, kind: str, low: int, high: int) -> np.ndarray:
        self.file.seek(self.tables + offset + 8 * low)
        return np.frombuffer(self.file.read(8 * (high - low)), kind)

    def documents(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents low..high-1 of the file and their bounds in its ids."""
        ends = self._table(0, "<u8", max(low - 1, 0), high).astype(np.int64)
        bounds = ends if low else np.r_[0, ends]
        return self._table(8 * self.docs, "<i8", low, high), bounds

    def ids(self, low: int, high: int) -> np.ndarray:
        """The ids low..high-1 of the file."""
        if high <= low:
            return np.zeros(0, np.uint32)
        first, last = low // self.block, (high - 1) // self.block
        offsets = self._table(16 * self.docs, "<u8", first, last + 1)
        start = int(offsets[0])
        stop = min(int(offsets[-1]) + self.block * self.bits // 8, self.tables)
        self.file.seek(start)
        return unpack(self.file.read(stop - start), self.bits, low - first * self.block, high - low)

    def close(self) -> None:
        self.file.close()


def mark_id(tokenizer) -> int | None:
    """Id of the mark between words; None where a text with marks does not fall into words."""
    def encoded(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    own, word = encoded(MARK), encoded("a")
    if tokenizer.truncation or tokenizer.padding or len(own) != 1 or encoded(f"a {MARK} a {MARK} ") != 2 * (word + own):
        return None
    return own[0]


class WordEncoder:
    """Encodes runs of texts by their different words; remembers words up to a bound."""

    def __init__(self, definition: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.end_id = end_id
        self.mark = mark_id(self.tokenizer)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _lists(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and the number of each word's."""
        if self.mark is None:
            lists = self._lists(words)
            return np.concatenate(lists), np.fromiter(map(len, lists), np.int32, len(lists))
        parts = [words[at:at + JOINED_WORDS] for at in range(0, len(words), JOINED_WORDS)]
        flat, sizes = [], []
        for part, ids in zip(parts, self._lists([f" {MARK} ".join([*part, ""]) for part in parts])):
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(part):
                flat.append(np.delete(ids, ends))
                sizes.append((np.diff(ends, prepend=-1) - 1).astype(np.int32))
            else:    # a word has the mark in it
                lists = self._lists(part)
                flat.extend(lists)
                sizes.append(np.fromiter(map(len, lists), np.int32, len(lists)))
        return np.concatenate(flat), np.concatenate(sizes)

    def encode(self, run: W.Run) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the run's texts with the end id behind each, and their sizes."""
        words = W.words_of(run)
        unique, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        slot = np.minimum(np.searchsorted(self.known, unique), max(len(self.known) - 1, 0))
        new = self.known[slot] != unique if len(self.known) else np.ones(len(unique), bool)
        if new.any():
            if len(self.known) + int(new.sum()) > CACHE_WORDS:
                self._forget()
                new[:] = True
            body, own = run.data.tobytes(), first[new]
            flat, sizes = self._words([body[a:b].decode("utf-8", "replace") for a, b in
                                       zip(words.start[own].tolist(), words.end[own].tolist())])
            place = np.searchsorted(self.known, unique[new])
            self.at = np.insert(self.at, place, len(self.ids) + np.cumsum(sizes) - sizes)
            self.size = np.insert(self.size, place, sizes)
            self.known = np.insert(self.known, place, unique[new])
            self.ids = np.concatenate((self.ids, flat))
        slot = np.searchsorted(self.known, unique)[which]
        size = self.size[slot].astype(np.int64)
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        place = np.repeat(self.at[slot] - (stop - size), size) + np.arange(total)
        edges = np.r_[0, stop][words.bounds]
        ids = np.insert(self.ids[place], edges[1:], np.uint32(self.end_id))
        return ids, np.diff(edges) + 1


_made: dict[str, WordEncoder] = {}


def _encoder(shared, key: str, end_id: int) -> WordEncoder:
    if key not in _made:
        _made.clear()
        _made[key] = WordEncoder(shared.value, end_id)
    return _made[key]


def _write(shared, key: str, end_id: int, bits: int, place: str):
    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        encoder = _encoder(shared, key, end_id)
        writer, path = None, ""
        for batch in batches:
            for run in W.runs(batch.column(1)):
                if writer is None:
                    path = f"{place}/tokens-{task.partitionId():06d}-{uuid.uuid4().hex}.bin"
                    writer = Writer(path, bits)
                ids, sizes = encoder.encode(run)
                own = batch.column(0).slice(run.first, run.count).fill_null(-(1 << 63))
                writer.add(ids, sizes, np.asarray(own))
        if writer is not None:
            docs, tokens = writer.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([task.partitionId()], pa.int32()), "path": [path], "n_docs": [docs], "n_tokens": [tokens]})

    return write


def write_tokens(docs: DataFrame, tokenizer_path: str, place: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files and returns the manifest: part, path, n_docs, n_tokens and start, the
    ids in all files before, one row per file."""
    spark = prepared(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    from tokenizers import Tokenizer

    bits = bits_for(max(Tokenizer.from_str(definition).get_vocab_size(True), end_id + 1))
    shared = spark.sparkContext.broadcast(definition)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    files = stored(
        rows.repartitionByRange("id").sortWithinPartitions("id", "text")
        .mapInArrow(_write(shared, uuid.uuid4().hex, end_id, bits, place),
                    "part int, path string, n_docs long, n_tokens long"), "manifest")
    # One row per file: few enough for one task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def _read(batches):
    for batch in batches:
        for row in batch.to_pylist():
            reader = Reader(row["path"])
            doc_ids, bounds = reader.documents(row["low"], row["high"])
            ids = reader.ids(int(bounds[0]), int(bounds[-1]))
            reader.close()
            body = memoryview(ids.astype("<u4").tobytes())
            cuts = ((bounds - bounds[0]) * 4).tolist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc_ids, mask=doc_ids == -(1 << 63)),
                "start": pa.array(row["start"] + bounds[:-1]),
                "ids": pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()),
                                                pa.array(ids.astype(np.int32))),
                "ids_crc32": pa.array([zlib.crc32(body[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.int64())})


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Documents read back from the files of a manifest: doc_id, start, ids, ids_crc32."""
    spark = manifest.sparkSession
    ranges = manifest.where("n_docs > 0").select(
        "path", "start", "n_docs", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(READ_DOCS).cast("long"))).alias("low"))
    ranges = ranges.select("path", "start", "low", F.least(F.col("low") + READ_DOCS, "n_docs").alias("high"))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows that name files are small, so Spark is told how many tasks read them.
    return ranges.repartition(count, "path", "low").mapInArrow(
        _read, "doc_id long, start long, ids array<int>, ids_crc32 long")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the files: where its ids start, how many they are, their crc."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    manifest = write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"),
                            folder(spark, "tokens"), 1)
    return read_tokens(manifest).select(
        "doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32")
