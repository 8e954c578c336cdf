"""Lines that stand in several documents, found with two Bloom filters.

A line's key is the line without white space at its ends, in ASCII lower case. Keys of at
least ``min_chars`` characters that at least ``min_docs`` documents hold lose all their lines,
except in the document with the largest id. The steps:

1. Each task hashes its long lines and notes, per block of the filter, which bits hashes set:
   the once-seen filter, and for hashes that came from two documents the twice-seen filter.
2. Blocks are merged where they belong: a bit that two notes have once is seen twice. Only
   bits that are set travel, two bytes each.
3. With the twice-seen filter every task probes its own lines again. A line whose bits are
   not all set there stands in one document only and is never shuffled.
4. The suspected lines are grouped by their whole keys: how many documents hold it, and the
   largest id. Counts combine on the map side, so a line that a third of all documents share
   sends one row per task.
5. Their places are joined with the confirmed keys, and each document drops its lines.

The filter has a byte for each ``min_chars + 1`` bytes of text and at most ``FILTER_BYTES``:
that bounds what is broadcast. Beyond it, more lines that stand once are suspected and
shuffled; the result is the same, as keys are compared whole.

Defined results: each row is a document; a null id is smaller than all others, and rows that
share the largest id all keep their lines; a null or empty text is one empty line; a line that
repeats inside one document counts once. Columns of the input stay, those that have the name
of a new one are replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.store import freeing, prepared, row_key, stored

MIN_CHARS = 40
MIN_DOCS = 5
FILTER_BYTES = 1 << 25
BLOCK_BITS = 1 << 16
HASHES = 1 << 20            # hashes noted at once
MADE = {"n_lines": "long", "n_dropped": "long"}


def lines_of(run: W.Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of all lines of a run, and the bounds of each text in them."""
    breaks = np.flatnonzero(run.data == 0x0A)
    start = np.sort(np.concatenate((run.offsets[:-1], breaks + 1)), kind="stable")
    end = np.sort(np.concatenate((run.offsets[1:], breaks)), kind="stable")
    bounds = np.searchsorted(breaks, run.offsets) + np.arange(run.count + 1)
    return start, end, bounds


def long_lines(run: W.Run, min_chars: int) -> tuple[np.ndarray, ...]:
    """Lines whose key has ``min_chars`` characters: text, place in the text, span and hash of
    the key."""
    start, end, bounds = lines_of(run)
    inside = np.flatnonzero(W.SPACED[run.data])
    low, high = np.searchsorted(inside, start), np.searchsorted(inside, end)
    own = np.flatnonzero(high > low)
    start, end = inside[low[own]], inside[high[own] - 1] + 1
    heads = np.r_[0, np.cumsum((run.data & 0xC0) != 0x80)]
    wide = heads[end] - heads[start] >= min_chars
    own, start, end = own[wide], start[wide], end[wide]
    text = np.searchsorted(bounds, own, "right") - 1
    if not len(own):
        return text, own, start, end, np.zeros(0, np.uint64)
    values = W._BYTE_VALUES[W.LOWER[run.data]]
    return text, own - bounds[text], start, end, W.span_hash(W.prefix_sums(values), start, end)


def first_of_text(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a line is the first with its hash in its text."""
    order = np.lexsort((np.arange(len(text)), hashes, text))
    first = np.ones(len(text), bool)
    first[order[1:]] = (hashes[order[1:]] != hashes[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    return first


def bits_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """The three bits of each hash, all in one block."""
    base = ((hashes >> np.uint64(48)) & np.uint64(blocks - 1)) * np.uint64(BLOCK_BITS)
    places = [(hashes >> np.uint64(shift)) & np.uint64(BLOCK_BITS - 1) for shift in (0, 16, 32)]
    return np.stack([(base + place).astype(np.int64) for place in places])


def _notes(hashes: list[np.ndarray], blocks: int) -> pa.RecordBatch:
    """Bits that hashes set once and twice, one row per block that has any."""
    unique, counts = np.unique(np.concatenate(hashes), return_counts=True)
    once = np.unique(bits_of(unique, blocks))
    twice = np.unique(bits_of(unique[counts > 1], blocks))
    block = np.unique(once // BLOCK_BITS)
    columns = {"block": pa.array(block, pa.int32())}
    for name, bits in (("once", once), ("twice", twice)):
        edges = np.searchsorted(bits, np.r_[block * BLOCK_BITS, (block[-1] + 1) * BLOCK_BITS])
        body = pa.py_buffer((bits % BLOCK_BITS).astype("<u2").tobytes())
        columns[name] = pa.Array.from_buffers(
            pa.binary(), len(block), [None, pa.py_buffer((edges * 2).astype(np.int32).tobytes()), body])
    return pa.RecordBatch.from_pydict(columns)


def _noted(blocks: int, min_chars: int, at_once: int):
    def noted(batches):
        held, count = [], 0
        for batch in batches:
            for run in W.runs(batch.column(0)):
                text, _, _, _, hashes = long_lines(run, min_chars)
                hashes = hashes[first_of_text(text, hashes)]
                held.append(hashes)
                count += len(hashes)
                if count >= at_once:
                    yield _notes(held, blocks)
                    held, count = [], 0
        if count:
            yield _notes(held, blocks)

    return noted


def _merged(batches):
    """The twice-seen bits of each block; rows come in the order of their blocks."""
    block, once, twice = None, np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)

    def row():
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int32()), "bits": [zlib.compress(np.packbits(twice, bitorder="little").tobytes(), 1)]})

    for batch in batches:
        for own, one, two in zip(*(column.to_pylist() for column in batch.columns)):
            if own != block:
                if block is not None and twice.any():
                    yield row()
                block = own
                once[:], twice[:] = False, False
            one = np.frombuffer(one, "<u2")
            twice[one[once[one]]] = True
            twice[np.frombuffer(two, "<u2")] = True
            once[one] = True
    if block is not None and twice.any():
        yield row()


def twice_seen(texts: DataFrame, text_col: str, min_chars: int = MIN_CHARS,
               filter_bytes: int = FILTER_BYTES) -> tuple[bytes, int]:
    """The twice-seen filter over the long lines of all texts, and its number of blocks."""
    prepared(texts.sparkSession)
    text = texts.select(F.col(f"`{text_col}`").alias("text"))
    size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = -(-size // (min_chars + 1) * 8 // BLOCK_BITS)
    blocks = 1 << max(0, min(wanted, filter_bytes * 8 // BLOCK_BITS, BLOCK_BITS) - 1).bit_length()
    notes = text.where("text is not null").mapInArrow(
        freeing(_noted(blocks, min_chars, HASHES)), "block int, once binary, twice binary")
    merged = stored(notes.repartition("block").sortWithinPartitions("block").mapInArrow(
        freeing(_merged), "block int, bits binary"), "filter").toArrow()
    # At most filter_bytes, whatever the size of the table.
    whole = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for block, bits in zip(merged.column(0).to_pylist(), merged.column(1).to_pylist()):
        whole[block] = np.frombuffer(zlib.decompress(bits), np.uint8)
    return whole.tobytes(), blocks


def _suspects(shared, blocks: int, min_chars: int):
    def suspects(batches):
        seen = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for run in W.runs(batch.column(2)):
                text, place, start, end, hashes = long_lines(run, min_chars)
                bits = bits_of(hashes, blocks)
                hit = np.flatnonzero(((seen[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1).all(0))
                if not len(hit):
                    continue
                first = first_of_text(text, hashes)
                body = W.LOWER[run.data].tobytes()
                rows = pa.array(run.first + text[hit])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), batch.column(1).take(rows),
                    pa.array(place[hit], pa.int32()), pa.array(first[hit]),
                    pa.array([body[a:b] for a, b in zip(start[hit].tolist(), end[hit].tolist())],
                             pa.binary()).cast(pa.string())],
                    names=["rk", "doc", "line", "first", "key"])

    return suspects


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                   filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Lines to drop: (rk, doc, lines), lines counted from 0. ``rk`` is store.row_key."""
    spark = prepared(docs.sparkSession)
    texts = docs.select(
        row_key(id_col, text_col).alias("rk"), F.col(f"`{id_col}`").cast("long").alias("doc"),
        F.col(f"`{text_col}`").alias("text")).where("text is not null")
    seen, blocks = twice_seen(texts, "text", min_chars, filter_bytes)
    shared = spark.sparkContext.broadcast(seen)
    suspects = stored(texts.mapInArrow(
        freeing(_suspects(shared, blocks, min_chars)),
        "rk long, doc long, line int, first boolean, key string"), "suspects")
    confirmed = stored(
        suspects.groupBy("key").agg(F.count_if("first").alias("n"), F.max("doc").alias("last"))
        .where(F.col("n") >= min_docs).select("key", "last"), "confirmed")
    # Both sides are written tables, so a hot key can be split.
    found = suspects.join(confirmed, "key").where(~F.col("doc").eqNullSafe(F.col("last")))
    return found.groupBy("rk", "doc").agg(F.collect_set("line").alias("lines"))


def _kept(names: list[str]):
    def kept(batches):
        for batch in batches:
            texts, counts, dropped = [], [], []
            for text, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = (text or "").split("\n")
                counts.append(len(parts))
                dropped.append(len(lines or ()))
                if lines:
                    gone = set(lines)
                    text = "\n".join(part for place, part in enumerate(parts) if place not in gone)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), *batch.columns[1:], pa.array(counts, pa.int64()),
                 pa.array(dropped, pa.int64())], names=names)

    return kept


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           **options) -> DataFrame:
    """``docs`` with their lines dropped, and n_lines (before) and n_dropped."""
    gone = repeated_lines(docs, id_col, text_col, **options)
    kept = [c for c in docs.columns if c not in MADE]
    inner = docs.select(
        F.col(f"`{text_col}`").alias("x"), row_key(id_col, text_col).alias("rk"),
        F.col(f"`{id_col}`").cast("long").alias("doc"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept) if c != text_col])
    gone = gone.select(F.col("rk").alias("gone_rk"), F.col("doc").alias("gone_doc"), "lines")
    joined = inner.join(gone, (F.col("rk") == F.col("gone_rk")) & F.col("doc").eqNullSafe(F.col("gone_doc")), "left")
    joined = joined.select("x", "lines", *[c for c in inner.columns if c[0] == "c"])
    schema = joined.select("*", F.lit(0).cast("long").alias("y0"), F.lit(0).cast("long").alias("y1")).schema
    out = joined.mapInArrow(freeing(_kept(schema.names)), schema)
    return out.select(
        *[F.col("x").alias(c) if c == text_col else F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
        *[F.col(f"y{i}").alias(c) for i, c in enumerate(MADE)])


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many were dropped, and the digest of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
