"""Repeated passages across documents: seed on winnowed anchors, extend, keep long ones.

A window is ``window`` consecutive words of one document. It is a repeat when the same
words also start in a document with a smaller id. The steps:

1. Every document is winnowed: of each ``window - seed + 1`` consecutive seed-word grams
   the one with the smallest hash is an anchor (the last among equals). A window holds
   at least one anchor, and equal windows hold it at the same place.
2. Anchors join documents on their hash; an anchor of one document only is dropped here,
   and with it nearly all of a corpus.
3. An anchor is extended both ways over all windows it was chosen in. A whole extension
   that an earlier document holds is a repeat as it is, so of many copies only the first
   one goes on.
4. What is left is extended word by word: every window in it looks for its first document.
5. Overlapping windows are merged into maximal spans.

Joins are on hashes with the first document of each, found by a combining aggregate; no
pair of documents is ever made, so a passage that a third of all documents share costs
one row per occurrence. Hashes have 64 bits.

Defined results: a null or empty text has no words; a null id is neither judged nor
referred to; rows with equal id and text get the same spans, rows with equal ids and
other texts are not earlier than each other; no document is changed before all are judged.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.store import freeing, prepared, row_key, stored

WINDOW = 50
SEED = 20


def _table(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _anchors(window: int, seed: int):
    width = window - seed + 1

    def batch_anchors(batches):
        for batch in batches:
            keys, ids = (np.asarray(batch.column(i)) for i in (0, 1))
            for run in W.runs(batch.column(2)):
                words = W.words_of(run)
                sums = W.prefix_sums(words.hash)
                grams = W.gram_hashes(words, seed, sums)
                starts = np.flatnonzero(W.gram_valid(words, window))
                if not len(starts):
                    continue
                # Places of anchors never fall, so the windows of an anchor are neighbours.
                chosen = W.sliding_argmin(grams, width)[starts]
                new = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
                at, low = chosen[new], starts[new]
                high = starts[np.r_[new[1:] - 1, len(starts) - 1]]
                text = np.searchsorted(words.bounds, at, "right") - 1
                base = words.bounds[text]
                whole = W.span_hash(sums, low, high + window)
                yield _table({
                    "seed": grams[at].view(np.int64), "whole": whole.view(np.int64),
                    "doc": ids[run.first + text], "rk": keys[run.first + text],
                    "low": (low - base).astype(np.int32), "high": (high - base).astype(np.int32)})

    return batch_anchors


def _windows(window: int):
    """Hashes of the windows that start in the given ranges of each text."""

    def batch_windows(batches):
        for batch in batches:
            keys, ids = (np.asarray(batch.column(i)) for i in (0, 1))
            ranges = batch.column(3)
            values = ranges.flatten()
            lows, highs = (np.asarray(values.field(i)).astype(np.int64) for i in (0, 1))
            cuts = np.r_[0, np.cumsum(np.asarray(ranges.value_lengths()))]
            for run in W.runs(batch.column(2)):
                words = W.words_of(run)
                sums = W.prefix_sums(words.hash)
                a, b = cuts[run.first], cuts[run.first + run.count]
                text = np.repeat(np.arange(run.count), np.diff(cuts[run.first:run.first + run.count + 1]))
                low, size = lows[a:b], highs[a:b] - lows[a:b] + 1
                total = int(size.sum())
                if not total:
                    continue
                inner = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
                place = np.repeat(low, size) + inner
                text = np.repeat(text, size)
                start = place + words.bounds[text]
                yield _table({
                    "hash": W.span_hash(sums, start, start + window).view(np.int64),
                    "doc": ids[run.first + text], "rk": keys[run.first + text],
                    "at": place.astype(np.int32)})

    return batch_windows


def _earliest(rows: DataFrame, key: str) -> DataFrame:
    """The first document of each key that several documents hold."""
    return stored(rows.groupBy(key).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                  .where("first < last").select(key, "first"), "earliest", clean=True)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Maximal spans of words that repeat an earlier document: (rk, spans), spans an array
    of (low, high), the first word and the one after the last, in order and apart.
    ``rk`` is store.row_key of the row."""
    prepared(docs.sparkSession)
    texts = docs.select(
        row_key(id_col, text_col).alias("rk"), F.col(f"`{id_col}`").cast("long").alias("doc"),
        F.col(f"`{text_col}`").alias("text")).where("doc is not null and text is not null")
    anchors = stored(texts.mapInArrow(
        freeing(_anchors(window, seed)), "seed long, whole long, doc long, rk long, low int, high int"),
        "anchors")
    # Written, so that the join's sides are plain exchanges and a hot seed can be split.
    shared = stored(anchors.groupBy("seed").agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
                    .where("a < b").select("seed"), "shared", clean=True)
    seeded = stored(anchors.join(shared, "seed").select("whole", "doc", "rk", "low", "high"), "seeded",
                    clean=True)
    judged = stored(
        seeded.join(_earliest(seeded, "whole"), "whole", "left")
        .select("rk", "doc", "low", "high",
                F.coalesce(F.col("first") < F.col("doc"), F.lit(False)).alias("repeat")), "judged", clean=True)
    known = judged.where("repeat").select("rk", "low", (F.col("high") + window).alias("high"))
    # Ranges of one document only meet here: as many as it has anchors at most.
    open_ranges = (judged.where("not repeat").groupBy("rk")
                   .agg(F.array_distinct(F.collect_list(F.struct("low", "high"))).alias("ranges")))
    grams = (texts.join(open_ranges, "rk").select("rk", "doc", "text", "ranges")
             .mapInArrow(freeing(_windows(window)), "hash long, doc long, rk long, at int"))
    grams = stored(grams, "windows", clean=True)
    found = (grams.join(_earliest(grams, "hash"), "hash").where("first < doc")
             .select("rk", F.col("at").alias("low"), (F.col("at") + window).alias("high")))
    return (known.unionByName(found).groupBy("rk")
            .agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias("spans"))
            .select("rk", _merged("spans").alias("spans")))


def _merged(spans: str):
    """Sorted spans merged where they meet or overlap."""
    return F.expr(f"""aggregate({spans},
        cast(array() as array<struct<low:int,high:int>>),
        (acc, x) -> case
            when size(acc) = 0 or x.low > acc[size(acc) - 1].high then concat(acc, array(x))
            when x.high > acc[size(acc) - 1].high then concat(slice(acc, 1, size(acc) - 1),
                array(named_struct('low', acc[size(acc) - 1].low, 'high', x.high)))
            else acc end)""")


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The rows and columns of ``docs`` with ``repeats``: the spans of repeated words, null
    where there are none. An input column of that name is replaced."""
    spans = repeated_spans(docs, id_col, text_col, window, seed)
    key = "__row_key"
    return (docs.drop("repeats").withColumn(key, row_key(id_col, text_col))
            .join(spans.select(F.col("rk").alias(key), F.col("spans").alias("repeats")), key, "left")
            .drop(key))


def _removed(run: W.Run, words: W.Words, spans: pa.Array):
    """Per word of a run: whether a span of its text covers it."""
    lists = spans.slice(run.first, run.count)
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    values = lists.flatten()
    low, high = (np.asarray(values.field(i)).astype(np.int64) for i in (0, 1))
    base = np.repeat(words.bounds[:-1], sizes)
    edge = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(edge, low + base, 1)
    np.add.at(edge, high + base, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(batches):
    """Text without the repeated words and the white space after each of them."""
    for batch in batches:
        texts, spans = batch.column(0), batch.column(1)
        out: list = []
        for run in W.runs(texts):
            words = W.words_of(run, hashed=False)
            gone = _removed(run, words, spans)
            for i in range(run.count):
                a, b = words.bounds[i], words.bounds[i + 1]
                body = run.data[run.offsets[i]:run.offsets[i + 1]]
                if not gone[a:b].any():
                    out.append(body.tobytes())
                    continue
                # Each word owns the bytes up to the next word.
                edges = np.r_[words.start[a:b] - run.offsets[i], len(body)]
                keep = np.repeat(np.r_[True, ~gone[a:b]], np.diff(np.r_[0, edges]))
                out.append(body[keep].tobytes().strip(b" \t\n\v\f\r"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out, pa.binary()).cast(pa.string()), *batch.columns[2:]],
            names=["text", *batch.schema.names[2:]])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``docs`` with the repeated words cut from their texts. Rows and columns stay; a text
    without repeats stays as it is, a null text stays null."""
    columns = docs.columns
    found = with_repeats(docs, id_col, text_col, window, seed)
    rest = [c for c in columns if c != text_col]
    hit = found.where("repeats is not null")
    schema = hit.select(F.col(f"`{text_col}`").alias("text"),
                        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]).schema
    cut = (hit.select(F.col(f"`{text_col}`").alias("text"), "repeats",
                      *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
           .mapInArrow(freeing(_cut), schema))
    cut = cut.select(*[F.col("text").alias(text_col) if c == text_col
                       else F.col(f"c{rest.index(c)}").alias(c) for c in columns])
    return found.where("repeats is null").select(*[f"`{c}`" for c in columns]).unionByName(cut)


def _digest(batches):
    for batch in batches:
        spans = batch.column(2)
        counts, removed, digests = [], [], []
        for run in W.runs(batch.column(1)):
            words = W.words_of(run, hashed=False)
            gone = _removed(run, words, spans)
            sums = np.r_[0, np.cumsum(gone)]
            counts.append(words.counts)
            removed.append(sums[words.bounds[1:]] - sums[words.bounds[:-1]])
            # The kept words with one blank after each, for the whole run at once.
            size = np.where(gone, 0, words.end - words.start + 1)
            stop = np.cumsum(size)
            place = np.repeat(words.start - (stop - size), size) + np.arange(int(size.sum()))
            # Taken by places, so a copy: run.data itself is read-only, also where no word is kept.
            flat = run.data[np.minimum(place, len(run.data) - 1)]
            flat[stop[~gone] - 1] = 0x20
            edges = np.r_[0, stop][words.bounds]
            body = flat.tobytes()
            digests += [hashlib.sha256(body[a:max(a, b - 1)]).hexdigest()
                        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        yield _table({
            "doc_id": batch.column(0),
            "n_words": pa.array(np.concatenate(counts) if counts else [], pa.int64()),
            "n_removed": pa.array(np.concatenate(removed) if removed else [], pa.int64()),
            "kept_sha256": pa.array(digests, pa.string())})


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: its words, the repeated ones among them, the digest of the others."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_repeats(docs).select("doc_id", "text", "repeats").mapInArrow(
        freeing(_digest), "doc_id long, n_words long, n_removed long, kept_sha256 string")
