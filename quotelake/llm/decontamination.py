"""Benchmark passages in documents, by an FM-index over each shard of texts.

Words are runs of ASCII letters and digits and of all non-ASCII characters, with A-Z in
lower case. A phrase is ``window`` consecutive words of an item; a shorter item with words
is one phrase. A shard is a run of whole texts inside a batch. Words that no phrase holds
part the shard into runs, and runs shorter than the shortest phrase cannot hold one, so the
index covers the other runs only and still finds every occurrence. All phrases are searched
backwards at once, occurrences are located by sampled suffix positions, and their words are
merged into spans. Documents are never shuffled.

Phrases go to the shards in blocks of at most ``PHRASE_BYTES`` of benchmark text, one pass
for each block, so the benchmark may be of any size.

Defined results: null texts and items have no words; an item without id hits words and is
not listed; equal items and repeated documents count as often as they are there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.fm_index import FMIndex
from quotelake.llm.store import freeing, prepared
from quotelake.llm.substring_dedup import _merged

WINDOW = 10
PHRASE_BYTES = 8 << 20
SHARD_BYTES = 1 << 20


@dataclass
class Phrases:
    """Phrases of a block of items: per length their symbols and items."""

    vocabulary: np.ndarray
    groups: list[tuple[np.ndarray, np.ndarray]]
    names: list[str | None]

    @classmethod
    def of(cls, names: list[str | None], texts: pa.Array, window: int) -> Phrases:
        found: dict[int, tuple[list, list]] = {}
        hashes = []
        for run in W.runs(texts):
            words = W.words_of(run, W.ALNUM, W.LOWER)
            hashes.append(words.hash)
            for i in range(run.count):
                own = words.hash[words.bounds[i]:words.bounds[i + 1]]
                if not len(own):
                    continue
                size = min(window, len(own))
                lines, items = found.setdefault(size, ([], []))
                lines.append(np.lib.stride_tricks.sliding_window_view(own, size))
                items.append(np.full(len(own) - size + 1, run.first + i))
        vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        groups = [(np.searchsorted(vocabulary, np.concatenate(lines)) + 1, np.concatenate(items))
                  for lines, items in found.values()]
        return cls(vocabulary, groups, names)

    def occurrences(self, words: W.Words):
        """(word, length, item) of every occurrence in a run's words."""
        none = np.zeros(0, np.int64)
        if not self.groups or not len(words.hash):
            return none, none, none
        slot = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        symbols = np.where(self.vocabulary[slot] == words.hash, slot + 1, 0)
        known = symbols > 0
        start = known.copy()
        start[1:] &= ~known[:-1]
        edges = words.bounds[:-1][words.bounds[:-1] < len(known)]
        start[edges] = known[edges]
        begin = np.flatnonzero(start)
        # Known words before each place, and so the length of each run of them.
        before = np.cumsum(known) - known
        length = np.diff(np.r_[before[begin], int(known.sum())])
        long = length >= min(lines.shape[1] for lines, _ in self.groups)
        begin, length = begin[long], length[long]
        if not len(begin):
            return none, none, none
        # The runs one after the other, each with a separator behind it.
        stop = np.cumsum(length + 1)
        place = np.repeat(begin - (stop - length - 1), length + 1) + np.arange(int(stop[-1]))
        text = symbols[np.minimum(place, len(symbols) - 1)]
        text[stop - 1] = 0
        index = FMIndex(text, len(self.vocabulary))
        at, sizes, items = [], [], []
        for lines, owner in self.groups:
            low, high = index.search(lines)
            count = np.maximum(high - low, 0)
            total = int(count.sum())
            if not total:
                continue
            inner = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
            at.append(place[index.locate(np.repeat(low, count) + inner)])
            sizes.append(np.full(total, lines.shape[1]))
            items.append(np.repeat(owner, count))
        if not at:
            return none, none, none
        return np.concatenate(at), np.concatenate(sizes), np.concatenate(items)


def _scan(phrases, names: list[str]):
    """Adds to each text its words, the spans hit and the items found."""

    def batch_scan(batches):
        block: Phrases = phrases.value
        for batch in batches:
            n_words, lists, pairs = [], [], []
            for run in W.runs(batch.column(0), SHARD_BYTES):
                words = W.words_of(run, W.ALNUM, W.LOWER)
                n_words.append(words.counts)
                at, size, item = block.occurrences(words)
                edge = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + size, -1)
                hit = np.cumsum(edge) > 0
                # Spans start where a hit word follows a free one or begins its text.
                first = hit[:-1].copy()
                first[1:] &= ~hit[:-2]
                final = hit[:-1] & ~hit[1:]
                heads = words.bounds[:-1][words.bounds[:-1] < len(first)]
                tails = words.bounds[1:][words.bounds[1:] > 0] - 1
                first[heads] = hit[heads]
                final[tails] = hit[tails]
                low, high = np.flatnonzero(first), np.flatnonzero(final) + 1
                text = np.searchsorted(words.bounds, low, "right") - 1
                lists.append((run, text, low - words.bounds[text], high - words.bounds[text]))
                owner = np.searchsorted(words.bounds, at, "right") - 1 + run.first
                pairs.append(np.unique(np.stack((owner, item)), axis=1) if len(at)
                             else np.zeros((2, 0), np.int64))
            rows = batch.num_rows
            text = np.concatenate([run.first + t for run, t, _, _ in lists]) if lists else np.zeros(0, int)
            cuts = np.searchsorted(text, np.arange(rows + 1)).astype(np.int32)
            spans = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays([
                pa.array(np.concatenate([x[k] for x in lists]) if lists else [], pa.int32())
                for k in (2, 3)], ["low", "high"]))
            owner, item = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
            found = [(o, block.names[i]) for o, i in zip(owner.tolist(), item.tolist())
                     if block.names[i] is not None]
            cuts = np.searchsorted(np.array([o for o, _ in found], np.int64), np.arange(rows + 1))
            items = pa.ListArray.from_arrays(cuts.astype(np.int32),
                                             pa.array([name for _, name in found], pa.string()))
            counts = pa.array(np.concatenate(n_words) if n_words else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts, spans, items], names=names)

    return batch_scan


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """The items in blocks of bounded size, one on the driver at a time."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("name"),
                             F.col(f"`{text_col}`").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, -(-size // PHRASE_BYTES))
    for block in range(count):
        part = items if count == 1 else items.where(
            F.pmod(F.xxhash64("name", "text"), F.lit(count)) == block)
        yield part.sort("name", "text").toArrow()


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text",
              window: int = WINDOW) -> DataFrame:
    """The rows and columns of ``docs`` with ``n_words``, ``hits`` (spans of words, low and
    high, in order and apart) and ``items`` (ids as strings, sorted). Input columns of these
    names are replaced."""
    spark = prepared(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    rest = [c for c in columns if c != text_col]
    found = docs.select(F.col(f"`{text_col}`").alias("text"),
                        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    count = 0
    for table in _blocks(benchmark, item_id_col, item_text_col):
        table = table.combine_chunks()
        texts = table.column("text")
        phrases = spark.sparkContext.broadcast(Phrases.of(
            table.column("name").to_pylist(),
            texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, window))
        names = [*found.columns, f"n{count}", f"h{count}", f"i{count}"]
        schema = found.select("*", F.lit(0).cast("long").alias(names[-3]),
                              F.expr("cast(array() as array<struct<low:int,high:int>>)").alias(names[-2]),
                              F.expr("cast(array() as array<string>)").alias(names[-1])).schema
        found = found.mapInArrow(freeing(_scan(phrases, names)), schema)
        count += 1
    hits = F.col("h0") if count == 1 else _merged(
        "sort_array(concat(" + ", ".join(f"h{i}" for i in range(count)) + "))")
    items = F.array_sort(F.array_distinct(F.concat(*[F.col(f"i{i}") for i in range(count)])))
    return found.select(
        *[F.col("text").alias(text_col) if c == text_col else F.col(f"c{rest.index(c)}").alias(c)
          for c in columns],
        F.col("n0").alias("n_words"), hits.alias("hits"), items.alias("items"))


def _cut(batches):
    """Texts without the bytes from the first to the last word of each span."""
    for batch in batches:
        texts, spans = batch.column(0), batch.column(1)
        lists = spans.to_pylist()
        out: list = []
        for run in W.runs(texts):
            words = W.words_of(run, W.ALNUM, hashed=False)
            for i in range(run.count):
                body = run.data[run.offsets[i]:run.offsets[i + 1]]
                base, shift = words.bounds[i], run.offsets[i]
                keep, at = [], 0
                for span in lists[run.first + i]:
                    keep.append(body[at:words.start[base + span["low"]] - shift])
                    at = words.end[base + span["high"] - 1] - shift
                out.append(b"".join(x.tobytes() for x in (*keep, body[at:])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out, pa.binary()).cast(pa.string()), *batch.columns[2:]],
            names=["text", *batch.schema.names[2:]])


def without_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """``docs`` with benchmark spans cut from their texts; rows and columns stay, and a text
    without hits stays as it is."""
    columns = docs.columns
    rest = [c for c in columns if c != text_col]
    inner = docs.select(F.col(f"`{text_col}`").alias("text"),
                        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    found = with_hits(inner, benchmark, "text", item_id_col, item_text_col, window)
    # Texts without hits pass as they are, null texts among them.
    mark = found.withColumn("whole", F.when(F.size("hits") == 0, F.struct("text")))
    cut = mark.select("text", "hits", *[f"c{i}" for i in range(len(rest))], "whole")
    schema = cut.drop("hits").schema
    cut = cut.mapInArrow(freeing(_cut), schema)
    return cut.select(*[
        F.when(F.col("whole").isNotNull(), F.col("whole.text")).otherwise(F.col("text")).alias(c)
        if c == text_col else F.col(f"c{rest.index(c)}").alias(c) for c in columns])


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """Per document: its words, those that benchmark passages cover, and the items found."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["high"] - x["low"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))
