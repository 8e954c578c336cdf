"""Similarity join on word n-grams: MinHash candidates, Bayesian pruning, exact check.

1. Texts that are equal become one node, the smallest id of them.
2. Each node gets ``BANDS * ROWS`` MinHash values. Nodes that agree on all values of a band
   share a bucket; at a similarity of 0.8 a pair shares none with probability 3e-6.
3. In a bucket the values of a pair are compared ``STEP`` at a time. With m of n equal, the
   posterior of the similarity (uniform prior) is Beta(m + 1, n - m + 1); a pair goes as
   soon as the probability that it reaches the threshold is below ``TOLERANCE``.
4. What survives connects nodes to components, whose shingle sets then meet, and every pair
   in a component is checked exactly, whether it was a candidate or not.

Buckets and components of more than ``BLOCK`` nodes are cut into blocks, and each pair of
blocks is a group of its own, so the largest group is bounded by a parameter and no link is
dropped. Pairs never leave a group: it returns links per node and a spanning forest.

Defined results: a text of one to four words is one shingle; a text without words has no
links, but equal ones are copies; a null text is a class of its own; rows with one id are
one document. Ids are integers; a null id is left out.
"""

from __future__ import annotations

from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.components import components
from quotelake.llm.store import freeing, prepared, stored

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
BANDS, ROWS = 24, 4
STEP = 16
TOLERANCE = 1e-6
BLOCK = 512
PAIRS = 1 << 19             # compared at once in a task

_FACTORS = W.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_TERMS = W.mix(np.arange(1001, BANDS * ROWS + 1001, dtype=np.uint64))


def least_matches(step: int = STEP, total: int = BANDS * ROWS, threshold: Fraction = THRESHOLD,
                  tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n values: the fewest matches with which P(similarity >= threshold) is not below
    the tolerance. That tail of Beta(m + 1, n - m + 1) is P(Binomial(n + 1, threshold) <= m)."""
    found, t = {}, float(threshold)
    for n in range(step, total + 1, step):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if tail >= tolerance:
                found[n] = m
                break
    return found


def shingles(run: W.Run, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of a run's texts, and bounds per text."""
    words = W.words_of(run)
    grams = W.gram_hashes(words, size)
    valid = W.gram_valid(words, size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        sums = W.prefix_sums(words.hash)
        first = words.bounds[short]
        grams[first] = W.span_hash(sums, first, words.bounds[short + 1])
        valid[first] = True
    sums = np.r_[0, np.cumsum(valid)]
    return grams[valid], sums[words.bounds]


def _signatures(batches):
    for batch in batches:
        for run in W.runs(batch.column(1)):
            grams, bounds = shingles(run)
            some = np.flatnonzero(np.diff(bounds))
            low = np.empty((len(some), BANDS * ROWS), np.uint64)
            for k in range(BANDS * ROWS):
                values = grams * _FACTORS[k] + _TERMS[k]
                values >>= np.uint64(24)
                if len(some):
                    low[:, k] = np.minimum.reduceat(values, bounds[some])
            sums = np.zeros((len(some), BANDS), np.uint64)
            for k in range(ROWS):
                sums = W.mix(sums ^ low[:, k::ROWS])
            bands: list = [None] * run.count
            values: list = [None] * run.count
            # A byte of each value is compared; equal values have equal bytes.
            bytes_ = W.mix(low).astype(np.uint8)
            for i, t in enumerate(some.tolist()):
                bands[t] = sums[i].view(np.int64)
                values[t] = bytes_[i].tobytes()
            sums = W.prefix_sums(W._BYTE_VALUES[run.data])
            own = W.span_hash(sums, run.offsets[:-1], run.offsets[1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(run.first, run.count), batch.column(2).slice(run.first, run.count),
                 pa.array(own), pa.array(bands, pa.list_(pa.int64())), pa.array(values, pa.binary())],
                names=["id", "x", "y", "bands", "sig"])


def _groups(batches, keys: int):
    """Tables of whole groups: rows come sorted by the first ``keys`` columns."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None and held.num_rows:
            table = pa.concat_tables([held, table]).combine_chunks()
        columns = [np.asarray(table.column(k)) for k in range(keys)]
        new = np.zeros(table.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new)
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield table.slice(0, last), np.r_[0, cuts]
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest one that the edges connect it with."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root


def _survivors(sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of lines stay likely enough to reach the threshold."""
    live, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, least in least_matches().items():
        part = slice(n - STEP, n)
        matches = matches + (sig[a[live], part] == sig[b[live], part]).sum(1)
        stay = matches >= least
        live, matches = live[stay], matches[stay]
        if not len(live):
            break
    return live


def _pairs(sizes: np.ndarray, first: np.ndarray, sides: np.ndarray, cross: np.ndarray):
    """Pairs of rows of consecutive groups: all of a group, or those across its two sides."""
    rows = np.arange(int(sizes.sum())) + first[0]
    end = np.repeat(first + sizes, sizes)
    count = end - rows - 1
    a = np.repeat(rows, count)
    b = a + 1 + (np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count))
    across = np.repeat(np.repeat(cross, sizes), count)
    keep = ~across | (sides[a] != sides[b])
    return a[keep], b[keep]


def _prune(batches):
    """Rows (bucket, i, j, side, id, sig) by bucket and pair of blocks -> edges."""
    for table, cuts in _groups(batches, 3):
        ids = np.asarray(table.column("id"))
        sides = np.asarray(table.column("side"))
        cross = np.asarray(table.column("i")) != np.asarray(table.column("j"))
        body = table.column("sig").combine_chunks()
        sig = np.frombuffer(b"".join(body.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
        sizes = np.diff(cuts)
        total = np.cumsum(sizes * (sizes - 1) // 2)
        at = 0
        while at < len(sizes):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + PAIRS, "right")))
            a, b = _pairs(sizes[at:to], cuts[at:to], sides, cross[cuts[at:to]])
            live = _survivors(sig, a, b)
            root = _roots(len(ids), a[live], b[live])
            moved = np.flatnonzero(root != np.arange(len(ids)))
            # Copies of a row in other groups are other lines; ids bring them together.
            yield pa.RecordBatch.from_pydict({"a": ids[moved], "b": ids[root[moved]]})
            at = to


def _sets(batches):
    """Adds the sorted distinct shingles of each text, as bytes."""
    for batch in batches:
        sets: list = []
        for run in W.runs(batch.column(0)):
            grams, bounds = shingles(run)
            text = np.repeat(np.arange(run.count), np.diff(bounds))
            order = np.lexsort((grams, text))
            grams, text = grams[order], text[order]
            new = np.ones(len(grams), bool)
            new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
            grams, text = grams[new], text[new]
            edges = np.searchsorted(text, np.arange(run.count + 1))
            sets += [grams[x:y].tobytes() for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sets, pa.binary())],
                                         names=[*batch.schema.names[1:], "shingles"])


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    number = np.cumsum(new) - 1
    shared = np.bincount(number) > 1
    keep = shared[number]
    column = (np.cumsum(shared) - 1)[number[keep]]
    owner = owner[keep]
    out = np.zeros((n, n), np.float32)
    width = max(256, (1 << 22) // n)
    for start in range(0, int(shared.sum()), width):
        part = slice(*np.searchsorted(column, (start, start + width)))
        lines = np.zeros((n, width), np.float32)
        lines[owner[part], column[part] - start] = 1
        out += lines @ lines.T
    return out.astype(np.int64)


def _verify(batches):
    """Rows (comp, i, j, side, id, shingles) by component and pair of blocks -> links and
    root of each id in its group."""
    t = THRESHOLD
    for table, cuts in _groups(batches, 3):
        out: dict[str, list] = {"id": [], "links": [], "root": []}
        ids = np.asarray(table.column("id"))
        sides = np.asarray(table.column("side"))
        cross = np.asarray(table.column("i")) != np.asarray(table.column("j"))
        body = table.column("shingles")
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if high - low < 2:
                continue
            # Repeated rows are one line here.
            lines = {(ids[k], body[k].as_py()): k for k in range(low, high)}
            own, side = (x[list(lines.values())] for x in (ids, sides))
            sets = [np.frombuffer(x, np.uint64) for _, x in lines]
            both = _overlaps(sets)
            sizes = np.array([len(s) for s in sets])
            union = sizes[:, None] + sizes[None, :] - both
            linked = both * t.denominator >= union * t.numerator
            linked &= own[:, None] != own[None, :]
            if cross[low]:
                linked &= side[:, None] != side[None, :]
            a, b = np.nonzero(np.triu(linked))
            out["id"].append(own)
            out["links"].append(linked.sum(1))
            out["root"].append(own[_roots(len(own), a, b)])
        if out["id"]:
            yield pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in out.items()})


def _blocked(rows: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """Rows with the pairs of blocks (i <= j) of their group that they take part in."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.join(sizes.select(group, blocks.alias("blocks")), group)
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int")
    rows = rows.withColumn("side", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with an id: id, class_id (smallest id that links and copies
    connect it with), text_id (smallest id with this very text), n_copies (rows with this
    text) and n_links (other texts that reach the threshold with this one)."""
    prepared(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text")).where("id is not null")
    signed = stored(rows.where("text is not null").select("id", "text", F.xxhash64("text").alias("x"))
                    .mapInArrow(freeing(_signatures), "id long, x long, y long, bands array<bigint>, sig binary"),
                    "signatures")
    heads = stored(signed.groupBy("x", "y").agg(F.min("id").alias("head"), F.count("*").alias("n_copies")),
                   "heads")
    nodes = stored(signed.join(heads, ["x", "y"]).where("id = head and sig is not null")
                   .select("id", "bands", "sig").dropDuplicates(["id", "sig"]), "nodes")
    bands = nodes.select("id", F.posexplode("bands").alias("band", "value")).select(
        "id", F.xxhash64("band", "value").alias("bucket"))
    sizes = stored(bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = _blocked(bands, "bucket", sizes).select("bucket", "i", "j", "side", "id")
    edges = (members.join(nodes.select("id", "sig"), "id")
             .select("bucket", "i", "j", "side", "id", "sig")
             .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
             .mapInArrow(freeing(_prune), "a long, b long").distinct())
    groups = stored(components(edges), "candidates")
    sizes = stored(groups.groupBy("root").agg(F.count("*").alias("n")), "sizes")
    blocks = _blocked(groups, "root", sizes).select(F.col("root").alias("comp"), "i", "j", "side", "id")
    tasks = (blocks.groupBy("id", "comp", "side")
             .agg(F.collect_list(F.struct("i", "j")).alias("tasks")))
    shingled = (rows.where("text is not null").join(tasks, "id")
                .select("text", "comp", "side", "id", "tasks")
                .mapInArrow(freeing(_sets), "comp long, side int, id long, tasks array<struct<i:int,j:int>>, "
                                   "shingles binary"))
    checked = stored(
        shingled.select("comp", F.explode("tasks").alias("t"), "side", "id", "shingles")
        .select("comp", "t.i", "t.j", "side", "id", "shingles")
        .repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
        .mapInArrow(freeing(_verify), "id long, links long, root long"), "checked")
    links = checked.groupBy("id").agg(F.sum("links").alias("n_links"))
    roots = components(checked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = stored(links.join(roots, "id", "left").select(
        F.col("id").alias("head"), "n_links", F.coalesce("root", "id").alias("class_id")), "classes")
    found = (signed.select("id", "x", "y").join(heads, ["x", "y"])
             .join(classes, "head", "left")
             .select("id", F.coalesce("class_id", "head").alias("class_id"),
                     F.col("head").alias("text_id"), "n_copies",
                     F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
    lone = rows.where("text is null").select(
        "id", F.col("id").alias("class_id"), F.col("id").alias("text_id"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(lone)


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class; rows without an id stay."""
    found = near_duplicates(docs, id_col, text_col)
    gone = found.where("id <> class_id").select(F.col("id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def op2_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Per document: its class, its text's first document, its copies and its links."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).withColumnRenamed("id", "doc_id")
