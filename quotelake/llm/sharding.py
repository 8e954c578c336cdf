"""Shards by a k-d tree over document metadata.

A node of the tree holds some documents and the number of shards to make of them. It is
split along its widest dimension, width being its range by that of the whole table, at the
weighted quantile that gives each side bytes for its number of shards (the median, for an
even number), until a node is one shard. All nodes of a level are split together.

Weighted quantiles are exact to ``TOLERANCE`` of a shard: bytes are summed in ``BINS`` equal
bins of each node's range, the bin that holds the quantile becomes the range, and where one
value holds too much, the unit's hash goes on as a further dimension. The driver sees one
line per node and bin, a bounded number; documents are only ever aggregated.

A unit is all documents of one text, with the metadata of the first of them, so that copies
stay in one shard. Units of more than ``HEAVY`` of a shard would make a cut uneven: they are
placed first, the largest into the emptiest shard, and the tree shares the other units out by
the room that is left. Only a text whose copies are more than a whole shard is split into its
documents.

Defined results: a document weighs the UTF-8 bytes of its text plus one; a null text weighs
one; null metadata comes before all values; slots follow the ids, null first, and equal ids
the text's checksum.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.llm.store import prepared, stored

BINS = 512                  # of a node, fewer where nodes are many
DRIVER_ROWS = 1 << 18       # bins of all nodes that the driver sees at once, 8 a node at least
TOLERANCE = 0.0005
HEAVY = 0.01
MOST_SHARDS = 100_000


def ordinal(column: str) -> Column:
    """A number in the order of the first six bytes of a string; null is before all."""
    head = F.rpad(F.substring(F.hex(F.col(f"`{column}`")), 1, 12), 12, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(-1.0))


def _weighted(docs: DataFrame, dimensions: Mapping[str, Column], id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(f"`{text_col}`").alias("copies"),
        *[F.coalesce(c.cast("double"), F.lit(-1.0)).alias(f"d{i}") for i, c in enumerate(dimensions.values())])


def _units(rows: DataFrame, dims: list[str], most: float) -> tuple[DataFrame, DataFrame]:
    """Rows with their unit, and the units with metadata and weight; texts of more than
    ``most`` bytes are split into their documents."""
    groups = stored(rows.groupBy("copies").agg(
        F.sum("size").alias("w"),
        F.min(F.struct(F.col("doc_id").isNotNull().alias("n"), "doc_id", *dims)).alias("head")), "copies")
    large = groups.where(F.col("w") > most).select("copies")
    alone = F.xxhash64("copies", "doc_id")
    rows = stored(rows.join(large.withColumn("large", F.lit(True)), "copies", "left")
                  .withColumn("unit", F.when(F.col("large"), alone).otherwise(F.col("copies")))
                  .drop("large", "copies"), "rows")
    light = groups.where(F.col("w") <= most).select(
        F.col("copies").alias("unit"), *[F.col(f"head.{d}").alias(d) for d in dims], "w")
    single = rows.join(light.select("unit"), "unit", "left_anti").groupBy("unit").agg(
        *[F.min(d).alias(d) for d in dims], F.sum("size").alias("w"))
    return rows, light.unionByName(single)


def _packed(units: list, n: int, share: float) -> tuple[dict[int, int], list[float]]:
    """The shard of each (unit, weight), the heaviest first into the emptiest, and the room
    that is left in each shard."""
    loads = [(0, shard) for shard in range(n)]
    placed = {}
    for unit, weight in sorted(units, key=lambda u: (-u[1], u[0])):
        load, shard = loads[0]
        placed[unit] = shard
        heapq.heapreplace(loads, (load + weight, shard))
    room = [0.0] * n
    for load, shard in loads:
        room[shard] = max(0.0, share - load)
    return placed, room


class _Cut:
    """The search for one node's cut: a range of one dimension, then of the unit's hash."""

    def __init__(self, node: int, dim: int, low: float, high: float, goal: float, fine: float):
        self.node, self.dim, self.goal, self.fine = node, dim, goal, fine
        self.low, self.high, self.below = low, high, 0.0
        self.value, self.done = None, False     # value: once the hash decides
        self.cut: tuple[float, float] = (high, 1.0)

    def row(self) -> tuple:
        return (self.node, self.dim, self.low, self.high, self.value)

    def narrow(self, bins: list) -> None:
        """Takes the bin in which the goal lies. bins: (weight, least, most), in order."""
        for weight, least, most in bins:
            if self.below + weight >= self.goal or (weight, least, most) == bins[-1]:
                break
            self.below += weight
        self.cut = (most, 1.0) if self.value is None else (self.value, most)
        if weight <= self.fine or (least == most and self.value is not None):
            # The nearer edge of the bin.
            if self.goal - self.below < weight / 2 and self.below > 0:
                before = max((m for _, _, m in bins if m < least), default=None)
                if before is not None:
                    self.cut = (before, 1.0) if self.value is None else (self.value, before)
            self.done = True
        elif least == most:
            self.value, self.low, self.high = least, -1.0, 1.0
        else:
            self.low, self.high = least, most


def _pick(dims: list[str], column: str) -> Column:
    """The dimension that ``column`` numbers."""
    return F.element_at(F.array(*dims), F.col(column) + 1)


def _split(units: DataFrame, dims: list[str], cuts: list[_Cut]) -> DataFrame:
    """Finds the cuts of the nodes and returns the units in their new nodes."""
    spark = units.sparkSession
    while open_cuts := [c for c in cuts if not c.done]:
        ranges = spark.createDataFrame(
            [c.row() for c in open_cuts], "node long, dim int, low double, high double, value double")
        inside = units.join(F.broadcast(ranges), "node").withColumn("v", _pick(dims, "dim"))
        inside = inside.where("value is null or v = value").withColumn(
            "x", F.when(F.col("value").isNull(), F.col("v")).otherwise(F.col("tie")))
        count = max(8, min(BINS, DRIVER_ROWS // len(open_cuts)))
        place = F.least(F.floor((F.col("x") - F.col("low")) / F.greatest(
            F.col("high") - F.col("low"), F.lit(1e-300)) * count), F.lit(count - 1))
        bins = (inside.where("x >= low and x <= high").groupBy("node", place.alias("bin"))
                .agg(F.sum("w").alias("w"), F.min("x").alias("a"), F.max("x").alias("b")).collect())
        by_node: dict[int, list] = {}
        for r in sorted(bins, key=lambda r: r.bin):
            by_node.setdefault(r.node, []).append((r.w, r.a, r.b))
        for cut in open_cuts:
            cut.narrow(by_node[cut.node])
    table = spark.createDataFrame([(c.node, c.dim, *map(float, c.cut)) for c in cuts],
                                  "node long, dim int, at double, tie_at double")
    joined = units.join(F.broadcast(table), "node", "left").withColumn("v", _pick(dims, "dim"))
    right = (F.col("v") > F.col("at")) | ((F.col("v") == F.col("at")) & (F.col("tie") > F.col("tie_at")))
    node = F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + right.cast("long"))
    return stored(joined.withColumn("node", node).select("unit", "node", "tie", "w", *dims), "units")


def kd_shards(docs: DataFrame, dimensions: Mapping[str, Column], n_shards: int | None = None,
              target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard (0..) and slot (0.. in its shard).

    ``dimensions`` names numeric expressions over the documents. Either the number of shards
    is given or the bytes that one should hold."""
    prepared(docs.sparkSession)
    dims = [f"d{i}" for i in range(len(dimensions))]
    rows = stored(_weighted(docs, dimensions, id_col, text_col), "weighted")
    total = rows.agg(F.sum("size")).first()[0] or 0
    n = n_shards or max(1, -(-total // target_bytes))
    if n > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards; raise target_bytes")
    share = total / n
    rows, units = _units(rows, dims, share)
    # At most DRIVER_ROWS units are that heavy.
    heavy = max(HEAVY, n / DRIVER_ROWS) * share
    packed, room = _packed([tuple(r) for r in units.where(F.col("w") > heavy).select("unit", "w").collect()], n, share)
    # The hash of a unit as a number from -1 to 1.
    units = stored(units.where(F.col("w") <= heavy).select(
        "unit", F.lit(1).cast("long").alias("node"), (F.col("unit") / F.lit(float(2 ** 63))).alias("tie"), "w", *dims),
        "units")
    # Node -> its first shard and their number.
    shards = {1: (0, n)}
    extent = None
    while any(k > 1 for _, k in shards.values()):
        stats = units.groupBy("node").agg(
            F.sum("w").alias("w"), *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]).collect()
        if extent is None:
            extent = [max((r[f"max_{d}"] - r[f"min_{d}"] for r in stats), default=0.0) for d in dims]
        cuts, new = [], {}
        by_node = {r.node: r for r in stats}
        for node, (first, k) in shards.items():
            row = by_node.get(node)
            if k == 1 or row is None:
                new[node] = first, k
                continue
            width = [(row[f"max_{d}"] - row[f"min_{d}"]) / (e or 1.0) for d, e in zip(dims, extent)]
            dim = max(range(len(dims)), key=lambda i: width[i])
            half = k // 2
            left, both = sum(room[first:first + half]), sum(room[first:first + k])
            cuts.append(_Cut(node, dim, row[f"min_{dims[dim]}"], row[f"max_{dims[dim]}"],
                             row.w * (left / both if both else half / k), TOLERANCE * share))
            new[2 * node], new[2 * node + 1] = (first, half), (first + half, k - half)
        if not cuts:
            break
        units = _split(units, dims, cuts)
        shards = new
    spark = docs.sparkSession
    names = spark.createDataFrame([(node, first) for node, (first, _) in shards.items()], "node long, shard int")
    heavies = spark.createDataFrame(list(packed.items()), "unit long, shard int")
    homes = units.join(F.broadcast(names), "node").select("unit", "shard").unionByName(heavies)
    placed = rows.join(homes, "unit")
    return _slotted(placed.select("doc_id", "size", "text_crc32", "shard"))


def _slotted(rows: DataFrame) -> DataFrame:
    """Adds slot: ranges of the rows are numbered apart and put one after the other."""
    line = F.monotonically_increasing_id()
    ordered = stored(rows.repartitionByRange("shard", "doc_id")
                     .sortWithinPartitions("shard", "doc_id", "text_crc32").withColumn("line", line)
                     .withColumn("part", F.shiftright("line", 33)), "ordered")
    # A few rows per part.
    parts = ordered.groupBy("part", "shard").agg(F.min("line").alias("low"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
                   .select("part", "shard", "low", "before"), "parts")
    return ordered.join(parts, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("line") - F.col("low") + F.col("before")).alias("slot"))


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    dimensions = {"length": F.log2(F.octet_length("text") + F.lit(1.0)),
                  "source": ordinal("source"), "lang": ordinal("lang")}
    return kd_shards(docs, dimensions, n_shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
