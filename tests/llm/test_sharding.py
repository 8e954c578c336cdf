import collections
import zlib

from common import SF, clashing, empty, odd  # noqa: F401
from pyspark.sql import functions as F
from quotelake.llm import sharding as op


def _check(rows, docs, shards):
    got = sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows)
    body = [((t or "").encode(), i) for i, t in docs]
    assert got == sorted((str(i), len(t) + 1, zlib.crc32(t)) for t, i in body)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(own, key=lambda r: r.slot)]
        assert order == sorted(order)
    return {k: sum(r.size for r in v) for k, v in by.items()}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op.op9_kd_shards(spark, SF).collect()
    bytes_ = _check(rows, docs, 8)
    largest = max(r.size for r in rows)
    assert len(bytes_) == 8 and max(bytes_.values()) - min(bytes_.values()) <= 2 * largest
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    texts = dict(docs)
    homes = collections.defaultdict(set)
    for r in rows:
        homes[texts[r.doc_id]].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_near_equal_bytes_copies_together_hot_text_split(spark):
    rows = [(i, f"text {i} " + "x" * (i % 90), f"s{i % 5}") for i in range(3000)]
    rows += [(5000 + i, "copy", "s9") for i in range(9)] + [(6000 + i, "hot " * 20, "s1") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    dims = {"length": F.length("text").cast("double"), "source": op.ordinal("source")}
    for n in (3, 8):
        found = op.kd_shards(df, dims, n_shards=n).collect()
        bytes_ = _check(found, [(i, t) for i, t, _ in rows], n)
        mean = sum(bytes_.values()) / n
        assert all(abs(b - mean) < 0.02 * mean for b in bytes_.values()) and len(bytes_) == n
        assert len({r.shard for r in found if 5000 <= r.doc_id < 6000}) == 1
    by_bytes = op.kd_shards(df, dims, target_bytes=40_000).collect()
    assert len({r.shard for r in by_bytes}) == -(-sum(r.size for r in by_bytes) // 40_000)


def _plain_tree(units, shards):
    """A k-d tree by sorting; units: (values, tie, weight, name). Shard -> names."""
    extent = [max(u[0][d] for u in units) - min(u[0][d] for u in units) or 1.0 for d in range(len(units[0][0]))]

    def split(own, k):
        if k == 1:
            return [[u[3] for u in own]]
        width = [(max(u[0][d] for u in own) - min(u[0][d] for u in own)) / e for d, e in enumerate(extent)]
        dim = max(range(len(width)), key=lambda d: width[d])
        own = sorted(own, key=lambda u: (u[0][dim], u[1]))
        goal, below, at = sum(u[2] for u in own) * (k // 2) / k, 0, 0
        while below + own[at][2] / 2 <= goal:
            below += own[at][2]
            at += 1
        return split(own[:at], k // 2) + split(own[at:], k - k // 2)

    return split(units, shards)


def test_plain_tree(spark):
    rows = [(i, f"{i} " + "x" * (i * 37 % 190), f"s{i * i % 7}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({
        "length": F.length("text").cast("double"), "origin": op.ordinal("source")})
    dims = {"length": F.col("length"), "origin": F.col("origin")}
    units = [((r.length, r.origin), r.tie, r.size + 1, r.doc_id) for r in df.select(
        "doc_id", "length", "origin", F.xxhash64("text").alias("tie"), F.octet_length("text").alias("size")).collect()]
    for n in (2, 5, 8):
        plain = {i: shard for shard, own in enumerate(_plain_tree(units, n)) for i in own}
        found = {r.doc_id: r.shard for r in op.kd_shards(df, dims, n_shards=n).collect()}
        # Cuts are exact to TOLERANCE of a shard.
        assert sum(plain[i] == found[i] for i in plain) >= 0.99 * len(plain)


def test_copies_stay_together_up_to_a_shard(spark):
    hot = [(5000 + i, f"copied {i % 5} " * (20 + i % 5), "s1") for i in range(2000)]
    rows = hot + [(i, f"text {i} " + "y" * (i % 250), f"s{i % 3}") for i in range(6000)]
    rows += [(9000 + i, None, None) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = op.kd_shards(df, {"source": op.ordinal("source")}, n_shards=8).collect()
    bytes_ = _check(found, [(i, t) for i, t, _ in rows], 8)
    mean = sum(bytes_.values()) / 8
    assert all(abs(b - mean) < 0.02 * mean for b in bytes_.values()) and len(bytes_) == 8
    homes = collections.defaultdict(set)
    for r in found:
        homes[r.text_crc32].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_odd_rows(spark, clashing):
    dims = {"length": F.length("text"), "lang": op.ordinal("lang"), "source": op.ordinal("source")}
    rows = op.kd_shards(clashing, dims, n_shards=4).collect()
    _check(rows, [(r.doc_id, r.text) for r in clashing.collect()], 4)
    assert op.kd_shards(empty(clashing), dims, n_shards=8).count() == 0
    same = spark.createDataFrame([(1, "a", "x")] * 50, "doc_id long, text string, lang string")
    assert len(op.kd_shards(same, {"lang": op.ordinal("lang")}, n_shards=4).collect()) == 50
