"""Quality rules: limits on a text's own counts, then robust multivariate outliers.

The counts are column expressions over the whole text. Repeated words are found by sorting
the hashes of a text's three-word windows inside its row, so no word is shuffled; windows
are taken for equal only if their words are.

Outliers: per language and source the minimum-covariance-determinant estimate of the mean
and covariance of transformed counts, reached by concentration steps from four starts: keep
the share ``H`` of a group's rows with the smallest Mahalanobis distances, estimate again from
those, until the determinant stops falling. The start that ends with the smallest determinant
counts, and the rows within ``NEAR`` of it give the estimate. Rows of equal counts weigh once,
so copies of a text do not make it ordinary, and other junk may be just under half of a group.
A row beyond ``CUTOFF`` from the centre of its group is rejected. Every step aggregates a narrow
table of all different rows that pass the limits, combining a group of any size before it is
shuffled. Groups of fewer than ``LEAST`` different rows are put together per language, and what
is fewer still over all languages. Only DataFrame operations are used.

Defined results: a null text has no words and fails the limits; null languages and sources
are values of their own; floors on the deviations keep rows that differ little from a group
whose counts hardly vary, for shares their sampling error; equal rows get the same verdict;
rows of a group without an estimate have no distance and are kept if they pass the limits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.store import prepared, stored

LEAST_WORDS = 50
MOST_REPEATED = 50          # per cent of the words
H = 0.5                     # share of a group that a determinant is made from
SPREAD = 1.91               # what that share of a five-dimensional normal law lacks in variance
FALL = 1e-3                 # a logarithm of a determinant that falls by less has stopped
NEAR = 12.83                # squared distance that one row in 40 of that law exceeds
NEAR_SPREAD = 1.06          # what the others lack in variance
LEAST = 100                 # different rows that a group needs for an estimate of its own
CUTOFF = 25.74              # squared distance that one row in 10,000 of that law exceeds
BROADCAST_GROUPS = 20_000   # rows of about 200 bytes
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Transformed counts, and the smallest deviation that each is measured by.
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats")
# The symbols' is the sampling error of the root of a share of 200 characters, which the
# shortest texts have; that of repeats follows the texts' own words, see _error.
FLOORS = (0.7, 0.6, 0.035, 0.35, 0.0)

_PLACE = (1 << 26) - 1      # bits of a window's place; its hash has the others
_DIM = range(len(FEATURES))


def _behind(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a generator: their values are made once, also where a lambda
    refers to them for each element."""
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", made.alias("__made")).select(
        *[c for c in df.columns if c not in columns],
        *[F.col(f"__made.{n}").alias(n) for n in columns])


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COUNTS`` (long); input columns of these names are
    replaced."""
    rest = [c for c in docs.columns if c not in COUNTS]
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.col(f"`{text_col}`").alias("text"),
                     F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    df = _behind(df, w=F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.select(
        "row", "w", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    def same(x: Column, y: Column) -> Column:
        """Whether the windows of two entries are equal; false beyond either end."""
        i, j = ((v.bitwiseAND(F.lit(_PLACE))).cast("int") for v in (x, y))
        words = [F.get("w", i + k) == F.get("w", j + k) for k in range(3)]
        return F.coalesce((F.shiftright(x, 26) == F.shiftright(y, 26))
                          & words[0] & words[1] & words[2], F.lit(False))

    df = _behind(df, s=F.sort_array(F.transform(
        F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))
        .bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")))))
    df = _behind(df, s=F.sort_array(F.transform(
        F.filter("s", lambda x, i: same(x, F.get("s", i + 1)) | same(x, F.get("s", i - 1))),
        lambda x: x.bitwiseAND(F.lit(_PLACE)))))
    # Sorted places of windows that come twice: each adds the words not yet covered.
    covered = F.aggregate(
        "s", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct((a["n"] + x + 3 - F.greatest(a["end"], x)).alias("n"),
                              (x + 3).alias("end")), lambda a: a["n"])
    return df.select(*[F.col("row").getField(c).alias(c) for c in rest],
                     *COUNTS[:4], covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def _features() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    made = (F.log(words), chars / words, F.sqrt(F.col("n_symbols") / chars),
            F.log1p(F.col("n_dup_lines").cast("double")), F.col("n_repeat_words") / words)
    return [c.alias(name) for c, name in zip(made, FEATURES)]


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its group's estimate."""
    total = F.lit(0.0)
    for i in _DIM:
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"u{i}{j}") * (F.col(FEATURES[j]) - F.col(f"m{j}"))
        if i == _DIM[-1]:
            # The estimate has the error of its mean row; a shorter text has more.
            more = F.greatest(_error() - F.col("error"), F.lit(0.0))
            total = total + z * z / (1 + more * F.col(f"u{i}{i}") * F.col(f"u{i}{i}"))
        else:
            total = total + z * z
    return total


def _error() -> Column:
    """Greatest sampling variance of a share of a text's words that come by windows of three:
    that of repeats, which are last."""
    return 0.75 * F.exp(-F.col("log_words"))


def _whitened(moments: DataFrame) -> DataFrame:
    """Per group the centre m, the inverse u of the Cholesky factor of the covariance, and
    the logarithm ``size`` of its determinant."""
    # Cells that need no other of their step are made together, in one projection.
    df = moments.withColumns({
        f"c{i}{i}": F.col(f"c{i}{i}") + FLOORS[i] ** 2
        + (F.col("error") if i == _DIM[-1] else F.lit(0.0)) for i in _DIM})
    for j in _DIM:
        for cells in ([j], range(j + 1, len(_DIM))):
            made = {}
            for i in cells:
                rest = F.col(f"c{i}{j}")
                for k in range(j):
                    rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
                made[f"l{i}{j}"] = (F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j
                                    else rest / F.col(f"l{j}{j}"))
            df = df.withColumns(made) if made else df
    df = df.withColumns({f"u{i}{i}": 1 / F.col(f"l{i}{i}") for i in _DIM})
    for below in _DIM[1:]:
        made = {}
        for i in _DIM[below:]:
            u = F.lit(0.0)
            for k in range(i - below, i):
                u = u - F.col(f"l{i}{k}") * F.col(f"u{k}{i - below}")
            made[f"u{i}{i - below}"] = u / F.col(f"l{i}{i}")
        df = df.withColumns(made)
    size = F.lit(0.0)
    for i in _DIM:
        size = size + 2 * F.log(F.col(f"l{i}{i}"))
    return df.select(*[c for c in ("grp", "start") if c in moments.columns], size.alias("size"), "error",
                     *[f"m{i}" for i in _DIM], *[f"u{i}{j}" for i in _DIM for j in range(i + 1)])


def _moments(rows: DataFrame, spread: float, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        *[F.avg(FEATURES[i]).alias(f"m{i}") for i in _DIM],
        *[(spread * F.covar_pop(FEATURES[i], FEATURES[j])).alias(f"c{i}{j}")
          for i in _DIM for j in range(i + 1)], F.avg(_error()).alias("error"))


def _small(groups: DataFrame, kind: str) -> DataFrame:
    """One row per group, written and counted. Up to ``BROADCAST_GROUPS`` they are broadcast,
    so rows are not dealt by group to be joined; beyond that Spark joins two plain exchanges
    and can split a group that holds much of the rows."""
    groups = stored(groups, kind)
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def _starts(rows: DataFrame) -> DataFrame:
    """Four centres per group: medians, middles of the shortest halves, and both quartiles;
    deviations are those of a normal law whose half is as short."""
    twentieths = F.array(*[F.lit(k / 20) for k in range(21)])
    parts = rows.groupBy("grp").agg(*[
        F.percentile_approx(name, twentieths, 10000).alias(f"q{i}") for i, name in enumerate(FEATURES)],
        F.avg(_error()).alias("error"))

    def half(q: str) -> Column:
        return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(10)), lambda k: F.struct(
            (F.get(q, k + 10) - F.get(q, k)).alias("length"),
            ((F.get(q, k + 10) + F.get(q, k)) / 2).alias("middle"))))

    parts = parts.select("grp", "error", *[f"q{i}" for i in _DIM], *[half(f"q{i}").alias(f"h{i}") for i in _DIM])
    centres = [[F.get(f"q{i}", F.lit(10)) for i in _DIM], [F.col(f"h{i}.middle") for i in _DIM],
               [F.get(f"q{i}", F.lit(5)) for i in _DIM], [F.get(f"q{i}", F.lit(15)) for i in _DIM]]
    starts = F.array(*[F.struct(F.lit(k).alias("start"), *[m.alias(f"m{i}") for i, m in enumerate(centre)])
                       for k, centre in enumerate(centres)])
    return parts.select("grp", "error", *[f"h{i}" for i in _DIM], F.explode(starts).alias("s")).select(
        "grp", "error", "s.*", *[(F.pow(F.col(f"h{i}.length") / 1.349, F.lit(2)) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
                        for i in _DIM for j in range(i + 1)])


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimate per ``grp`` of rows with FEATURES."""
    state = stored(_whitened(_starts(rows)).withColumn("size", F.lit(float("inf")))
                   .withColumn("done", F.lit(False)), "estimates")
    # As in _small, but groups do not become more from one step to the next.
    held = F.broadcast if state.count() <= BROADCAST_GROUPS else (lambda groups: groups)
    ended = []
    while not state.where("not done").isEmpty():
        before = state.where("not done").drop("done")
        apart = rows.join(held(before), "grp").select(
            "grp", "start", F.col("size").alias("before"), *FEATURES, _distance().alias("d"))
        near = apart.groupBy("grp", "start").agg(F.percentile_approx("d", H, 10000).alias("most"))
        after = _whitened(_moments(apart.join(held(near), ["grp", "start"]).where("d <= most"),
                                   SPREAD, "grp", "start"))
        sizes = before.select("grp", "start", F.col("size").alias("before"))
        state = stored(after.join(held(sizes), ["grp", "start"]).withColumn(
            "done", F.col("size") > F.col("before") - FALL).drop("before"), "estimates")
        ended.append(state.where("done").drop("done"))
    if not ended:
        return state.drop("start", "done")
    estimates = reduce(DataFrame.unionByName, ended)
    names = [c for c in estimates.columns if c != "grp"]
    best = _small(estimates.groupBy("grp").agg(
        F.min(F.struct("size", "start", *names[2:])).alias("e")).select("grp", "e.*").drop("start"), "estimates")
    apart = rows.join(best, "grp").select("grp", *FEATURES, _distance().alias("d"))
    return _small(_whitened(_moments(apart.where(F.col("d") <= NEAR), NEAR_SPREAD, "grp")), "estimates")


def _assigned(rows: DataFrame) -> DataFrame:
    """Rows with ``grp``, the group whose estimate judges them."""
    unlike = stored(rows.select("pair", "lang", *FEATURES).distinct(), "unlike")
    pairs = _small(unlike.groupBy("pair").count().where(F.col("count") >= LEAST).select("pair"), "pairs")
    langs = _small(unlike.join(pairs, "pair", "left_anti").select("lang", *FEATURES).distinct()
                   .groupBy("lang").count().where(F.col("count") >= LEAST).select("lang"), "langs")
    own = rows.join(pairs, "pair", "left_semi").withColumn("grp", F.col("pair"))
    others = rows.join(pairs, "pair", "left_anti")
    return (own
            .unionByName(others.join(langs, "lang", "left_semi").withColumn("grp", F.col("lang")))
            .unionByName(others.join(langs, "lang", "left_anti")
                         .withColumn("grp", F.lit(0).cast("long"))))


def _group_key(*cols: str) -> Column:
    """Hash of values, nulls included, and of how many they are."""
    values = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])
    return F.xxhash64(F.lit(len(cols)), F.to_json(values, {"ignoreNullFields": "false"}))


def verdicts(docs: DataFrame, keys: dict[str, Column], text_col: str = "text",
             lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: the ``keys`` (name -> expression over docs), COUNTS,
    base_failed, distance (squared; null where base_failed or no estimate) and kept."""
    prepared(docs.sparkSession)
    keyed = docs.select(
        F.struct(*[c.alias(n) for n, c in keys.items()]).alias("key"),
        F.col(f"`{text_col}`").alias("text"),
        _group_key(lang_col).alias("lang"), _group_key(lang_col, source_col).alias("pair"))
    counted = with_counts(keyed).drop("text").withColumn("base_failed", base_failed())
    counted = stored(counted.select("*", *_features()), "counts")
    rows = stored(_assigned(counted.where("not base_failed")), "grouped")
    estimate = robust_estimates(stored(rows.select("grp", *FEATURES).distinct(), "unlike"))
    far = rows.join(estimate, "grp", "left").select("key", *COUNTS, "base_failed",
                                                    _distance().alias("distance"))
    failed = counted.where("base_failed").select(
        "key", *COUNTS, "base_failed", F.lit(None).cast("double").alias("distance"))
    return (far.unionByName(failed)
            .select("key.*", *COUNTS, "base_failed", "distance",
                    (~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)))
                    .alias("kept")))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass all rules, unchanged."""
    key = F.xxhash64(*[F.col(f"`{c}`") for c in (id_col, text_col, lang_col, source_col)])
    gone = verdicts(docs, {"__rk": key}, text_col, lang_col, source_col).where("not kept")
    return (docs.withColumn("__rk", key).join(gone.select("__rk").distinct(), "__rk", "left_anti")
            .drop("__rk"))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Per document: its counts, whether they fail the limits, and the verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return verdicts(docs, {"doc_id": F.col("doc_id")})
