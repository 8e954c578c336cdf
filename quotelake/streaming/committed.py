"""What a stream over files has finished, read from its checkpoint.

A batch is finished once it has a file under ``commits``; its rows are in the sink by then.
``offsets`` says up to which entry of the source's own log it went, and that log
(``sources/0``, compacted from time to time) names the files of each entry.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.sources import files

NOTHING = -1


def _number(name: str) -> int | None:
    base = name.rsplit("/", 1)[-1].removesuffix(".compact")
    return int(base) if base.isdigit() else None


def finished_entry(spark: SparkSession, checkpoint: str) -> int:
    """Last entry of the source's log that a finished batch has read; ``NOTHING`` before the first."""
    done = [n for n in map(_number, files.names(spark, f"{checkpoint}/commits/*")) if n is not None]
    if not done:
        return NOTHING
    # A version, the batch's clocks, then a line for each source.
    source = files.read_text(spark, f"{checkpoint}/offsets/{max(done)}").splitlines()[2]
    return NOTHING if source == "-" else json.loads(source)["logOffset"]


def plain_path(path: str) -> Column:
    """A column of paths in one spelling: ``file:/x`` and ``file:///x`` are the same file."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def read_files(spark: SparkSession, checkpoint: str, after: int, upto: int) -> DataFrame:
    """Files of the log's entries after one and up to another: (path, entry); see ``plain_path``."""
    logs = {name: _number(name) for name in files.names(spark, f"{checkpoint}/sources/0/*")}
    logs = {name: n for name, n in logs.items() if n is not None}
    whole = max((n for name, n in logs.items() if name.endswith(".compact")), default=NOTHING)
    wanted = [name for name, n in logs.items() if n > whole or n == whole and name.endswith(".compact")]
    if not wanted:
        return spark.createDataFrame([], "path string, entry long")
    line = F.from_json("value", "path string, batchId long")
    return (spark.read.text(wanted).select(line.alias("line"))
            .select(plain_path("line.path").alias("path"), F.col("line.batchId").alias("entry"))
            .where(F.col("path").isNotNull() & (F.col("entry") > after) & (F.col("entry") <= upto)).distinct())
