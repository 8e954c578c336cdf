"""Written tables that cut lineage, and session settings of the operators."""

from __future__ import annotations

import ctypes
import sys
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.session import configure, shared_dir

# A batch holds this many rows on its way to Python; long texts are cut into runs
# of whole rows again (words.runs), so a batch costs its text and little more.
BATCH_ROWS = 1000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def folder(spark: SparkSession, kind: str) -> str:
    """A new folder that all executors reach."""
    return f"{shared_dir(spark)}/quotelake-llm/{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str, clean: bool = False) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, safe from
    the loss of an executor. ``clean`` removes the shuffle files of the write at its end;
    otherwise they stay until the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = folder(spark, kind)
    before = spark.conf.get(CLEANUP, "false")
    if clean:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if clean:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def freeing(function):
    """A batch function that gives unused memory back when its task ends: Python workers wait
    for their next task beside those that run, and share an executor's memory with them."""
    def batches_of(batches):
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            # Looked up here: the function is sent to the workers with what it refers to.
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
            if trim:
                trim(0)
    return batches_of


def row_key(id_col: str, text_col: str):
    """Key of a row: rows of equal id and text share it, for they share their result."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
