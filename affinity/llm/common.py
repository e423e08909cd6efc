"""Helpers of the operators: shared-folder tables, bounded broadcasts, folds."""

from __future__ import annotations

import math
import threading
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_dir, shared_dir

#: Rows of one Arrow batch handed to a Python worker (long texts make rows large).
ARROW_ROWS = 512


def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the Arrow batches of a session that left the default of 10,000 rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


#: Spark's setting that removes a query's shuffle files when it has ended.
_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_open = threading.local()


@contextmanager
def scratch(spark: SparkSession):
    """Tables ``saved`` inside are removed at the end, but for those to keep."""
    before, _open.paths = getattr(_open, "paths", None), []
    try:
        yield
    finally:
        paths, _open.paths = _open.paths, before
        for path in paths:
            remove_dir(spark, path)


def saved(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Several branches then read one computed table, and a lost executor costs
    a re-read of shared files only.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    if not keep and getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    # the shuffles of this write are read by it alone
    before = spark.conf.get(_CLEAN_SHUFFLES, "false")
    spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(rows: int, per_bucket: int) -> int:
    return max(1, math.ceil(rows / per_bucket))


def held_out(doc_id: Column) -> Column:
    """True for the fold no model may learn from: crc32(text of id) mod 5 = 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
