"""Table writers.

Every table is a versioned Parquet table (``snapshots``): readers see the old
rows until a write is complete, and a failed write leaves them.  In partitioned tables a
rerun replaces exactly the partitions present in
the batch and leaves the others (a rerun of one day does not duplicate it;
``mode="append"`` restores the original append behaviour).  Columns are
selected in the declared order before each write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.etl import DAILY_EVENT_COLUMNS, DAY
from ..operators.serving import SERVING_COLUMNS
from ..operators.popularity import POPULARITY_COLUMNS
from .snapshots import publish


def write_daily_events(df: DataFrame, path: str, mode: str = "overwrite", done: tuple[str, ...] = ()) -> None:
    """Daily events partitioned by day; ``done``: the days a backfill has finished with it."""
    publish(df.select(*DAILY_EVENT_COLUMNS), path, DAY, mode, done)


def write_corr(payloads: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(product_id string, corr_payload) partitioned by event."""
    publish(payloads.select(F.col("product_id").cast("string").alias("product_id"),
                            "corr_payload", "event"), path, "event", mode)


def write_popularity(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    cols = [F.col("product_id").cast("string").alias("product_id")] + list(POPULARITY_COLUMNS[1:])
    publish(df.select(*cols), path, mode=mode)


def write_similarity(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(product_id string, cat_path, text_corr_payload)."""
    publish(df.select(F.col("product_id").cast("string").alias("product_id"), "cat_path",
                      "text_corr_payload"), path, mode=mode)


def write_serving(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    publish(df.select(*SERVING_COLUMNS), path, mode=mode)
