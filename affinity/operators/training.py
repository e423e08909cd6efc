"""Reads of the daily event table: training edges and per-item counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import EVENT_NAMES
from .etl import DAY, _as_date, _day_filter


def _valid(daily: DataFrame) -> DataFrame:
    # A null id made the original job fail; here such rows are dropped.
    return daily.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull()
                       & F.col("event").isNotNull())


def training_triples(daily: DataFrame, start=None, end=None,
                     names=EVENT_NAMES) -> DataFrame:
    """(event, user_id, product_id, event_uvs) of the closed day range.

    ``event_uvs`` counts the rows of a (user, product, event); the
    cross-occurrence job uses only the keys.  Event types not in ``names``
    are dropped.
    """
    d = _valid(daily).where(_day_filter(F.col(DAY), None, start, end)
                            & F.col("event").isin(list(names)))
    return d.groupBy("event", "user_id", "product_id").agg(
        F.count("event_uv").alias("event_uvs"))


def lookback_start(end, days: int) -> dt.date:
    """``end`` minus ``days`` calendar days (the training window's start)."""
    return _as_date(end) - dt.timedelta(days=days)


def training_lookback(daily: DataFrame, end, days: int, names=EVENT_NAMES) -> DataFrame:
    """Training edges of the ``days`` days before ``end``, both ends included."""
    return training_triples(daily, lookback_start(end, days), end, names)


def item_event_uv(daily: DataFrame, start=None, end=None) -> DataFrame:
    """(event, product_id, event_uv): rows per (event, product) in the range.

    Every event type is kept, named or not; the sum counts (session, user)
    rows, not distinct users.
    """
    # Only the event and product are read per row here; a missing user does
    # not drop the row (it does for the training edges).
    d = daily.where(F.col("event").isNotNull() & F.col("product_id").isNotNull()
                    & _day_filter(F.col(DAY), None, start, end))
    return d.groupBy("event", "product_id").agg(
        F.sum("event_uv").cast("double").alias("event_uv"))


def sql_read(spark: SparkSession, sql: str, tables: dict[str, DataFrame], values: dict | None = None) -> DataFrame:
    """Run SQL text over DataFrames and values.

    ``{name}`` in the text stands for a table of ``tables``, ``:name`` for a
    value.  Values are bound, never pasted into the text, so a quote in one is
    data; no view is left behind in the session.
    """
    return spark.sql(sql, args=values or {}, **tables)
