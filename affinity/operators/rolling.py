"""Popularity windows kept from run to run and moved by the days that differ.

Two versioned tables under a state folder:

    days   (day, event, product_id, uv, n)   one row per day, event and product
    sums   product_id, event, {window}, n_{window}

A run to a new end day reads three things: the days of the daily table whose
files are new since they were counted, the counts of the days that enter or leave one of the six
windows (8 of 61 for a step of one day, see ``moved_days``), and the
sums of the run before.  A sum gains the days its window gained and loses those it lost;
``n``, the rows behind a sum, tells a sum of 0 from a product that is absent.

Every table remembers which files it was made from (the manifest's note).  A
day that was written again after it had entered the sums, or came late, cannot be taken
back from them: the sums are then built anew from ``days``, which is a
count of at most one row per day, event and product, not a read of the events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import EVENT_NAMES, POPULARITY_DAYS
from ..sources import snapshots
from .etl import DAY, _as_date
from .popularity import Windows


def day_counts(daily: DataFrame, names=EVENT_NAMES) -> DataFrame:
    """(day, event, product_id, uv, n): sum of event_uv and the rows that have one."""
    return (daily.where(F.col("event").isin(list(names)) & F.col("product_id").isNotNull() & F.col(DAY).isNotNull())
            .groupBy(DAY, "event", "product_id")
            .agg(F.sum(F.col("event_uv").cast("long")).alias("uv"), F.count("event_uv").alias("n")))


def _within(parts, first: dt.date, last: dt.date) -> dict:
    """The partitions of days from ``first`` to ``last``; a partition without a day is in no window."""
    names = {f"{DAY}={first + dt.timedelta(days=i)}" for i in range((last - first).days + 1)}
    return {p: v for p, v in parts.items() if p in names}


def refresh_days(spark: SparkSession, daily_path: str, path: str, first: dt.date, last: dt.date,
                 names=EVENT_NAMES) -> dict:
    """Count the days whose files changed; returns partition -> the daily files it was counted from."""
    source = snapshots.manifest(spark, daily_path)
    if source is None:
        raise ValueError(f"{daily_path}: no manifest; rolling windows need a table written by write_daily_events")
    known = (snapshots.manifest(spark, path) or {}).get("note") or {"names": list(names), "from": {}}
    if known["names"] != list(names):
        raise ValueError(f"{path} counts the events {known['names']}")
    counted, now = known["from"], _within(source["parts"], first, last)
    stale = [p for p, files in now.items() if counted.get(p) != files]
    gone = [p for p in _within(counted, first, last) if p not in now]
    if stale or gone:
        counted = {**{p: f for p, f in counted.items() if p not in gone}, **{p: now[p] for p in stale}}
        snapshots.publish(day_counts(snapshots.read(spark, daily_path, stale), names), path, DAY,
                          covers=(*stale, *gone), note={"names": list(names), "from": counted})
    return counted


def _inside(day, bounds):
    return day.between(*(F.lit(b) for b in bounds)).cast("int")


def _moves(old: Windows | None, new: Windows) -> dict[str, Column]:
    """Window -> what a row of a day adds to its sum: 1, -1 or 0 times the row."""
    before = old.ranges() if old else {}
    return {k: _inside(F.col(DAY), r) - (_inside(F.col(DAY), before[k]) if old else F.lit(0))
            for k, r in new.ranges().items()}


def moved_days(old: Windows | None, new: Windows) -> set[dt.date]:
    """Days that are in a window of one of the two ends but not in that of the other."""
    def days(r):
        return {r[0] + dt.timedelta(days=i) for i in range((r[1] - r[0]).days + 1)}

    before = old.ranges() if old else {}
    return set().union(*(days(r) ^ (days(before[k]) if old else set()) for k, r in new.ranges().items()))


def moved_sums(counts: DataFrame, sums: DataFrame | None, old: Windows | None, new: Windows) -> DataFrame:
    """``sums`` of the windows ``old`` plus what ``counts`` changes on the way to ``new``."""
    moves = _moves(old, new)
    cols = [f"{p}{k}" for k in moves for p in ("", "n_")]
    step = counts.select("product_id", "event", *[
        (m * F.coalesce(F.col(c), F.lit(0))).alias(f"{p}{k}") for k, m in moves.items() for p, c in (("", "uv"), ("n_", "n"))])
    rows = step if sums is None else sums.select("product_id", "event", *cols).unionByName(step)
    # every window lies in pop: without rows there, the product has none
    return rows.groupBy("product_id", "event").agg(*[F.sum(c).alias(c) for c in cols]).where("n_pop > 0")


def _wide(sums: DataFrame, names) -> DataFrame:
    """As ``popularity.window_sums``: a double per window and event, null where the window has no row."""
    keys = Windows.of(dt.date(2000, 1, 1)).ranges()
    return sums.groupBy("product_id").agg(*[
        F.max(F.when((F.col("event") == e) & (F.col(f"n_{k}") > 0), F.col(k))).cast("double").alias(f"{k}_{e}")
        for e in names for k in keys])


def advance(spark: SparkSession, daily_path: str, state: str, end, days: int = POPULARITY_DAYS,
            names=EVENT_NAMES) -> DataFrame:
    """``popularity.window_sums`` for ``end``, from the sums kept under ``state``.

    ``daily_path`` is a table of ``write_daily_events``.  The first run, another
    number of days or a day that changed builds the sums from the day
    counts; every other run, forward or backward, moves them.  A run that breaks leaves the state as it was
    (days counted so far are kept and valid); a rerun gives the same rows.
    """
    new = Windows.of(end, days)
    day_path, sum_path = f"{state}/days", f"{state}/sums"
    counted = refresh_days(spark, daily_path, day_path, new.start, new.end, names)
    kept = (snapshots.manifest(spark, sum_path) or {}).get("note")
    old = None
    if kept and kept["days"] == days and kept["names"] == list(names):
        old = Windows.of(kept["end"], days)
        if _within(counted, old.start, old.end) != kept["from"]:
            old = None
    if old != new:
        parts = {f"{DAY}={d}" for d in moved_days(old, new)}
        sums = moved_sums(snapshots.read(spark, day_path, parts), old and snapshots.read(spark, sum_path), old, new)
        snapshots.publish(sums, sum_path, note={"end": str(_as_date(end)), "days": days, "names": list(names),
                                                "from": _within(counted, new.start, new.end)})
    return _wide(snapshots.read(spark, sum_path), names)
