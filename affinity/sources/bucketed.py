"""Log tables laid out for the daily join: bucketed by (day, session), pruned by day.

    root/<log table>/log_period=2024-01-01/...       bucketed and sorted by (log_day, sess_id)
    root/<log table>_hot/log_period=2024-01-01/...   rows of hot sessions, not bucketed

``log_period`` is the first day of a row's day, week, month or year: the period is a choice, so
that buckets of small logs do not become very many small files; within one,
sorted files let days be skipped.  ``log_day`` is the day in days since 1970.  All five tables have the same buckets, so
distinct and join on (log_day, sess_id) need no exchange
(``etl.daily_events_bucketed``).  A bucket is one task, which a bot's session would
make as long as the session: sessions with more than ``hot_rows`` rows of a day in
any table are kept apart and joined by an exchange, which AQE can split.

Days are added, never changed.  The session tables are written last and a day
counts as there once they have it, so a broken write can be run again (the daily
events are distinct, rows written twice do not matter).
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.etl import order_day
from ..session import remove_dir, stored
from .snapshots import _Folder
from .tables import LogTables

DAY, LOG_DAY, SESSION, PERIOD = "dctime", "log_day", "sess_id", "log_period"
PERIODS = ("day", "week", "month", "year")
LAYOUT = "layout.json"
#: Marks the rows of hot sessions while a batch is written.
HOT = "log_hot"
BUCKETS = 1024
HOT_ROWS = 1_000_000
NAMES = tuple(LogTables.__dataclass_fields__)


@dataclass(frozen=True)
class BucketedLogs:
    """``cold``: bucketed tables; ``hot``: the sessions kept apart (disjoint from them)."""

    cold: LogTables
    hot: LogTables
    period: str


def _table(root: str, name: str) -> str:
    return f"affinity_{hashlib.sha1(root.encode()).hexdigest()[:12]}_{name}"


def _register(spark: SparkSession, root: str, name: str, schema: StructType, buckets: int | None) -> None:
    """Make the folder a table of this session; its partitions are found from the folders."""
    table = _table(root, name)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        cluster = f" CLUSTERED BY ({LOG_DAY}, {SESSION}) SORTED BY ({LOG_DAY}, {SESSION}) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({PERIOD})"
                  f"{cluster if buckets else ''} LOCATION '{root}/{name}'")
    spark.catalog.recoverPartitions(table)


def write_logs(logs: LogTables, root: str, buckets: int = BUCKETS, hot_rows: int = HOT_ROWS,
               time_zone: str = "UTC", period: str = "day") -> None:
    """Add the days of ``logs`` to the bucketed tables under ``root``.

    An order's day is that of its time in ``time_zone``.  Rows without a day or a
    session join nothing and are left out.  A day that is already there, or other
    buckets or periods than those there, are errors.
    """
    if period not in PERIODS:
        raise ValueError(f"period {period}")
    spark = logs.rec_session.sparkSession
    tables = {}
    for name in NAMES:
        df = getattr(logs, name)
        if name == "rec_order_products":
            df = df.withColumn(DAY, order_day(F.col("add_time"), time_zone))
        df = df.where(F.col(DAY).isNotNull() & F.col(SESSION).isNotNull())
        rest = [c for c in df.columns if c not in (LOG_DAY, SESSION, PERIOD)]
        tables[name] = df.select(F.unix_date(DAY).alias(LOG_DAY), SESSION, *rest,
                                 _period(period).alias(PERIOD))
    folder = _Folder(spark, root)
    if not folder.names(LAYOUT):
        folder.create(LAYOUT, json.dumps(
            {"buckets": buckets, "period": period, "schemas": {n: df.schema.jsonValue() for n, df in tables.items()}}))
    layout = json.loads(folder.read(LAYOUT))
    if (layout["buckets"], layout["period"]) != (buckets, period):
        raise ValueError(f"{root} has {layout['buckets']} buckets a {layout['period']}")
    for name in NAMES:
        for n in (name, f"{name}_hot"):
            folder.fs.mkdirs(folder._path(n))
    old = read_logs(spark, root)
    there = old.cold.rec_session.select(PERIOD, DAY).union(old.hot.rec_session.select(PERIOD, DAY))
    new = tables["rec_session"].select(PERIOD, DAY).distinct()
    again = [str(r[0]) for r in there.join(new, [PERIOD, DAY], "left_semi").select(DAY).distinct().collect()]   # days
    if again:
        raise ValueError(f"{root} already has {', '.join(sorted(again))}")
    same: dict[int, list[str]] = {}                        # a log table may be given under two names
    for name in NAMES:
        same.setdefault(id(getattr(logs, name)), []).append(name)
    hot = None
    for names in same.values():
        n = (tables[names[0]].groupBy(LOG_DAY, SESSION).count().where(F.col("count") > hot_rows)
             .select(LOG_DAY, SESSION))
        hot = n if hot is None else hot.union(n)
    hot = stored(hot.distinct(), "hot_sessions")           # at most rows / hot_rows sessions of a table
    for names in reversed(same.values()):
        df = tables[names[0]]
        # told apart once, by a join that AQE can split, and written: neither the logs nor the join run again
        apart = stored(df.drop(PERIOD).join(hot.withColumn(HOT, F.lit(True)), [LOG_DAY, SESSION], "left"), "log_rows")
        apart = apart.withColumn(PERIOD, _period(period))
        for name in reversed(names):
            _add(apart, df.columns, _table(root, name), buckets)


def _period(period: str) -> Column:
    return F.date_trunc(period, DAY).cast("date")


def _add(rows: DataFrame, columns: list[str], table: str, buckets: int) -> None:
    rows.where(HOT).hint("rebalance", PERIOD).select(*columns).write.insertInto(f"{table}_hot")
    # the exchange places rows as the buckets do: a file per bucket and period
    rest = rows.where(F.col(HOT).isNull()).select(*columns).repartition(buckets, LOG_DAY, SESSION)
    rest.write.insertInto(table)


def read_logs(spark: SparkSession, root: str) -> BucketedLogs:
    """The tables under ``root``, registered in this session's catalog by the layout kept there."""
    layout = json.loads(_Folder(spark, root).read(LAYOUT))
    for name, schema in layout["schemas"].items():
        _register(spark, root, name, StructType.fromJson(schema), layout["buckets"])
        _register(spark, root, f"{name}_hot", StructType.fromJson(schema), None)
    return BucketedLogs(LogTables(*(spark.table(_table(root, n)) for n in NAMES)),
                        LogTables(*(spark.table(_table(root, f"{n}_hot")) for n in NAMES)), layout["period"])


def drop_logs(spark: SparkSession, root: str) -> None:
    """Remove the tables and their files."""
    for name in NAMES:
        for n in (name, f"{name}_hot"):
            spark.sql(f"DROP TABLE IF EXISTS {_table(root, n)}")
    remove_dir(spark, root)
