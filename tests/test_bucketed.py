"""Bucketed log tables: no exchange, days pruned, hot sessions apart, days added once."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from affinity.operators import etl
from affinity.params import EtlParams
from affinity.session import shared_dir
from affinity.sources import bucketed
from affinity.sources.tables import LogTables

D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
P = EtlParams(sites=("s",), position_regex="ring", order_status_deny=(4,))
ACTION = "sess_id long, products_id long, dctime date, site string, {} string, r_position string"


def _logs(spark, days=(D1, D2), busy=40):
    """Sessions 1-20 on each day; session 7 has ``busy`` clicks, session 8 two users."""
    users = [(s, 100 + s, d) for d in days for s in range(1, 21)] + [(8, 999, d) for d in days]
    users += [(None, 5, days[0]), (21, 5, None), (22, 0, days[0])]
    act = [(s, 10 + s, d, "s", k, "ring") for d in days for s in range(1, 21) for k in ("view", "wish", "cart")]
    act += [(7, p, d, "s", "view", "ring") for d in days for p in range(1, busy)] + act[:9]
    act += [(3, 77, days[0], "other", "view", "ring"), (None, 1, days[0], "s", "view", "ring")]
    t = [(s, 50, int(dt.datetime(d.year, d.month, d.day, 2, tzinfo=dt.timezone.utc).timestamp()), "s", 4 - s % 2, "ring")
         for d in days for s in range(1, 21)]
    com = spark.createDataFrame(act, ACTION.format("com"))
    operating = com.withColumnRenamed("com", "operating")
    return LogTables(spark.createDataFrame(users, "sess_id long, customers_id long, dctime date"), com, operating, operating,
                     spark.createDataFrame(t, "sess_id long, products_id long, add_time long, site string, "
                                              "orders_status int, r_position string"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def root(spark):
    path = shared_dir(spark, "test_bucketed")
    yield path
    bucketed.drop_logs(spark, path)


@pytest.mark.parametrize("period", ["day", "month"])
def test_rows_of_the_ordinary_join_with_hot_sessions_apart(spark, root, period):
    logs = _logs(spark)
    bucketed.write_logs(logs, root, 3, hot_rows=20, period=period)
    b = bucketed.read_logs(spark, root)
    assert {r[0] for r in b.hot.rec_session_action.select("sess_id").distinct().collect()} == {7}
    assert b.cold.rec_session_action.where("sess_id = 7").count() == 0
    assert _rows(etl.daily_events_bucketed(b, P)) == _rows(etl.daily_events(logs, P))
    assert _rows(etl.daily_events_bucketed(b, P, day=D2)) == _rows(etl.daily_events(logs, P, day=D2))
    assert _rows(etl.daily_events_bucketed(b, P, start=D1, end=D1)) == _rows(etl.daily_events(logs, P, end=D1))


def test_order_days_follow_the_zone_they_were_written_in(spark, root):
    logs = _logs(spark)
    bucketed.write_logs(logs, root, 2, hot_rows=20, time_zone="Etc/GMT+5")
    want = _rows(etl.daily_events(logs, dataclasses.replace(P, time_zone="Etc/GMT+5")))
    assert _rows(etl.daily_events_bucketed(bucketed.read_logs(spark, root), P)) == want


def test_no_exchange_below_the_bucketed_join_and_only_the_day_is_read(spark, root):
    bucketed.write_logs(_logs(spark), root, 3)
    b = bucketed.read_logs(spark, root)
    empty = LogTables(*(t.where("false") for t in (b.hot.rec_session, b.hot.rec_session_action, b.hot.rec_session_operate,
                                                   b.hot.rec_session_basket, b.hot.rec_order_products)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = etl.daily_events_bucketed(dataclasses.replace(b, hot=empty), P, day=D1)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan
    assert "PartitionFilters: [isnotnull(log_period" in plan
    assert {r.event_time for r in df.collect()} == {D1}


def test_days_are_added_once_and_a_broken_write_can_be_repeated(spark, root, monkeypatch):
    logs = _logs(spark)

    def day(d):
        at = F.date_from_unix_date(F.floor(F.col("add_time") / 86400).cast("int"))
        return LogTables(*(getattr(logs, n).where((F.col("dctime") if n != "rec_order_products" else at) == d)
                           for n in bucketed.NAMES))

    bucketed.write_logs(day(D1), root, 3, hot_rows=20)
    with pytest.raises(ValueError):
        bucketed.write_logs(day(D1), root, 3, hot_rows=20)
    with pytest.raises(ValueError):
        bucketed.write_logs(day(D2), root, 4)
    add = bucketed._add

    def broken(df, hot, table, buckets):
        if table.endswith("rec_session"):
            raise RuntimeError("lost")
        add(df, hot, table, buckets)

    monkeypatch.setattr(bucketed, "_add", broken)
    with pytest.raises(RuntimeError):
        bucketed.write_logs(day(D2), root, 3, hot_rows=20)
    monkeypatch.undo()
    bucketed.write_logs(day(D2), root, 3, hot_rows=20)
    assert _rows(etl.daily_events_bucketed(bucketed.read_logs(spark, root), P)) == _rows(etl.daily_events(logs, P))


def test_empty_logs(spark, root):
    bucketed.write_logs(LogTables(*(getattr(_logs(spark), n).where("false") for n in bucketed.NAMES)), root, 2)
    assert etl.daily_events_bucketed(bucketed.read_logs(spark, root), P).count() == 0


def test_jobs_write_buckets_and_join_them(spark, root):
    from affinity.plans import jobs
    from affinity.session import remove_dir
    from affinity.sources import snapshots

    work = shared_dir(spark, "bucket_job")
    logs = _logs(spark)
    for n in bucketed.NAMES:
        getattr(logs, n).write.parquet(f"{work}/logs/{n}")
    jobs.bucket_job(spark, f"{work}/logs", root, 2, hot_rows=20)
    jobs.etl_job(spark, root, f"{work}/daily", P, start=D1, end=D2, bucketed_logs=True)
    assert _rows(snapshots.read(spark, f"{work}/daily")) == _rows(etl.daily_events(logs, P))
    remove_dir(spark, work)


def test_a_log_table_is_told_apart_once_and_joined_lines_can_be_kept(spark, root):
    from affinity import session
    from affinity.sources import adapters as ad

    logs = ad.orders_logs(spark, "/root/testdata/sf0.001", keep=True)
    assert sum("/log_lines-" in p for p in session._STORED) == 1
    before = len(session._STORED)
    bucketed.write_logs(logs, root, 2, hot_rows=5, period="year")         # operate and basket are one table
    assert sum("/log_rows-" in p for p in session._STORED[before:]) == 4
    b = bucketed.read_logs(spark, root)
    for n in LogTables.__dataclass_fields__:
        parts = getattr(b.cold, n).drop("log_day", "log_period").unionByName(getattr(b.hot, n).drop("log_day", "log_period"))
        want = getattr(logs, n)
        assert parts.select(want.columns).exceptAll(want).isEmpty() and parts.count() == want.count() > 0
