"""Daily ETL: guards, fan-out, idempotent day writes."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from affinity.operators import etl
from affinity.params import EtlParams
from affinity.session import shared_dir
from affinity.sources import sinks, snapshots
from affinity.sources.tables import LogTables

DAY = dt.date(2018, 11, 20)
P = EtlParams(sites=("s1",), position_regex=".*(ring|bolt).*", order_status_deny=(1, 4))


def _logs(spark):
    sess = spark.createDataFrame(
        [(1, 10, DAY), (1, 11, DAY), (2, 0, DAY), (3, 12, DAY - dt.timedelta(1))],
        "sess_id long, customers_id long, dctime date")
    act = spark.createDataFrame(
        [(1, 100, DAY, "s1", "view", "home ring"), (1, 0, DAY, "s1", "view", "ring"),
         (1, 101, DAY, "s2", "view", "ring"), (1, 102, DAY, "s1", "view", "gear"),
         (1, 103, DAY, "s1", "click", "ring"), (2, 104, DAY, "s1", "view", "ring"),
         (3, 105, DAY - dt.timedelta(1), "s1", "view", "bolt")],
        "sess_id long, products_id long, dctime date, site string, com string, r_position string")
    op = spark.createDataFrame(
        [(1, 200, DAY, "s1", "wish", "ring"), (1, 201, DAY, "s1", "cart", "bolt"),
         (1, 202, DAY, "s1", "buynow", "bolt")],
        "sess_id long, products_id long, dctime date, site string, operating string, "
        "r_position string")
    t = int(dt.datetime(2018, 11, 20, 12).replace(tzinfo=dt.timezone.utc).timestamp())
    orders = spark.createDataFrame(
        [(1, 300, t, "s1", 2, "ring"), (1, 301, t, "s1", 4, "ring"),
         (1, 302, t, "s1", None, "ring")],
        "sess_id long, products_id long, add_time long, site string, orders_status int, "
        "r_position string")
    return LogTables(sess, act, op, op, orders)


def test_guards_and_two_user_fanout(spark):
    rows = etl.daily_events(_logs(spark), P, day=DAY).collect()
    got = sorted((r.user_id, r.product_id, r.event) for r in rows)
    # session 1 has users 10 and 11: one row per user and product
    assert got == sorted([(u, p, e) for u in (10, 11) for p, e in
                          [(100, "click"), (200, "wish"), (201, "cart"), (202, "cart"),
                           (300, "order")]])
    assert all(r.event_time == DAY and r.event_uv == 1 for r in rows)


def test_range_form_equals_union_of_days(spark):
    logs = _logs(spark)
    days = [DAY - dt.timedelta(1), DAY]
    one = sum(etl.daily_events(logs, P, day=d).count() for d in days)
    assert etl.daily_events(logs, P, start=days[0], end=days[1]).count() == one == 11


def test_rerun_day_overwrite_and_append(spark):
    df = etl.daily_events(_logs(spark), P, day=DAY)
    path = shared_dir(spark, "test-daily")
    sinks.write_daily_events(df, path)
    sinks.write_daily_events(df, path)
    assert snapshots.read(spark, path).count() == 10          # dynamic overwrite: unchanged
    other = etl.daily_events(_logs(spark), P, day=DAY - dt.timedelta(1))
    sinks.write_daily_events(other, path)                  # another day is added, not replaced
    assert snapshots.read(spark, path).count() == 11
    sinks.write_daily_events(df, path, mode="append")
    assert snapshots.read(spark, path).count() == 21          # append doubles the day


def test_order_day_bounds_reach_the_scan_in_any_zone(spark):
    root = shared_dir(spark, "orders")
    t0 = 1_700_000_000
    spark.range(0, 400).select(
        F.col("id").alias("sess_id"), (F.col("id") + 1).alias("products_id"),
        (F.lit(t0) + F.col("id") * 3600).alias("add_time"), F.lit("s").alias("site"),
        F.lit(2).alias("orders_status"), F.lit("category").alias("r_position")).write.parquet(root)
    logs = LogTables(None, None, None, None, spark.read.parquet(root))
    for zone in ("UTC", "Asia/Shanghai", "America/New_York"):
        p = EtlParams(time_zone=zone)
        got = etl.order_scan(logs, p, day="2023-11-20")
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        pushed = [x for x in got._jdf.queryExecution().explainString(mode).splitlines() if "PushedFilters" in x][0]
        assert "GreaterThanOrEqual(add_time," in pushed and "LessThan(add_time," in pushed
        day = [i for i in range(400)
               if dt.datetime.fromtimestamp(t0 + 3600 * i, ZoneInfo(zone)).date() == dt.date(2023, 11, 20)]
        assert sorted(r.sess_id for r in got.collect()) == day


def test_a_day_is_not_a_time():
    with pytest.raises(TypeError):
        etl._as_date(dt.datetime(2024, 1, 1, 5))
