"""Daily event ETL: raw session logs -> (session, user, product, event, day).

Five filtered scans (session users, click, wish, cart, order), each a
DISTINCT projection, then ONE join of the session users with the union of
the tagged product actions.  The original ran one job per day; here a run
covers one day (``day``), a closed range (``start``/``end``) or, with
neither, every day in the data.  The day is a column, so a range run equals
the union of per-day runs: sessions are joined on (day, sess_id).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import EtlParams
from ..sources.tables import LogTables

DAY = "event_time"
DAILY_EVENT_COLUMNS = ("sess_id", "user_id", "product_id", "event", "event_uv", DAY)


def _day_filter(day_col: Column, day=None, start=None, end=None) -> Column:
    """Day equality, a closed range, or no restriction."""
    if day is not None:
        return day_col == F.lit(_as_date(day))
    cond = F.lit(True)
    if start is not None:
        cond = cond & (day_col >= F.lit(_as_date(start)))
    if end is not None:
        cond = cond & (day_col <= F.lit(_as_date(end)))
    return cond


def _as_date(d) -> dt.date:
    """Calendar date from a date or 'yyyy-MM-dd'; anything else is an error."""
    if isinstance(d, dt.datetime):
        raise TypeError("a day is a date, not a date and time")
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def session_users(logs: LogTables, day=None, start=None, end=None) -> DataFrame:
    """Distinct (day, session, user) of identified users (customers_id > 0)."""
    s = logs.rec_session
    return (s.where(_day_filter(F.col("dctime"), day, start, end)
                    & (F.col("customers_id") > 0))
            .select(F.col("dctime").alias(DAY), "sess_id",
                    F.col("customers_id").alias("user_id"))
            .distinct())


def _guards(p: EtlParams) -> Column:
    """Site allow-list, product guard and position pattern shared by all scans."""
    cond = (F.col("products_id") != 0) & F.col("r_position").rlike(p.position_regex)
    if p.sites is not None:
        cond = cond & F.col("site").isin(list(p.sites))
    return cond


def _action_scan(df: DataFrame, day_col: Column, action: Column, p: EtlParams,
                 day, start, end) -> DataFrame:
    return (df.where(_day_filter(day_col, day, start, end) & action & _guards(p))
            .select(day_col.alias(DAY), "sess_id", F.col("products_id").alias("product_id"))
            .distinct())


def click_scan(logs: LogTables, p: EtlParams, day=None, start=None, end=None) -> DataFrame:
    return _action_scan(logs.rec_session_action, F.col("dctime"),
                        F.col("com") == p.click_com, p, day, start, end)


def wish_scan(logs: LogTables, p: EtlParams, day=None, start=None, end=None) -> DataFrame:
    return _action_scan(logs.rec_session_operate, F.col("dctime"),
                        F.col("operating").isin(list(p.wish_operating)), p, day, start, end)


def cart_scan(logs: LogTables, p: EtlParams, day=None, start=None, end=None) -> DataFrame:
    return _action_scan(logs.rec_session_basket, F.col("dctime"),
                        F.col("operating").isin(list(p.cart_operating)), p, day, start, end)


def order_day(add_time: Column, time_zone: str = "UTC") -> Column:
    """Calendar day in ``time_zone`` of a unix-seconds timestamp, independent
    of the session time zone."""
    if time_zone != "UTC":
        add_time = F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(add_time), time_zone))
    return F.date_from_unix_date(F.floor(add_time / 86400).cast("int"))


def _epoch(day: dt.date, time_zone: str) -> int:
    """Unix seconds of the first moment of a day in a time zone."""
    return int(dt.datetime.combine(day, dt.time(), ZoneInfo(time_zone)).timestamp())


def _time_bounds(add_time: Column, time_zone: str, day=None, start=None, end=None) -> Column:
    """The day restriction as bounds on the raw column, which reach the scan.

    A day either side is let through; the exact day filter follows."""
    lo, hi = (day, day) if day is not None else (start, end)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (add_time >= _epoch(_as_date(lo) - dt.timedelta(days=1), time_zone))
    if hi is not None:
        cond = cond & (add_time < _epoch(_as_date(hi) + dt.timedelta(days=2), time_zone))
    return cond


def order_scan(logs: LogTables, p: EtlParams, day=None, start=None, end=None) -> DataFrame:
    # NOT IN drops a null status, as SQL does.
    deny = ~F.col("orders_status").isin(list(p.order_status_deny))
    t = F.col("add_time")
    return _action_scan(logs.rec_order_products, order_day(t, p.time_zone),
                        _time_bounds(t, p.time_zone, day, start, end) & deny, p, day, start, end)


def daily_events(logs: LogTables, p: EtlParams, day=None, start=None, end=None) -> DataFrame:
    """All four event types of the selected days.

    The tagged actions are unioned first so that the session users are
    shuffled and joined once, not once per event type.  A session with two
    users yields a row per user.
    """
    scans = (("click", click_scan), ("wish", wish_scan), ("cart", cart_scan),
             ("order", order_scan))
    actions = None
    for name, scan in scans:
        tagged = scan(logs, p, day, start, end).withColumn("event", F.lit(name))
        actions = tagged if actions is None else actions.unionByName(tagged)
    users = session_users(logs, day, start, end)
    return (users.join(actions, [DAY, "sess_id"])
            .select("sess_id", "user_id", "product_id", "event",
                    F.lit(1).alias("event_uv"), DAY))


def daily_events_bucketed(logs, p: EtlParams, day=None, start=None, end=None) -> DataFrame:
    """``daily_events`` over ``bucketed.BucketedLogs``: the rows of ``daily_events``.

    Only the partitions that hold selected days are read, and the bucketed
    sessions meet their actions without an exchange.  An order's day is the one
    it was written under, so the zone of ``p`` plays no part.
    """
    lo, hi = (day, day) if day is not None else (start, end)
    days = _day_filter(F.col("dctime"), day, start, end)
    if lo is not None:
        days = days & (F.col("log_period") >= F.date_trunc(logs.period, F.lit(_as_date(lo))).cast("date"))
    if hi is not None:
        days = days & (F.col("log_period") <= F.lit(_as_date(hi)))
    cold, hot = (LogTables(*(getattr(t, n).where(days) for n in LogTables.__dataclass_fields__))
                 for t in (logs.cold, logs.hot))
    scans = (("click", cold.rec_session_action, F.col("com") == p.click_com),
             ("wish", cold.rec_session_operate, F.col("operating").isin(list(p.wish_operating))),
             ("cart", cold.rec_session_basket, F.col("operating").isin(list(p.cart_operating))),
             ("order", cold.rec_order_products, ~F.col("orders_status").isin(list(p.order_status_deny))))
    users = (cold.rec_session.where(F.col("customers_id") > 0)
             .select("log_day", "sess_id", F.col("customers_id").alias("user_id")).distinct())
    # hot sessions: the same days, by the ordinary join
    noon = F.unix_date("dctime").cast("bigint") * 86400 + 43200
    hot = dataclasses.replace(hot, rec_order_products=hot.rec_order_products.withColumn("add_time", noon))
    out = daily_events(hot, dataclasses.replace(p, time_zone="UTC"), day, start, end)
    for name, table, action in scans:
        actions = (table.where(action & _guards(p))
                   .select("log_day", "sess_id", F.col("products_id").alias("product_id")).distinct())
        out = out.unionByName(users.join(actions, ["log_day", "sess_id"])
                              .select("sess_id", "user_id", "product_id", F.lit(name).alias("event"),
                                      F.lit(1).alias("event_uv"), F.date_from_unix_date("log_day").alias(DAY)))
    return out
