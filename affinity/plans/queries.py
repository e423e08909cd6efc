"""Registered queries: one callable (spark, sf_dir) -> DataFrame per key.

Each query reads the driver's tables through an adapter (see
``sources/adapters.py``) and runs one operator of the pipeline over the
whole tables.  Parameters below are the ones the checks use; they are
the pipeline's defaults unless a key exists to exercise a bound (small
sampling caps, a minimum event count, a top-k smaller than the data).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import round_half_away
from ..operators import cooccurrence as cco
from ..operators import etl, popularity, rolling, serving, similarity, training
from ..operators.payload import corr_payload, similarity_payload
from ..params import CcoParams, EtlParams, Indicator, cco_default_params
from ..session import materialize, remove_dir, shared_dir
from ..sources import adapters as ad
from ..sources import bucketed, sinks, snapshots

# -- parameters of the checks -----------------------------------------------
EVENTS_END = dt.date(2024, 1, 31)       # end of the popularity and lookback windows
POP_DAYS = 30                           # thirds at 01-11 / 01-21, half at 01-16
LOOKBACK_DAYS = 10
UPDATE_TIME = "2024-01-31"
MIN_EVENTS = 10                         # binds: users have ~12 items per event
ORDER_ZONE = "Etc/GMT+5"                # five hours behind UTC: orders fall on the day before
CLUSTER_ROWS = 8                        # categories of the embeddings are small: make them cluster
DEFAULT_CAP = 8                         # binds, so the default sampler's seed takes effect
LOG_BUCKETS = 4                         # small tables
HOT_LINES = 5                           # binds: an order has up to seven lines
# The backfill operator takes an explicit day range; a calendar year of the
# orders data is that range (the whole tables are still scanned).
BACKFILL = (dt.date(1996, 1, 1), dt.date(1996, 12, 31))
SAMPLED = CcoParams(indicators=(Indicator("order", 12, 20), Indicator("cart", 12, 20),
                                Indicator("wish", 5, 20), Indicator("click", 5, 20)))
ETL_PARAMS = EtlParams(sites=ad.ORDERS_SITES, position_regex=ad.ORDERS_POSITION_REGEX,
                       order_status_deny=ad.ORDERS_STATUS_DENY)
UV_SQL = (
    "SELECT event, product_id, CAST(sum(event_uv) AS DOUBLE) AS event_uv "
    "FROM {customer_daily_events} WHERE event IS NOT NULL AND product_id IS NOT NULL "
    "GROUP BY event, product_id")


# -- adapters ----------------------------------------------------------------
def _daily(spark, d):
    return ad.events_daily(spark, d)


def _triples(spark, d):
    return training.training_triples(_daily(spark, d))


def _logs(spark, d):
    return ad.orders_logs(spark, d)


# -- ETL ---------------------------------------------------------------------
def q_etl_session_users(spark, d):
    return etl.session_users(_logs(spark, d))


def q_etl_click(spark, d):
    return etl.click_scan(_logs(spark, d), ETL_PARAMS)


def q_etl_wish(spark, d):
    return etl.wish_scan(_logs(spark, d), ETL_PARAMS)


def q_etl_cart(spark, d):
    return etl.cart_scan(_logs(spark, d), ETL_PARAMS)


def q_etl_order(spark, d):
    return etl.order_scan(_logs(spark, d), ETL_PARAMS)


def q_etl_order_tz(spark, d):
    """Orders by the calendar day of a time zone other than UTC."""
    return etl.order_scan(_logs(spark, d), dataclasses.replace(ETL_PARAMS, time_zone=ORDER_ZONE))


def q_daily_events(spark, d):
    return etl.daily_events(_logs(spark, d), ETL_PARAMS)


def q_daily_events_backfill(spark, d):
    return etl.daily_events(_logs(spark, d), ETL_PARAMS, start=BACKFILL[0], end=BACKFILL[1])


def q_daily_events_bucketed(spark, d):
    """The logs written as bucketed tables, sessions above a few lines as hot ones, then joined."""
    root = shared_dir(spark, "bucketed_logs")
    bucketed.write_logs(ad.orders_logs(spark, d, keep=True), root, LOG_BUCKETS, HOT_LINES, period="year")
    out = materialize(etl.daily_events_bucketed(bucketed.read_logs(spark, root), ETL_PARAMS))
    bucketed.drop_logs(spark, root)
    return out


def _read_back(spark, path, *columns):
    """The sink's content as a checkpointed table; the sink's folder goes."""
    back = materialize(snapshots.read(spark, path).select(*columns))
    remove_dir(spark, path)
    return back


def q_sink_daily_events(spark, d):
    """Write all days, then one year again (it must replace, not append); read back."""
    path = shared_dir(spark, "daily_events")
    sinks.write_daily_events(q_daily_events(spark, d), path)
    sinks.write_daily_events(q_daily_events_backfill(spark, d), path)
    return _read_back(spark, path, *[F.col(c) for c in etl.DAILY_EVENT_COLUMNS[:-1]],
                      F.col(etl.DAY).cast("date").alias(etl.DAY))


# -- training reads ----------------------------------------------------------
def q_training_triples(spark, d):
    return _triples(spark, d)


def q_training_lookback(spark, d):
    return training.training_lookback(_daily(spark, d), EVENTS_END, LOOKBACK_DAYS)


def q_item_event_uv(spark, d):
    return training.item_event_uv(_daily(spark, d))


def q_sql_read(spark, d):
    return training.sql_read(spark, UV_SQL, {"customer_daily_events": _daily(spark, d)})


# -- cross-occurrence preparation --------------------------------------------
def q_min_events_users(spark, d):
    p = CcoParams(min_events=MIN_EVENTS)
    e = cco.edges(_triples(spark, d), p)
    return cco.primary_users(e, cco.primary_event(e, p), p)


def q_restricted_events(spark, d):
    return cco.restrict(_triples(spark, d), CcoParams()).edges.select(*cco.EDGE)


def _without_order(spark, d):
    # The fallback rule only acts when the first event type has no rows:
    # removing that event type from the (whole) input creates the case.
    return _triples(spark, d).where(F.col("event") != "order")


def q_primary_event_fallback(spark, d):
    return cco.cross_occurrence(_without_order(spark, d), CcoParams())


def q_downsampled_events(spark, d):
    return cco.sampled_edges(_triples(spark, d), SAMPLED).select(*cco.EDGE)


def q_sampling_report(spark, d):
    """What the caps drop, by event type."""
    return cco.sampling_report(_triples(spark, d), SAMPLED)


def q_item_user_counts(spark, d):
    s = cco.sampled_edges(_triples(spark, d), CcoParams())
    per_user = s.groupBy("event", "user_id").agg(F.count(F.lit(1)).alias("n")).select(
        "event", F.lit("user").alias("axis"), F.col("user_id").alias("id"), "n")
    # the counts as they travel on the edges, one row per item
    per_item = cco.with_item_counts(s, CcoParams()).select(
        "event", F.lit("item").alias("axis"), F.col("product_id").alias("id"), F.col("n_item").alias("n")).distinct()
    return per_user.unionByName(per_item)


# -- cross-occurrence --------------------------------------------------------
def q_cco_counts(spark, d):
    c = cco.cooccurrence_counts(_triples(spark, d), CcoParams())
    return c.withColumn("llr", round_half_away(F.col("llr"), 5))


def q_cco_primary(spark, d):
    return cco.cross_occurrence(_triples(spark, d), CcoParams(), only="primary")


def q_cco_cross(spark, d):
    return cco.cross_occurrence(_triples(spark, d), CcoParams(), only="cross")


def q_cco_all(spark, d):
    return cco.cross_occurrence(_triples(spark, d), CcoParams())


def q_cco_default_params(spark, d):
    return cco.cross_occurrence(_triples(spark, d), cco_default_params(max_events=DEFAULT_CAP))


def q_cco_sampled(spark, d):
    return cco.cross_occurrence(_triples(spark, d), SAMPLED)


def q_cco_orders(spark, d):
    t = training.training_triples(ad.lineitem_daily(spark, d))
    return cco.cross_occurrence(t, CcoParams())


# -- payloads, outcome, serving ----------------------------------------------
def q_corr_payload(spark, d):
    return corr_payload(q_cco_all(spark, d))


def q_sink_corr(spark, d):
    """Write all events, then a batch without one: its partition must stay."""
    path = shared_dir(spark, "item_event_corr")
    pay = materialize(q_corr_payload(spark, d))
    sinks.write_corr(pay, path)
    sinks.write_corr(pay.where(F.col("event") != "wish"), path)
    return _read_back(spark, path, "product_id", "corr_payload", F.col("event").cast("string"))


def q_outcome(spark, d):
    cat = ad.part_catalogue(spark, d)
    return serving.outcome(cat.products, q_corr_payload(spark, d), UPDATE_TIME)


def _sim_payload(spark, d):
    return similarity_payload(similarity.vector_similarity(ad.embedding_vectors(spark, d)))


def q_sink_serving(spark, d):
    path = shared_dir(spark, "serving")
    rows = materialize(q_serving_table(spark, d))
    sinks.write_serving(rows, path)
    sinks.write_serving(rows, path)
    return _read_back(spark, path, "*")


def q_serving_table(spark, d):
    pop = popularity.popularity_table(_daily(spark, d), EVENTS_END, POP_DAYS)
    return serving.serving_table(q_outcome(spark, d), pop, _sim_payload(spark, d))


# -- popularity ----------------------------------------------------------------
def q_pop_wide(spark, d):
    return popularity.theme_wide(_daily(spark, d), "pop", EVENTS_END, POP_DAYS)


def q_trend(spark, d):
    return popularity.theme_long(_daily(spark, d), "trend", EVENTS_END, POP_DAYS)


def q_trend_wide(spark, d):
    return popularity.theme_wide(_daily(spark, d), "trend", EVENTS_END, POP_DAYS)


def q_hot(spark, d):
    return popularity.theme_long(_daily(spark, d), "hot", EVENTS_END, POP_DAYS)


def q_hot_wide(spark, d):
    return popularity.theme_wide(_daily(spark, d), "hot", EVENTS_END, POP_DAYS)


def q_popularity_table(spark, d):
    return popularity.popularity_table(_daily(spark, d), EVENTS_END, POP_DAYS)


def q_popularity_rolled(spark, d):
    """The windows of three days before, moved to the end day by the days that differ."""
    path = shared_dir(spark, "rolled")
    sinks.write_daily_events(_daily(spark, d), f"{path}/daily")
    for back in (3, 1, 0):
        sums = rolling.advance(spark, f"{path}/daily", f"{path}/state", EVENTS_END - dt.timedelta(days=back), POP_DAYS)
    back = materialize(popularity.table_of(sums))
    remove_dir(spark, path)
    return back


def q_sink_popularity(spark, d):
    path = shared_dir(spark, "item_popularity")
    rows = materialize(q_popularity_table(spark, d))
    sinks.write_popularity(rows, path)
    sinks.write_popularity(rows, path)
    return _read_back(spark, path, "*")


# -- similarity ------------------------------------------------------------------
def q_item_desc(spark, d):
    return similarity.item_desc(ad.part_catalogue(spark, d))


def q_vector_similarity(spark, d):
    return similarity.vector_similarity(ad.embedding_vectors(spark, d)).drop("row_id")


def q_vector_similarity_clustered(spark, d):
    """Every category clustered, whatever its size: the same neighbours."""
    return similarity.vector_similarity(ad.embedding_vectors(spark, d), cluster_rows=CLUSTER_ROWS).drop("row_id")


def q_vector_similarity_repeats(spark, d):
    """Items with several vectors per category path: a list for each."""
    return similarity.vector_similarity(ad.repeated_vectors(spark, d)).drop("row_id")


def q_text_mean_vectors(spark, d):
    """Mean of given word vectors per item, then neighbours in the category."""
    items = similarity.item_desc(ad.part_catalogue(spark, d))
    vec = similarity.mean_word_vectors(items, ad.hashed_word_vectors(items))
    return similarity.vector_similarity(vec).drop("row_id")


def q_text_similarity(spark, d):
    return similarity.text_similarity(ad.part_catalogue(spark, d)).drop("row_id")


def q_sink_similarity(spark, d):
    path = shared_dir(spark, "item_similarity")
    rows = materialize(_sim_payload(spark, d))
    sinks.write_similarity(rows, path)
    sinks.write_similarity(rows, path)
    return _read_back(spark, path, "*")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
