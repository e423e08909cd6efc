"""End-to-end jobs: table in, table out.

The pipeline's four batch jobs and the serving assembly, each one Spark
plan ending in one write:

    etl         raw session logs      -> daily events (partitioned by day)
    bucket      raw session logs      -> log tables bucketed by (day, session), for etl
    cco         daily events          -> item-event correlations (by event)
    popularity  daily events          -> pop / trend / hot per product
    words       catalogue             -> word vectors of the item texts
    similarity  catalogue [+ words]   -> in-category text neighbours
    serving     catalogue + the above -> serving rows

Paths are folders (Parquet).  Run as ``python -m affinity.plans.jobs <job>
--help``.  On a cluster the session comes from ``spark-submit``; the
settings of ``session.CONF`` are applied to it.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..operators import cooccurrence as cco
from ..operators import etl, popularity, rolling, serving, similarity, training, word2vec
from ..operators.payload import corr_payload, similarity_payload
from ..params import (
    INDICATOR_MAX_CORRELATORS,
    INDICATOR_MAX_EVENTS,
    NEIGHBOURS,
    POPULARITY_DAYS,
    W2V_DIM,
    W2V_MIN_COUNT,
    CcoParams,
    EtlParams,
    Indicator,
    cco_default_params,
)
from ..session import CONF, apply_cluster_sizing, drop_stored, ensure_checkpoint_dir, ship_package
from ..sources import bucketed, sinks, snapshots
from ..sources.tables import read_catalogue, read_log_tables


def etl_job(spark: SparkSession, logs_root: str, out: str, p: EtlParams, day=None,
            start=None, end=None, mode: str = "overwrite", bucketed_logs: bool = False) -> None:
    """One day (default: yesterday), or a closed day range in one run.

    ``bucketed_logs``: ``logs_root`` holds what ``bucket_job`` wrote.
    """
    if day is None and start is None and end is None:
        day = dt.date.today() - dt.timedelta(days=1)
    if bucketed_logs:
        df = etl.daily_events_bucketed(bucketed.read_logs(spark, logs_root), p, day, start, end)
    else:
        df = etl.daily_events(read_log_tables(spark, logs_root), p, day, start, end)
    sinks.write_daily_events(df, out, mode)
    drop_stored(spark)


def bucket_job(spark: SparkSession, logs_root: str, out: str, buckets: int = bucketed.BUCKETS,
               hot_rows: int = bucketed.HOT_ROWS, time_zone: str = "UTC", period: str = "day") -> None:
    """Add the days of the logs to the bucketed tables at ``out``."""
    try:
        bucketed.write_logs(read_log_tables(spark, logs_root), out, buckets, hot_rows, time_zone, period)
    finally:
        drop_stored(spark)


def etl_backfill(spark: SparkSession, logs_root: str, out: str, p: EtlParams, start, end, chunk_days: int = 7) -> int:
    """Every day of a closed range, some days at a time; returns the days computed.

    Each chunk's rows and the fact that its days are done (days without rows too)
    are published together, so a run that broke goes on with the first day
    that is not done, and a run over finished days reads no logs.
    """
    first, last = etl._as_date(start), etl._as_date(end)
    table = snapshots.manifest(spark, out)
    done = set(table["done"]) if table else set()
    days = [d for d in (first + dt.timedelta(days=i) for i in range((last - first).days + 1)) if str(d) not in done]
    logs, computed = None, 0
    while days:
        # a chunk is a run of consecutive days: one range for the scans
        n = 1
        while n < min(chunk_days, len(days)) and days[n] - days[n - 1] == dt.timedelta(days=1):
            n += 1
        chunk, days = days[:n], days[n:]
        logs = logs or read_log_tables(spark, logs_root)
        df = etl.daily_events(logs, p, None, chunk[0], chunk[-1])
        sinks.write_daily_events(df, out, done=tuple(str(d) for d in chunk))
        computed += n
    drop_stored(spark)
    return computed


def cco_job(spark: SparkSession, daily_path: str, out: str, end, lookback_days: int,
            p: CcoParams | None = None) -> None:
    """Correlators of the ``lookback_days`` before ``end`` (both included).

    Exact unless ``p`` sets caps; then the edges they drop are reported.
    """
    p = p or CcoParams()
    daily = snapshots.read(spark, daily_path)
    triples = training.training_lookback(daily, end, lookback_days, p.names)
    sinks.write_corr(corr_payload(cco.cross_occurrence(triples, p)), out)
    if any(i.max_events is not None for i in p.indicators):
        for r in cco.sampling_report(triples, p).orderBy("event").collect():   # one row per event type
            print(f"{r.event}: {r.edges} edges, {r.kept} kept, {r.dropped} dropped by max_events")
    drop_stored(spark)


def popularity_job(spark: SparkSession, daily_path: str, out: str, end,
                   days: int = POPULARITY_DAYS, state: str | None = None) -> None:
    """The windows that end on ``end``; with ``state``, moved there from those of the last run."""
    if state is None:
        table = popularity.popularity_table(snapshots.read(spark, daily_path), end, days)
    else:
        table = popularity.table_of(rolling.advance(spark, daily_path, state, end, days))
    sinks.write_popularity(table, out)


def word_vectors_job(spark: SparkSession, catalogue_root: str, out: str) -> None:
    """Train word vectors on the catalogue's texts and keep them as a table."""
    items = similarity.item_desc(read_catalogue(spark, catalogue_root))
    snapshots.publish(word2vec.train(items, W2V_DIM, W2V_MIN_COUNT), out)
    drop_stored(spark)


def similarity_job(spark: SparkSession, catalogue_root: str, out: str,
                   k: int = NEIGHBOURS, words: str | None = None) -> None:
    """Text neighbours, by kept word vectors (``words``: their table) or newly trained ones."""
    kept = None if words is None else snapshots.read(spark, words)
    sim = similarity.text_similarity(read_catalogue(spark, catalogue_root), k, words=kept)
    sinks.write_similarity(similarity_payload(sim), out)
    drop_stored(spark)


def serving_job(spark: SparkSession, catalogue_root: str, corr_path: str, pop_path: str,
                sim_path: str, out: str, update_time: str) -> DataFrame:
    cat = read_catalogue(spark, catalogue_root)
    corr = snapshots.read(spark, corr_path).selectExpr(
        "event", "CAST(product_id AS BIGINT) AS product_id", "corr_payload")
    pop = snapshots.read(spark, pop_path).selectExpr(
        "CAST(product_id AS BIGINT) AS product_id", "* EXCEPT (product_id)")
    sim = snapshots.read(spark, sim_path).selectExpr(
        "CAST(product_id AS BIGINT) AS product_id", "cat_path", "text_corr_payload")
    rows = serving.serving_table(serving.outcome(cat.products, corr, update_time), pop, sim)
    sinks.write_serving(rows, out)
    return rows


def _session() -> SparkSession:
    b = SparkSession.builder.appName("affinity").config("spark.ui.enabled", "false")
    for k, v in CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_cluster_sizing(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _indicator(text: str) -> Indicator:
    """``order``, ``order:3000`` or ``order:3000:300``."""
    name, cap, k = (text.split(":") + ["", ""])[:3]
    return Indicator(name, int(cap or 0) or None, int(k or INDICATOR_MAX_CORRELATORS))


def cco_params(a) -> CcoParams:
    """Parameters of the cco command: exact, the original's defaults, or a list of event types."""
    p = cco_default_params() if a.default_params else CcoParams()
    changes = {"min_events": a.min_events}
    if a.indicator:
        changes["indicators"] = tuple(_indicator(x) for x in a.indicator)
    if a.seed is not None:
        changes["seed"] = a.seed
    return dataclasses.replace(p, **changes)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="affinity.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    e = sub.add_parser("etl")
    e.add_argument("--logs", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--day")
    e.add_argument("--start")
    e.add_argument("--end")
    e.add_argument("--sites", required=True, help="comma-separated site allow-list")
    e.add_argument("--append", action="store_true")
    e.add_argument("--backfill", action="store_true",
                   help="days from --start to --end that are not done yet, a week at a time")
    e.add_argument("--time-zone", default="UTC", help="zone of the logs' calendar days")
    e.add_argument("--bucketed", action="store_true", help="--logs holds tables of the bucket job")
    b = sub.add_parser("bucket")
    b.add_argument("--logs", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--buckets", type=int, default=bucketed.BUCKETS)
    b.add_argument("--hot-rows", type=int, default=bucketed.HOT_ROWS, help="rows of a day from which a session is kept apart")
    b.add_argument("--period", choices=bucketed.PERIODS, default="day", help="days of one partition")
    b.add_argument("--time-zone", default="UTC", help="zone of the orders' calendar days")
    c = sub.add_parser("cco")
    c.add_argument("--daily", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--end", default=str(dt.date.today()))
    c.add_argument("--lookback", type=int, required=True)
    c.add_argument("--default-params", action="store_true",
                   help="cap events per user and item at 500 and report what that drops (default: exact)")
    c.add_argument("--indicator", action="append", metavar="EVENT[:MAX_EVENTS[:MAX_CORRELATORS]]",
                   help="an event type with its caps, in order of priority; MAX_EVENTS 0: exact; "
                        f"e.g. order:{INDICATOR_MAX_EVENTS}:{INDICATOR_MAX_CORRELATORS}")
    c.add_argument("--min-events", type=int, default=1, help="distinct primary items a user needs")
    c.add_argument("--seed", type=int, help="of the sampler that applies the caps")
    p = sub.add_parser("popularity")
    p.add_argument("--daily", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--end", required=True)
    p.add_argument("--days", type=int, default=POPULARITY_DAYS)
    p.add_argument("--state", help="folder of the window sums: only days that enter or leave a window are read")
    wv = sub.add_parser("words")
    wv.add_argument("--catalogue", required=True)
    wv.add_argument("--out", required=True)
    s = sub.add_parser("similarity")
    s.add_argument("--catalogue", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--words", help="word vectors kept by the words job (default: train)")
    v = sub.add_parser("serving")
    for a in ("--catalogue", "--corr", "--popularity", "--similarity", "--out",
              "--update-time"):
        v.add_argument(a, required=True)
    a = ap.parse_args(argv)
    spark = _session()
    if a.job == "etl":
        p = EtlParams(sites=tuple(a.sites.split(",")), time_zone=a.time_zone)
        if a.backfill and a.bucketed:
            raise SystemExit("--backfill reads plain logs")
        if a.backfill:
            print(f"{etl_backfill(spark, a.logs, a.out, p, a.start, a.end)} days computed")
            return
        etl_job(spark, a.logs, a.out, p, a.day,
                a.start, a.end, "append" if a.append else "overwrite", a.bucketed)
    elif a.job == "bucket":
        bucket_job(spark, a.logs, a.out, a.buckets, a.hot_rows, a.time_zone, a.period)
    elif a.job == "cco":
        cco_job(spark, a.daily, a.out, a.end, a.lookback, cco_params(a))
    elif a.job == "popularity":
        popularity_job(spark, a.daily, a.out, a.end, a.days, a.state)
    elif a.job == "similarity":
        similarity_job(spark, a.catalogue, a.out, words=a.words)
    elif a.job == "words":
        word_vectors_job(spark, a.catalogue, a.out)
    else:
        serving_job(spark, a.catalogue, a.corr, a.popularity, a.similarity, a.out,
                    a.update_time)


if __name__ == "__main__":
    main()
