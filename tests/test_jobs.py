"""End-to-end jobs through Parquet folders (sf 0.001)."""

import os

import pytest

from affinity.plans import jobs
from affinity.params import EtlParams, Indicator
from affinity.session import shared_dir
from affinity.sources import adapters as ad
from affinity.sources import sinks, snapshots

from .conftest import SF_SMALL


def test_jobs_end_to_end(spark):
    root = shared_dir(spark, "test-jobs")
    logs = ad.orders_logs(spark, SF_SMALL)
    for name in logs.__dataclass_fields__:
        getattr(logs, name).write.parquet(os.path.join(root, "logs", name))
    cat = ad.part_catalogue(spark, SF_SMALL)
    for name in cat.__dataclass_fields__:
        getattr(cat, name).write.parquet(os.path.join(root, "catalogue", name))

    p = EtlParams(sites=ad.ORDERS_SITES, position_regex=ad.ORDERS_POSITION_REGEX,
                  order_status_deny=ad.ORDERS_STATUS_DENY)
    daily_b = os.path.join(root, "daily_b")
    jobs.etl_job(spark, os.path.join(root, "logs"), daily_b, p, start="1996-01-01",
                 end="1996-12-31")
    assert snapshots.read(spark, daily_b).count() > 0

    daily = os.path.join(root, "daily")
    sinks.write_daily_events(ad.events_daily(spark, SF_SMALL), daily)
    corr, pop, sim = (os.path.join(root, x) for x in ("corr", "pop", "sim"))
    jobs.cco_job(spark, daily, corr, "2024-01-31", 30)
    jobs.popularity_job(spark, daily, pop, "2024-01-31", 30)
    jobs.similarity_job(spark, os.path.join(root, "catalogue"), sim, k=20)
    c = snapshots.read(spark, corr)
    assert c.count() > 0 and set(c.columns) == {"product_id", "corr_payload", "event"}
    assert snapshots.read(spark, pop).count() > 0
    assert snapshots.read(spark, sim).count() == 200

    out = os.path.join(root, "serving")
    jobs.serving_job(spark, os.path.join(root, "catalogue"), corr, pop, sim, out, "2024-01-31")
    rows = snapshots.read(spark, out)
    assert rows.count() == 200                      # one row per catalogue product
    assert len(rows.columns) == 24


def test_cli_popularity_and_cco(spark):
    root = shared_dir(spark, "test-cli")
    daily = os.path.join(root, "daily")
    sinks.write_daily_events(ad.events_daily(spark, SF_SMALL), daily)
    pop = os.path.join(root, "pop")
    jobs.main(["popularity", "--daily", daily, "--out", pop, "--end", "2024-01-31",
               "--days", "30"])
    assert snapshots.read(spark, pop).count() > 0
    corr = os.path.join(root, "corr")
    jobs.main(["cco", "--daily", daily, "--out", corr, "--end", "2024-01-31",
               "--lookback", "30", "--default-params"])
    assert snapshots.read(spark, corr).select("event").distinct().count() == 4


def test_cli_indicators_and_kept_word_vectors(spark):
    root = shared_dir(spark, "test-cli2")
    daily, corr, cat = (os.path.join(root, x) for x in ("daily", "corr", "catalogue"))
    sinks.write_daily_events(ad.events_daily(spark, SF_SMALL), daily)
    args = ["cco", "--daily", daily, "--out", corr, "--end", "2024-01-31", "--lookback", "30"]
    jobs.main([*args, "--indicator", "cart:3000:2", "--indicator", "order:0:3", "--min-events", "2", "--seed", "5"])
    sizes = {e: {len(r.corr_payload.split(" ")) for r in snapshots.read(spark, corr).where(f"event = '{e}'").collect()}
             for e in ("cart", "order")}
    assert max(sizes["cart"]) == 2 and max(sizes["order"]) == 3
    assert jobs._indicator("wish:3000") == Indicator("wish", 3000, 300)
    tables = ad.part_catalogue(spark, SF_SMALL)
    for name in tables.__dataclass_fields__:
        getattr(tables, name).write.parquet(os.path.join(cat, name))
    words, a, b = (os.path.join(root, x) for x in ("words", "a", "b"))
    jobs.main(["words", "--catalogue", cat, "--out", words])
    jobs.main(["similarity", "--catalogue", cat, "--out", a, "--words", words])
    jobs.main(["similarity", "--catalogue", cat, "--out", b])
    x, y = (snapshots.read(spark, t) for t in (a, b))
    assert x.count() == 200 and x.exceptAll(y).count() == 0


def test_backfill_goes_on_where_it_broke(spark, monkeypatch):
    root = shared_dir(spark, "test-backfill")
    logs = ad.orders_logs(spark, SF_SMALL)
    for name in logs.__dataclass_fields__:
        getattr(logs, name).write.parquet(os.path.join(root, "logs", name))
    p = EtlParams(sites=ad.ORDERS_SITES, position_regex=ad.ORDERS_POSITION_REGEX,
                  order_status_deny=ad.ORDERS_STATUS_DENY)
    clean, out = os.path.join(root, "clean"), os.path.join(root, "out")
    jobs.etl_job(spark, os.path.join(root, "logs"), clean, p, start="1996-01-01", end="1996-01-25")

    real, seen = jobs.etl.daily_events, []

    def third_chunk_fails(logs, p, day, start, end):
        seen.append((str(start), str(end)))
        if len(seen) == 3:
            raise RuntimeError("lost")
        return real(logs, p, day, start, end)

    monkeypatch.setattr(jobs.etl, "daily_events", third_chunk_fails)
    args = ["etl", "--logs", os.path.join(root, "logs"), "--out", out, "--sites", ",".join(ad.ORDERS_SITES),
            "--start", "1996-01-01", "--end", "1996-01-25", "--backfill"]
    backfill = lambda: jobs.etl_backfill(spark, os.path.join(root, "logs"), out, p, "1996-01-01", "1996-01-25")
    with pytest.raises(RuntimeError):
        backfill()
    assert max(snapshots.manifest(spark, out)["done"]) == "1996-01-14"
    assert backfill() == 11 and seen[3][0] == "1996-01-15"
    a, b = (snapshots.read(spark, x) for x in (clean, out))
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    seen.clear()
    jobs.main(args)
    assert seen == []                               # nothing left to do, no log is read
