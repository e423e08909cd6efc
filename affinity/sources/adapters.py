"""Adapters from the driver's test tables to the pipeline's input tables.

The pipeline reads shop logs and a catalogue; the test data is a TPC-H-like
star schema plus an ``events`` table.  Each adapter is a plain projection
(plus the joins a log row needs), so the oracle SQL can repeat it.

A. ``events``  -> daily user-product events (training, CCO, popularity).
B. ``orders`` + ``lineitem`` + ``part`` -> the five raw log tables (ETL), and
   a larger daily-event table for cross-occurrence at scale.
C. ``embeddings`` -> item vectors; ``part`` -> catalogue and item text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from .tables import CatalogueTables, LogTables, read_parquet

# Adapter A: driver event types -> pipeline event names ("error" stays as is
# and is dropped later as an unknown event type).
EVENT_TYPE_MAP = (("purchase", "order"), ("signup", "cart"), ("view", "wish"), ("click", "click"))
# Adapter B: (l_returnflag, l_linestatus) -> log action kind.
LINE_KIND_MAP = ((("N", "F"), "order"), (("N", "O"), "cart"), (("R", None), "wish"),
                 (("A", None), "view"))
# Adapter B for cross-occurrence at scale: l_returnflag -> event.
RETURNFLAG_EVENT_MAP = (("N", "order"), ("A", "cart"), ("R", "wish"))


def _case(col: Column, pairs, default: Column | None = None) -> Column:
    expr = None
    for k, v in pairs:
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(default) if default is not None else expr


def events_daily(spark: SparkSession, root: str) -> DataFrame:
    """Adapter A: ``events`` as the daily event table.

    sess_id = event_id, product_id = props.k, event mapped from event_type,
    event_uv = 1, event_time = the event's calendar day.
    """
    ev = read_parquet(spark, root, "events")
    return ev.select(
        F.col("event_id").alias("sess_id"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("product_id"),
        _case(F.col("event_type"), EVENT_TYPE_MAP, F.col("event_type")).alias("event"),
        F.lit(1).alias("event_uv"),
        F.col("ts").cast("date").alias("event_time"),
    )


def _line_actions(spark: SparkSession, root: str) -> DataFrame:
    o = read_parquet(spark, root, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    li = read_parquet(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    p = read_parquet(spark, root, "part").select("p_partkey", "p_name")
    kind = None
    for (flag, status), k in LINE_KIND_MAP:
        cond = F.col("l_returnflag") == flag
        if status is not None:
            cond = cond & (F.col("l_linestatus") == status)
        kind = F.when(cond, k) if kind is None else kind.when(cond, k)
    day = F.col("o_orderdate").cast("date")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, li.l_partkey == p.p_partkey, "left")
            .select(F.col("l_orderkey").alias("sess_id"),
                    F.col("l_partkey").alias("products_id"),
                    day.alias("dctime"),
                    F.col("o_orderpriority").alias("site"),
                    F.col("p_name").alias("r_position"),
                    F.col("o_orderstatus").alias("orders_status"),
                    (F.unix_date(day).cast("bigint") * 86400).alias("add_time"),
                    kind.alias("kind")))


def orders_logs(spark: SparkSession, root: str, keep: bool = False) -> LogTables:
    """Adapter B: an order is a session, its lines are logged actions.

    ``keep``: the joined lines are written, for readers that scan whole log tables several times.
    """
    o = read_parquet(spark, root, "orders")
    session = o.select(F.col("o_orderkey").alias("sess_id"),
                       F.col("o_custkey").alias("customers_id"),
                       F.col("o_orderdate").cast("date").alias("dctime"))
    lines = _line_actions(spark, root)
    lines = stored(lines, "log_lines") if keep else lines
    base = ["sess_id", "products_id", "dctime", "site"]
    action = lines.select(*base, F.col("kind").alias("com"), "r_position")
    operate = lines.select(*base, F.col("kind").alias("operating"), "r_position")
    orders = lines.where(F.col("kind") == "order").select(
        "sess_id", "products_id", "add_time", "site", "orders_status", "r_position")
    return LogTables(session, action, operate, operate, orders)


# Filters that select adapter B's rows the way the production lists select
# production rows (used by tests, queries and the benchmark).
ORDERS_SITES = ("1-URGENT", "2-HIGH")
ORDERS_POSITION_REGEX = ".*(ring|bolt).*"
ORDERS_STATUS_DENY = ("P",)


def lineitem_daily(spark: SparkSession, root: str) -> DataFrame:
    """Adapter B as a daily event table: customer x part, event by return flag."""
    o = read_parquet(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_parquet(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("sess_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        _case(F.col("l_returnflag"), RETURNFLAG_EVENT_MAP).alias("event"),
        F.lit(1).alias("event_uv"),
        F.col("o_orderdate").cast("date").alias("event_time"),
    )


def embedding_vectors(spark: SparkSession, root: str) -> DataFrame:
    """Adapter C: ``embeddings`` as item vectors; the label is the category."""
    e = read_parquet(spark, root, "embeddings")
    label = F.col("label").cast("string")
    return e.select(F.col("vec_id").alias("product_id"), label.alias("cat_path"),
                    label.alias("cat4cat"),
                    F.col("embedding").cast("array<double>").alias("vec"))


def repeated_vectors(spark: SparkSession, root: str) -> DataFrame:
    """Adapter C with four vectors per item and two categories: every item has
    several vectors in one category path."""
    e = read_parquet(spark, root, "embeddings")
    label = (F.col("label") % 2).cast("string")
    return e.select(F.floor(F.col("vec_id") / 4).cast("bigint").alias("product_id"), label.alias("cat_path"),
                    label.alias("cat4cat"), F.col("embedding").cast("array<double>").alias("vec"))


def hashed_word_vectors(items: DataFrame, dim: int = 8) -> DataFrame:
    """(word, vec): a vector per distinct word whose components are md5 digits
    (stands in for trained vectors where a result must be reproducible)."""
    words = items.select(F.explode("text").alias("word")).distinct()
    part = [(F.conv(F.substring(F.md5(F.concat(F.col("word"), F.lit(f"|{i}"))), 1, 8), 16, 10).cast("double")
             / F.lit(4294967296.0) - F.lit(0.5)) for i in range(dim)]
    return words.select("word", F.array(*part).alias("vec"))


def part_catalogue(spark: SparkSession, root: str) -> CatalogueTables:
    """Adapter C: ``part`` as the catalogue; cat_path = type-brand number."""
    p = read_parquet(spark, root, "part")
    desc = p.select(F.col("p_partkey").alias("products_id"),
                    F.col("p_name").alias("products_name"))
    cats = p.select(F.col("p_partkey").alias("products_id"),
                    F.concat_ws("-", "p_type", F.regexp_replace("p_brand", "#", ""))
                    .alias("cat_path"))
    prods = p.select(F.col("p_partkey").alias("products_id"))
    return CatalogueTables(desc, cats, prods)
