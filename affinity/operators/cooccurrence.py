"""Correlated cross-occurrence (CCO) with log-likelihood ratio scoring.

Input: training edges (event, user_id, product_id).  With A the primary
event's user x item matrix and B any event's (A included), the job scores
every (primary item x, B item y) pair by the LLR of how often users who have
x also have y, and keeps the top-k partners per (event, x).

The plan is a handful of shuffles on edge tables plus one blocked product:

1. primary event = first configured event type with data (scalar subquery);
2. U = users with >= min_events primary items, N = |U| (scalar subquery);
   every event is restricted to U by one join that also carries the user's
   item count per event type (a map with one entry per type);
3. the counts are exact.  Only where an event type has a cap is each of its
   edges hash-sampled with rate min(1, cap/items(user), cap/users(item))
   (counts before sampling); ``sampling_report`` counts what that drops;
4. users per item (a for A, b for B), carried on the edges so the pair table
   never joins a count table;
5. A'B block by block of users (``pairs``), counts combined in task memory
   before they are shuffled as arrays.  A user's pair
   work is split over a grid of (primary bucket, other bucket) cells once either list is
   long, so no cell holds more than hot_user_items**2 pairs;
6. where an event's items differ much in their users, the partners with most
   users come first; the k-th score they give an item is the floor below which, by an exact bound,
   the other partners are never paired;
7. drop exactly independent pairs, LLR rounded to 5 places, ranked by
   (llr desc, partner id) with a row_number limit (window group limit).

Skew: user and item counts are written tables, so the joins that attach them
are plain exchanges on both sides, which adaptive execution splits where one
user or item holds a large share of the edges (an aggregate between exchange
and join would prevent that).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.llr import llr
from ..functions.sampling import keep_sampled, sample_hash
from ..params import CcoParams
from ..session import stored
from . import pairs

EDGE = ("event", "user_id", "product_id")


def _by_event(event: Column, values: dict, cast: str = "int") -> Column:
    expr = None
    for name, v in values.items():
        expr = F.when(event == name, F.lit(v)) if expr is None else expr.when(event == name, F.lit(v))
    return expr.cast(cast)


def _keep(df: DataFrame, p: CcoParams, name: str) -> DataFrame:
    return stored(df, name) if p.checkpoint else df


def edges(triples: DataFrame, p: CcoParams) -> DataFrame:
    """Distinct (event, user, item) edges of the configured event types."""
    return (triples.where(F.col("event").isin(list(p.names))
                          & F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
            .select(*EDGE).distinct())


def primary_event(e: DataFrame, p: CcoParams) -> Column:
    """First configured event type that has edges (NULL when there are none).

    A one-value scalar subquery: its size is bounded by construction.
    """
    prio = _by_event(F.col("event"), {n: i for i, n in enumerate(p.names)})
    return e.select(F.min_by("event", prio)).scalar()


def _primary_user_counts(e: DataFrame, primary: Column, p: CcoParams) -> DataFrame:
    """(user_id, n_primary, n_by_event) of the primary users.

    ``n_by_event`` maps each event type to the user's number of items in it
    (at most one entry per configured event type, so the per-user group is
    bounded).  Carrying it through the restriction join gives the sampler
    its items-per-user count without another shuffle of the edges.
    """
    per = e.groupBy("user_id", "event").agg(F.count(F.lit(1)).alias("c"))
    m = per.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event", "c"))).alias("n_by_event"))
    n_primary = F.coalesce(F.element_at("n_by_event", primary), F.lit(0).cast("long"))
    return (m.select("user_id", n_primary.alias("n_primary"), "n_by_event")
            .where(F.col("n_primary") >= max(1, p.min_events)))


def primary_users(e: DataFrame, primary: Column, p: CcoParams) -> DataFrame:
    """(user_id, n_primary) of users with at least ``min_events`` primary items."""
    return _primary_user_counts(e, primary, p).select("user_id", "n_primary")


def restricted(e: DataFrame, users: DataFrame) -> DataFrame:
    """Every event restricted to the primary users; carries their counts."""
    return e.join(users, "user_id").select(
        *EDGE, *[c for c in users.columns if c != "user_id"])


def _item_counts(e: DataFrame, p: CcoParams, alias: str) -> DataFrame:
    """(event, product_id, alias[, work]): users per item, as a table of its own."""
    work = [F.sum("n_all").alias("work")] if "n_all" in e.columns and alias == "n_item" else []
    return _keep(e.groupBy("event", "product_id").agg(F.count(F.lit(1)).alias(alias), *work), p, alias)


def downsample(r: DataFrame, p: CcoParams) -> DataFrame:
    """Keep an edge with rate min(1, cap/items(user), cap/users(item)).

    Event types without a cap keep every edge; without any cap this is the
    identity.  Counts are per event type and taken before sampling.  Items
    per user come with the edge (``n_by_event``).
    """
    out = [c for c in r.columns if c != "n_by_event"]
    caps = {i.name: i.max_events for i in p.indicators if i.max_events is not None}
    if not caps:
        return r.select(*out)
    cap = _by_event(F.col("event"), caps, "double")
    n_u = F.element_at("n_by_event", F.col("event"))
    rate = F.least(cap / n_u, cap / F.col("n_i"))
    h = sample_hash(F.col("event"), F.col("user_id"), F.col("product_id"), p.seed)
    return (r.join(_item_counts(r, p, "n_i"), ["event", "product_id"])
            .where(cap.isNull() | keep_sampled(rate, h)).select(*out))


def with_item_counts(s: DataFrame, p: CcoParams) -> DataFrame:
    """Attach users-per-item after sampling (``n_item``) to each edge, and the
    pairs the item takes part in (``work``) where the edges know ``n_all``."""
    return s.join(_item_counts(s, p, "n_item"), ["event", "product_id"])


@dataclass(frozen=True)
class Restricted:
    """The edges of the primary users, the primary event and the users."""

    edges: DataFrame
    primary: Column
    users: DataFrame


def restrict(triples: DataFrame, p: CcoParams) -> Restricted:
    """Steps 1 and 2; each table is computed once."""
    e = _keep(edges(triples, p), p, "cco_edges")
    primary = primary_event(e, p)
    users = _keep(_primary_user_counts(e, primary, p), p, "cco_users")
    r = _keep(restricted(e, users), p, "cco_restricted")
    return Restricted(r, primary, users)


def sampled_edges(triples: DataFrame, p: CcoParams) -> DataFrame:
    """(event, user_id, product_id, n_primary) after restriction and sampling."""
    return downsample(restrict(triples, p).edges, p)


def sampling_report(triples: DataFrame, p: CcoParams) -> DataFrame:
    """(event, edges, kept, dropped) of the restricted edges of each event type."""
    r = restrict(triples, p).edges
    kept = downsample(r, p).groupBy("event").agg(F.count(F.lit(1)).alias("kept"))
    total = r.groupBy("event").agg(F.count(F.lit(1)).alias("edges"))
    k = F.coalesce("kept", F.lit(0).cast("long"))
    return total.join(kept, "event", "left").select(
        "event", "edges", k.alias("kept"), (F.col("edges") - k).alias("dropped"))


def _grid(length: Column, p: CcoParams) -> Column:
    return F.greatest(F.lit(1), F.ceil(length / F.lit(p.hot_user_items))).cast("int")


def _total(by_event: str) -> Column:
    return F.aggregate(F.map_values(by_event), F.lit(0).cast("long"), lambda s, x: s + x)


@dataclass(frozen=True)
class Sides:
    """Both matrices as edges, the number of users and of blocks, and whether
    an item has more pairs than a block.

    primary: user_id, x, a, parts, n_primary, n_all; partners: ev, user_id, y, b, own, n_primary, n_all.
    """

    primary: DataFrame
    partners: DataFrame
    n_users: int
    blocks: int
    split_items: bool

    @property
    def item(self):
        return self.primary.schema["x"].dataType


def sides(triples: DataFrame, p: CcoParams, only: str | None = None) -> Sides:
    """The counted edges.  ``only`` restricts the partner events to the ``primary``
    or the ``cross`` ones."""
    r = restrict(triples, p)
    # Edges carry the event as its small integer position (cheaper to move than the
    # name); the name is restored at the end.
    code = _by_event(F.col("event"), {name: i for i, name in enumerate(p.names)}, "tinyint")
    s = _keep(downsample(r.edges.withColumn("n_all", _total("n_by_event")), p), p, "cco_sampled")
    s = _keep(with_item_counts(s, p).select(
        code.alias("ev"), "user_id", "product_id", "n_item", "work", "n_primary", "n_all",
        (F.col("event") == r.primary).alias("own")), p, "cco_counted")
    n, work = r.users.agg(F.count(F.lit(1)), F.sum(F.col("n_primary") * _total("n_by_event"))).first()
    parts = F.ceil(F.col("work") / p.block_pairs)
    a = s.where("own").select("user_id", F.col("product_id").alias("x"), F.col("n_item").alias("a"),
                              parts.alias("parts"), "n_primary", "n_all")
    b = s if only is None else s.where("own" if only == "primary" else "not own")
    b = b.select("ev", "user_id", F.col("product_id").alias("y"), F.col("n_item").alias("b"), "own",
                 "n_primary", "n_all")
    most = s.where("own").agg(F.max("work")).first()[0] or 0
    return Sides(a, b, n, max(1, -(-(work or 0) // p.block_pairs)), most > p.block_pairs)


def _product(s: Sides, primary: DataFrame, partners: DataFrame, p: CcoParams) -> DataFrame:
    """Packed pair counts.  ``primary`` may carry ``floor``, a score per event."""
    # Both lists of a user are hashed into buckets of about hot_user_items;
    # each side is copied to the other side's buckets.
    na, nb = _grid(F.col("n_primary"), p), _grid(F.col("n_all"), p)
    block = F.pmod(F.xxhash64("user_id", "ba", "bb"), F.lit(s.blocks)).cast("int")
    floor = F.col("floor") if "floor" in primary.columns else F.lit(None).cast("array<double>")
    a = primary.select("user_id", "x", "a", "parts", floor.alias("floor"),
                       F.pmod(F.xxhash64("x"), na).cast("int").alias("ba"),
                       F.explode(F.sequence(F.lit(0), nb - 1)).alias("bb")).withColumn("block", block)
    # fresh attribute ids on one side: both come from one table
    b = partners.select(F.col("user_id").alias("user_id"), "ev", "y", "b", "own",
                        F.pmod(F.xxhash64("y"), nb).cast("int").alias("bb"),
                        F.explode(F.sequence(F.lit(0), na - 1)).alias("ba")).withColumn("block", block)
    return pairs.blocks_of(a, b, s.n_users, s.blocks, s.item)


def _heads(s: Sides, p: CcoParams) -> dict[int, int]:
    """Per event whose items differ much in their users: the users from which an item is
    one of the partners counted first (a quarter of the partner edges)."""
    if not p.prune:
        return {}
    q = s.partners.groupBy("ev").agg(F.percentile_approx("b", [0.25, 0.75]).alias("q"))
    return {r.ev: r.q[1] for r in q.collect() if r.q[1] >= p.prune * r.q[0]}      # one row per event type


def _ranked(scored: DataFrame, caps: dict[int, int]) -> DataFrame:
    """The best partners of each event and item, over all of them."""
    w = Window.partitionBy("ev", "x").orderBy(F.desc("llr"), F.asc("y"))
    # The literal bound lets Spark insert a per-partition group limit before
    # the shuffle; the per-event bound applies when caps differ.
    top = scored.select("ev", "x", "y", "llr", F.row_number().over(w).alias("rank"))
    top = top.where(F.col("rank") <= max(caps.values()))
    return top if len(set(caps.values())) == 1 else top.where(F.col("rank") <= _by_event(F.col("ev"), caps))


def _best(s: Sides, p: CcoParams) -> DataFrame:
    """(ev, x, y, llr, rank): every item's best partners."""
    caps = {i: ind.max_correlators for i, ind in enumerate(p.indicators)}

    def scored(primary, partners):
        return pairs.best(_product(s, primary, partners, p), s.n_users, s.blocks, caps, s.item)

    heads = _heads(s, p)
    if not heads:
        top = scored(s.primary, s.partners)
        if not s.split_items:
            return top.drop("whole")
        # only the items whose pairs are spread over buckets are ranked again
        top = _keep(top, p, "cco_best")
        return top.where("whole").drop("whole").unionByName(_ranked(top.where("not whole"), caps))
    first = F.col("b") >= F.coalesce(_by_event(F.col("ev"), heads, "long"), F.lit(0))
    top = _keep(_ranked(scored(s.primary, s.partners.where(first)), caps), p, "cco_heads")
    # the score an item's last place has, where all its places are taken
    floors = [F.max(F.when((F.col("ev") == i) & (F.col("rank") == k), F.col("llr"))) for i, k in caps.items()]
    floors = _keep(top.groupBy("x").agg(F.array(*floors).alias("floor")), p, "cco_floors")
    rest = scored(s.primary.join(floors, "x", "left"), s.partners.where(~first))
    return _ranked(top.drop("rank").unionByName(rest.drop("rank", "whole")), caps)


def _event_name(p: CcoParams) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in p.names]), F.col("ev") + 1)


def cooccurrence_counts(triples: DataFrame, p: CcoParams) -> DataFrame:
    """(event, product_id, other_id, k11, a, b, n, llr) for every co-occurring pair.

    ``product_id`` is the primary item, ``other_id`` the item of ``event``.
    The primary event's own diagonal (x = y) is excluded; cross events keep
    it.  ``llr`` is unrounded.
    """
    s = sides(triples, p)
    c = pairs.counts(_product(s, s.primary, s.partners, p), s.item).withColumn("n", F.lit(s.n_users).cast("long"))
    return c.select(
        _event_name(p).alias("event"), F.col("x").alias("product_id"),
        F.col("y").alias("other_id"), "k11", "a", "b", "n",
        llr(F.col("k11"), F.col("a"), F.col("b"), F.col("n")).alias("llr"))


def cross_occurrence(triples: DataFrame, p: CcoParams, only: str | None = None) -> DataFrame:
    """(event, product_id, other_id, llr, rank): top correlators per event.

    Exactly independent pairs (LLR 0) are not correlators.  Ranking is on the
    LLR rounded to 5 places with ties broken by partner id, so it is
    deterministic.  ``only`` = "primary" or "cross" computes just the primary
    event's own correlators or just the other events'.
    """
    return _best(sides(triples, p, only), p).select(
        _event_name(p).alias("event"), F.col("x").alias("product_id"), F.col("y").alias("other_id"), "llr", "rank")
