"""The blocked product, its bound and its paths against brute force."""

import dataclasses
import math

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from affinity.operators import cooccurrence as cco
from affinity.operators import pairs
from affinity.params import CcoParams, Indicator, cco_default_params
from affinity.plans.queries import SAMPLED

from .conftest import SF_SMALL
from .test_cco_bruteforce import _llr, brute


def test_llr_on_arrays_is_the_formula():
    rng = np.random.default_rng(1)
    for _ in range(500):
        n = int(rng.integers(1, 50))
        a, b = (int(rng.integers(1, n + 1)) for _ in range(2))
        k = int(rng.integers(max(0, a + b - n), min(a, b) + 1))
        got = pairs.llr_values(np.array([k]), np.array([a]), np.array([b]), n)[0]
        assert math.isclose(got, _llr(k, a, b, n), abs_tol=1e-9)


def test_independence_is_exact_beyond_64_bits():
    k, a, b = np.array([3, 3, 0]), np.array([3 << 30, 3 << 30, 1]), np.array([1 << 40, (1 << 40) + 1, 1])
    n = 1 << 70
    assert pairs.independent_values(k, a, b, n).tolist() == [True, False, False]
    assert pairs.independent_values(np.array([1, 1]), np.array([2, 2]), np.array([3, 4]), 6).tolist() == [True, False]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.data())
def test_no_pair_beats_the_bound_and_the_floor_is_the_first_to_reach_it(n, data):
    a = data.draw(st.integers(1, n))
    bound = [0.0] + [pairs.upper_bound(a, b, n) for b in range(1, n + 1)]
    for b in range(1, n + 1):
        for k in range(max(1, a + b - n), min(a, b) + 1):
            assert _llr(k, a, b, n) <= bound[b] + 1e-9
    score = data.draw(st.one_of(st.just(float("nan")), st.floats(0, 2 * max(bound) + 1)))
    got = int(pairs.floor_of(np.array([a]), np.array([score]), n)[0])
    goal = -1.0 if math.isnan(score) else score - 1e-5 - 1e-9 * score
    want = next((b for b in range(1, n + 1) if bound[b] >= goal), n + 1)
    # never beyond the first b that reaches it, and nothing below it reaches it
    assert got <= want and (got == want or goal <= 0 or abs(bound[want] - goal) < 1e-6), (a, n, score)


def _block(rng, users, items, floor=None):
    left = sorted({(int(u), 0, 0, int(i)) for u, i in zip(rng.integers(0, users, 80), rng.integers(0, items, 80))})
    right = sorted({(int(u), 0, 0, int(e), int(i)) for u, e, i in
                    zip(rng.integers(0, users, 160), rng.integers(0, 2, 160), rng.integers(0, items, 160))})
    per_x, per_y = {}, {}
    for r in left:
        per_x[r[3]] = per_x.get(r[3], 0) + 1
    for r in right:
        per_y[r[3], r[4]] = per_y.get((r[3], r[4]), 0) + 1
    lt = pa.table({"user_id": [r[0] for r in left], "ba": [0] * len(left), "bb": [0] * len(left),
                   "x": [r[3] for r in left], "a": [per_x[r[3]] for r in left], "parts": [1] * len(left),
                   "floor": pa.array([floor] * len(left), pa.list_(pa.float64()))})
    rt = pa.table({"user_id": [r[0] for r in right], "ba": [0] * len(right), "bb": [0] * len(right),
                   "ev": pa.array([r[3] for r in right], pa.int8()), "y": [r[4] for r in right],
                   "b": [per_y[r[3], r[4]] for r in right], "own": [r[3] == 0 for r in right]})
    want = {}
    for u, _, _, x in left:
        for v, _, _, e, y in right:
            if u == v and not (e == 0 and x == y):
                want[e, x, y] = want.get((e, x, y), 0) + 1
    return lt, rt, want, per_x, per_y


def test_a_block_holds_every_pair_once():
    rng = np.random.default_rng(3)
    for chunk in (1, 7, 1 << 20):
        left, right, want, per_x, per_y = _block(rng, 12, 9)
        items, _, ev, x, y, a, b, c = pairs.multiply(left, right, 12, chunk)
        got = {(int(e), int(items[i]), int(items[j])): int(n) for e, i, j, n in zip(ev, x, y, c)}
        assert got == want and len(got) == len(ev)
        assert [per_x[int(items[i])] for i in x] == a.tolist()
        assert [per_y[int(e), int(items[j])] for e, j in zip(ev, y)] == b.tolist()


def test_a_floor_skips_only_what_cannot_reach_it():
    rng = np.random.default_rng(5)
    n, floor = 40, [40.0, float("nan")]
    left, right, want, per_x, per_y = _block(rng, n, 6, floor)
    items, _, ev, x, y, *_, c = pairs.multiply(left, right, n)
    got = {(int(e), int(items[i]), int(items[j])): int(k) for e, i, j, k in zip(ev, x, y, c)}
    assert all(want[p] == k for p, k in got.items()) and len(got) < len(want)
    for (e, i, j), k in want.items():
        if (e, i, j) not in got:
            assert e == 0 and _llr(k, per_x[i], per_y[e, j], n) < floor[0]


def _long_tail(spark, users=400, items=300, seed=2):
    """Items whose users fall off as a power of their rank."""
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, items + 1) ** 1.1
    edges = {(str(rng.choice(["order", "cart"])), u, int(i)) for u in range(users)
             for i in rng.choice(items, 12, p=p / p.sum())}
    return sorted(edges), spark.createDataFrame([(*e, 1) for e in sorted(edges)],
                                                "event string, user_id long, product_id long, event_uvs long")


def _rows(df):
    return sorted((r.event, r.product_id, r.other_id, r.rank) for r in df.collect())


def test_pruning_and_splitting_change_no_row(spark):
    edges, df = _long_tail(spark)
    for k in (3, 20, 300):
        inds = (Indicator("order", None, k), Indicator("cart", None, k + 1))
        want = [x[:3] + x[4:] for x in brute(edges, CcoParams(indicators=inds))]
        for p in (CcoParams(indicators=inds, prune=0.0), CcoParams(indicators=inds, prune=1.5),
                  CcoParams(indicators=inds, prune=0.0, block_pairs=500),
                  CcoParams(indicators=inds, prune=1.5, block_pairs=700, hot_user_items=3)):
            assert _rows(cco.cross_occurrence(df, p)) == want, (k, p)


def test_fewer_pairs_are_counted_with_the_bound(spark, monkeypatch):
    """The same rows from fewer pairs: the entries of the packed blocks."""
    counted = []
    real = pairs.best

    def spy(blocks, *args):
        counted[-1] += blocks.select(F.sum(F.size("c"))).first()[0] or 0
        return real(blocks, *args)

    monkeypatch.setattr(pairs, "best", spy)
    # 30 sets of 8 items that go together, and many items of one or two users
    rng = np.random.default_rng(9)
    edges = sorted({("order", u, i) for u in range(600)
                    for i in [*range(u % 30 * 8, u % 30 * 8 + 8), *rng.integers(1000, 9000, 8).tolist()]})
    df = spark.createDataFrame([(*e, 1) for e in edges],
                               "event string, user_id long, product_id long, event_uvs long")
    inds = (Indicator("order", None, 5),)
    rows = []
    for prune in (0.0, 1.5):
        counted.append(0)
        rows.append(_rows(cco.cross_occurrence(df, CcoParams(indicators=inds, prune=prune))))
    assert rows[0] == rows[1] and counted[1] < 0.85 * counted[0], counted


def test_blocks_send_arrays_not_pairs(spark):
    """On order lines: a packed row per block and bucket, holding all pairs."""
    from affinity.operators import training
    from affinity.sources import adapters as ad
    p = CcoParams()
    s = cco.sides(training.training_triples(ad.lineitem_daily(spark, SF_SMALL)), p)
    blocks = cco._product(s, s.primary, s.partners, p)
    rows, entries = blocks.agg(F.count(F.lit(1)), F.sum(F.size("c"))).first()
    per_user = (s.primary.select("user_id").join(s.partners.select("user_id", "own"), "user_id").count()
                - s.primary.count())
    assert entries <= per_user and rows < per_user / 1000, (rows, entries, per_user)


def test_one_user_with_very_long_lists(spark):
    """3,000 x 3,000 pairs of one user, cut into cells and dealt over blocks."""
    df = (spark.range(3000).select(F.lit("order").alias("event"), F.lit(1).cast("long").alias("user_id"),
                                   F.col("id").alias("product_id"))
          .unionByName(spark.range(50).select(F.lit("order").alias("event"), (F.col("id") + 2).alias("user_id"),
                                              F.col("id").alias("product_id"))))
    p = CcoParams(indicators=(Indicator("order", None, 4),))
    s = cco.sides(df, p)
    assert s.blocks >= 8
    c = pairs.counts(cco._product(s, s.primary, s.partners, p), s.item)
    assert c.agg(F.count(F.lit(1)), F.sum("k11"), F.min("k11")).first() == (3000 * 2999, 3000 * 2999, 1)


def test_string_ids(spark):
    edges, df = _long_tail(spark, users=60, items=30)
    p = CcoParams(indicators=(Indicator("order", None, 4), Indicator("cart", None, 4)), prune=1.5)
    text = df.select("event", F.concat(F.lit("u"), "user_id").alias("user_id"),
                     F.lpad(F.col("product_id").cast("string"), 4, "0").alias("product_id"), "event_uvs")
    got = [(e, int(x), int(y), k) for e, x, y, k in _rows(cco.cross_occurrence(text, p))]
    assert sorted(got) == [x[:3] + x[4:] for x in brute(edges, p)]


def test_no_edges(spark):
    df = spark.createDataFrame([], "event string, user_id long, product_id long, event_uvs long")
    assert cco.cross_occurrence(df, CcoParams()).collect() == []
    assert cco.cooccurrence_counts(df, CcoParams()).collect() == []


def test_packed_pairs_take_few_bytes_and_come_back_whole():
    import pyarrow as pa

    r = np.random.default_rng(8)
    for item, far in ((pa.int64(), 1), (pa.int64(), (1 << 62) // 2500), (pa.string(), 1)):
        def ids(v):
            return pa.array((v - 2500) * far, item) if item == pa.int64() else pa.array([f"i{k}" for k in v], item)

        user, x, y = np.repeat(np.arange(60), 15), r.integers(0, 5000, 900), r.integers(0, 5000, 900)
        zero = pa.array(np.zeros(900, np.int32))
        left = pa.table({"user_id": user, "ba": zero, "bb": zero, "x": ids(x), "a": r.integers(1, 90, 900),
                         "parts": np.ones(900, np.int64), "floor": pa.nulls(900, pa.list_(pa.float64()))})
        right = pa.table({"user_id": user, "ba": zero, "bb": zero, "ev": pa.array(np.zeros(900, np.int8)), "y": ids(y),
                          "b": r.integers(1, 90, 900), "own": pa.array(np.zeros(900, bool))})
        items, _, ev, px, py, a, b, c = pairs.multiply(left, right, 60)
        packed = pairs._packer(60, 3, item)(left, right)
        got = [v for k in range(3) for v in zip(*pairs._unpacked(packed.filter(pa.compute.equal(packed["bucket"], k)))[:6],
                                                strict=True)]
        assert sorted(got) == sorted(zip(ev, items[px], items[py], a, b, c, strict=True)) and len(got) > 13_000
        if item == pa.int64() and far == 1:
            assert packed.nbytes < 12 * len(got), packed.nbytes / len(got)


def test_a_block_whose_items_meet_only_themselves_is_empty():
    user, zero, one = np.arange(20), np.zeros(20, np.int32), np.ones(20, np.int64)
    left = pa.table({"user_id": user, "ba": zero, "bb": zero, "x": user, "a": one, "parts": one,
                     "floor": pa.nulls(20, pa.list_(pa.float64()))})
    right = pa.table({"user_id": user, "ba": zero, "bb": zero, "ev": pa.array(zero, pa.int8()), "y": user, "b": one,
                      "own": pa.array(np.ones(20, bool))})
    for chunk in (1, 7, 1 << 20):
        assert pairs.multiply(left, right, 20, chunk) is None
    packed = pairs._packer(20, 3, pa.int64())(left, right)
    assert len(packed) == 0 and packed.schema.names == ["bucket", "ev", "x", "a", "m", "y", "b", "c"]


def test_default_caps_may_leave_users_with_one_item(spark):
    """Few of an item's many users stay, so whole blocks have no pair."""
    edges = sorted({(ev, u, (u * s + k) % 5) for u in range(300) for k in range(2)
                    for ev, s in (("order", 1), ("cart", 3))})
    df = spark.createDataFrame([(*e, 1) for e in edges], "event string, user_id long, product_id long, event_uvs long")
    p = dataclasses.replace(cco_default_params(max_events=40), block_pairs=30)
    assert cco.sides(df, p).blocks >= 30
    assert _rows(cco.cross_occurrence(df, p)) == [x[:3] + x[4:] for x in brute(edges, p)]


def test_small_caps_per_event_may_leave_users_with_one_item(spark):
    """The caps of ``cco_sampled`` on items of many users, with and without the bound."""
    edges = sorted({(ev, u, (u * s + k) % 6) for u in range(400) for k in range(3)
                    for ev, s in (("order", 1), ("cart", 2), ("wish", 4), ("click", 5))})
    df = spark.createDataFrame([(*e, 1) for e in edges], "event string, user_id long, product_id long, event_uvs long")
    for prune in (0.0, 1.0):
        p = dataclasses.replace(SAMPLED, block_pairs=200, prune=prune)
        want = [x[:3] + x[4:] for x in brute(edges, p)]
        assert _rows(cco.cross_occurrence(df, p)) == want and len(want) > 4
