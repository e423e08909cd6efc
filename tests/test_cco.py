"""Cross-occurrence: hand-worked cases and properties."""

from pyspark.sql import functions as F

from affinity.operators import cooccurrence as cco
from affinity.params import CcoParams, Indicator


def _triples(spark, rows):
    return spark.createDataFrame([(e, u, p, 1) for e, u, p in rows],
                                 "event string, user_id long, product_id long, event_uvs long")


def _rows(df):
    return {(r.event, r.product_id, r.other_id): r for r in df.collect()}


ROWS = [("order", 1, 10), ("order", 1, 11), ("cart", 1, 10), ("cart", 1, 12),
        ("order", 2, 10), ("order", 2, 11), ("cart", 2, 13),
        ("order", 3, 12), ("cart", 3, 12), ("click", 3, 14),
        ("order", 4, 13), ("cart", 4, 11),
        ("cart", 9, 10), ("cart", 9, 11)]           # user 9: no primary event


def test_self_pair_rules_and_user_restriction(spark):
    res = _rows(cco.cooccurrence_counts(_triples(spark, ROWS), CcoParams()))
    # same product in order and cart: kept in the cart list, not in its own order list
    assert ("cart", 10, 10) in res and ("order", 10, 10) not in res
    # N counts primary users only; user 9 (cart only) contributes nothing
    assert {r.n for r in res.values()} == {4}
    # nobody but user 9 has 11 in the cart beside 10, so that pair does not exist
    assert ("cart", 10, 11) not in res and res[("cart", 11, 10)].k11 == 1
    assert all(r.k11 <= min(r.a, r.b) for r in res.values())


def test_primary_cooccurrence_is_symmetric(spark):
    res = _rows(cco.cooccurrence_counts(_triples(spark, ROWS), CcoParams()))
    prim = {k: r for k, r in res.items() if k[0] == "order"}
    for (e, x, y), r in prim.items():
        s = prim[(e, y, x)]
        assert (r.k11, r.llr) == (s.k11, s.llr) and (r.a, r.b) == (s.b, s.a)


def test_empty_primary_falls_back_to_next_event(spark):
    t = _triples(spark, [r for r in ROWS if r[0] != "order"])
    res = cco.cross_occurrence(t, CcoParams()).collect()
    assert {r.event for r in res} <= {"cart", "click"}
    assert any(r.event == "cart" for r in res)
    assert all(not (r.event == "cart" and r.product_id == r.other_id) for r in res)


def test_rank_bounded_and_ties_by_id(spark):
    p = CcoParams(indicators=(Indicator("order", 3000, 1), Indicator("cart", 3000, 2)))
    res = cco.cross_occurrence(_triples(spark, ROWS), p).collect()
    for r in res:
        assert r.rank <= (1 if r.event == "order" else 2)
    by = {}
    for r in res:
        by.setdefault((r.event, r.product_id), []).append((r.rank, -r.llr, r.other_id))
    for lst in by.values():
        assert [x[1:] for x in sorted(lst)] == sorted(x[1:] for x in lst)


def test_sampling_is_repeatable_and_caps_users(spark, duck_small):
    from affinity.plans.queries import _triples as q_triples
    t = q_triples(spark, "/root/testdata/sf0.01")
    p = CcoParams(indicators=(Indicator("order", 5), Indicator("cart", 5),
                              Indicator("wish", 5), Indicator("click", 5)))
    a = cco.sampled_edges(t, p).select(*cco.EDGE)
    b = cco.sampled_edges(t, p).select(*cco.EDGE)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    full = cco.sampled_edges(t, CcoParams()).count()
    assert a.count() < full


def test_salting_hot_users_does_not_change_results(spark):
    from affinity.plans.queries import _triples as q_triples
    t = q_triples(spark, "/root/testdata/sf0.001")
    base = cco.cross_occurrence(t, CcoParams())
    salted = cco.cross_occurrence(t, CcoParams(hot_user_items=1))   # every user split
    assert base.exceptAll(salted).count() == 0 and salted.exceptAll(base).count() == 0


def test_min_events_filters_users(spark):
    p = CcoParams(min_events=2)
    e = cco.edges(_triples(spark, ROWS), p)
    users = cco.primary_users(e, cco.primary_event(e, p), p)
    assert sorted(r.user_id for r in users.collect()) == [1, 2]
    r = cco.restricted(e, users)
    assert r.where(F.col("user_id").isin(3, 4, 9)).count() == 0


def test_exact_by_default_and_caps_are_reported(spark):
    assert all(i.max_events is None for i in CcoParams().indicators)
    t = _triples(spark, [("order", u, 1) for u in range(40)])
    exact = cco.sampling_report(t, CcoParams()).collect()
    assert [(r.edges, r.kept, r.dropped) for r in exact] == [(40, 40, 0)]
    capped = cco.sampling_report(t, CcoParams(indicators=(Indicator("order", 4),))).first()
    assert capped.edges == 40 and capped.dropped > 0 and capped.kept + capped.dropped == 40


def test_only_primary_and_only_cross_split_the_result(spark):
    t = _triples(spark, ROWS)
    every = cco.cross_occurrence(t, CcoParams())
    parts = [cco.cross_occurrence(t, CcoParams(), only=o) for o in ("primary", "cross")]
    union = parts[0].unionByName(parts[1])
    assert every.exceptAll(union).count() == 0 and union.exceptAll(every).count() == 0
    assert {r.event for r in parts[0].collect()} == {"order"}
