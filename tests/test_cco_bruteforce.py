"""Cross-occurrence against a brute-force Python model of the specification.

Random small edge sets (hypothesis); caps, minimum events and salting vary
so that sampling, restriction, the self-pair rule, top-k and ties all bind.
"""

import hashlib
import math
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from affinity.operators import cooccurrence as cco
from affinity.params import CcoParams, Indicator

NAMES = ("order", "cart", "wish", "click")


def _round5(x):
    return math.copysign(math.floor(abs(x) * 1e5 + 0.5) / 1e5, x)


def _llr(k11, a, b, n):
    def t(k, r, c):
        return k * math.log(k * n / (r * c)) if k > 0 else 0.0
    k12, k21, k22 = a - k11, b - k11, n - a - b + k11
    return max(0.0, 2.0 * (t(k11, a, b) + t(k12, a, n - b) + t(k21, n - a, b)
                           + t(k22, n - a, n - b)))


def brute(edges, p: CcoParams):
    names = [i.name for i in p.indicators]
    cap = {i.name: i.max_events for i in p.indicators}
    kk = {i.name: i.max_correlators for i in p.indicators}
    e = {x for x in edges if x[0] in names}
    present = [nm for nm in names if any(x[0] == nm for x in e)]
    if not present:
        return []
    prim = present[0]
    items_of = defaultdict(set)
    for ev, u, i in e:
        if ev == prim:
            items_of[u].add(i)
    users = {u for u, s in items_of.items() if len(s) >= p.min_events}
    n = len(users)
    r = [x for x in e if x[1] in users]
    nu = Counter((ev, u) for ev, u, _ in r)
    ni = Counter((ev, i) for ev, _, i in r)
    s = []
    for ev, u, i in r:
        rate = 1.0 if cap[ev] is None else min(cap[ev] / nu[(ev, u)], cap[ev] / ni[(ev, i)])
        h = int(hashlib.md5(f"{ev}|{u}|{i}|{p.seed}".encode()).hexdigest()[:8], 16)
        if rate >= 1.0 or h < rate * 4294967296.0:
            s.append((ev, u, i))
    cnt = Counter((ev, i) for ev, _, i in s)
    by_user = defaultdict(list)
    for ev, u, i in s:
        by_user[u].append((ev, i))
    k11 = Counter()
    for u, lst in by_user.items():
        for ea, x in lst:
            if ea != prim:
                continue
            for eb, y in lst:
                if eb == prim and x == y:
                    continue
                k11[(eb, x, y)] += 1
    scored = defaultdict(list)
    for (ev, x, y), k in k11.items():
        a, b = cnt[(prim, x)], cnt[(ev, y)]
        if k * n == a * b:
            continue
        scored[(ev, x)].append((-_round5(_llr(k, a, b, n)), y))
    out = []
    for (ev, x), lst in scored.items():
        for rank, (neg, y) in enumerate(sorted(lst)[:kk[ev]], 1):
            out.append((ev, x, y, -neg, rank))
    return sorted(out)


edge_sets = st.lists(st.tuples(st.sampled_from(NAMES + ("error",)), st.integers(0, 7),
                               st.integers(0, 9)), min_size=1, max_size=90)


@settings(max_examples=10, deadline=None)
@given(edges=edge_sets, caps=st.tuples(st.integers(1, 6), st.integers(1, 6)),
       k=st.integers(1, 4), min_events=st.integers(1, 3), hot=st.sampled_from([1, 2, 2000]))
def test_cross_occurrence_equals_brute_force(spark, edges, caps, k, min_events, hot):
    p = CcoParams(indicators=(Indicator("order", caps[0], k), Indicator("cart", caps[1], k + 1),
                              Indicator("wish", 100, k), Indicator("click", caps[0], 3)),
                  min_events=min_events, hot_user_items=hot, checkpoint=False)
    df = spark.createDataFrame([(ev, u, i, 1) for ev, u, i in edges],
                               "event string, user_id long, product_id long, event_uvs long")
    got = sorted((r.event, r.product_id, r.other_id, r.llr, r.rank)
                 for r in cco.cross_occurrence(df, p).collect())
    exp = brute(edges, p)
    assert [g[:3] + g[4:] for g in got] == [x[:3] + x[4:] for x in exp]
    assert all(abs(g[3] - x[3]) < 1e-9 for g, x in zip(got, exp))
