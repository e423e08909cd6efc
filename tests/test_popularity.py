"""Popularity windows and presence rules (hand-worked cases)."""

import datetime as dt

from affinity.operators import popularity as pop

D = dt.date


def _daily(spark, rows):
    return spark.createDataFrame(
        [(i, 1, p, e, 1, d) for i, (p, e, d) in enumerate(rows)],
        "sess_id long, user_id long, product_id long, event string, event_uv int, event_time date")


def test_window_boundaries_60_days():
    w = pop.Windows.of("2018-11-20", 60)
    assert w.start == D(2018, 9, 21) and w.end == D(2018, 11, 20)
    assert (w.end - w.start).days + 1 == 61            # closed window holds 61 days
    assert w.half == D(2018, 10, 21)
    assert (w.third, w.two_thirds) == (D(2018, 10, 11), D(2018, 10, 31))


def test_window_boundaries_31_days():
    w = pop.Windows.of("2018-11-20", 31)
    s = w.start
    assert w.half == s + dt.timedelta(15)
    assert (w.third, w.two_thirds) == (s + dt.timedelta(10), s + dt.timedelta(20))


def test_boundary_day_counts_in_both_neighbours(spark):
    w = pop.Windows.of("2018-11-20", 60)
    daily = _daily(spark, [(1, "order", w.half), (1, "order", w.third), (1, "order", w.two_thirds)])
    t = {r.event: r.trend for r in pop.theme_long(daily, "trend", "2018-11-20", 60).collect()}
    # half boundary in both halves: older = 2 (third, half), newer = 2 (half, two_thirds)
    assert t == {"order": 0.0}
    h = {r.event: r.hot for r in pop.theme_long(daily, "hot", "2018-11-20", 60).collect()}
    # old = 1 (third), mid = 3 (third, half, two_thirds), new = 1 (two_thirds)
    assert h == {"order": (1 - 3) - (3 - 1)}


def test_item_only_in_newer_half_has_no_trend(spark):
    w = pop.Windows.of("2018-11-20", 60)
    daily = _daily(spark, [(1, "order", w.end), (2, "order", w.start), (2, "order", w.end),
                           (2, "click", w.start), (2, "click", w.third), (2, "click", w.end)])
    assert {r.product_id for r in pop.theme_long(daily, "trend", "2018-11-20", 60).collect()} == {2}
    table = pop.popularity_table(daily, "2018-11-20", 60).collect()
    assert [r.product_id for r in table] == [2]        # product 1: pop only -> absent
    r = table[0]
    assert r.pop_order == 2.0 and r.trend_cart == 0.0 and r.hot_wish == 0.0
    # click on start, third, end: old [S, third] = 2, mid [third, 2/3] = 1, new = 1
    assert r.trend_click == 1 - 2
    assert r.hot_click == (1 - 1) - (1 - 2)


def test_unknown_event_types_vanish(spark):
    w = pop.Windows.of("2018-11-20", 60)
    daily = _daily(spark, [(1, "error", w.end), (1, "error", w.start)])
    assert pop.theme_wide(daily, "pop", "2018-11-20", 60).count() == 0
