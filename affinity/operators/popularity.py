"""Popularity, trend and acceleration ("hot") per product and event type.

For an end day E and a length of D days, with S = E - D, the windows are
closed day ranges (a boundary day counts in both neighbours):

    pop    [S, E]
    trend  older [S, S+D//2],  newer [S+D//2, E]             newer - older
    hot    older [S, S+D//3],  middle [S+D//3, S+2D//3],
           newer [S+2D//3, E]          (newer - middle) - (middle - older)

A score is the number of event rows of the product in the window.  A trend
needs the product in both windows, a hot score in all three (the original
inner-joined the windows); the four event types are then combined by a
full outer join filled with 0, and pop / trend / hot by inner joins.

All of that is one scan and ONE group-by on product with conditional sums
(null = absent from a window), so a single shuffle replaces six reads and
eleven joins.  The per-event presence rules become null checks.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import EVENT_NAMES, POPULARITY_DAYS
from .etl import DAY, _as_date

THEMES = ("pop", "trend", "hot")


@dataclass(frozen=True)
class Windows:
    start: dt.date
    end: dt.date
    half: dt.date
    third: dt.date
    two_thirds: dt.date

    @classmethod
    def of(cls, end, days: int = POPULARITY_DAYS) -> "Windows":
        e = _as_date(end)
        s = e - dt.timedelta(days=days)
        return cls(s, e, s + dt.timedelta(days=days // 2), s + dt.timedelta(days=days // 3),
                   s + dt.timedelta(days=(2 * days) // 3))

    def ranges(self) -> dict[str, tuple[dt.date, dt.date]]:
        return {
            "pop": (self.start, self.end),
            "t_old": (self.start, self.half), "t_new": (self.half, self.end),
            "h_old": (self.start, self.third), "h_mid": (self.third, self.two_thirds),
            "h_new": (self.two_thirds, self.end),
        }


def window_sums(daily: DataFrame, end, days: int = POPULARITY_DAYS,
                names=EVENT_NAMES) -> DataFrame:
    """product_id plus ``{window}_{event}`` sums (null when absent)."""
    w = Windows.of(end, days)
    day = F.col(DAY)
    d = daily.where(day.between(F.lit(w.start), F.lit(w.end))
                    & F.col("event").isin(list(names)) & F.col("product_id").isNotNull())
    aggs = []
    for e in names:
        for key, (lo, hi) in w.ranges().items():
            cond = (F.col("event") == e) & day.between(F.lit(lo), F.lit(hi))
            aggs.append(F.sum(F.when(cond, F.col("event_uv"))).cast("double").alias(f"{key}_{e}"))
    return d.groupBy("product_id").agg(*aggs)


def _scores(names) -> dict[str, Column]:
    """Raw (nullable) pop/trend/hot per event from the window sums."""
    out = {}
    for e in names:
        c = {k: F.col(f"{k}_{e}") for k in ("pop", "t_old", "t_new", "h_old", "h_mid", "h_new")}
        out[f"pop_{e}"] = c["pop"]
        out[f"trend_{e}"] = c["t_new"] - c["t_old"]
        out[f"hot_{e}"] = (c["h_new"] - c["h_mid"]) - (c["h_mid"] - c["h_old"])
    return out


def _any_present(cols) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | c.isNotNull()
    return cond


def theme_wide(daily: DataFrame, theme: str, end, days: int = POPULARITY_DAYS,
               names=EVENT_NAMES) -> DataFrame:
    """product_id + ``{theme}_{event}`` for products with >= 1 score, 0 filled."""
    sc = _scores(names)
    cols = [sc[f"{theme}_{e}"] for e in names]
    raw = window_sums(daily, end, days, names)
    return raw.where(_any_present(cols)).select(
        "product_id", *[F.coalesce(c, F.lit(0.0)).alias(f"{theme}_{e}")
                        for c, e in zip(cols, names)])


def theme_long(daily: DataFrame, theme: str, end, days: int = POPULARITY_DAYS,
               names=EVENT_NAMES) -> DataFrame:
    """(event, product_id, {theme}) for every product that has the score."""
    sc = _scores(names)
    raw = window_sums(daily, end, days, names)
    stacked = raw.select("product_id", F.explode(F.array(*[
        F.struct(F.lit(e).alias("event"), sc[f"{theme}_{e}"].alias(theme)) for e in names
    ])).alias("s"))
    return stacked.select("s.event", "product_id", f"s.{theme}").where(F.col(theme).isNotNull())


POPULARITY_COLUMNS = ("product_id",) + tuple(f"{t}_{e}" for t in THEMES for e in EVENT_NAMES)


def table_of(sums: DataFrame, names=EVENT_NAMES) -> DataFrame:
    """The popularity table of window sums (``window_sums``, or ``rolling.advance``)."""
    sc = _scores(names)
    has = {t: _any_present([sc[f"{t}_{e}"] for e in names]) for t in THEMES}
    out = [F.coalesce(sc[f"{t}_{e}"], F.lit(0.0)).alias(f"{t}_{e}") for t in THEMES for e in names]
    return sums.where(has["pop"] & has["trend"] & has["hot"]).select("product_id", *out)


def popularity_table(daily: DataFrame, end, days: int = POPULARITY_DAYS,
                     names=EVENT_NAMES) -> DataFrame:
    """product_id + pop/trend/hot x event (13 columns for the four events).

    A product is listed when it has at least one trend and one hot score
    (pop ⋈ trend ⋈ hot, inner).  Missing scores are 0.
    """
    return table_of(window_sums(daily, end, days, names), names)
