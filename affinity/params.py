"""Parameters of the pipeline.

Everything a deployment may tune is a plain dataclass field with the
default the original job used.  Values that must equal the original job's
for the results to agree are listed together below, unchanged and in their
natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the original pipeline's for equal results)
# --------------------------------------------------------------------------
# Event types in priority order; the first one present is the primary event.
EVENT_NAMES: tuple[str, ...] = ("order", "cart", "wish", "click")
# Order status codes excluded by the order scan.
ORDER_STATUS_DENY: tuple[int, ...] = (1, 4, 6, 12, 17, 20, 21, 22, 23, 27)
# Recommendation positions a logged action must come from.
POSITION_REGEX: str = (
    ".*(buytogether-auto|youMayAlsoLike|home_recommend|category|categories|hot_product).*"
)
# Click scan: value of `com`; wish scan: value of `operating`; cart scan:
# values of `operating`.
CLICK_COM: str = "view"
WISH_OPERATING: tuple[str, ...] = ("wish",)
CART_OPERATING: tuple[str, ...] = ("cart", "buynow")
# Cross-occurrence: per-event caps (max events per user/item, max correlators).
INDICATOR_MAX_EVENTS: int = 3000
INDICATOR_MAX_CORRELATORS: int = 300
# Cross-occurrence without per-event parameters.
DEFAULT_MAX_EVENTS: int = 500
DEFAULT_MAX_CORRELATORS: int = 300
# Sampler seed of the per-event path; the default path uses the library's.
CCO_SEED: int = 1024
DEFAULT_CCO_SEED: int = 0xDEADBEEF
# Text similarity: Word2Vec size, min count, neighbours per item.
W2V_DIM: int = 200
W2V_MIN_COUNT: int = 0
NEIGHBOURS: int = 200
# Popularity window in days.
POPULARITY_DAYS: int = 60
# Score text: "%.5f", pairs as "id|score" joined by one space.
SCORE_FORMAT: str = "%.5f"
PAIR_SEP: str = "|"
ITEM_SEP: str = " "
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Indicator:
    """One event type in the cross-occurrence job.

    ``max_events`` caps the events of a user and of an item by sampling
    edges; ``None`` (the default) keeps every edge.
    """

    name: str
    max_events: int | None = None
    max_correlators: int = INDICATOR_MAX_CORRELATORS


def indicator_params(names=EVENT_NAMES, max_events: int | None = None) -> tuple[Indicator, ...]:
    """All event types alike: exact, or capped (the original job's list has
    ``max_events=INDICATOR_MAX_EVENTS``)."""
    return tuple(Indicator(n, max_events) for n in names)


def default_params(names=EVENT_NAMES, max_events: int | None = DEFAULT_MAX_EVENTS) -> tuple[Indicator, ...]:
    """The original job's caps where no per-event parameters are given."""
    return tuple(Indicator(n, max_events, DEFAULT_MAX_CORRELATORS) for n in names)


@dataclass(frozen=True)
class EtlParams:
    """Filters of the daily event ETL.

    ``sites`` is deployment configuration (the storefront host names whose
    logs count); it has no default, so pass your own list.  ``None`` means no
    site filter.  ``time_zone`` is the zone whose calendar day an order's unix
    time falls on; it must be the one the session logs' ``dctime`` uses.
    """

    sites: tuple[str, ...] | None = None
    position_regex: str = POSITION_REGEX
    order_status_deny: tuple = ORDER_STATUS_DENY
    click_com: str = CLICK_COM
    wish_operating: tuple[str, ...] = WISH_OPERATING
    cart_operating: tuple[str, ...] = CART_OPERATING
    time_zone: str = "UTC"


@dataclass(frozen=True)
class CcoParams:
    """Cross-occurrence parameters.

    ``indicators`` lists the event types in priority order with their caps;
    ``min_events`` is the minimum number of distinct primary items a user
    needs; ``seed`` feeds the deterministic sampler; a user's item lists are
    dealt into buckets of ``hot_user_items``, and pair work is split by pair of
    buckets; ``block_pairs`` is the number of pairs a task multiplies or adds up;
    ``prune``: an event's partners are counted in two passes if the third quartile of
    their users is at least this many times the first (0: never); ``checkpoint`` writes the
    edge and count tables that several branches of the plan read (see ``session.stored``).
    None of the last four changes a result.
    """

    indicators: tuple[Indicator, ...] = field(default_factory=indicator_params)
    min_events: int = 1
    seed: int = CCO_SEED
    hot_user_items: int = 500
    block_pairs: int = 1 << 20
    prune: float = 3.0
    checkpoint: bool = True

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(i.name for i in self.indicators)


def cco_default_params(names=EVENT_NAMES, max_events: int | None = DEFAULT_MAX_EVENTS) -> CcoParams:
    return CcoParams(indicators=default_params(names, max_events), seed=DEFAULT_CCO_SEED)
