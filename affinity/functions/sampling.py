"""Deterministic Bernoulli sampling by hashing.

An edge (event, user, item) is kept with probability ``rate``.  The coin is
the first 32 bits of md5("event|user|item|seed") read as an unsigned number:
keep iff h < rate * 2^32 (always when rate >= 1).  The same seed gives the
same sample on every run, engine and partitioning; the event name is part
of the key so that event types sample independently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def sample_hash(event: Column, user: Column, item: Column, seed: int) -> Column:
    key = F.concat_ws("|", event, user.cast("string"), item.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def keep_sampled(rate: Column, h: Column) -> Column:
    return (rate >= 1.0) | (h.cast("double") < rate * F.lit(TWO_POW_32))
