"""Assembly of the serving rows.

``outcome``: every catalogue product with its four correlation payloads
("" when none) and an update stamp -- the original's catalogue LEFT JOIN of
four per-event subqueries, done as one pivot (one shuffle on product) and
one left join.

``serving_table``: the serving table's columns in their declared order.
Only the outcome columns, the twelve pop/trend/hot scores, cat_path and the
text payload have a producer; ``price``, ``popular_score``, ``hot_score``
and ``trend_score`` have no defining computation and stay NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import EVENT_NAMES
from .popularity import THEMES

OUTCOME_COLUMNS = ("product_id",) + tuple(f"{e}_corr_payload" for e in EVENT_NAMES) + (
    "update_time",)
SCORE_COLUMNS = tuple(f"{t}_{e}" for t in THEMES for e in EVENT_NAMES)
SERVING_COLUMNS = (("product_id", "cat_path", "price") + SCORE_COLUMNS
                   + ("popular_score", "hot_score", "trend_score")
                   + tuple(f"{e}_corr_payload" for e in EVENT_NAMES)
                   + ("text_corr_payload", "update_time"))


def outcome(products: DataFrame, payloads: DataFrame, update_time: str,
            names=EVENT_NAMES) -> DataFrame:
    """``products``: products_id; ``payloads``: (event, product_id, corr_payload)."""
    wide = (payloads.where(F.col("event").isin(list(names)))
            .groupBy("product_id").pivot("event", list(names)).agg(F.max("corr_payload")))
    cat = products.select(F.col("products_id").alias("product_id"))
    return cat.join(wide, "product_id", "left").select(
        "product_id",
        *[F.coalesce(F.col(e), F.lit("")).alias(f"{e}_corr_payload") for e in names],
        F.lit(update_time).alias("update_time"))


def serving_table(outcome_rows: DataFrame, popularity: DataFrame,
                  similarity: DataFrame) -> DataFrame:
    """Serving rows: outcome LEFT JOIN popularity LEFT JOIN similarity payloads.

    ``similarity``: (product_id, cat_path, text_corr_payload); a product in
    several categories has a row per category path.  Scores default to 0
    and strings to "", as the table's column defaults do.
    """
    j = (outcome_rows.join(popularity, "product_id", "left")
         .join(similarity, "product_id", "left"))
    cols = []
    for c in SERVING_COLUMNS:
        if c in ("price", "popular_score", "hot_score", "trend_score"):
            cols.append(F.lit(None).cast("double").alias(c))
        elif c in SCORE_COLUMNS:
            cols.append(F.coalesce(F.col(c), F.lit(0.0)).alias(c))
        elif c in ("cat_path", "text_corr_payload"):
            cols.append(F.coalesce(F.col(c), F.lit("")).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)
