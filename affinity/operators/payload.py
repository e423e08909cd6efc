"""Ranked neighbour lists -> "id|score id|score ..." payload strings.

A payload holds at most k entries (k = max correlators / neighbours), so
collecting one per key is bounded.  Entries are ordered by rank (score
descending, ties by id); scores print with five decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import ITEM_SEP, PAIR_SEP, SCORE_FORMAT


def payload_of(rank: Column, other: Column, score: Column) -> Column:
    """Aggregate expression: the payload string of one group."""
    entries = F.sort_array(F.collect_list(F.struct(rank.alias("r"), other.alias("o"),
                                                   score.alias("s"))))
    return F.array_join(F.transform(entries, lambda e: F.concat(
        e["o"].cast("string"), F.lit(PAIR_SEP), F.format_string(SCORE_FORMAT, e["s"]))),
        ITEM_SEP)


def corr_payload(cco: DataFrame) -> DataFrame:
    """(event, product_id, corr_payload) from ``cross_occurrence`` rows."""
    return cco.groupBy("event", "product_id").agg(
        payload_of(F.col("rank"), F.col("other_id"), F.col("llr")).alias("corr_payload"))


def similarity_payload(sim: DataFrame) -> DataFrame:
    """(product_id, cat_path, text_corr_payload), one row per input vector of
    ``vector_similarity`` (``row_id`` tells repeated items apart)."""
    return sim.groupBy("product_id", "cat_path", "row_id").agg(
        payload_of(F.col("rank"), F.col("other_id"), F.col("score")).alias("text_corr_payload")
    ).drop("row_id")
