"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame.

Each applies one operator, with its production parameters, to the whole of
its table and returns the columns of its contract, the operator's own columns
after them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    audit,
    chat,
    decontaminate,
    jaccard,
    langid,
    licenses,
    merkle,
    packing,
    quality,
    suffixes,
    topk,
    toxicity,
    urls,
)
from .common import arrow_rows


def _table(spark, d, name):
    arrow_rows(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_suffix_dedup(spark, d):
    return suffixes.deduplicate(_table(spark, d, "documents"))


def op2_best_fit_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"))


def op3_decontaminate(spark, d):
    return decontaminate.contaminated(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op4_jaccard_join(spark, d):
    return jaccard.near_duplicates(_table(spark, d, "documents"))


def op5_url_filter(spark, d):
    return urls.filter_urls(_table(spark, d, "pages"))


def op6_quality(spark, d):
    return quality.quality_scores(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op7_language_id(spark, d):
    return langid.identify(_table(spark, d, "documents"))


def op8_chat_perspectives(spark, d):
    return chat.rotate(_table(spark, d, "conversations"))


def op9_exact_topk(spark, d):
    e = _table(spark, d, "embeddings")
    return topk.exact_topk(e, e.where(F.col("vec_id") % 100 == 0))


def op10_toxicity(spark, d):
    return toxicity.toxicity_scores(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op11_license_scan(spark, d):
    return licenses.scan(_table(spark, d, "documents"))


def op12_filter_audit(spark, d):
    return audit.audit(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op13_merkle_manifest(spark, d):
    return merkle.verify(_table(spark, d, "documents"))


QUERIES = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
