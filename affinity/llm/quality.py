"""Quality classifier: hashed word n-gram logistic regression trained with FTRL.

The labels table is joined only for the training sample: at most
``max_rows`` labelled rows outside the held-out fold (those of the ids of
smallest hash; equal rows count once), a documented bound.  Scoring is one
map-only scan of all documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, saved
from .ftrl import FeatureMap, FtrlParams, bounded_sample, log_tf, score, train, word_ngram_features

FEATURES = FeatureMap(word_ngram_features, log_tf)
PARAMS = FtrlParams(alpha=1.0, l1=0.02, l2=0.1)
#: Score from which a document is predicted to be of quality.
THRESHOLD = 0.3


def training_sample(documents: DataFrame, labels: DataFrame, label: str, p: FtrlParams) -> DataFrame:
    """(doc_id, text, y): at most ``p.max_rows`` labelled rows outside the held-out fold.

    Labels that are null or not 0/1 are skipped; of several labels of one id
    the smallest counts.  Rows of one id with equal texts are one row, so an
    id that is repeated does not make the sample larger.
    """
    ids = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.min(label).alias("y")))
    ids = bounded_sample(ids, "doc_id", p.max_rows, p.seed)
    # max_rows ids at most: a proven size
    rows = saved(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                 .join(F.broadcast(ids), "doc_id").distinct().withColumn("part", F.xxhash64("text")), label + "_rows")
    # an id may have many texts: the bound holds for rows too
    keep = bounded_sample(rows.select("doc_id", "part").distinct(), "doc_id", p.max_rows, p.seed, "part")
    return rows.join(F.broadcast(keep), ["doc_id", "part"]).select("doc_id", "text", "y")


def fit_quality(documents: DataFrame, labels: DataFrame, p: FtrlParams = PARAMS) -> np.ndarray:
    return train(training_sample(documents, labels, "quality", p), FEATURES, p)


def quality_scores(documents: DataFrame, labels: DataFrame, p: FtrlParams = PARAMS,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, held_out, score, predicted) for every document.

    Null and empty texts get the bias as score; a null doc_id is scored and
    counts as not held out; repeated rows are scored each; an empty labels
    table gives 0.5 everywhere.  Extra columns are ignored unless kept.
    """
    s = score(documents, fit_quality(documents, labels, p), FEATURES, p.dim, keep=keep)
    return s.select("doc_id", *keep, F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
