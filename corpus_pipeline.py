"""Corpus pipeline: quality filter, near duplicates, repeated passages,
benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``.  Between stages rows are written as Parquet to the shared
folder and read again, which also cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.llm import decontaminate, jaccard, packing, quality, suffixes
from affinity.llm.common import arrow_rows, saved


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go (operator 6)."""
    arrow_rows(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = tuple(c for c in docs.columns if c != "doc_id")
    scored = quality.quality_scores(docs, labels, keep=rest)
    return scored.where("predicted = 1").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents stays, the one with
    the smallest id; rows without an id stay (operator 4).  An id with several
    texts is several documents, decided each by its own component."""
    arrow_rows(spark)
    both = F.struct("doc_id", F.xxhash64("text").alias("same"))
    found = jaccard.near_duplicates(
        docs.select(F.when(F.col("doc_id").isNotNull(), both).alias("doc_id"), "text"), links=False)
    gone = saved(found.where("doc_id <> component_id").select("doc_id.doc_id", "doc_id.same").distinct(),
                 "pipeline_gone")
    one = Window.partitionBy("doc_id", "same").orderBy("text")
    left = docs.withColumn("same", F.xxhash64("text")).join(gone, ["doc_id", "same"], "left_anti")
    return (left.withColumn("_r", F.row_number().over(one))
            .where(F.col("doc_id").isNull() | (F.col("_r") == 1)).select(*docs.columns))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur elsewhere too are cut out; a document of which
    nothing but white space is left goes (operator 1)."""
    arrow_rows(spark)
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = suffixes.deduplicate(docs, keep=rest, texts=True)
    cut = cut.where((F.col("n_removed") == 0) | (F.trim(F.translate("text", "\t\n\r", "   ")) != ""))
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited or not, go (operator 3)."""
    arrow_rows(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins of fixed capacity (operator 2)."""
    arrow_rows(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeated_passage_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs


#: Learned scores and 64-bit hashes have no SQL form; tests/llm compares the
#: stages with brute force instead.
ORACLE_SQL = None
