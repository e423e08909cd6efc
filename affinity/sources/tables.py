"""Table readers.

The pipeline reads six kinds of input: the five raw log tables of the daily
ETL, the daily event table it writes, and the three catalogue tables.  In a
deployment they are Parquet folders (or catalogue tables); here they are
read by name under one root folder.  Readers stay lazy so that Catalyst
prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``root/name.parquet`` if it exists, else ``root/name`` (any file system)."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(os.path.join(root, f"{name}.parquet"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
    return spark.read.parquet(os.path.join(root, name))


@dataclass(frozen=True)
class LogTables:
    """Raw session logs read by the daily ETL.

    rec_session          sess_id, customers_id, dctime (date)
    rec_session_action   sess_id, products_id, dctime, site, com, r_position
    rec_session_operate  sess_id, products_id, dctime, site, operating, r_position
    rec_session_basket   sess_id, products_id, dctime, site, operating, r_position
    rec_order_products   sess_id, products_id, add_time (unix seconds), site,
                         orders_status, r_position
    """

    rec_session: DataFrame
    rec_session_action: DataFrame
    rec_session_operate: DataFrame
    rec_session_basket: DataFrame
    rec_order_products: DataFrame


@dataclass(frozen=True)
class CatalogueTables:
    """Product catalogue.

    products_description    products_id, products_name
    products_to_categories  products_id, cat_path ("a-b-c")
    products                products_id
    """

    products_description: DataFrame
    products_to_categories: DataFrame
    products: DataFrame


def read_log_tables(spark: SparkSession, root: str) -> LogTables:
    return LogTables(*(read_parquet(spark, root, n) for n in LogTables.__dataclass_fields__))


def read_catalogue(spark: SparkSession, root: str) -> CatalogueTables:
    return CatalogueTables(*(read_parquet(spark, root, n)
                             for n in CatalogueTables.__dataclass_fields__))
