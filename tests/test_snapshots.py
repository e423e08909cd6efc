"""Versioned tables: a failed write leaves the old rows, for every sink."""

import os

import pytest
from pyspark.sql import functions as F

from affinity.operators import training
from affinity.operators.serving import SCORE_COLUMNS, SERVING_COLUMNS
from affinity.session import shared_dir
from affinity.sources import sinks, snapshots


def _path(spark, name="snap"):
    return shared_dir(spark, name)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _daily(spark, n):
    return spark.range(n).selectExpr("concat('s', id) AS sess_id", "id AS user_id", "id AS product_id", "'order' AS event",
                                     "1L AS event_uv", "date_add(date'2024-01-01', CAST(id % 3 AS INT)) AS daystr")


def _wide(spark, n, columns):
    return spark.range(n).select(*[
        (F.col("id") if c == "product_id" else F.col("id").cast("double") if c in SCORE_COLUMNS
         else F.concat(F.lit("x"), "id")).alias(c) for c in columns])


def _cases(spark):
    from affinity.operators.popularity import POPULARITY_COLUMNS
    from affinity.operators.etl import DAY
    daily = _daily(spark, 6).withColumnRenamed("daystr", DAY)
    corr = spark.range(6).selectExpr("id AS product_id", "concat('p', id) AS corr_payload",
                                     "element_at(array('order', 'cart'), CAST(id % 2 AS INT) + 1) AS event")
    return {
        "daily": (sinks.write_daily_events, daily, "user_id"),
        "corr": (sinks.write_corr, corr, "corr_payload"),
        "popularity": (sinks.write_popularity, _wide(spark, 6, POPULARITY_COLUMNS), POPULARITY_COLUMNS[1]),
        "similarity": (sinks.write_similarity, _wide(spark, 6, ("product_id", "cat_path", "text_corr_payload")),
                       "cat_path"),
        "serving": (sinks.write_serving, _wide(spark, 6, SERVING_COLUMNS), "cat_path"),
    }


@pytest.mark.parametrize("name", ["daily", "corr", "popularity", "similarity", "serving"])
def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, name):
    write, df, column = _cases(spark)[name]
    path = _path(spark, name)
    write(df, path)
    old = _rows(snapshots.read(spark, path))
    assert len(old) == 6
    bad = F.when(F.col(column).cast("string").contains("4"), F.raise_error(F.lit("row is lost")).cast("string"))
    broken = df.repartition(6).withColumn(column, F.coalesce(bad, F.col(column).cast("string")).cast(df.schema[column].dataType))
    with pytest.raises(Exception, match="row is lost"):
        write(broken, path)
    assert _rows(snapshots.read(spark, path)) == old
    write(df, path)                                             # and the next write goes through
    assert _rows(snapshots.read(spark, path)) == old


def test_partitions_are_replaced_and_others_stay(spark):
    path = _path(spark)
    write = lambda rows, **kw: snapshots.publish(spark.createDataFrame(rows, "k string, n int"), path, "k", **kw)
    write([("a", 1), ("b", 2), (None, 3)])
    write([("b", 9), ("c d/é", 4)])
    assert _rows(snapshots.read(spark, path)) == sorted([("a", 1), ("b", 9), (None, 3), ("c d/é", 4)], key=str)
    write([("a", 7)], mode="append")
    assert sorted(r.n for r in snapshots.read(spark, path).where("k = 'a'").collect()) == [1, 7]
    with pytest.raises(ValueError):
        write([("a", 1)], mode="ignore")


def test_empty_tables_and_plain_folders(spark):
    path = _path(spark)
    none = spark.createDataFrame([], "k string, n int")
    snapshots.publish(none, path)
    assert snapshots.read(spark, path).columns == ["k", "n"] and snapshots.read(spark, path).count() == 0
    snapshots.publish(spark.createDataFrame([("a", 1)], "k string, n int"), path)
    snapshots.publish(none, path)                               # an empty overwrite empties the table
    assert snapshots.read(spark, path).count() == 0
    plain = _path(spark, "plain")
    spark.range(3).write.parquet(plain)
    assert snapshots.read(spark, plain).count() == 3


def test_a_reader_keeps_its_version_and_old_ones_go(spark):
    path = _path(spark)
    snapshots.publish(spark.range(5), path)
    old = snapshots.read(spark, path)
    snapshots.publish(spark.range(9), path)
    assert old.count() == 5 and snapshots.read(spark, path).count() == 9
    snapshots.publish(spark.range(2), path)
    folder = path.removeprefix("file:")
    assert len([f for f in os.listdir(f"{folder}/data") if f.startswith("v=")]) == 2
    assert len([f for f in os.listdir(f"{folder}/manifest") if f.endswith(".json") and f[0] != "."]) == 2


def test_of_two_writers_one_fails(spark, monkeypatch):
    path = _path(spark)
    snapshots.publish(spark.range(5), path)
    real = snapshots._Folder.create

    def late(self, name, text):
        monkeypatch.setattr(snapshots._Folder, "create", real)
        snapshots.publish(spark.range(9), path)                 # another writer is faster
        real(self, name, text)

    monkeypatch.setattr(snapshots._Folder, "create", late)
    with pytest.raises(FileExistsError):
        snapshots.publish(spark.range(2), path)
    assert snapshots.read(spark, path).count() == 9


def test_sql_values_are_data_and_no_view_is_left(spark):
    t = spark.createDataFrame([("it's", 1), ("x' OR '1'='1", 2), ("y", 3)], "name string, n int")
    before = {v.name for v in spark.catalog.listTables()}
    sql = "SELECT n FROM {items} WHERE name = :name AND n < :most"
    for name, n in (("it's", 1), ("x' OR '1'='1", 2)):
        assert [r.n for r in training.sql_read(spark, sql, {"items": t}, {"name": name, "most": 3}).collect()] == [n]
    assert {v.name for v in spark.catalog.listTables()} == before
