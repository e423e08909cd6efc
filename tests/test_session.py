"""Session helpers and the table reader."""

import os

import pytest

from affinity.session import (_STORED, _local_folder, apply_cluster_sizing, drop_stored,
                              ensure_checkpoint_dir, shared_dir, stored)
from affinity.sources.tables import read_parquet

from .conftest import SF_SMALL


def test_checkpoint_dir_is_kept_and_shared_dirs_are_unique(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and ensure_checkpoint_dir(spark) == d
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(d) and b.startswith(d)


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("local", "local[4]", "local[*]"):
        assert _local_folder(master)
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            _local_folder(master)


def test_stored_tables_are_removed(spark):
    df = stored(spark.range(3), "t")
    path = _STORED[-1]
    assert df.count() == 3 and os.path.isdir(path.removeprefix("file:"))
    drop_stored(spark)
    assert not _STORED and not os.path.exists(path.removeprefix("file:"))


def test_workers_have_the_package(spark):
    def probe(batches):
        import affinity
        for b in batches:
            b["where"] = affinity.__file__
            yield b
    assert spark.range(2).mapInPandas(probe, "id long, where string").count() == 2
    assert any("affinity-" in str(f) for f in spark.sparkContext._python_includes)


def test_cluster_sizing_is_not_applied_locally(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    apply_cluster_sizing(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_read_parquet_finds_both_layouts(spark):
    assert read_parquet(spark, SF_SMALL, "region").count() == 5
    root = shared_dir(spark, "test-reader")
    spark.range(3).write.parquet(os.path.join(root, "plain"))
    assert read_parquet(spark, root, "plain").count() == 3
