"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Folders written by ``stored`` in this process.
_STORED: list[str] = []

# Settings every job relies on.  Spark broadcasts a side only below a checked
# size: a small static estimate, or the size AQE measured at run time.  AQE also coalesces
# small shuffle partitions and splits skewed ones; dynamic overwrite makes
# partitioned writes idempotent per partition.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "4MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files are deleted once their data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Partition sizing for cluster runs (applied by the jobs only where the
# cluster's own configuration leaves a key unset).  Shuffles start wide and
# AQE coalesces them to ~128 MB partitions, so a 100 TB input neither spills
# from oversized partitions nor drowns in tiny tasks.
CLUSTER_SIZING = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
}


def apply_cluster_sizing(spark: SparkSession) -> None:
    """Set ``CLUSTER_SIZING`` keys the cluster did not set (never locally)."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        return
    conf = sc.getConf()
    for k, v in CLUSTER_SIZING.items():
        if not conf.contains(k):
            spark.conf.set(k, v)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "affinity", extra: dict | None = None) -> SparkSession:
    """Session for tests, benchmarks and local runs.

    On a cluster use the cluster's session and apply ``CONF``; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces from there).
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver found it.

    Python functions of the operators are loaded by module name on the
    workers; on a cluster they would need ``--py-files`` otherwise.
    """
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    digest = hashlib.sha1()
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".py"))
    for f in files:
        with open(f, "rb") as src:
            digest.update(f.encode() + src.read())
    target = os.path.join(tempfile.gettempdir(), f"{name}-{digest.hexdigest()[:12]}-{os.getpid()}.zip")
    if not os.path.exists(target):
        with zipfile.ZipFile(target, "w") as z:
            for f in files:
                z.write(f, os.path.join(name, os.path.relpath(f, root)))
    spark.sparkContext.addPyFile(target)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is used as given, and a cluster session without one is an error.
    Only a local session (a test) gets a fresh folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = _local_folder(sc.master)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def _local_folder(master: str) -> str:
    """A temporary folder, for a master whose executors share this machine's JVM."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="affinity-ckpt-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Used where one intermediate table feeds several branches of a plan: it is
    computed once, and a lost executor later costs a re-read.  Unlike a
    checkpoint it forgets its partitioning, so a join on it is a plain
    exchange that AQE can split on a hot key.  ``drop_stored`` removes the
    folders once a job has written its result.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_stored(spark: SparkSession) -> None:
    """Remove the folders ``stored`` made in this process."""
    while _STORED:
        remove_dir(spark, _STORED.pop())


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint folder.

    The result is computed at once and its files are deleted when the data is no
    longer referenced; a lost executor later costs a re-read.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
