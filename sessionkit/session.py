"""Session helpers: a local builder for tests/bench and the shared scratch location.

Library functions never depend on these settings for correctness; they only
need ``spark.sql.session.timeZone`` to be irrelevant (all timestamps are
``timestamp_ntz``) and ANSI mode on or off (every division is a ``try_divide``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the engine is designed around.  On a cluster these belong in
# spark-defaults; ``build_session`` only applies them for local runs.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "sessionkit", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    local_only = {}
    if master.startswith("local"):
        # One executor: every task is process-local, so waiting for locality
        # only delays the many small jobs of iterative learners.
        local_only["spark.locality.wait"] = "0s"
    for k, v in {**RECOMMENDED_CONF, **local_only, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is.  A session on
    one machine (``local``) that names none gets a private temporary folder; on
    a cluster, whose machines would each write to a disk of their own, that is
    an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sessionkit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where it was imported, for
    sessions started elsewhere; where it is installed this changes nothing."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location.

    Used for written intermediate tables (lineage cuts that survive executor
    loss) and for round-trip sinks in the registered queries.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/sessionkit/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def delete_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this application has written; returns how
    many.  Call it when the results that read them are no longer needed."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        fs, jpath = file_system(spark, path)
        fs.delete(jpath, True)
    return len(paths)


def folder_state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files of a file or folder, as text: it
    changes when the data do."""
    fs, jpath = file_system(spark, path)
    files = [f for top in fs.globStatus(jpath) or [] for f in fs.listStatus(top.getPath())]
    return ";".join(sorted(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in files))


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a file or folder."""
    fs, jpath = file_system(spark, path)
    return sum(fs.getContentSummary(top.getPath()).getLength() for top in fs.globStatus(jpath) or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (works for
    local, HDFS and object-store paths alike)."""
    fs, jpath = file_system(spark, path)
    return bool(fs.exists(jpath))


#: Functions called with (name, DataFrame) before a table is cut; for tools
#: that report the plan behind a written table.
CUT_WATCHERS: list = []


def materialize(df, name: str = "table"):
    """Cut a DataFrame's lineage by writing it as a Parquet table in the
    shared checkpoint folder and reading it back (never ``localCheckpoint``).

    Later passes and a lost executor re-read the written files instead of
    replaying the plan; the read-back carries the table's real size (better
    broadcast / AQE decisions than an estimated RDD checkpoint) and is split
    by ``spark.sql.files.maxPartitionBytes``, so its partitioning follows the
    data volume.
    """
    spark = df.sparkSession
    for watch in CUT_WATCHERS:
        watch(name, df)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # known schema: no footer inference
