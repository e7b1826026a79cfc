"""Session construction and shared-storage helpers.

On a cluster the session is created by the platform; ``get_session`` only fills in settings
that are unset, so cluster-level choices (shuffle partitions, checkpoint directory) win.
"""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied when the session is built here (local runs, tests, bench).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Remove checkpoint files once their DataFrames are garbage-collected on the driver.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Scratch folders handed out by this process, for ``clear_scratch``.
_SCRATCH: list[str] = []


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one with the project defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a local one only when it is unset.

    The fallback exists for tests and single-machine runs. On a cluster the setting must name a
    shared folder that every executor can reach, and a missing setting raises.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if conf_dir:
        if not current:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current:
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: checkpoints and "
                           "intermediate tables go there")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch folder."""
    if path in _SCRATCH:
        _SCRATCH.remove(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders handed out so far; call it when no result reads them any more."""
    while _SCRATCH:
        drop_scratch(spark, _SCRATCH[-1])


def path_join(base: str, *parts: str) -> str:
    if "://" in base:
        return "/".join([base.rstrip("/"), *parts])
    return os.path.join(base, *parts)


def spread(df, min_partitions: int | None = None):
    """Round-robin repartition a table scan that Spark reads in fewer tasks than there are cores.

    A small file (one Parquet row group, say) is read by one task; row-wise work such as JSON
    parsing would then run on one core. The number of tasks is taken from the sizes of the scanned
    files, before anything runs, and a scan with enough of them is returned unchanged, so at scale
    this adds no shuffle. Meant for scans: a frame without files of its own is returned unchanged.
    """
    spark = df.sparkSession
    files = df.inputFiles()
    target = min_partitions or spark.sparkContext.defaultParallelism
    if not files or len(files) >= target:
        return df
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    split = int(jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes").removesuffix("b")))
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    tasks = sum(math.ceil(p.getFileSystem(conf).getFileStatus(p).getLen() / split) for p in paths)
    return df if tasks >= target else df.repartition(target)


def growing(df):
    """``df`` as a side of an equi-join that grows with the input: sorted and merged, never collected on the driver to
    be broadcast. Spark broadcasts by the size of compressed files, so that a load of many joins would send
    the driver some hundred megabytes at a time."""
    return df.hint("merge")


def working_partitions(spark: SparkSession) -> int:
    """Partition count for explicit repartitions (which AQE does not coalesce): the session's own
    shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
