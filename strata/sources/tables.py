"""Parquet tables with full-refresh and append sinks.

A full refresh never overwrites the directory being read: it writes a new version directory
``<table>/__version=<n>`` and then publishes it with the layer's next manifest (``_manifests/<number>``, a
small new file that lists every table's current version). Readers take the highest whole
manifest, so they see a whole layer switch at once and never a half-written version, a failed
refresh or a crash while publishing leaves the old versions current, and old versions are removed
once they are no longer needed.
Appends go to a partitioned directory (``partitionBy``), and dynamic partition overwrite is
available for re-loading single partitions.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


_MANIFESTS = "_manifests"
# Folders of versions are named like partitions, by a column that no table has.
_VERSION = "__version"
# Manifest updates are read-modify-write; steps of one driver may publish from several threads.
_PUBLISH_LOCK = threading.Lock()
# The last line of a whole manifest: a file without it was cut off and does not count.
_END = "end"


def _split(table_dir: str) -> tuple[str, str]:
    base = table_dir.rstrip("/")
    parent, _, name = base.rpartition("/")
    return parent, name


def _read_lines(spark: SparkSession, path: str) -> list[str]:
    # Read through the Hadoop API: Spark's file sources skip names starting with '_'.
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        while (line := reader.readLine()) is not None:
            lines.append(line)
    finally:
        stream.close()
    return lines


def _manifest_numbers(spark: SparkSession, layer_dir: str) -> list[int]:
    return sorted((int(n) for n in _names(spark, f"{layer_dir}/{_MANIFESTS}") if n.isdigit()), reverse=True)


def _whole_manifest(spark: SparkSession, layer_dir: str) -> tuple[int, dict[str, list[int]]]:
    """(next number, table -> versions) of the highest whole manifest; (1, {}) before the first.

    A table that is replaced has one version; one that is appended to has all that were added. The next
    number comes from the same listing, so that it is taken if anything was published since.
    """
    numbers = _manifest_numbers(spark, layer_dir)
    for number in numbers:
        tables = manifest_tables(spark, layer_dir, number)
        if tables is not None:
            return numbers[0] + 1, tables
    return max(numbers, default=0) + 1, {}


def manifest_tables(spark: SparkSession, layer_dir: str, number: int) -> dict[str, list[int]] | None:
    """Table -> versions of one manifest; None if it is not whole."""
    lines = _read_lines(spark, f"{layer_dir}/{_MANIFESTS}/{number:012d}")
    if not lines or lines[-1] != _END:
        return None
    return {name: [int(v) for v in versions.split(",")] for name, _, versions in (x.partition("=") for x in lines[:-1])}


def claim(spark: SparkSession, path: str) -> bool:
    """Create the empty file ``path``, unless it is there: one of several callers gets True."""
    fs, p = _fs(spark, path)
    if fs.getScheme() == "file":
        fs.mkdirs(p.getParent())
        return bool(spark.sparkContext._jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).createNewFile())
    try:
        fs.create(p, False).close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception.getClass()):
            return False
        raise


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` with ``text``, unless it is there: then nothing happens. Of several writers one gets True.

    The file is written whole under another name and gets its own in one step that fails where that
    exists: a hard link on a local disk, a rename elsewhere (atomic on HDFS and on object stores with
    a hierarchical namespace).
    """
    fs, target = _fs(spark, path)
    parent, _, name = path.rpartition("/")
    _, draft = _fs(spark, f"{parent}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    try:
        if fs.getScheme() != "file":
            return bool(not fs.exists(target) and fs.rename(draft, target))
        local = spark.sparkContext._jvm.java.io.File
        names = [local(fs.makeQualified(p).toUri().getPath()).toPath() for p in (target, draft)]
        try:
            spark.sparkContext._jvm.java.nio.file.Files.createLink(*names)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception.getClass()):
                return False
            raise
    finally:
        fs.delete(draft, False)


def _claim_manifest(spark: SparkSession, layer_dir: str, number: int, tables: dict[str, list[int]]) -> bool:
    """Make ``tables`` the manifest ``number``, unless that number is taken."""
    text = "\n".join([*(f"{k}={','.join(map(str, v))}" for k, v in sorted(tables.items())), _END])
    return create_once(spark, f"{layer_dir}/{_MANIFESTS}/{number:012d}", text)


def current_version(spark: SparkSession, table_dir: str) -> int | None:
    """The published version, from the layer's manifest (of a table that is appended to, the last)."""
    parent, name = _split(table_dir)
    versions = _whole_manifest(spark, parent)[1].get(name)
    return versions[-1] if versions else None


def published_paths(spark: SparkSession, table_dir: str) -> list[str]:
    """The folders that make up the published table."""
    parent, name = _split(table_dir)
    return [version_path(table_dir, v) for v in _whole_manifest(spark, parent)[1].get(name, [])]


def _versions(spark: SparkSession, table_dir: str) -> list[int]:
    """The versions on disk, published or not."""
    found = (n.removeprefix(f"{_VERSION}=") for n in _names(spark, table_dir) if n.startswith(f"{_VERSION}="))
    return sorted(int(n) for n in found if n.isdigit())


def version_path(table_dir: str, version: int) -> str:
    return f"{table_dir.rstrip('/')}/{_VERSION}={version:06d}"


def replace_table(df: DataFrame, table_dir: str, partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = (), publish: bool = True) -> int:
    """Full refresh as a new version; returns the version number.

    With ``publish=False`` the version is written but not made current (publish several tables
    together with ``publish_versions``).
    """
    spark = df.sparkSession
    # Never a number that is on disk already: a failed run may have left part of it.
    version = max([*_versions(spark, table_dir), current_version(spark, table_dir) or 0]) + 1
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version_path(table_dir, version))
    if publish:
        publish_versions(spark, {table_dir: version})
    return version


def publish_versions(spark: SparkSession, versions: dict[str, int], keep: int = 2) -> None:
    """Make written versions current, atomically per layer, and remove old ones.

    All tables of a layer switch with one new manifest file. Afterwards each table keeps its
    current version and the ``keep - 1`` before it, for readers that still hold them.
    """
    by_layer: dict[str, dict[str, int]] = {}
    for table_dir, version in versions.items():
        parent, name = _split(table_dir)
        by_layer.setdefault(parent, {})[name] = version
    with _PUBLISH_LOCK:
        for layer_dir, entries in by_layer.items():
            while True:  # another process may publish other tables of the layer meanwhile
                number, tables = _whole_manifest(spark, layer_dir)
                if _claim_manifest(spark, layer_dir, number, tables | {name: [v] for name, v in entries.items()}):
                    break
            forget_manifests(spark, layer_dir, keep)
        for table_dir, version in versions.items():
            before = [v for v in _versions(spark, table_dir) if v < version]
            for v in before[:len(before) - max(0, keep - 1)]:
                fs, old = _fs(spark, version_path(table_dir, v))
                fs.delete(old, True)


def forget_manifests(spark: SparkSession, layer_dir: str, keep: int) -> None:
    for number in _manifest_numbers(spark, layer_dir)[max(1, keep):]:
        fs, old = _fs(spark, f"{layer_dir}/{_MANIFESTS}/{number:012d}")
        fs.delete(old, False)


def read_table(spark: SparkSession, table_dir: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The current version of a versioned table, or a plain Parquet directory."""
    paths = published_paths(spark, table_dir)
    if not paths:
        if not _exists(spark, table_dir) or _versions(spark, table_dir):  # versions without a manifest are not published
            return spark.createDataFrame([], schema) if schema is not None else None
        paths = [table_dir]
    return _read_paths(spark, table_dir, paths, schema)


def _read_paths(spark: SparkSession, table_dir: str, paths: list[str], schema: T.StructType | None = None) -> DataFrame | None:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        if len(paths) == 1:
            return reader.parquet(paths[0])
        # Several versions are read as partitions, whose column is none of the table's.
        return reader.option("basePath", table_dir).parquet(*paths).drop(_VERSION)
    except AnalysisException as exc:
        # A directory with no data files yet (an empty first append writes only _SUCCESS).
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return spark.createDataFrame([], schema) if schema is not None else None
        raise


def append_table(df: DataFrame, table_dir: str, partition_by: Sequence[str] = (),
                 sort_within: Sequence[str] = (), defaults: dict | None = None) -> None:
    """Append, filling omitted columns from ``defaults`` (column -> literal or Column)."""
    for name, value in (defaults or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, value if hasattr(value, "_jc") else F.lit(value))
    if partition_by:
        # REBALANCE: AQE groups rows by partition value into evenly sized tasks, splitting a
        # hot value over several files and merging small ones, so daily appends do not
        # scatter small files into every partition.
        df = df.hint("rebalance", *partition_by)
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(table_dir)


def write_day(df: DataFrame, table_dir: str, day, day_col: str = "run_day") -> None:
    """The rows of one run day of a report table, replacing what an earlier run of that day wrote."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{table_dir.rstrip('/')}/{day_col}={day:%Y-%m-%d}"))


def overwrite_partitions(df: DataFrame, table_dir: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(table_dir))


def create_if_absent(spark: SparkSession, table_dir: str, schema: T.StructType,
                     partition_by: Sequence[str] = ()) -> None:
    """An empty table with the declared schema when none exists (first run)."""
    if _exists(spark, table_dir):
        return
    w = spark.createDataFrame([], schema).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(table_dir)


def layer_path(root: str, layer: str, table: str) -> str:
    """bronze/silver/gold namespaces as directory prefixes."""
    return f"{root.rstrip('/')}/{layer}/{table}"
