"""Named, versioned tables kept as Parquet folders below one root.

A table is ``<root>/<name>_v<version>`` with one ``snapshot=<n>`` folder per
rewrite; readers take the newest finished snapshot. Appended logs use the same
layout with one ``batch=<n>`` folder per batch, so that a repeated batch replaces
itself instead of adding rows twice. Tables that rows are merged into are partitioned
by a hash of their key, ``keyed=<parts>/snapshot=<n>/key_part=<p>``: a merge writes a snapshot of the partitions it
meets, and readers take the newest finished one of each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkrisk.operators.dedupe import latest_by_key
from linkrisk.session import write_scratch

KEY_PARTS = 16
_PART = "key_part"


def table_path(root: str, name: str, version: int = 1) -> str:
    return f"{root.rstrip('/')}/{name}_v{version}"


def _numbers(spark: SparkSession, path: str, prefix: str, finished: bool) -> list[int]:
    """Numbers of the ``<prefix>=<n>`` folders below a path, or of those that a write has finished."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{prefix}=") and (not finished or fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))):
            found.append(int(name.split("=", 1)[1]))
    return sorted(found)


def _children(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the finished ``<prefix>=<n>`` folders of a table."""
    return _numbers(spark, path, prefix, finished=True)


def finished_batches(spark: SparkSession, root: str, name: str, version: int = 1) -> list[int]:
    """Numbers of the batches that a log table holds."""
    return _children(spark, table_path(root, name, version), "batch")


def get_table(spark: SparkSession, root: str, name: str, version: int = 1) -> DataFrame | None:
    """The table, or None when it does not exist."""
    path = table_path(root, name, version)
    keyed = _keyed(spark, path)
    if keyed is not None and keyed[1]:
        return _read_parts(spark, keyed[1])
    snapshots = _children(spark, path, "snapshot")
    if snapshots:
        return spark.read.parquet(f"{path}/snapshot={snapshots[-1]}")
    batches = _children(spark, path, "batch")
    if batches:
        return spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in batches])
    return None


def read_table(spark: SparkSession, root: str, name: str, version: int = 1) -> DataFrame:
    found = get_table(spark, root, name, version)
    if found is None:
        raise ValueError(f"table {name} version {version} does not exist below {root}")
    return found


def write_snapshot(df: DataFrame, root: str, name: str, version: int = 1) -> DataFrame:
    """Write the whole table as its next snapshot and return what was written."""
    spark = df.sparkSession
    path = table_path(root, name, version)
    snapshots = _children(spark, path, "snapshot")
    target = f"{path}/snapshot={snapshots[-1] + 1 if snapshots else 0}"
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def write_batch(df: DataFrame, root: str, name: str, batch: int, version: int = 1) -> None:
    """Append one numbered batch to a log table; the same batch may be written again."""
    df.write.mode("overwrite").parquet(f"{table_path(root, name, version)}/batch={batch}")


def stream_log(spark: SparkSession, root: str, name: str, schema: str, version: int = 1) -> DataFrame:
    """The rows of a log table as a stream, batch by batch as they are written; a batch written again comes again.

    A table that does not exist yet is an empty folder until its first batch.
    """
    path = table_path(root, name, version)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)


def merge_rows(
    existing: DataFrame | None, incoming: DataFrame, key: Sequence[str], event_time: str | None = None
) -> DataFrame:
    """Rows of both sides, one per key: the newest by event time, else the incoming one."""
    new = incoming.withColumn("_source", F.lit(1))
    both = new if existing is None else existing.withColumn("_source", F.lit(0)).unionByName(new, allowMissingColumns=True)
    order = [event_time, "_source"] if event_time else ["_source"]
    return latest_by_key(both, key, order).drop("_source")


def _keyed(spark: SparkSession, path: str) -> tuple[int, dict[int, str], int] | None:
    """How many partitions a keyed table has, the newest finished folder of each, and the number of the next snapshot."""
    parts = _numbers(spark, path, "keyed", finished=False)
    if not parts:
        return None
    base, newest = f"{path}/keyed={parts[0]}", {}
    snapshots = _children(spark, base, "snapshot")
    for n in snapshots:
        newest |= {p: f"{base}/snapshot={n}/{_PART}={p}" for p in _numbers(spark, f"{base}/snapshot={n}", _PART, finished=False)}
    return parts[0], newest, snapshots[-1] + 1 if snapshots else 0


def _read_parts(spark: SparkSession, newest: dict[int, str], wanted: Sequence[int] | None = None) -> DataFrame:
    """The wanted partitions, or all. Every merge writes all columns that the table has, so the last snapshot names them."""
    last = max(newest.values(), key=lambda folder: int(folder.rsplit("/snapshot=", 1)[1].split("/")[0]))
    folders = [newest[p] for p in (newest if wanted is None else wanted) if p in newest]
    schema = spark.read.parquet(last).schema
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert_table(
    df: DataFrame, root: str, name: str, key: Sequence[str] | str, version: int = 1, event_time: str | None = None, parts: int = KEY_PARTS
) -> DataFrame:
    """Create the table or merge rows into it by key, and return the new state.

    The table has ``parts`` partitions by a hash of the key, a number that stays as it was when the table was made. Only
    partitions with keys of the incoming rows are read, merged and written anew; the files of all others stay. The
    merge counts once it is finished as a whole, and tables that were read before stay readable. Merge
    from one writer at a time. A table written as snapshots before is taken over by its first merge.
    """
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    path = table_path(root, name, version)
    parts, newest, number = _keyed(spark, path) or (parts, {}, 0)
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    incoming = merge_rows(None, df, keys, event_time)
    if newest:
        incoming = write_scratch(incoming, f"upsert-{name}")
        met = [r[0] for r in incoming.select(part).distinct().collect()]  # parts at most
        existing = _read_parts(spark, newest, met)
    else:
        existing = get_table(spark, root, name, version)
    merged = incoming if existing is None else merge_rows(existing, incoming, keys, event_time)
    # a large partition is written by several tasks
    rows = merged.withColumn(_PART, part).hint("rebalance", _PART)
    target = f"{path}/keyed={parts}/snapshot={number}"
    rows.write.mode("overwrite").partitionBy(_PART).parquet(target)
    state = get_table(spark, root, name, version)
    # a partitioned table without rows would have no columns
    return write_snapshot(merged, root, name, version) if state is None else state


def feature_view(df: DataFrame, name: str, columns: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Register a named projection; label columns carry a marker in their metadata."""
    chosen = [F.col(c) for c in columns]
    chosen += [F.col(c).alias(c, metadata={"label": True}) for c in labels]
    view = df.select(*chosen)
    view.createOrReplaceTempView(name)
    return view
