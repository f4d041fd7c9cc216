"""Writers (SNK-1..SNK-11).

File outputs of a stream are keyed by (query id, batch id): a batch that is replayed
replaces its own folder, and a query started anew (fresh checkpoint) writes beside
what earlier queries left. The table upsert is idempotent and never leaves a
partition without its rows. Kafka and JDBC appends are at-least-once: a replayed
batch is sent again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatch.operators.upsert import dedupe_updates, upsert

# Layout of the averaged-tier table: a micro-batch of minute averages touches
# only the current hour's partition, so an upsert rewrites at most one hour of
# rows per tier instead of a whole (growing) day.
AVG_PARTITIONS = ("type", "end_date", "end_hour")


def with_avg_partitions(df: DataFrame) -> DataFrame:
    """Add the partition columns of the averaged-tier table."""
    return df.withColumns({"end_date": F.to_date("end_time"),
                           "end_hour": F.hour("end_time")})


def stream_id(batch: DataFrame) -> str:
    """Id of the streaming query whose ``foreachBatch`` is running: the same for
    every restart from one checkpoint, new for a fresh checkpoint."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("not inside foreachBatch: pass the run id")
    return found


def write_kafka(df: DataFrame, bootstrap: str, topic: str) -> None:
    """SNK-1/SNK-9: rows with a ``value`` text column to a Kafka topic
    (needs the spark-sql-kafka package). At-least-once."""
    (df.select(F.col("value").cast("string"))
       .write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
       .option("topic", topic).save())


def write_batch_files(df: DataFrame, path: str, batch_id: int, run_id: str,
                      fmt: str = "parquet", partition_by=(),
                      max_records_per_file: int = 0) -> None:
    """One folder per run and batch: ``path/run=<id>/batch_id=<n>/``. Overwriting
    that folder makes a replayed batch idempotent; other runs are not touched."""
    w = df.write.mode("overwrite").format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    w.save(f"{path}/run={run_id}/batch_id={batch_id}")


def write_archive(records: DataFrame, path: str, batch_id: int | None = None,
                  run_id: str | None = None, by_day: bool = True,
                  max_records_per_file: int = 1_000_000) -> None:
    """SNK-5: JSON lines in one folder per ``day`` (``day=yyyy-MM-dd``);
    SNK-6 (``by_day=False``): the same lines without day folders.

    With a run and batch id the days lie inside the batch's folder, which is
    replaced as a whole: a replay on another day leaves nothing of the first try.
    Without them the lines are appended. File size is bounded by
    ``maxRecordsPerFile`` instead of a rolling policy.
    """
    out = records.select(*(["day"] if by_day else []), "value")
    days = ["day"] if by_day else []
    if batch_id is not None:
        write_batch_files(out, path, batch_id, run_id, "text", days, max_records_per_file)
        return
    w = out.write.mode("append").option("maxRecordsPerFile", max_records_per_file)
    (w.partitionBy(*days) if days else w).text(path)


def write_documents(docs: DataFrame, path: str, batch_id: int, run_id: str) -> None:
    """SNK-8: JSON documents as text lines (a search-index writer would read
    them or plug into ``foreachBatch`` instead)."""
    write_batch_files(docs.select(F.col("doc").alias("value")), path, batch_id, run_id, "text")


def write_jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None,
                      batchsize: int = 1000) -> None:
    """SNK-3/SNK-4: append rows to a JDBC table in batches. At-least-once."""
    (df.write.mode("append").option("batchsize", batchsize)
       .jdbc(url, table, properties=properties or {}))


def upsert_statement(table: str, staging: str, columns, keys) -> str:
    """``INSERT ... SELECT ... ON DUPLICATE KEY UPDATE`` (MySQL dialect)
    moving a staging table into ``table``; non-key columns are updated."""
    cols = [f"`{c}`" for c in columns]
    keyset = {f"`{k}`" for k in keys}
    updates = ", ".join(f"{c} = VALUES({c})" for c in cols if c not in keyset)
    return (f"INSERT INTO {table} ({', '.join(cols)}) SELECT {', '.join(cols)} "
            f"FROM {staging} ON DUPLICATE KEY UPDATE {updates}")


def staging_name(table: str, run_id: str | None = None, batch_id: int | None = None) -> str:
    """A staging table of its own for every run and batch (random without them)."""
    token = uuid.uuid4().hex if run_id is None else f"{run_id}_{batch_id}"
    return f"{table}_staging_{re.sub('[^A-Za-z0-9_]', '', token)}"


def write_jdbc_upsert(df: DataFrame, url: str, table: str, keys,
                      properties: dict | None = None, staging_table: str | None = None,
                      batchsize: int = 1000) -> None:
    """SNK-2 on a MySQL-compatible database: rows go to a staging table of their
    own with Spark's JDBC writer (parallel, batched), then one
    ``INSERT ... SELECT ... ON DUPLICATE KEY UPDATE`` runs in the database and the
    staging table is dropped. The statement is idempotent, so a replayed batch
    leaves the same rows."""
    props = dict(properties or {})
    staging = staging_table or staging_name(table)
    (df.write.mode("overwrite").option("batchsize", batchsize)
       .jdbc(url, staging, properties=props))
    jvm = df.sparkSession.sparkContext._jvm
    info = jvm.java.util.Properties()
    for k, v in props.items():
        info.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        stmt = conn.createStatement()
        stmt.executeUpdate(upsert_statement(table, staging, df.columns, keys))
        stmt.executeUpdate(f"DROP TABLE {staging}")
        stmt.close()
    finally:
        conn.close()


# -- the versioned table -----------------------------------------------------
#
# path/<col>=<value>/.../version=<n>/part-*.parquet: a partition's rows are those of
# its highest version. An upsert writes new versions aside and moves each into place
# by one rename, then drops the versions before the last: at no moment is a partition
# without rows, and a crash anywhere is mended by replaying the batch.

VERSION = "version"
KEPT_VERSIONS = 2   # the current one, and the one a running reader may still hold
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class _Files:
    """The few file-system calls the versioned table needs, on any Hadoop store."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def folders(self, path: str) -> list[str]:
        """Names of the ``col=value`` folders in ``path`` (none if it is not there)."""
        if not self.exists(path):
            return []
        found = [s for s in self._fs.listStatus(self._path(path)) if s.isDirectory()]
        return sorted(n for n in (s.getPath().getName() for s in found) if "=" in n)

    def move(self, source: str, target: str) -> None:
        parent = self._path(target).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _versions(files: _Files, folder: str) -> list[int]:
    prefix = f"{VERSION}="
    return sorted(int(n[len(prefix):]) for n in files.folders(folder) if n.startswith(prefix))


def _current_folders(files: _Files, path: str, keep, below: str = "") -> list[str]:
    """The folder of the current version of every partition under ``path/below``."""
    out = []
    names = files.folders(f"{path}{below}")
    if any(n.startswith(f"{VERSION}=") for n in names):
        return [f"{path}{below}/{VERSION}={_versions(files, path + below)[-1]}"]
    for name in names:
        column, _, value = name.partition("=")
        if keep is None or keep(column, value):
            out += _current_folders(files, path, keep, f"{below}/{name}")
    return out


def read_table(spark: SparkSession, path: str,
               keep: Callable[[str, str], bool] | None = None) -> DataFrame | None:
    """The current rows of a versioned table; None if there is no table (yet).

    ``keep(column, value)`` says which partition folders to look into: only those
    are listed and read.
    """
    folders = _current_folders(_Files(spark, path), path, keep)
    if not folders:
        return None
    return spark.read.option("basePath", path).parquet(*folders).drop(VERSION)


def tier_folders(tier_code=None, start=None, end=None):
    """``keep`` of :func:`read_table` for one tier and an inclusive range of times
    (text ``yyyy-MM-dd...``)."""
    def keep(column: str, value: str) -> bool:
        if column == "type":
            return tier_code is None or value == str(tier_code)
        if column == "end_date":
            return (start is None or value >= str(start)[:10]) and (
                end is None or value <= str(end)[:10])
        return True
    return keep


def _folder(partition_by, row) -> str:
    """``col=value/...`` of a row's partition."""
    parts = []
    for c in partition_by:
        value = NULL_FOLDER if row[c] is None else str(row[c])
        if not re.fullmatch(r"[A-Za-z0-9_.\-]+", value):
            raise ValueError(f"{value!r} can't name a partition of {c}")
        parts.append(f"{c}={value}")
    return "/".join(parts)


def _written_partitions(files: _Files, root: str, depth: int, below: str = "") -> list[str]:
    if not depth:
        return [below.lstrip("/")]
    return [p for n in files.folders(root + below)
            for p in _written_partitions(files, root, depth - 1, f"{below}/{n}")]


def upsert_table(spark: SparkSession, updates: DataFrame, path: str, keys,
                 partition_by=("type",), order: str | None = None) -> None:
    """SNK-2/SNK-7: keyed upsert into a partitioned, versioned parquet table.

    The updates are computed once (persisted). The partitions they touch (a set that
    the calendar bounds, not the rows) are collected, and only those folders are
    listed, read and written anew. Replaying the same updates gives the same table;
    so does replaying after a crash at any point.
    """
    keys, partition_by = list(keys), list(partition_by)
    files = _Files(spark, path)
    staging = f"{path}/_staging/{uuid.uuid4().hex}"
    updates = dedupe_updates(updates, keys, order).persist()
    try:
        touched = sorted(_folder(partition_by, r)
                         for r in updates.select(*partition_by).distinct().collect())
        held = {p: v[-1] for p in touched if (v := _versions(files, f"{path}/{p}"))}
        merged = updates
        if held:
            rest = [f for f in updates.schema.fields if f.name not in partition_by]
            kind = [updates.schema[c] for c in partition_by]
            schema = type(updates.schema)([*rest, *kind])
            current = spark.read.schema(schema).option("basePath", path).parquet(
                *[f"{path}/{p}/{VERSION}={v}" for p, v in held.items()])
            merged = upsert(current.select(*updates.columns), updates, keys)
        merged.write.partitionBy(*partition_by).parquet(staging)
        for p in _written_partitions(files, staging, len(partition_by)):
            _switch(files, f"{staging}/{p}", f"{path}/{p}")
    finally:
        updates.unpersist()
        files.delete(staging)


def _switch(files: _Files, written: str, partition: str) -> None:
    """Make ``written`` the current version of ``partition``, then drop old ones."""
    before = _versions(files, partition)
    files.move(written, f"{partition}/{VERSION}={(before[-1] if before else 0) + 1}")
    for v in before[:len(before) + 1 - KEPT_VERSIONS]:
        files.delete(f"{partition}/{VERSION}={v}")


def purge_table(spark: SparkSession, path: str, column: str, values) -> None:
    """SNK-11: drop whole partitions ``column in (values)`` of a table whose first
    partition column is ``column`` (the retention job)."""
    files = _Files(spark, path)
    for v in values:
        files.delete(f"{path}/{column}={v}")


def print_rows(df: DataFrame, label: str) -> None:
    """SNK-10: every row on the console, one line each, with a label."""
    print(f"{label}:")
    for row in df.toLocalIterator():
        print("  " + ", ".join(f"{k}={v}" for k, v in row.asDict().items()))
