"""A log of text lines that every micro-batch reaches exactly once, in rolling files.

A streaming data source writer (``once_log``). Tasks write files that nobody reads yet and
report their names; when all have, the driver publishes the batch by one manifest, moved
into place whole. Readers take the files that manifests name and no others:

* a task that fails or runs twice leaves a file without a manifest (``sweep`` deletes it),
* a crash before the manifest leaves nothing, and the batch is written again on restart,
* a crash after it makes Spark run the batch again: its manifest is there, so the new
  files are dropped.

Files roll when they reach ``roll_bytes`` (1 MiB, as the archive this replaces), and at the
end of a batch, so the trigger is the longest age of an open file. ``compact`` joins the
small files of past batches; its result is published by one manifest, too.

path/data[/day=...]/*.txt      lines
path/_commits/<run>/<n>.json   the files of batch n of a query (a run: one checkpoint)
path/_snapshots/<n>.json       after compaction: all files of the manifests it names
"""

from __future__ import annotations

import json
import sys
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)
from pyspark.sql.streaming import StreamingQuery

# executors get the writer itself and need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "once_log"
ROLL_BYTES = 1 << 20
OPEN_FILES = 64


def _store(path: str):
    """(file system, path in it) of a local path or a store's address."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _names(store, folder: str) -> list[str]:
    """File names in a folder, sorted; none if it is not there."""
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file and not f.base_name.startswith("."))


def _publish(store, path: str, content) -> None:
    """Write a small JSON file that is there whole or not at all."""
    folder, name = path.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(json.dumps(content).encode())
    store.move(draft, path)


def _read(store, path: str):
    with store.open_input_stream(path) as f:
        return json.loads(f.read())


@dataclass
class Files(WriterCommitMessage):
    """What one task wrote: [name under data/, bytes]."""
    files: list


class _Rolling:
    """The open files of a task, one per day, each closed at ``roll_bytes``."""

    def __init__(self, store, root, run, roll_bytes):
        self.store, self.root, self.run, self.roll_bytes = store, root, run, roll_bytes
        self.open, self.done = {}, []

    def write(self, day, line: bytes) -> None:
        held = self.open.get(day)
        if held is not None and held[2] + len(line) > self.roll_bytes and held[2]:
            self.close(day)
            held = None
        if held is None:
            if len(self.open) >= OPEN_FILES:
                self.close(next(iter(self.open)))
            folder = f"{self.root}/data" + ("" if day is None else f"/day={day}")
            self.store.create_dir(folder, recursive=True)
            name = f"{folder}/{self.run}-{uuid.uuid4().hex}.txt"
            held = self.open[day] = [name, self.store.open_output_stream(name), 0]
        held[1].write(line)
        held[2] += len(line)

    def close(self, day) -> None:
        name, out, size = self.open.pop(day)
        out.close()
        self.done.append([name[len(self.root) + len("/data/"):], size])

    def close_all(self) -> list:
        for day in list(self.open):
            self.close(day)
        return self.done


class LogWriter(DataSourceStreamArrowWriter):
    """Writes ``value`` lines, under ``day`` folders if there is such a column."""

    def __init__(self, options):
        self.path, self.run = options["path"].rstrip("/"), options["run"]
        self.roll_bytes = int(options.get("rollbytes", options.get("rollBytes", ROLL_BYTES)))

    def write(self, iterator):
        store, root = _store(self.path)
        files = _Rolling(store, root, self.run, self.roll_bytes)
        for batch in iterator:
            lines = batch.column(batch.schema.get_field_index("value")).cast(pa.binary())
            at = batch.schema.get_field_index("day")
            days = [None] * batch.num_rows if at < 0 else \
                pc.coalesce(batch.column(at).cast(pa.string()), "none").to_pylist()
            for day, line in zip(days, lines.to_pylist()):
                if line is not None:
                    files.write(day, line + b"\n")
        return Files(files.close_all())

    def _manifest(self, root, batch_id):
        return f"{root}/_commits/{self.run}/{batch_id:012d}.json"

    def _drop(self, store, root, messages, kept=()):
        for name, _ in (f for m in messages if m is not None for f in m.files):
            if name not in kept:
                store.delete_file(f"{root}/data/{name}")

    def commit(self, messages, batchId):
        store, root = _store(self.path)
        manifest = self._manifest(root, batchId)
        if store.get_file_info(manifest).type != fs.FileType.NotFound:
            self._drop(store, root, messages, {n for n, _ in _read(store, manifest)})
            return
        _publish(store, manifest, [f for m in messages if m is not None for f in m.files])

    def abort(self, messages, batchId):
        store, root = _store(self.path)
        self._drop(store, root, messages)


class OnceLog(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def streamWriter(self, schema, overwrite):
        return LogWriter(dict(self.options))


def _run_of(checkpoint: str) -> str:
    """The name of the query that owns a checkpoint: made once, kept beside it, so that a
    fresh checkpoint, whose batches count from 0 again, is another run."""
    store, root = _store(checkpoint.rstrip("/"))
    path = f"{root}/sink-run.json"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        _publish(store, path, uuid.uuid4().hex)
    return _read(store, path)


def log_stream(lines: DataFrame, path: str, checkpoint: str, trigger: dict,
               roll_bytes: int = ROLL_BYTES) -> StreamingQuery:
    """Start writing a stream's ``value`` lines (and ``day``) to the log at ``path``."""
    lines.sparkSession.dataSource.register(OnceLog)
    return (lines.writeStream.format(FORMAT).option("path", path)
            .option("run", _run_of(checkpoint)).option("rollBytes", roll_bytes)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def _manifests(store, root) -> list[str]:
    base = f"{root}/_commits"
    runs = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return [f"{r.base_name}/{n}" for r in sorted(runs, key=lambda r: r.base_name)
            for n in _names(store, r.path)]


def _published(store, root):
    """(files with bytes, manifests they come from, number of the last snapshot)."""
    snapshots = _names(store, f"{root}/_snapshots")
    files, taken, last = [], [], 0
    if snapshots:
        last = int(snapshots[-1].split(".")[0])
        held = _read(store, f"{root}/_snapshots/{snapshots[-1]}")
        files, taken = held["files"], held["manifests"]
    known = set(taken)
    for m in _manifests(store, root):
        if m not in known:
            files = files + _read(store, f"{root}/_commits/{m}")
            taken = taken + [m]
    return files, taken, last


def published_files(path: str) -> list:
    """[name, bytes] of every file a reader may read."""
    store, root = _store(path.rstrip("/"))
    return _published(store, root)[0]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The published lines (``value``, and ``day`` where there are such folders)."""
    path = path.rstrip("/")
    names = [f"{path}/data/{n}" for n, _ in published_files(path)]
    if not names:
        return spark.createDataFrame([], "value string")
    return spark.read.option("basePath", f"{path}/data").text(names)


def _packed(files, limit):
    """Files below half the limit, by folder, in groups of up to the limit's bytes."""
    groups, rest = [], []
    folders: dict[str, list] = {}
    for name, size in files:
        if 2 * size < limit:
            folders.setdefault(name.rpartition("/")[0], []).append((name, size))
        else:
            rest.append([name, size])
    for folder, small in folders.items():
        group, held = [], 0
        for name, size in small:
            if held + size > limit and group:
                groups.append((folder, group))
                group, held = [], 0
            group.append([name, size])
            held += size
        groups.append((folder, group))
    return groups, rest


def compact(spark: SparkSession, path: str, limit: int = ROLL_BYTES) -> int:
    """Join small files into ones of up to ``limit`` bytes, each group in a task; all files
    of a folder but the last are then over half of it. Readers see the old files or the new.
    Returns the number of files replaced (deleted by the next ``sweep``)."""
    path = path.rstrip("/")
    store, root = _store(path)
    files, taken, last = _published(store, root)
    groups, rest = _packed(files, limit)
    joined = [(folder, group) for folder, group in groups if len(group) > 1]
    rest += [f for _, group in groups if len(group) == 1 for f in group]
    if not joined:
        return 0

    def join(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                task_store, task_root = _store(path)
                name = f"{row['folder']}/joined-{uuid.uuid4().hex}.txt".lstrip("/")
                size = 0
                with task_store.open_output_stream(f"{task_root}/data/{name}") as target:
                    for part in row["files"]:
                        with task_store.open_input_stream(f"{task_root}/data/{part}") as f:
                            while block := f.read(1 << 20):
                                target.write(block)
                                size += len(block)
                out.append({"name": name, "size": size})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("name", pa.string()),
                                                             ("size", pa.int64())]))
    work = spark.createDataFrame([(folder, [n for n, _ in group]) for folder, group in joined],
                                 "folder string, files array<string>")
    done = work.repartition(min(len(joined), 1000)).mapInArrow(
        join, "name string, size long").collect()
    _publish(store, f"{root}/_snapshots/{last + 1:012d}.json",
             {"files": rest + [[r["name"], r["size"]] for r in done], "manifests": taken})
    return sum(len(group) for _, group in joined)


def sweep(path: str, keep_seconds: float = 86400.0) -> int:
    """Delete files of the log that no reader can reach, if older than ``keep_seconds``
    (a running batch's files are not published yet). Returns their number."""
    from datetime import datetime, timedelta, timezone

    store, root = _store(path.rstrip("/"))
    live = {n for n, _ in _published(store, root)[0]}
    before = datetime.now(timezone.utc) - timedelta(seconds=keep_seconds)
    gone = 0
    for info in store.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True,
                                                    recursive=True)):
        if info.is_file and info.path[len(root) + len("/data/"):] not in live \
                and info.mtime <= before:
            store.delete_file(info.path)
            gone += 1
    return gone
