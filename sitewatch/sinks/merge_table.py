"""A keyed table that is merged when it is read (SNK-2, SNK-7).

Rows are dealt into buckets by a hash of their key. A batch of updates writes its own rows
only, as a delta; readers take the last row of every key. ``compact`` merges the deltas into
the buckets that they touch. What belongs to the table is said by the last state file, which
is moved into place whole:

path/base/<id>/bucket=<b>/    merged rows of a bucket
path/delta/<id>/bucket=<b>/   updates, with their number ``_seq`` and whether the row goes
path/_state/<n>.json          {"base": {b: id}, "deltas": [[id, [b, ...]]], "seq": ...,
                               "applied": {run: last batch}}

A crash before the state is written leaves folders that nothing names (``sweep``); the batch
runs again. A batch whose state was written is not applied a second time. Buckets without
deltas are read as they lie; in the others the old rows and the deltas meet in one aggregate
by key. One writer at a time (a streaming query, or the compaction between its batches).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatch.operators.upsert import dedupe_updates
from sitewatch.sinks.once_log import _names, _publish, _read, _store
from sitewatch.sinks.writers import stream_id

SEQ, GONE, BUCKET = "_seq", "_gone", "bucket"
EMPTY = {"base": {}, "deltas": [], "seq": 0, "applied": {}}


class MergeTable:
    """``keys`` and ``buckets`` are those of the table's whole life."""

    def __init__(self, spark: SparkSession, path: str, keys, schema, buckets: int = 64):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets = buckets
        self.schema = spark.createDataFrame([], schema).schema
        self.store, self.root = _store(self.path)

    # -- state --

    def state(self) -> dict:
        names = _names(self.store, f"{self.root}/_state")
        return _read(self.store, f"{self.root}/_state/{names[-1]}") if names else dict(EMPTY)

    def _switch(self, state: dict) -> None:
        names = _names(self.store, f"{self.root}/_state")
        n = int(names[-1].split(".")[0]) + 1 if names else 1
        _publish(self.store, f"{self.root}/_state/{n:012d}.json", state)

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _written_buckets(self, folder: str) -> list[int]:
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(f"{self.root}/{folder}",
                                                         allow_not_found=True))
        return sorted(int(f.base_name.partition("=")[2]) for f in found
                      if f.base_name.startswith(f"{BUCKET}="))

    # -- writing --

    def _append(self, rows: DataFrame, gone: bool, run, batch_id) -> None:
        state = self.state()
        if run is not None and state["applied"].get(run, -1) >= batch_id:
            return  # the batch ran before
        seq, name = state["seq"] + 1, uuid.uuid4().hex
        (rows.select(*self.schema.names, F.lit(seq).cast("long").alias(SEQ),
                     F.lit(gone).alias(GONE), self._bucket())
         .repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/delta/{name}"))
        touched = self._written_buckets(f"delta/{name}")
        applied = state["applied"] | ({run: batch_id} if run is not None else {})
        self._switch(state | {"seq": seq, "applied": applied,
                              "deltas": state["deltas"] + ([[name, touched]] if touched else [])})

    def upsert(self, updates: DataFrame, order: str | None = None, run: str | None = None,
               batch_id: int | None = None) -> None:
        """Insert or replace the rows of ``updates`` (one per key, or the last by ``order``)."""
        self._append(dedupe_updates(updates, self.keys, order), False, run, batch_id)

    def delete(self, keys: DataFrame, run: str | None = None, batch_id: int | None = None) -> None:
        """Remove the rows whose keys are in ``keys``."""
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema
                if f.name not in self.keys]
        self._append(keys.select(*self.keys).distinct().select(*self.keys, *rest), True, run,
                     batch_id)

    def batch_writer(self, order: str | None = None) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: every batch is applied once, whatever is replayed."""
        def write(df: DataFrame, batch_id: int) -> None:
            self.upsert(df, order, stream_id(df), batch_id)
        return write

    # -- reading --

    def _paths(self, state: dict):
        """(base paths of untouched buckets, of touched ones, delta paths, touched buckets)."""
        touched = {b for _, buckets in state["deltas"] for b in buckets}
        base = {int(b): f"{self.path}/base/{i}/{BUCKET}={b}" for b, i in state["base"].items()}
        return ([p for b, p in sorted(base.items()) if b not in touched],
                [p for b, p in sorted(base.items()) if b in touched],
                [f"{self.path}/delta/{i}/{BUCKET}={b}" for i, buckets in state["deltas"]
                 for b in buckets], sorted(touched))

    def _rows(self, paths, schema) -> DataFrame | None:
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def _merged(self, old_paths, delta_paths) -> DataFrame:
        """The last row of every key of the touched buckets."""
        full = self.spark.createDataFrame([], self.schema).select(
            "*", F.lit(0).cast("long").alias(SEQ), F.lit(False).alias(GONE)).schema
        rows = self._rows(delta_paths, full)
        old = self._rows(old_paths, self.schema)
        if old is not None:
            rows = rows.unionByName(old.select("*", F.lit(0).cast("long").alias(SEQ),
                                               F.lit(False).alias(GONE)))
        rest = [c for c in self.schema.names if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(
            F.max_by(F.struct(*rest, GONE), F.col(SEQ)).alias("_row"))
        return last.where(~F.col("_row").getField(GONE)).select(
            *[F.col(c) if c in self.keys else F.col("_row").getField(c).alias(c)
              for c in self.schema.names])

    def read(self) -> DataFrame:
        """The table's rows now."""
        still, old, deltas, _ = self._paths(self.state())
        parts = [self._rows(still, self.schema)]
        if deltas:
            parts.append(self._merged(old, deltas))
        parts = [p for p in parts if p is not None]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    # -- upkeep --

    def compact(self) -> list[int]:
        """Merge the deltas into new folders of the buckets they touch, and return these
        buckets. Readers of the state before still find its folders."""
        state = self.state()
        _, old, deltas, touched = self._paths(state)
        if not deltas:
            return []
        name = uuid.uuid4().hex
        self._merged(old, deltas).select("*", self._bucket()).repartition(BUCKET) \
            .write.partitionBy(BUCKET).parquet(f"{self.path}/base/{name}")
        written = set(self._written_buckets(f"base/{name}"))  # a bucket may have become empty
        base = {b: i for b, i in state["base"].items() if int(b) not in touched}
        self._switch(state | {"deltas": [], "base": base | {str(b): name for b in written}})
        return touched

    def sweep(self, states: int = 2) -> int:
        """Delete folders that none of the last ``states`` states names, and older state
        files; not while a batch is being written. Returns the number of folders."""
        from pyarrow import fs

        names = _names(self.store, f"{self.root}/_state")
        kept = [_read(self.store, f"{self.root}/_state/{n}") for n in names[-states:]]
        live = {f"base/{i}/{BUCKET}={b}" for s in kept for b, i in s["base"].items()}
        live |= {f"delta/{i}/{BUCKET}={b}" for s in kept for i, bs in s["deltas"] for b in bs}
        gone = 0
        for kind in ("base", "delta"):
            for info in self.store.get_file_info(fs.FileSelector(
                    f"{self.root}/{kind}", allow_not_found=True, recursive=True)):
                place = info.path[len(self.root) + 1:]
                if not info.is_file and info.base_name.startswith(f"{BUCKET}=") \
                        and place not in live:
                    self.store.delete_dir(info.path)
                    gone += 1
        for n in names[:-states]:
            self.store.delete_file(f"{self.root}/_state/{n}")
        return gone
