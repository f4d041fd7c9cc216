"""A table read again at every interval, as a stream (SRC-2, SRC-3).

A streaming data source (``table_poll``): its offset is the number of the interval, so a
query that restarts goes on with the next poll and never repeats one that it committed; an
interval that passes while the query is down is not made up for, as the table only shows
its rows of now. A poll lists the table's Parquet files once, on the driver, and each file
is read by a task. All rows are emitted again at every poll, with ``poll_time``: the order
in which the versions of a row arrive.
"""

from __future__ import annotations

import sys
import time
from dataclasses import dataclass

from pyarrow import dataset as ds
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from sitewatch.sinks.once_log import _store

# executors get the reader itself and need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "table_poll"
POLL = "_poll"


@dataclass
class PolledFile(InputPartition):
    path: str
    poll: int


class PollReader(DataSourceStreamReader):
    """One poll for every interval of the clock in which a batch is asked for."""

    def __init__(self, schema, path: str, seconds: float):
        self.names = [f.name for f in schema if f.name != POLL]
        self.path, self.seconds = path.rstrip("/"), seconds

    def _now(self) -> int:
        return int(time.time() // self.seconds)

    def initialOffset(self) -> dict:
        return {"poll": self._now() - 1}

    def latestOffset(self) -> dict:
        return {"poll": self._now()}

    def partitions(self, start: dict, end: dict):
        if end["poll"] <= start["poll"]:
            return []
        store, root = _store(self.path)
        return [PolledFile(f, end["poll"])
                for f in sorted(ds.dataset(root, filesystem=store, format="parquet").files)]

    def read(self, partition: PolledFile):
        import pyarrow as pa

        store, _ = _store(self.path)
        table = ds.dataset(partition.path, filesystem=store, format="parquet")
        for batch in table.to_batches(columns=self.names):
            if batch.num_rows:
                yield batch.append_column(
                    POLL, pa.array([partition.poll] * batch.num_rows, pa.int64()))


class TablePoll(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def streamReader(self, schema):
        return PollReader(schema, self.options["path"], float(self.options["seconds"]))


def poll_table(spark: SparkSession, path: str, schema, seconds: float = 30.0) -> DataFrame:
    """The rows of the Parquet table at ``path``, all of them again every ``seconds``, with
    ``poll_time`` (the beginning of the interval). ``schema``: the wanted columns."""
    spark.dataSource.register(TablePoll)
    fields = spark.createDataFrame([], schema).withColumn(POLL, F.lit(0).cast("long")).schema
    rows = (spark.readStream.format(FORMAT).schema(fields).option("path", path)
            .option("seconds", seconds).load())
    return rows.withColumn("poll_time", F.timestamp_micros(
        (F.col(POLL) * F.lit(float(seconds)) * 1e6).cast("long"))).drop(POLL)
