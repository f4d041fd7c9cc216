"""The largest stored value of a Parquet column, from the files' footers (CAL-4).

Every footer keeps the largest value of each column of each row group. A Spark job reads
the footers, some files to a task; no data page is read and one row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

TASKS_PER_CORE = 4

# Type of the column -> its value from the stored number (days or microseconds since 1970).
_VALUES = {
    DateType(): "date_from_unix_date(cast({0} as int))",
    TimestampType(): "timestamp_micros({0})",
    TimestampNTZType(): "timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval("
                        "{0} div 86400000000, 0, 0, ({0} % 86400000000) / 1000000)",
}


def _read_footers(column: str, adjusted: bool | None):
    """mapInArrow function: paths -> (number, known), one row for each path.

    ``number`` is NULL where a file holds no value; ``known`` is false where the footer
    does not tell. ``adjusted``: whether a timestamp counts from an instant; None for dates.
    """
    def number(file):
        import pyarrow as pa

        meta, schema = file.metadata, file.schema_arrow
        same = [i for i, name in enumerate(schema.names) if name.lower() == column.lower()]
        if not same:
            return None, True   # Spark reads NULLs
        kind = schema.field(same[0]).type
        if adjusted is None:
            fits = pa.types.is_date32(kind)
        else:
            fits = (pa.types.is_timestamp(kind) and kind.unit in ("ms", "us")
                    and (kind.tz is not None) == adjusted)
        leaf = [i for i in range(meta.num_columns)
                if meta.schema.column(i).path == schema.names[same[0]]]
        # days and instants of a file marked so are shifted when Spark reads them
        shifted = b"org.apache.spark.legacyDateTime" in (meta.metadata or {})
        if len(same) > 1 or len(leaf) != 1 or not fits or shifted:
            return None, False
        found = []
        for group in range(meta.num_row_groups):
            chunk = meta.row_group(group).column(leaf[0])
            held = chunk.statistics
            if held is not None and held.has_min_max:
                value = pa.scalar(held.max, kind)
                found.append(value.value if adjusted is None
                             else value.cast(pa.timestamp("us", kind.tz)).value)
            elif held is None or not held.has_null_count or held.null_count != chunk.num_values:
                return None, False
        return max(found, default=None), True

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            numbers, known = [], []
            for path in batch.column(0).to_pylist():
                try:
                    if path.startswith("file:"):
                        store, inside = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
                    else:
                        store, inside = fs.FileSystem.from_uri(path)
                    with pq.ParquetFile(store.open_input_file(inside)) as file:
                        n, k = number(file)
                except (pa.ArrowException, OSError, ValueError, OverflowError):
                    n, k = None, False   # a store or a value that pyarrow does not read
                numbers.append(n)
                known.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(known, pa.bool_())],
                names=["number", "known"])
    return run


def stored_max(spark: SparkSession, path: str, column: str, kind: DataType) -> Column | None:
    """The largest ``column`` of the Parquet files under ``path``, as a constant of its
    type ``kind`` (DATE, TIMESTAMP or TIMESTAMP_NTZ); None if the footers do not tell:
    another type, no statistics, a store that pyarrow cannot open, no value at all."""
    if kind not in _VALUES:
        return None
    adjusted = None if kind == DateType() else kind == TimestampType()
    # binaryFile lists the files; their content is not read where only the path is selected
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .load(path).select("path"))
    tasks = spark.sparkContext.defaultParallelism * TASKS_PER_CORE
    row = (files.coalesce(tasks)
           .mapInArrow(_read_footers(column, adjusted), "number long, known boolean")
           .agg(F.max("number").alias("number"), F.bool_and("known").alias("known")).first())
    if not row["known"] or row["number"] is None:
        return None
    return F.expr(_VALUES[kind].format(f"{row['number']}L"))
