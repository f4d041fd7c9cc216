"""Readers for every source of the monitoring jobs (SRC-1..SRC-8).

Each reader returns a DataFrame whose shape the operators expect; streams and
tables share the parsing operators in ``sitewatch.operators.parse``. Hosts,
topics and credentials are arguments, never constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewatch.operators.parse import (parse_config_messages, parse_csv_events,
                                       parse_report_table)


def read_kafka(spark: SparkSession, bootstrap: str, topic: str,
               starting_offsets: str = "latest", streaming: bool = True,
               options: dict | None = None) -> DataFrame:
    """SRC-1/SRC-4: a Kafka topic as ``value`` text plus its offsets.

    Needs the spark-sql-kafka package on the classpath of the cluster.
    ``offset``/``partition`` give an arrival order for last-write-wins.
    """
    reader = spark.readStream if streaming else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap)
               .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"),
                           "topic", "partition", "offset",
                           F.col("timestamp").alias("kafka_ts"))


def read_text(spark: SparkSession, path: str, streaming: bool = False,
              max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files as ``value`` lines (the file stand-in for a topic)."""
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.text(path)


def read_config_snapshot(spark: SparkSession, *, path: str | None = None,
                         fmt: str = "parquet", jdbc_url: str | None = None,
                         table: str = "dev_monitor_config",
                         properties: dict | None = None) -> DataFrame:
    """SRC-2: the whole config table (re-read on every micro-batch = poll).

    Columns: site_id, timestamp, is_delete, version, interval, monitor_items, and
    config_id, the order of arrival: the table's own, otherwise the row's place in
    this read (the last row of a site wins, as when rows are taken one by one).
    """
    if jdbc_url:
        df = spark.read.jdbc(jdbc_url, table, properties=properties or {})
    else:
        df = spark.read.format(fmt).load(path)
    if "config_id" not in df.columns:
        df = df.withColumn("config_id", F.monotonically_increasing_id())
    return df


def read_tier(source, site_id=None, start=None, end=None, tier_code=None) -> DataFrame:
    """SRC-3: bounded scan of one averaged tier:
    ``site_id = ? AND end_time BETWEEN ? AND ? AND type = ?`` (inclusive).

    ``source`` is a DataFrame (e.g. ``spark.read.parquet(path)`` or a JDBC
    table); the predicates are pushed to the scan by Spark, and on the
    partitioned averaged table the range also prunes ``end_date`` partitions.
    """
    df = source
    partitioned = "end_date" in df.columns
    if site_id is not None:
        df = df.where(F.col("site_id") == site_id)
    if start is not None:
        df = df.where(F.col("end_time") >= F.lit(start).cast("timestamp"))
        if partitioned:   # implied partition predicate: prunes whole days
            df = df.where(F.col("end_date") >= F.to_date(F.lit(start).cast("timestamp")))
    if end is not None:
        df = df.where(F.col("end_time") <= F.lit(end).cast("timestamp"))
        if partitioned:
            df = df.where(F.col("end_date") <= F.to_date(F.lit(end).cast("timestamp")))
    if tier_code is not None:
        df = df.where(F.col("type") == tier_code)
    return df


def read_jdbc_query(spark: SparkSession, url: str, query: str,
                    properties: dict | None = None, partition_column: str | None = None,
                    lower=None, upper=None, partitions: int = 8) -> DataFrame:
    """SRC-5: any JDBC query as a table (columns typed by the driver).

    With a numeric, date or timestamp ``partition_column`` and its bounds the query
    is read by ``partitions`` tasks, each with a range of that column of its own (the
    bounds only deal out the ranges; rows outside them are read too).
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) t")
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
              .option("upperBound", str(upper)).option("numPartitions", partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def read_jdbc_table(spark: SparkSession, url: str, table: str,
                    properties: dict | None = None) -> DataFrame:
    """A whole JDBC table; filters and columns asked of it reach the database."""
    return spark.read.jdbc(url, table, properties=properties or {})


def from_rows(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """SRC-6: an in-memory collection as a (small) table."""
    return spark.createDataFrame(rows, schema)


def read_config_changes(spark: SparkSession, bootstrap: str, topic: str = "config",
                        starting_offsets: str = "earliest") -> DataFrame:
    """SRC-4: config change stream, one JSON config per message, with the
    Kafka offset as arrival order (``config_id``). Offsets count per partition, so
    the topic must be keyed by site: then all changes of a site share one."""
    raw = read_kafka(spark, bootstrap, topic, starting_offsets)
    return parse_config_messages(raw.withColumnRenamed("offset", "config_id"),
                                 keep=("config_id",))


def read_report_table(lines: DataFrame) -> DataFrame:
    """SRC-7: declared JSON table over a text stream/table, ``data`` as text."""
    return parse_report_table(lines)


def read_csv_events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """SRC-8: ``user,url,timestamp`` lines from text files."""
    return parse_csv_events(read_text(spark, path, streaming))
