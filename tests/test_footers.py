"""The trailing cutoff's anchor from Parquet footers."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sitewatch.operators.calendar_jobs import trailing_cutoff
from sitewatch.sources.footers import stored_max

BASE = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
KINDS = {"ntz": pa.timestamp("us"), "millis": pa.timestamp("ms"),
         "instant": pa.timestamp("us", "UTC"), "day": pa.date32()}


def _write(path, kind, rows, **options):
    values = pa.array(rows, pa.timestamp("us")).cast(kind, safe=False)
    pq.write_table(pa.table({"i": pa.array(range(len(rows))), "ts": values}), path, **options)


def _table(folder, kind, **options):
    for part in range(3):
        _write(f"{folder}/{part}.parquet", kind,
               [BASE + dt.timedelta(hours=7 * (10 * part + i)) for i in range(10)] + [None],
               row_group_size=4, **options)
    return folder


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_equals_the_aggregate(spark, tmp_dir, kind):
    df = spark.read.parquet(_table(tmp_dir, KINDS[kind]))
    found = stored_max(spark, tmp_dir, "TS", df.schema["ts"].dataType)
    one = spark.range(1).select(found.alias("m")).first()["m"]
    assert one == df.agg(F.max("ts")).first()[0]
    for amount, unit in ((40, "hour"), (3, "day"), (1, "month"), (90, "minute")):
        a, b = (trailing_cutoff(df, "ts", amount, unit, path=p) for p in (tmp_dir, None))
        assert sorted(a.collect()) == sorted(b.collect()) and a.count() > 0


def test_before_1970(spark, tmp_dir):
    rows = [dt.datetime(1951, 3, 4, 5, 6, 7, 890123), dt.datetime(1950, 1, 1)]
    _write(f"{tmp_dir}/a.parquet", pa.timestamp("us"), rows)
    df = spark.read.parquet(tmp_dir)
    found = stored_max(spark, tmp_dir, "ts", df.schema["ts"].dataType)
    assert spark.range(1).select(found).first()[0] == rows[0]


def test_no_data_page_is_read(spark, tmp_dir):
    """With every byte between the first mark and the footer gone, the maximum is still found."""
    _table(tmp_dir, KINDS["ntz"])
    kind = spark.read.parquet(tmp_dir).schema["ts"].dataType
    for part in range(3):
        with open(f"{tmp_dir}/{part}.parquet", "r+b") as f:
            f.seek(-8, 2)
            foot = f.tell() - int.from_bytes(f.read(4), "little")
            f.seek(4)
            f.write(bytes(foot - 4))
    found = stored_max(spark, tmp_dir, "ts", kind)
    assert spark.range(1).select(found).first()[0] == BASE + dt.timedelta(hours=7 * 29)


def test_plan_has_one_scan_with_the_comparison(spark, tmp_dir):
    df = spark.read.parquet(_table(tmp_dir, KINDS["ntz"]))
    plan = trailing_cutoff(df, "ts", 1, "day", path=tmp_dir)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-08T11:00:00.123456)" in plan.split("Physical Plan")[1]


def test_falls_back_where_footers_do_not_tell(spark, tmp_dir):
    df = spark.read.parquet(_table(tmp_dir, KINDS["ntz"], write_statistics=["i"]))
    assert stored_max(spark, tmp_dir, "ts", df.schema["ts"].dataType) is None
    got = trailing_cutoff(df, "ts", 1, "day", path=tmp_dir)
    assert sorted(r.i for r in got.collect()) == [6, 7, 8, 9]
    assert stored_max(spark, tmp_dir, "i", df.schema["i"].dataType) is None
    other = spark.read.parquet(_table(f"{tmp_dir}", KINDS["day"])).schema["ts"].dataType
    _write(f"{tmp_dir}/2.parquet", KINDS["ntz"], [BASE])   # one file of another type
    assert stored_max(spark, tmp_dir, "ts", other) is None


def test_column_of_nulls_and_partition_column(spark, tmp_dir):
    _write(f"{tmp_dir}/a.parquet", KINDS["ntz"], [None, None])
    df = spark.read.parquet(tmp_dir)
    assert stored_max(spark, tmp_dir, "ts", df.schema["ts"].dataType) is None
    assert trailing_cutoff(df, "ts", 1, "day", path=tmp_dir).count() == 0
    spark.sql("SELECT 1 AS i, DATE'2024-02-03' AS d").write.partitionBy("d").parquet(
        f"{tmp_dir}/dated")
    dated = spark.read.parquet(f"{tmp_dir}/dated")
    assert trailing_cutoff(dated, "d", 1, "day", path=f"{tmp_dir}/dated").count() == 1
