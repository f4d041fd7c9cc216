"""The exactly-once log and the table that is merged when read."""

import os

import pytest
from pyspark.sql import functions as F

from sitewatch.operators.upsert import upsert
from sitewatch.sinks import once_log as L
from sitewatch.sinks.merge_table import MergeTable

AVAILABLE_NOW = {"availableNow": True}


def _feed(spark, path, low, high, files=2):
    for i in range(files):
        a, b = low + (high - low) * i // files, low + (high - low) * (i + 1) // files
        spark.range(a, b).selectExpr("concat('line ', id) AS value").coalesce(2).write.mode(
            "append").text(path)


def _start(spark, tmp_dir, **kw):
    lines = (spark.readStream.option("maxFilesPerTrigger", 2).text(f"{tmp_dir}/in")
             .withColumn("day", F.concat(F.lit("d"), F.substring("value", 6, 1))))
    return L.log_stream(lines, f"{tmp_dir}/log", f"{tmp_dir}/ckpt", AVAILABLE_NOW, **kw)


def _done(q):
    q.awaitTermination(300)
    assert q.exception() is None


def _lines(spark, tmp_dir):
    return sorted(int(r.value.split()[1]) for r in L.read_log(spark, f"{tmp_dir}/log").collect())


def _all_files(tmp_dir):
    return [n for _, _, names in os.walk(f"{tmp_dir}/log/data") for n in names
            if n.endswith(".txt")]


def _forget_last_commit(tmp_dir):
    last = max(int(n) for n in os.listdir(f"{tmp_dir}/ckpt/commits") if n.isdigit())
    for n in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{tmp_dir}/ckpt/commits/{n}"):
            os.unlink(f"{tmp_dir}/ckpt/commits/{n}")


def test_replayed_batch_is_there_once(spark, tmp_dir):
    _feed(spark, f"{tmp_dir}/in", 0, 100)
    _done(_start(spark, tmp_dir))
    before = sorted(_all_files(tmp_dir))
    _forget_last_commit(tmp_dir)
    _done(_start(spark, tmp_dir))
    assert _lines(spark, tmp_dir) == list(range(100))
    assert sorted(_all_files(tmp_dir)) == before      # the replay's files were dropped
    _feed(spark, f"{tmp_dir}/in", 100, 150)
    _done(_start(spark, tmp_dir))
    assert _lines(spark, tmp_dir) == list(range(150))
    days = {r.day for r in L.read_log(spark, f"{tmp_dir}/log").select("day").distinct().collect()}
    assert days == {f"d{i}" for i in range(10)}


def test_crash_between_tasks_and_commit(spark, tmp_dir):
    """The manifest can't be written: nothing is visible; the restart writes every line once."""
    _feed(spark, f"{tmp_dir}/in", 0, 40)
    os.makedirs(f"{tmp_dir}/log")
    with open(f"{tmp_dir}/log/_commits", "w") as f:  # a file where the folder should be
        f.write("in the way")
    q = _start(spark, tmp_dir)
    with pytest.raises(Exception):
        q.awaitTermination(300)
    os.unlink(f"{tmp_dir}/log/_commits")
    assert L.read_log(spark, f"{tmp_dir}/log").count() == 0
    _done(_start(spark, tmp_dir))
    assert _lines(spark, tmp_dir) == list(range(40))
    L.sweep(f"{tmp_dir}/log", keep_seconds=0)
    assert len(_all_files(tmp_dir)) == len(L.published_files(f"{tmp_dir}/log"))


def test_fresh_checkpoint_is_another_run(spark, tmp_dir):
    _feed(spark, f"{tmp_dir}/in", 0, 20)
    _done(_start(spark, tmp_dir))
    lines = spark.readStream.text(f"{tmp_dir}/in").withColumn("day", F.lit("again"))
    _done(L.log_stream(lines, f"{tmp_dir}/log", f"{tmp_dir}/other", AVAILABLE_NOW))
    assert _lines(spark, tmp_dir) == sorted([*range(20)] * 2)


def test_files_roll_and_small_ones_are_joined(spark, tmp_dir):
    _feed(spark, f"{tmp_dir}/in", 0, 4000)
    _done(_start(spark, tmp_dir, roll_bytes=500))
    files = L.published_files(f"{tmp_dir}/log")
    assert files and all(size <= 500 for _, size in files)
    replaced = L.compact(spark, f"{tmp_dir}/log", limit=4000)
    joined = L.published_files(f"{tmp_dir}/log")
    assert replaced and len(joined) < len(files)
    by_day = {}
    for name, size in joined:
        by_day.setdefault(name.split("/")[0], []).append(size)
    assert all(max(s) <= 4000 and sum(2 * x <= 4000 for x in s) <= 1 for s in by_day.values())
    assert _lines(spark, tmp_dir) == list(range(4000))
    assert L.compact(spark, f"{tmp_dir}/log", limit=4000) == 0
    L.sweep(f"{tmp_dir}/log", keep_seconds=0)
    _feed(spark, f"{tmp_dir}/in", 4000, 4100)
    _done(_start(spark, tmp_dir))
    assert _lines(spark, tmp_dir) == list(range(4100))


SCHEMA = "k int, g string, v double"


def _table(spark, tmp_dir, **kw):
    return MergeTable(spark, f"{tmp_dir}/t", ["k", "g"], SCHEMA, **{"buckets": 8, **kw})


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_merged_table_equals_upserts(spark, tmp_dir):
    table, plain = _table(spark, tmp_dir), spark.createDataFrame([], SCHEMA)
    assert table.read().count() == 0 and table.compact() == []
    for i in range(6):
        new = spark.range(30).selectExpr(f"CAST(id * {i + 1} % 40 AS INT) AS k",
                                         "IF(id % 7 = 0, NULL, 'g') AS g",
                                         f"CAST(id + {100 * i} AS DOUBLE) AS v") \
            .groupBy("k", "g").agg(F.max("v").alias("v"))
        table.upsert(new)
        plain = spark.createDataFrame(upsert(plain, new, ["k", "g"]).collect(), SCHEMA)
        assert _rows(table.read()) == _rows(plain)
        if i == 3:
            assert table.compact() and _rows(table.read()) == _rows(plain)
    gone = plain.where("k < 10").select("k", "g")
    table.delete(gone)
    plain = plain.where("k >= 10")
    assert _rows(table.read()) == _rows(plain)
    table.compact()
    assert _rows(table.read()) == _rows(plain) and table.sweep(states=1) > 0
    assert _rows(table.read()) == _rows(plain)


def test_batch_writes_its_own_rows_and_runs_once(spark, tmp_dir):
    table = _table(spark, tmp_dir)
    table.upsert(spark.range(5000).selectExpr("CAST(id AS INT) AS k", "'g' AS g",
                                              "CAST(id AS DOUBLE) AS v"))
    table.compact()
    update = spark.createDataFrame([(3, "g", -1.0), (3, "g", -2.0)], SCHEMA)
    table.upsert(update, order="v", run="r", batch_id=4)
    table.upsert(update.withColumn("v", F.lit(9.0)), order="v", run="r", batch_id=4)  # a replay
    state = table.state()
    assert len(state["deltas"]) == 1 and len(state["deltas"][0][1]) == 1
    assert spark.read.parquet(f"{table.path}/delta/{state['deltas'][0][0]}").count() == 1
    assert table.read().where("k = 3").first().v == -1.0 and table.read().count() == 5000
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan   # buckets without deltas are read as they lie


def test_compaction_that_crashes_leaves_the_table(spark, tmp_dir, monkeypatch):
    table = _table(spark, tmp_dir)
    for v in (1.0, 2.0):
        table.upsert(spark.createDataFrame([(1, "a", v), (2, None, v)], SCHEMA))

    def crash(state):
        raise RuntimeError("crash")
    monkeypatch.setattr(table, "_switch", crash)
    with pytest.raises(RuntimeError):
        table.compact()
    monkeypatch.undo()
    assert _rows(table.read()) == [("1", "a", "2.0"), ("2", "None", "2.0")]
    running = table.read()               # a reader that planned before the compaction
    table.compact()
    assert _rows(table.read()) == _rows(running) == [("1", "a", "2.0"), ("2", "None", "2.0")]
