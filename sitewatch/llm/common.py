"""Shared helpers of the training-data operators: written tables, shipped code."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Paths of written tables, one list for every open :func:`work_tables`, innermost last.
_OPEN: list[list[str]] = []

# White space of the word rule: a word is a run of code points outside it.
WS = r"\x20\x09-\x0D"


def work_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for written tables (``spark.checkpoint.dir``).

    A private folder is set only where the session has none and runs in a single
    JVM, as in tests; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_llm_work", None)
    if not root:
        master = context.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        root = tempfile.mkdtemp(prefix="llm-work-")
        context._llm_work = root  # a running session does not let the setting be changed
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: what comes after survives lost executors without computing
    ``df`` again. The files go when the driver's JVM ends, or by :func:`discard` or
    :func:`work_tables`.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for held in _OPEN[-1:]:
        held.append(path)
    target, system = _file(spark, path)
    system.deleteOnExit(target)
    table = spark.read.schema(df.schema).parquet(path)
    table._work_path = path
    return table


def _file(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop's."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(table: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing will read again."""
    target, system = _file(table.sparkSession, table._work_path)
    system.delete(target, True)


@contextmanager
def work_tables(spark: SparkSession):
    """Within the block, ``written`` tables are work tables: their files are deleted at its
    end. ``keep(table)``, of the function that the block is given, leaves one to the
    enclosing block, or to the driver's end."""
    made: list[str] = []
    kept: list[str] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table._work_path)
        return table

    _OPEN.append(made)
    try:
        yield keep
    finally:
        _OPEN.pop()
        for path in made:
            if path not in kept:
                target, system = _file(spark, path)
                system.delete(target, True)
        for held in _OPEN[-1:]:
            held.extend(kept)


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once per Spark context.

    Tasks import their functions by name, and a cluster's machines need not have the
    package installed.
    """
    context = spark.sparkContext
    if getattr(context, "_sitewatch_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="sitewatch-code-"), "sitewatch_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    context._sitewatch_shipped = True


def crc_bucket(col, n: int):
    """crc32 of the value as text, modulo ``n``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n
