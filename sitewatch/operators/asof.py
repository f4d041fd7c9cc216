"""As-of lookup: for each left row, the latest right row of the same key with
``right_ts <= left_ts`` (the config that was in force when a report arrived).

Spark has no as-of join, and a window partitioned by the key alone would put
a hot site (possibly a third of all reports) into one task. Instead the time
axis is cut into buckets and the work is partitioned by (key, bucket):

1. left and right rows go through one shuffle by (key, bucket), which both of
   the following steps read;
2. carry-in: the last right row of every (key, bucket), pre-aggregated to one
   row each; from these the last one of any earlier bucket of the key's day, and
   from the days' last ones that of any earlier day (a prefix scan in two levels: a
   task holds the buckets of one key and day, or the days of one key, never all
   buckets of a key);
3. within a bucket, sorted by time, ``last(..., ignorenulls)`` over the running
   frame, and the carry-in before the bucket's first right row.

Key and bucket are one struct, which is never NULL: grouping, window and join all ask for the
shuffle's own partitioning, and the join follows the window's order.

No pairs are generated and no group grows beyond one bucket of one key. Without a
given ``bucket`` its width is measured: the busiest hour of any key is counted, and
the hour is cut so that a bucket of it holds about ``bucket_rows`` rows. The rows are
counted too: beyond FEW_ROWS the shuffle gets a partition for every TASK_ROWS of them,
which the engine does not merge by their compressed size, so that what a task sorts does
not grow with the tables. Rows without
key or time match nothing and are spread over buckets of their own. The left rows
travel whole through the shuffle: project them to the needed columns first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_ROWS = 25_000
TASK_ROWS = 100_000
FEW_ROWS = 400_000
HOUR = 3600
LOOSE_BUCKETS = 1024  # for rows without key or time


def measured_bucket(left: DataFrame, right: DataFrame, key: str, left_ts: str,
                    right_ts: str, bucket_rows: int = BUCKET_ROWS) -> tuple[int, int]:
    """Seconds of a bucket in which the busiest hour of any key leaves about
    ``bucket_rows`` rows (1 to 3600), and the number of all rows. One partial aggregate over
    keys and times."""
    both = left.select(F.col(key).alias("k"), F.col(left_ts).alias("t")).unionByName(
        right.select(F.col(key).alias("k"), F.col(right_ts).alias("t")))
    hours = both.groupBy("k", F.expr(
        f"floor(unix_seconds(CAST(t AS TIMESTAMP)) / {HOUR})").alias("h")).count()
    busiest, rows = hours.agg(
        F.expr("max(count) FILTER (WHERE k IS NOT NULL AND h IS NOT NULL)"), F.sum("count")).first()
    return max(1, min(HOUR, HOUR * bucket_rows // max(1, busiest or 0))), rows or 0


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str,
              right_ts: str, right_order: str, right_cols, bucket: int | None = None,
              prefix: str = "", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Left rows + ``prefix``-named columns of the matching right row (NULL if
    none). Ties on time: right rows at the same instant count as earlier;
    among right rows of one instant the greatest ``right_order`` wins.
    ``bucket``: seconds of a bucket (measured if not given)."""
    measured, rows = measured_bucket(left, right, key, left_ts, right_ts, bucket_rows)
    bucket = bucket or measured
    parts = []
    if rows > FEW_ROWS:
        parts = [max(-(-rows // TASK_ROWS),
                     int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))]
    start = f"timestamp_seconds(floor(unix_seconds(CAST({{}} AS TIMESTAMP)) / {int(bucket)}) * {int(bucket)})"
    right_cols = list(right_cols)
    left_cols = left.columns
    k, lt, rt = f"`{key}`", f"`{left_ts}`", f"`{right_ts}`"
    rv = (f"named_struct('_t', {rt}, '_o', CAST(`{right_order}` AS BIGINT), "
          + ", ".join(f"'{c}', `{c}`" for c in right_cols) + ")")
    lv = "named_struct(" + ", ".join(f"'{c}', `{c}`" for c in left_cols) + ")"
    loose = f"timestamp_seconds(pmod(xxhash64({lt}, to_json({lv})), {LOOSE_BUCKETS}))"
    r = right.where(f"{k} IS NOT NULL AND {rt} IS NOT NULL").selectExpr(
        f"{k} AS _k", f"{start.format(rt)} AS _b", f"{rt} AS _t", "0 AS _tag",
        f"CAST(`{right_order}` AS BIGINT) AS _o", f"{rv} AS _rv")
    held = f"{k} IS NOT NULL AND {lt} IS NOT NULL"
    l = left.selectExpr(
        f"CASE WHEN {held} THEN {k} END AS _k",
        f"CASE WHEN {held} THEN {start.format(lt)} ELSE {loose} END AS _b",
        f"{lt} AS _t", "1 AS _tag", "CAST(NULL AS BIGINT) AS _o", f"{lv} AS _lv")
    rv_type = r.schema["_rv"].dataType.simpleString()
    lv_type = l.schema["_lv"].dataType.simpleString()
    # 1. one shuffle
    u = (l.selectExpr("*", f"CAST(NULL AS {rv_type}) AS _rv")
         .unionByName(r.selectExpr("*", f"CAST(NULL AS {lv_type}) AS _lv"))
         .selectExpr("named_struct('_k', _k, '_b', _b) AS _kb", "_t", "_tag", "_o", "_lv", "_rv")
         .repartition(*parts, "_kb"))
    # 2. carry-in. The engine reuses the shuffle above if both readers ask for the same
    # rows and columns: so _lv is read here too (counted), and the join below has a key
    # that can't be NULL, which keeps it from filtering this side before the shuffle.
    marks = u.groupBy("_kb").agg(
        F.expr("max_by(_rv, struct(_t, _o)) FILTER (WHERE _tag = 0)").alias("_last"),
        F.count("_lv").alias("_n"))
    # Likewise the days count _n: both levels ask the same of the shuffle.
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    in_day = marks.selectExpr(
        "_kb AS _ckb", "_kb._k AS _ck", "_kb._b AS _cb", "date_trunc('DAY', _kb._b) AS _cd", "_n",
        "_last").selectExpr(
        "*", f"last(_last, true) OVER (PARTITION BY _ck, _cd ORDER BY _cb {before}) AS _in_day")
    days = marks.selectExpr("_kb._k AS _dk", "date_trunc('DAY', _kb._b) AS _dd", "_kb._b AS _b",
                            "_n", "_last") \
        .groupBy("_dk", "_dd").agg(
            F.expr("max_by(_last, _b) FILTER (WHERE _last IS NOT NULL)").alias("_day_last"),
            F.sum("_n").alias("_dn")).selectExpr(
        "_dk", "_dd", "_dn",
        f"last(_day_last, true) OVER (PARTITION BY _dk ORDER BY _dd {before}) AS _earlier")
    carry = in_day.join(days, F.col("_ck").eqNullSafe(F.col("_dk"))
                        & F.col("_cd").eqNullSafe(F.col("_dd")), "left").selectExpr(
        "_ckb", "IF(_n >= 0 AND _dn >= 0, coalesce(_in_day, _earlier), NULL) AS _carry")
    # 3. running last right row within the bucket
    own = F.expr("last(_rv, true) OVER (PARTITION BY _kb ORDER BY _t, _tag, _o "
                 "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    out = (u.withColumn("_own", own).join(carry, F.col("_kb") == F.col("_ckb"), "left")
           .where("_tag = 1")  # an outer join: the rows are never the broadcast side
           .withColumn("_hit", F.expr("coalesce(_own, _carry)")))
    return out.selectExpr(*[f"_lv.`{c}` AS `{c}`" for c in left_cols],
                          *[f"_hit.`{c}` AS `{prefix}{c}`" for c in right_cols])
