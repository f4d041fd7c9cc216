"""Stream operators with keyed state of their own (``transformWithState``).

match_streams     reports and config changes as two streams: a report meets the config of
                  its site that is in force when it arrives (value state per site)
config_snapshots  the whole current config, once for every change (map state)
ranked_windows    top N of each window by event-time timers (list state per window)

State lives in the RocksDB state store (``session.STATEFUL_CONF``), so it is not bounded by
an executor's heap, and its checkpoints hold changes only. What Python does per row is to
carry text from one row to another: parsing, the threshold test and the ranks' counts are
Spark expressions before and after it.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from sitewatch import schemas as S
from sitewatch.functions.json import readings_map
from sitewatch.operators.match import apply_rules
from sitewatch.operators.windows import window_counts
from sitewatch.session import use_state_store

# executors get the processors themselves and need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CONFIG, REPORT = 0, 1   # at one instant, a config arrives before a report
SALTS = 16
EXACT_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
CONFIG_FIELDS = "config_id BIGINT, is_delete INT, `interval` INT, monitor_items STRING"


class ConfigInForce(StatefulProcessor):
    """Value state: the last config of a site to arrive. Reports leave with it.

    Rows of one micro-batch are taken in the order of their arrival. A config that arrived
    before the one that is held is out of date and changes nothing.
    """

    def init(self, handle):
        self.held = handle.getValueState("config", "arrival long, seq long, config string")

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        frame = pd.concat(list(rows), ignore_index=True)
        frame = frame.sort_values(["arrival", "kind", "seq"], kind="stable")
        before = self.held.get() if self.held.exists() else None
        is_config = frame["kind"] == CONFIG
        if before is not None:
            stale = (frame["arrival"] < before[0]) | (
                (frame["arrival"] == before[0]) & (frame["seq"] <= before[1]))
            frame, is_config = frame[~(is_config & stale)], is_config[~(is_config & stale)]
        config = frame["payload"].where(is_config).ffill()
        if before is not None:
            config = config.fillna(before[2])
        if is_config.any():
            last = frame[is_config].iloc[-1]
            self.held.update((int(last["arrival"]), int(last["seq"]), last["payload"]))
        found = config[~is_config].astype(object)
        yield pd.DataFrame({"report": frame["payload"][~is_config],
                            "config": found.where(found.notna(), None)})

    def close(self):
        pass


def match_streams(reports: DataFrame, configs: DataFrame, arrival: str = "arrival",
                  salts: int = SALTS) -> DataFrame:
    """JN-1 to JN-4, ST-11 on two streams: reports with ``status``, ``config_id`` and
    ``violations``, as of :func:`sitewatch.operators.match.match_reports`.

    ``reports`` have ``site_id`` and the sensors (or ``data``), ``configs`` the columns of a
    config row; both have the time of ``arrival`` (a topic's record timestamp). A site's
    reports are dealt over ``salts`` tasks, its (few) configs go to each of them. A report
    that arrives before its site's first config passes unmatched.
    """
    use_state_store(reports.sparkSession)
    if "data" not in reports.columns:
        reports = reports.withColumn("data", readings_map())
    schema = reports.schema
    left = reports.select(
        "site_id", F.lit(REPORT).alias("kind"), F.unix_micros(arrival).alias("arrival"),
        F.lit(0).cast("long").alias("seq"),
        F.to_json(F.struct(*reports.columns), EXACT_TIME).alias("payload"))
    left = left.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(payload), {salts}) AS INT)"))
    items = F.col("monitor_items")
    if dict(configs.dtypes)["monitor_items"] != "string":
        items = F.to_json(items, {"ignoreNullFields": "false"})
    right = configs.select(
        "site_id", F.lit(CONFIG).alias("kind"), F.unix_micros(arrival).alias("arrival"),
        F.col("config_id").cast("long").alias("seq"),
        F.to_json(F.struct("config_id", "is_delete", "interval", items.alias("monitor_items")),
                  EXACT_TIME).alias("payload"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    met = left.unionByName(right).groupBy("site_id", "salt").transformWithStateInPandas(
        ConfigInForce(), outputStructType="report string, config string",
        outputMode="Append", timeMode="None")
    parsed = met.select(F.from_json("report", schema, EXACT_TIME).alias("r"),
                        F.from_json("config", CONFIG_FIELDS).alias("c")).select(
        "r.*", "c.config_id", F.col("c.is_delete").alias("_is_delete"),
        F.col("c.interval").alias("_interval"),
        F.from_json("c.monitor_items", S.RULES).alias("_rules"))
    return apply_rules(parsed, rules="_rules", is_delete="_is_delete",
                       interval="_interval").drop("_rules", "_is_delete", "_interval")


class EveryConfig(StatefulProcessor):
    """Map state: site -> its current config. One snapshot for every change, in order."""

    def init(self, handle):
        self.configs = handle.getMapState("configs", "site_id int", "config string")

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        frame = pd.concat(list(rows), ignore_index=True).sort_values("config_id", kind="stable")
        now = {k[0]: v[0] for k, v in self.configs.iterator()}
        out, touched = [], set()
        for change, site, config in zip(frame["config_id"], frame["site"], frame["payload"]):
            now[site] = config
            touched.add(site)
            text = ",".join(f'"{s}":{now[s]}' for s in sorted(now))
            out.append((change, site, "{" + text + "}"))
        for site in touched:
            self.configs.updateValue((int(site),), (now[site],))
        yield pd.DataFrame(out, columns=["config_id", "site_id", "snapshot"])

    def close(self):
        pass


def config_snapshots(configs: DataFrame, by: str | None = None) -> DataFrame:
    """ST-10: for every config change, the current config of all sites after it.

    Output: ``config_id, site_id`` of the change and ``snapshot``, a map from site to
    ``struct(config_id, is_delete, interval, monitor_items)``. Changes of a micro-batch
    are taken in the order of ``config_id``. One map means one key of state, as in the
    application this replaces: ``by`` (a column, such as the topic's partition) keeps one
    map for each of its values instead.
    """
    use_state_store(configs.sparkSession)
    items = F.col("monitor_items")
    if dict(configs.dtypes)["monitor_items"] == "string":
        items = F.from_json(items, S.RULES)
    rows = configs.where("site_id IS NOT NULL").select(
        (F.col(by) if by else F.lit(0)).alias("part"), F.col("config_id").cast("long"),
        F.col("site_id").cast("int").alias("site"),
        F.to_json(F.struct("config_id", "is_delete", "interval",
                           items.alias("monitor_items"))).alias("payload"))
    out = rows.groupBy("part").transformWithStateInPandas(
        EveryConfig(), outputStructType="config_id long, site_id int, snapshot string",
        outputMode="Append", timeMode="None")
    kind = ("MAP<STRING, STRUCT<config_id: BIGINT, is_delete: INT, `interval`: INT, "
            f"monitor_items: {S.RULES.simpleString()}>>")
    return out.withColumn("snapshot", F.transform_keys(
        F.from_json("snapshot", kind), lambda site, _: site.cast("int")))


class TopOfWindow(StatefulProcessor):
    """List state: the best rows of a window so far, at most ``n``. A timer 1 ms after the
    window's end ranks and emits them and clears the state."""

    def __init__(self, n):
        self.n = n

    def init(self, handle):
        self.handle = handle
        self.best = handle.getListState("best", "cnt long, site_id int")

    def handleInputRows(self, key, rows, timerValues):
        found = [(int(c), int(s)) for c, s in self.best.get()] if self.best.exists() else []
        if not found:
            self.handle.registerTimer(int(key[0].timestamp() * 1000) + 1)
        for frame in rows:
            found += zip(frame["cnt"].tolist(), frame["site_id"].tolist())
            found = sorted(found, key=lambda x: (-x[0], x[1]))[:self.n]
        self.best.put(found)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd

        found = [(int(c), int(s)) for c, s in self.best.get()]
        self.best.clear()
        yield pd.DataFrame([(key[0], s, c, i) for i, (c, s) in enumerate(found, start=1)],
                           columns=["window_end", "site_id", "cnt", "rank"])

    def close(self):
        pass


def ranked_windows(reports: DataFrame, n: int = 3, size: str = "10 seconds",
                   slide: str = "5 seconds", ts: str = "ts", key: str = "site_id") -> DataFrame:
    """TOP-1, ST-9: ``window_end, site_id, cnt, rank`` of the ``n`` busiest sites of every
    sliding window, ties to the lower id, emitted when the watermark passes the window's
    end. ``reports`` need a watermark on ``ts``. A window's counts meet in one task, which
    keeps ``n`` of them."""
    use_state_store(reports.sparkSession)
    counts = window_counts(reports, key, size, slide, ts).select(
        "window_end", F.col(key).cast("int").alias("site_id"), "cnt")
    return counts.groupBy("window_end").transformWithStateInPandas(
        TopOfWindow(n), outputStructType="window_end timestamp, site_id int, cnt long, rank int",
        outputMode="Append", timeMode="EventTime")
