"""The rollup and purge jobs end to end on a partitioned averaged table."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitewatch import fixtures as FX
from sitewatch import schemas as S
from sitewatch.cli import main
from sitewatch.operators.windows import rollup, window_averages
from sitewatch.sinks.writers import (AVG_PARTITIONS, read_table, upsert_table,
                                     with_avg_partitions)

COLS = ["site_id", "end_time", "type", "avg_tmp", "avg_hmt", "avg_lx"]


def test_rollup_job_and_purge(spark, tmp_dir):
    table = f"{tmp_dir}/avg"
    minute = window_averages(FX.reports(spark, SF_SMALL), tier="MINUTE")
    upsert_table(spark, with_avg_partitions(minute), table, S.AVG_KEYS,
                 partition_by=AVG_PARTITIONS)
    assert main(["rollup", "--table", table, "--type", "1"]) == 0
    assert main(["rollup", "--table", table, "--type", "1"]) == 0   # re-run: same table
    assert main(["rollup", "--table", table, "--type", "2", "--siteId", "3",
                 "--start", "2024-01-01 00:00:00", "--end", "2024-01-10 00:00:00"]) == 0
    t = read_table(spark, table)
    hours = {tuple(r) for r in t.where("type = 2").select(*COLS).collect()}
    expect = {tuple(r) for r in rollup(minute, 1).select(*COLS).collect()}
    assert hours == expect
    days = t.where("type = 3").select("site_id", "end_time").collect()
    assert days and {r.site_id for r in days} == {3}
    assert max(r.end_time for r in days).day <= 11
    assert main(["purge", "--table", table, "--types", "1", "2"]) == 0
    left = read_table(spark, table).groupBy("type").count().collect()
    assert [r.type for r in left] == [3]
    assert t.where(F.col("end_date").isNull()).count() == 0


def test_jdbc_upsert_statement():
    from sitewatch.sinks.writers import upsert_statement
    sql = upsert_statement("dev_avg_data", "dev_avg_data_staging",
                           ["site_id", "end_time", "type", "avg_tmp"], S.AVG_KEYS)
    assert sql == ("INSERT INTO dev_avg_data (`site_id`, `end_time`, `type`, `avg_tmp`) "
                   "SELECT `site_id`, `end_time`, `type`, `avg_tmp` FROM dev_avg_data_staging "
                   "ON DUPLICATE KEY UPDATE `avg_tmp` = VALUES(`avg_tmp`)")


def test_tier_scan_prunes_day_partitions(spark, tmp_dir):
    from sitewatch.sources.readers import read_tier
    table = f"{tmp_dir}/avg"
    hour = window_averages(FX.reports(spark, SF_SMALL), tier="HOUR")
    upsert_table(spark, with_avg_partitions(hour), table, S.AVG_KEYS,
                 partition_by=AVG_PARTITIONS)
    scan = read_tier(read_table(spark, table), site_id=2, start="2024-01-05 00:00:00",
                     end="2024-01-06 00:00:00", tier_code=2)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "(end_date" in partition_filters and "type" in partition_filters
    assert {r.end_time.day for r in scan.collect()} <= {5, 6}


def test_topn_command_runs_to_completion(spark, tmp_dir):
    import os
    src = f"{tmp_dir}/in"
    FX.reports_json(spark, SF_SMALL).coalesce(1).write.text(src)
    assert main(["topn", "--reports", src, "--available-now", "--out", f"{tmp_dir}/out",
                 "--checkpoint", f"{tmp_dir}/ckpt"]) == 0
    assert os.listdir(f"{tmp_dir}/ckpt/commits")
    assert spark.read.parquet(f"{tmp_dir}/out").count() > 1000   # every row, no console cut


def test_document_writer_replays_in_place(spark, tmp_dir):
    from sitewatch.sinks.records import search_documents
    from sitewatch.sinks.writers import write_documents
    docs = search_documents(FX.clicks(spark, SF_SMALL))
    write_documents(docs, f"{tmp_dir}/docs", batch_id=4, run_id="r")
    write_documents(docs, f"{tmp_dir}/docs", batch_id=4, run_id="r")     # replay: same folder
    lines = spark.read.text(f"{tmp_dir}/docs").collect()
    assert len(lines) == 1000 and lines[0].value.startswith('{"')


def test_staging_tables_are_per_run_and_batch():
    from sitewatch.sinks.writers import staging_name
    names = {staging_name("t", r, b) for r in ("a-1", "b-2") for b in (0, 1)}
    assert len(names) == 4 and "t_staging_a1_0" in names
    assert staging_name("t") != staging_name("t")


def test_jdbc_options_reach_the_jobs():
    from sitewatch.cli import _parser, _properties
    for argv in (["rollup", "--type", "1"], ["averages"], ["monitor", "--out", "o"]):
        args = _parser().parse_args([*argv, "--jdbc-url", "jdbc:mysql://h/d",
                                     "--jdbc-property", "user=u", "--jdbc-property", "password=a=b"])
        assert args.jdbc_url == "jdbc:mysql://h/d"
        assert _properties(args) == {"user": "u", "password": "a=b"}


def test_sources_and_sinks_are_given_their_options(spark, monkeypatch):
    """The options of a partitioned JDBC read, without a database."""
    from pyspark.sql import DataFrameReader
    from sitewatch.sources.readers import read_jdbc_query
    options = {}

    def option(self, k, v):
        options[k] = v
        return self

    monkeypatch.setattr(DataFrameReader, "option", option)
    monkeypatch.setattr(DataFrameReader, "load", lambda self: spark.range(1))
    read_jdbc_query(spark, "jdbc:x", "select 1 a", {"user": "u"}, "a", 0, 100, 4)
    assert options["dbtable"] == "(select 1 a) t" and options["user"] == "u"
    assert options["partitionColumn"] == "a" and options["numPartitions"] == 4


def test_alarms_job_on_two_streams(spark, tmp_dir):
    """Configs that arrive before the reports: every alarm of the batch form, once."""
    from sitewatch.operators.match import alarms, match_reports
    from sitewatch.operators.parse import (accepted_reports, annotate_reports,
                                           parse_config_messages)
    from sitewatch.sinks.once_log import read_log
    from sitewatch.sinks.records import alarm_records
    messages = FX.config_messages(spark, SF_SMALL).where("config_id < 200")
    messages.select("value").coalesce(1).write.text(f"{tmp_dir}/configs")
    FX.reports_json(spark, SF_SMALL).coalesce(2).write.text(f"{tmp_dir}/reports")
    args = ["alarms", "--reports", f"{tmp_dir}/reports", "--configs", f"{tmp_dir}/configs",
            "--out", f"{tmp_dir}/log", "--checkpoint", f"{tmp_dir}/ckpt", "--available-now"]
    assert main(args) == 0
    configs = parse_config_messages(messages.select("value")).withColumn(
        "config_id", F.col("timestamp"))   # messages of one file: their own time decides
    matched = match_reports(
        accepted_reports(annotate_reports(FX.reports_json(spark, SF_SMALL))),
        configs)
    expect = sorted(r.value for r in alarm_records(alarms(matched)).collect())
    assert sorted(r.value for r in read_log(spark, f"{tmp_dir}/log").collect()) == expect
    assert main(args) == 0 and len(expect) > 50       # nothing new: nothing more
    assert read_log(spark, f"{tmp_dir}/log").count() == len(expect)


def test_averages_into_a_table_merged_when_read(spark, tmp_dir):
    from sitewatch.cli import averaged_table
    from sitewatch.operators.parse import accepted_reports, annotate_reports
    FX.reports_json(spark, SF_SMALL).coalesce(2).write.text(f"{tmp_dir}/reports")
    assert main(["averages", "--reports", f"{tmp_dir}/reports", "--table", f"{tmp_dir}/avg",
                 "--tier", "DAY", "--merge-on-read", "--checkpoint", f"{tmp_dir}/ckpt",
                 "--available-now"]) == 0
    rows = {tuple(r) for r in averaged_table(spark, f"{tmp_dir}/avg").read().select(*COLS).collect()}
    reports = accepted_reports(annotate_reports(FX.reports_json(spark, SF_SMALL)))
    whole = {tuple(r) for r in window_averages(reports, tier="DAY").select(*COLS).collect()}
    assert rows and rows <= whole and len(whole - rows) <= FX.N_SITES * 2
    assert main(["compact", "--table", f"{tmp_dir}/avg"]) == 0
    assert {tuple(r) for r in averaged_table(spark, f"{tmp_dir}/avg").read().select(*COLS)
            .collect()} == rows
