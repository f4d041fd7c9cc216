"""Parse table of malformed and edge report lines, CSV and config parsing."""

import json

from pyspark.sql import functions as F

from sitewatch import fixtures as FX
from sitewatch.operators.parse import (accepted_reports, annotate_config_messages,
                                       annotate_csv_events, annotate_reports,
                                       explode_rules, parse_config_messages,
                                       parse_csv_events, parse_report_table,
                                       rejected_lines, rejected_reports)

def _made(forms, site=3, ts=1704067200000):
    """The lines of an event in every form, with the expected reason."""
    return [(f.replace("{site}", str(site)).replace("{ts}", str(ts)), r) for f, r in forms]


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_bad_lines_table(spark):
    made = _made(FX.BAD_REPORT_FORMS)
    ann = annotate_reports(_lines(spark, [v for v, _ in made]))
    assert {r.value: r.reject_reason for r in ann.collect()} == dict(made)
    good = accepted_reports(ann).orderBy("lx").collect()
    assert [(r.site_id, r.tmp, r.hmt, r.lx) for r in good] == [(3, None, None, None),
                                                               (3, 20.5, 0.5, 100.0)]
    assert good[0].ts.year == 2024
    assert rejected_reports(ann).count() == 10


def test_strict_rejects_unknown_fields(spark):
    made = _made(FX.BAD_REPORT_FORMS)
    ann = annotate_reports(_lines(spark, [v for v, _ in made]), strict=True)
    got = {r.value: r.reject_reason for r in ann.collect()}
    assert got[made[-1][0]] == "unknown_field"
    assert got[made[0][0]] is None


def test_fixture_gives_a_bad_line_per_event(spark):
    for forms in (FX.BAD_REPORT_FORMS, FX.BAD_CSV_FORMS, FX.BAD_CONFIG_FORMS):
        rows = FX.bad_lines(spark, "/root/testdata/sf0.001", forms).collect()
        assert len(rows) == 1000
        one = next(r for r in rows if r.event_id % len(forms) == 0)
        assert "{" not in forms[0][0].replace("{site}", "").replace("{ts}", "") \
            or "{site}" not in one.value


def test_csv_and_config_quarantines(spark):
    made = _made(FX.BAD_CSV_FORMS) + [("", "too_few_fields"), ("u,/a,5", None)]
    ann = annotate_csv_events(_lines(spark, [v for v, _ in made]))
    assert {r.value: r.reject_reason for r in ann.collect()} == dict(made)
    assert rejected_lines(ann).count() == len(made) - 1
    made = _made(FX.BAD_CONFIG_FORMS) + [('{"siteId":1,"timestamp":2}', None)]
    ann = annotate_config_messages(_lines(spark, [v for v, _ in made]))
    assert {r.value: r.reject_reason for r in ann.collect()} == dict(made)


def test_roundtrip_wire_json(spark):
    rep = FX.reports_with_data(spark, "/root/testdata/sf0.001")
    lines = FX.reports_wire(spark, "/root/testdata/sf0.001")
    parsed = accepted_reports(annotate_reports(lines))
    cols = ["site_id", "timestamp", "ts", "tmp", "hmt", "lx"]
    rows = rep.withColumn("ts", F.timestamp_millis("timestamp"))
    assert sorted(map(tuple, rows.select(*cols).collect())) \
        == sorted(map(tuple, parsed.select(*cols).collect()))


def test_csv_events_drop_bad_lines(spark):
    lines = _lines(spark, [" alice , ./home , 1000", "bob,./cart,xx", "short,line", "",
                           "cary,./prod?id=7,2000"])
    got = [tuple(r) for r in parse_csv_events(lines).collect()]
    assert got == [("alice", "./home", 1000), ("cary", "./prod?id=7", 2000)]


def test_config_messages_and_rules(spark):
    msg = json.dumps({"siteId": 3, "timestamp": 5, "version": 2, "interval": 30,
                      "isDelete": 0,
                      "monitorItems": {"tmp": {"type": "tmp", "open": 1, "max": 22.2,
                                               "min": 0.0}}})
    cfg = parse_config_messages(_lines(spark, [msg, "garbage"]))
    rows = cfg.collect()
    assert len(rows) == 1 and rows[0].site_id == 3 and rows[0].interval == 30
    rules = explode_rules(cfg.withColumn("config_id", cfg.version), keep=("config_id",))
    assert [(r.sensor, r.max) for r in rules.collect()] == [("tmp", 22.2)]


def test_report_table_keeps_data_text(spark):
    line = '{"siteId":1,"timestamp":7,"data":{"tmp":1.5}}'
    r = parse_report_table(_lines(spark, [line, '{"siteId":2}'])).collect()
    assert r[0].data == '{"tmp":1.5}' and r[1].timestamp is None
