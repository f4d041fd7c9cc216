"""The pipeline's stages against brute force, and the registered queries."""

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from sitewatch.llm import (common, q_audit, q_dedup, q_mixing, q_rules, q_search, quality_rules,
                           secret_scan)

from .helpers import SMALL, clashing
from .test_mixing import plain_mix
from .test_simhash import plain_fingerprint, plain_groups
from .test_tokens_packing import _check_places


def _with_a_secret(spark, docs):
    """``docs`` and one more: the words of a long one backwards, with a key."""
    long = docs.orderBy(F.length("text").desc()).where("lang = 'en'").limit(40).collect()
    kept = {r.doc_id for r in quality_rules.verdicts(docs).where("kept").collect()}
    r = next(r for r in long if r.doc_id in kept)
    text = " ".join(reversed(r.text.split())) + ' token = "deadbeefdeadbeefdeadbeefdeadbeef"'
    return docs.union(spark.createDataFrame(
        [(99_999, text, r.lang, r.source, len(text))], docs.schema))


def test_stages(spark, small_docs):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "near_duplicates", "secret_scans",
                                        "source_mixing", "packing"]
    docs = _with_a_secret(spark, small_docs)
    kept = {r.doc_id for r in quality_rules.verdicts(docs).where("kept").collect()}
    docs = clashing(docs).cache()
    steps = [docs]
    for _, stage in C.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], SMALL).cache())
        assert steps[-1].columns == docs.columns
    rules, unique, clean, mixed = ([r.asDict() for r in s.collect()] for s in steps[1:])

    assert {r["doc_id"] for r in rules} == kept and 99_999 in kept

    fps = [(r["doc_id"], plain_fingerprint(r["text"])) for r in rules]
    assert sorted(r["doc_id"] for r in unique) == sorted(set(plain_groups(fps)))
    assert len(unique) < len(rules)

    before = {r["doc_id"]: r["text"] for r in unique}
    changed = 0
    for r in clean:
        spans = secret_scan.base_spans(before[r["doc_id"]])
        assert r["n_chars"] == len(r["text"]) and not secret_scan.base_spans(r["text"])
        assert spans or secret_scan.REDACTED in r["text"] or r["text"] == before[r["doc_id"]]
        changed += r["text"] != before[r["doc_id"]]
    assert len(clean) == len(unique) and changed

    taken, _, _ = plain_mix([(r["doc_id"], r["text"], r["source"]) for r in clean])
    times = {}
    for r in mixed:
        times[str(r["doc_id"])] = times.get(str(r["doc_id"]), 0) + 1
    assert times == {i: t // n for i, n, t in taken if t}

    rows = C.STAGES[-1][1](spark, steps[-1], SMALL).collect()
    _check_places(rows, 2048)
    ends = {}
    for r in rows:
        ends[r.doc_id] = ends.get(r.doc_id, 0) + (r.piece == 0)
    assert {str(i): n for i, n in ends.items()} == times

    # the pieces hold the mixed texts: their ids, document row by document row
    by_row = {}
    for r in rows:
        by_row.setdefault((r.doc_row, r.doc_id), []).append((r.piece, r.start, r.ids))
    assert len({i for i, _ in by_row}) == len(by_row) == len(mixed)
    library = Tokenizer.from_file(C.public_tokenizers.path(C.VOCABULARY))
    packed = []
    for (_, doc_id), parts in by_row.items():
        parts.sort()
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        packed.append((doc_id, [i for _, _, ids in parts for i in ids]))
    assert sorted(packed) == sorted(
        (int(r["doc_id"]), [*library.encode(r["text"], add_special_tokens=False).ids, 0])
        for r in mixed)


def test_run_leaves_the_last_tables_only(spark, tmp_path, monkeypatch):
    """What a stage wrote for itself goes with it; the pieces stay until they are read."""
    monkeypatch.setattr(common, "work_folder", lambda spark: str(tmp_path))
    rows = C.run(spark, SMALL)
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir() if p.is_dir()}
    assert left == {"packing-pieces", "packing-groups"}
    assert rows.count() > 0


def test_work_tables_keep_what_they_are_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "work_folder", lambda spark: str(tmp_path))
    with common.work_tables(spark):
        with common.work_tables(spark) as keep:
            a = keep(common.written(spark.range(3).toDF("a"), "kept"))
            common.written(spark.range(3).toDF("a"), "dropped")
        assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["kept"] and a.count() == 3
    assert not list(tmp_path.iterdir())


def test_run_and_empty_table(spark, tmp_path, small_docs):
    assert C.run(spark, SMALL).count() > 0
    small_docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_run_over_odd_rows(spark, tmp_path, small_docs, edge_docs):
    """NULLs in every column, blank, long and repeated texts beside ordinary ones."""
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 2, edge_docs.schema)
    long = small_docs.orderBy(F.length("text").desc()).limit(5)
    odd = long.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "upper(text) AS text",
                          "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source",
                          "CAST(NULL AS BIGINT) AS n_chars")
    plain = long.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang",
                            "CAST(NULL AS STRING) AS source", "CAST(NULL AS BIGINT) AS n_chars")
    docs = small_docs.union(edge_docs).union(nulls).union(odd).union(plain)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = C.run(spark, str(tmp_path)).collect()
    assert _check_places(rows, 2048) and {r.doc_id for r in rows} <= {
        r.doc_id for r in small_docs.collect()}


def test_registered_queries():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()


def test_oracle_matches(spark):
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(E.__file__)), "tools"))
    import oracle_check
    con = oracle_check.duck_connect(SMALL)
    for module in (q_rules, q_search, q_mixing, q_dedup, q_audit):
        for name in module.ORACLE:
            status, detail = oracle_check.compare_one(spark, con, SMALL, name)
            assert status == "OK" and "type differences" not in detail, detail
