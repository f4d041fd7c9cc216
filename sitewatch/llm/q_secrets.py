"""Query of secret scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewatch.llm import secret_scan


def op2_secret_scans(spark, sf_dir):
    """Secrets of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = secret_scan.secret_spans(docs)

    def joined(keep: str):
        return F.expr("array_join(transform(filter(spans, s -> " + keep + "), "
                      "s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")

    counts = [F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}")
              for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts,
                        F.sha2(joined("s.kind <> 'model'"), 256).alias("base_sha256"),
                        joined("true").alias("spans"))


QUERIES = {"op2_secret_scans": op2_secret_scans}
ORACLE: dict[str, str] = {}
