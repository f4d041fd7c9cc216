"""Query of HTML extraction."""

from __future__ import annotations

from sitewatch.llm import html_extract


def op4_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html_extract.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op4_html_extraction": op4_html_extraction}
ORACLE: dict[str, str] = {}
