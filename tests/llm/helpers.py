"""Fixtures and edge cases shared by the tests of the training-data operators."""

import pytest

SMALL = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows."""
    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame(
            [(*r, len(r[1]) if r[1] is not None else None) for r in full], DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c"), (None, "no id at all here"),
         (7, "same text twice over"), (7, "same text twice over"), (8, "x" * 200_000),
         (9, "word " * 30_000), (10, "naïve Ω 漢字 🙂  two  spaces\r\n\x0b\x0c end ")]


@pytest.fixture(scope="session")
def edge_docs(docs_of):
    """NULLs, empty, blank, short, very long, repeated and odd texts."""
    return docs_of([(i, t, "en", "s") for i, t in EDGES])


def clashing(df):
    """The same rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ["_t", "_w", "_n", "size", "hash", "fp", "uid", "row", "kept", "length", "piece",
             "target", "copies", "spans", "node", "root", "component_id", "score", "_row", "_text"]
    return df.withColumns({n: F.lit(n) for n in names})
