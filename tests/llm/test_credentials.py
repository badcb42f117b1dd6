"""Secret scans of very long texts, and of tables whose columns bear the operator's own names."""

import time

import pytest
from pyspark.sql import functions as F

from airgrain.llm import credentials


def scanned(spark, rows):
    found = credentials.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    return {r.doc_id: r for r in found.select("doc_id", credentials.span_text(F.col("base_spans")).alias("base"), credentials.span_text(F.col("spans")).alias("all")).collect()}


def test_long_runs_and_many_digests(spark):
    """Work grows with the text: a run of letters is not read again from each place, spans are not copied for each match."""
    digest = "0123456789abcdef0"
    texts = ["z" * 400_000, " ".join([digest] * 12_000), "y" * 200_000 + " https://" + "z" * 200_000, ("password = " + "x" * 20 + "\n") * 5_000, "ABCDEFGH01234567 " * 6_000, "x" * 40 + "://y", "A1" * 100_000 + " " + digest]
    began = time.time()
    got = scanned(spark, list(enumerate(texts)))
    assert time.time() - began < 90
    assert got[0].all == "" and got[4].all == ""
    assert got[1].all == got[1].base == ",".join(f"hex:{i * 18}:{i * 18 + 17}" for i in range(12_000))
    assert got[3].base.count("assign:") == 5_000 and got[3].base.startswith("assign:0:31,assign:32:63")
    assert got[6].all == "ident:0:200000,hex:200001:200018"


@pytest.mark.parametrize("extra", ["_row", "spans", "base_spans", "_weak", "_r", "p", "BIN", "start"])
def test_extra_columns_stay(spark, extra):
    rows = [(1, "AKIA" + "A1" * 8 + " password=" + "x" * 12, 7), (None, None, 8), (2, "", 9), (2, "", 9)]
    found = credentials.scan_secrets(spark.createDataFrame(rows, f"doc_id long, text string, `{extra}` int"))
    assert found.columns[:2] == ["doc_id", extra] and sorted(r[extra] for r in found.collect()) == [7, 8, 9, 9]
    spans = [c for c in found.columns if c.startswith("spans") and c != extra][0]
    assert found.where(F.size(spans) == 2).count() == 1


def test_no_documents(spark):
    assert scanned(spark, []) == {}
