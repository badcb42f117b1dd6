"""Stages on awkward tables: helper names as extra columns, hot ids, and the whole pipeline against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgrain.llm import decontaminate, mixing, quality, sharding

GOOD, BAD = "This is a plain line of words.", "BUY!! NOW!! THIS!! THING!! BUY!!"


@pytest.mark.parametrize("extra", ["order", "_row", "mix_shard", "_key", "size", "passes", "shards"])
def test_mix_keeps_extra_columns(spark, extra):
    rows = [(i % 7 or None, f"word {i} " * (i % 5), f"s{i % 3}" if i % 4 else None, i) for i in range(60)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, `{extra}` int")
    out = mixing.mix_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    assert set(got) <= set(rows) and len({r[3] for r in got}) > 20 and all(r[1] for r in got)


@pytest.mark.parametrize("extra", ["text_hash", "hashes", "n_hit", "TEXT_HASH", "items"])
def test_decontamination_keeps_extra_columns(spark, tmp_path, extra):
    words = " ".join(f"w{i}" for i in range(20))
    spark.createDataFrame([(1, words)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, words, 5), (2, "all else", 6), (None, None, 7), (None, words, 8), (2, "", 9)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, `{extra}` int")
    out = decontaminate.decontaminate(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and sorted(r[2] for r in out.collect()) == [6, 7, 9]


@pytest.mark.parametrize("extra", ["score", "SCORE", "quality", "_h", "score_"])
def test_quality_stage_keeps_extra_columns(spark, tmp_path, extra):
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, GOOD if i % 2 else BAD, i) for i in range(40)] + [(None, GOOD, 100)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, `{extra}` int")
    out = quality.quality_stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and sorted(r[2] for r in out.collect()) == [*range(1, 40, 2), 100]
    assert quality.quality_stage(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_the_fit_is_bounded_in_rows_and_lines(spark, monkeypatch):
    """A doc_id with 10,000 rows, equal and different ones, and long documents: the driver gets no more than it asked for."""
    seen = []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda lines, length, f, label, **k: (seen.append((len(lines), int(lines.sum()))), real(lines, length, f, label, **k))[1])
    docs = spark.range(10_000).select(F.lit(2).cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit(GOOD)).otherwise(F.concat(F.lit(GOOD), F.col("id").cast("string"))).alias("text"))
    more = spark.createDataFrame([(i, "\n".join([GOOD if i % 2 else BAD] * 30)) for i in range(3, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(2, 60)] + [(4, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    both = docs.unionByName(more)
    assert quality.train(both, labels, sample=20) is not None and 10 < seen[-1][0] <= 20
    assert quality.train(more, labels, sample=1000, most_lines=300) is not None and seen[-1] == (10, 300)
    quality.train(more.unionByName(more), labels)
    assert seen[-1][0] == len({i for i in range(3, 60) if __import__("zlib").crc32(str(i).encode()) % 5})


@pytest.mark.parametrize("extra", ["shard", "slot", "g", "h", "_row"])
def test_sharding_ignores_extra_columns(spark, extra):
    rows = [(i % 9 or None, "same" if i % 3 else f"text {i}", i) for i in range(50)] + [(None, None, 0)]
    got = sharding.shard_stage(spark, spark.createDataFrame(rows, f"doc_id long, text string, `{extra}` int"), "").collect()
    count = np.bincount([r.shard for r in got], minlength=16)
    assert len(got) == 51 and count.max() - count.min() <= 1
