"""Documents to training shards: quality, near duplicates, benchmark, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of ``documents`` (the last one
the placement). A stage's result is written as Parquet in the shared scratch folder and read as the next one's
input, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airgrain.llm.common import saved, table
from airgrain.llm.decontaminate import decontaminate
from airgrain.llm.jaccard import jaccard_stage
from airgrain.llm.mixing import mix_stage
from airgrain.llm.quality import quality_stage
from airgrain.llm.sharding import shard_stage

STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", jaccard_stage),
    ("decontamination", decontaminate),
    ("mixing", mix_stage),
    ("sharding", shard_stage),
]

# The quality model cannot be stated in SQL; tests/llm/test_queries.py compares each stage with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
