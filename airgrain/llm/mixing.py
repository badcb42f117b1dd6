"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sizes and a permuting hash per document, once over all texts.
2. Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and share all words; none above
   ``most`` times its source, the excess reshared by weight (water-filling over the sorted sources).
3. A source's documents fall into blocks of about ``BLOCK`` documents by hash. It is taken whole as often as the
   target allows; of the next pass, blocks in permuted order until the target, the last block document by
   document, a document being taken if that brings the sum nearer.
4. The drawn blocks go to the output shards: a root node holds each source's quota of blocks; every node is split
   between its two halves of shards by drawing without replacement (exact multivariate hypergeometric counts, one
   Bernoulli draw per block). All margins are exact: shards differ by one block at most, every block goes out once.
5. Within a source the permuted blocks are dealt to shards by these quotas, and each shard is ordered by hash.

A hot source has as many more blocks, so no task holds a source. The table of sources meets in one task (one row
each), the blocks' table per source. Null text has size 0; empty texts are never taken; repeated rows are
separate documents; extra columns are kept by ``mix`` and ignored by the query. All choices are hashes of doc_id
and text, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import SPACE, free, left_join, saved, table

WEIGHTS, MOST, BLOCK, SHARDS = (5.0, 2.0, 1.0), 3, 4096, 16
BROADCAST_ROWS = 100_000


def _targets(sized: DataFrame, weights, most: int) -> DataFrame:
    """source, source_size, n_docs, target."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("cap", (most * F.col("source_size")).cast("double"))
    # Sources reach their cap in the order of cap / weight; find how many do.
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy(F.lit(0))
    level = (F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight"))
    # A source is capped if the level, were it and all later ones open, exceeds its ratio.
    sources = sources.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("weight") <= F.col("cap"))
    final = F.max(F.when(F.col("_open"), F.col("_level"))).over(everything)  # that of the first open one; later ones are lower
    target = F.when(F.col("_open"), final * F.col("weight")).otherwise(F.col("cap"))
    return sources.withColumn("target", F.least("cap", F.coalesce(target, F.lit(0.0)))).drop("_level", "_open", "weight", "cap")


def _shard_of_blocks(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """``blocks``: source, block, order, passes. Adds ``shards``: for each pass of a block its output shard."""
    draws = blocks.where(F.col("passes") > 0).select("source", "block", "order", F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("pass"))
    quota = draws.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    # The root: all sources in one order, their quotas, and the number of shards.
    root = quota.agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "n"))).alias("s")).select(
        F.expr("transform(s, x -> x.source)").alias("sources"), F.expr("transform(s, x -> x.n)").alias("counts"),
        F.lit(0).alias("low"), F.lit(shards).alias("high"), F.expr("aggregate(s, 0L, (a, x) -> a + x.n)").alias("total"))
    nodes, width = saved(root, "mix-root"), shards
    while width > 1:
        half = width // 2
        # Shard i holds the draws floor(i T / M) .. floor((i + 1) T / M).
        want = f"(floor((low + {half}) * total / {shards}) - floor(low * total / {shards}))"
        left = f"""aggregate(if(size(counts) > 0, sequence(1, size(counts)), cast(array() as array<int>)),
            named_struct('open', aggregate(counts, 0L, (a, x) -> a + x), 'want', cast({want} as bigint), 'out', cast(array() as array<bigint>)),
            (a, i) -> transform(array(
                -- draw without replacement: the smaller of quota and wanted number is stepped through
                aggregate(
                    if(least(counts[i - 1], a.want) > 0, sequence(1L, least(counts[i - 1], a.want)), cast(array() as array<bigint>)), 0L,
                    (x, j) -> x + if(shiftrightunsigned(xxhash64({seed}, low, high, i, j), 11) / 9007199254740992D
                        < (greatest(counts[i - 1], a.want) - x) / (a.open - j + 1), 1L, 0L))),
                x -> named_struct('open', a.open - counts[i - 1], 'want', a.want - x, 'out', concat(a.out, array(x))))[0],
            a -> a.out)"""
        nodes = nodes.withColumn("left", F.expr(left)).select(
            "sources", "total", F.explode(F.expr(f"""array(
                named_struct('low', low, 'high', low + {half}, 'counts', left),
                named_struct('low', low + {half}, 'high', high, 'counts', transform(counts, (x, i) -> x - left[i])))""")).alias("n")
        ).select("sources", "total", "n.*")
        nodes = saved(nodes, "mix-nodes")
        width = half
    quotas = nodes.select(F.col("low").alias("shard"), F.posexplode(F.arrays_zip("sources", "counts")).alias("i", "q")).select("shard", F.col("q.sources").alias("source"), F.col("q.counts").alias("n"))
    last = F.sum("n").over(W.partitionBy("source").orderBy("shard"))
    ranges = quotas.withColumn("upto", last).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("ranges"))
    ranked = draws.withColumn("j", F.row_number().over(W.partitionBy("source").orderBy("pass", "order", "block")))
    dealt = left_join(ranked, ranges, ["source"], "inner").withColumn("shard", F.expr("filter(ranges, r -> j <= r.upto)[0].shard"))
    return dealt.groupBy("source", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("shards"))


def plan_mix(documents: DataFrame, weights=WEIGHTS, most: int = MOST, shards: int = SHARDS, seed: int = 1, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, passes (times taken), shards (of each pass), order, and ``_row``, the column ``row``, if named."""
    if shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    # A word with the space after it becomes one character, and so does leading space, which is taken off again.
    words = F.length(F.regexp_replace("text", f"^[{SPACE}]+|[^{SPACE}]+[{SPACE}]*", "x")) - F.col("text").rlike(f"^[{SPACE}]").cast("int")
    size = F.coalesce(words, F.lit(0)).cast("long")
    sized = saved(documents.select(*([F.col(row).alias("_row")] if row else []), "doc_id", "source", size.alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("order")), "mix-sizes")
    targets = saved(_targets(sized, weights, most), "mix-targets").withColumn(
        "full", F.least(F.lit(most), F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).cast("int")
    ).withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")).withColumn("n_blocks", F.ceil(F.col("n_docs") / BLOCK))
    if targets.count() <= BROADCAST_ROWS:
        targets = F.broadcast(targets)
    blocked = left_join(sized, targets, ["source"], "inner").withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "order"), F.col("n_blocks")))
    sums = blocked.groupBy("source", "block", "full", "rest").agg(F.sum("size").alias("block_size"))
    along = W.partitionBy("source").orderBy("order", "block")
    sums = sums.withColumn("order", F.xxhash64(F.lit(seed), F.lit("permute"), "source", "block"))
    sums = sums.withColumn("_upto", F.sum("block_size").over(along.rowsBetween(W.unboundedPreceding, 0)))
    sums = saved(sums.select(
        "source", "block", "order", "full",
        (F.col("rest") - (F.col("_upto") - F.col("block_size"))).alias("room"),
        F.when(F.col("_upto") <= F.col("rest"), 2).when(F.col("_upto") - F.col("block_size") < F.col("rest"), 1).otherwise(0).alias("state"),
    ), "mix-blocks")
    dealt = _shard_of_blocks(sums.withColumn("passes", F.col("full") + (F.col("state") > 0).cast("int")), shards, seed)
    of_block = left_join(sums, dealt, ["source", "block"]).select("source", "block", "room", "state", "shards")
    if of_block.count() <= BROADCAST_ROWS:
        of_block = F.broadcast(of_block)
    rows = left_join(blocked, of_block, ["source", "block"], "inner")
    # Only the one block of a source where its target falls is ordered document by document.
    edge = rows.where(F.col("state") == 1)
    before = F.coalesce(F.sum("size").over(W.partitionBy("source").orderBy("order", "size", "doc_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    edge = edge.withColumn("extra", (before + F.col("size") / 2 <= F.col("room")).cast("int"))
    whole = rows.where(F.col("state") != 1).withColumn("extra", (F.col("state") == 2).cast("int"))
    out = whole.unionByName(edge).withColumn("passes", F.when(F.col("size") > 0, F.col("full") + F.col("extra")).otherwise(0))
    return out.withColumn("shards", F.slice(F.coalesce("shards", F.array().cast("array<int>")), F.lit(1), F.col("passes"))).drop("n_blocks", "n_docs", "full", "rest", "room", "state", "extra", "block")


def mix(documents: DataFrame, **settings) -> DataFrame:
    """The mixed documents: all columns, a row for each time one is taken, with ``mix_shard``, ordered by hash within shards.

    A column of the caller that bears this name keeps it; the shard's then gets an underscore after it.
    """
    row, shard, key = free(documents.columns, "_row", "mix_shard", "_key")
    docs = saved(documents.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    plan = plan_mix(docs, row=row, **settings).where(F.col("passes") > 0).select(F.col("_row").alias(row), F.explode("shards").alias(shard), "order")
    plan = plan.select(row, shard, F.xxhash64("order", shard).alias(key))
    return docs.join(plan, row).repartitionByRange(shard, key).sortWithinPartitions(shard, key).drop(row, key)


def op5_mixing(spark, sf_dir):
    plan = plan_mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).cast("long").alias("taken"), "shards")


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs).select(*docs.columns)
