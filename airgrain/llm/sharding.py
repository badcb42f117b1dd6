"""Sharding by balanced label propagation.

Documents linked into groups (equal texts in the query) start in shards by hash. In each round the counts of every
(group, shard) are formed by partial aggregates, each group names the shard with room that holds most of it, and
its members in shards with fewer move there: all of them while the shard's room allows, else the share of them
that fits, chosen by hash. Unlinked documents cut no edge; they fill the shards at the end, together with what exceeds a shard's quota, so that the
numbers of rows differ by one at most (law ``rows``). A group larger than a shard's quota has to be cut; it fills shards one after another.

Nothing but one number per shard reaches the driver. A hot group is a skewed join of its members with its few
(group, from, to) rows, which Spark splits or broadcasts. Ranks come from parts of the hash range with offsets, so
no shard meets in one task.

Null text: size 1, crc32 of no bytes, no links. Repeated rows are separate documents. doc_id may be null. Extra
columns are ignored by the query and kept by the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, saved, table

SHARDS, ROUNDS = 16, 8


def _loads(members: DataFrame, shards: int) -> list[int]:
    got = dict(members.groupBy("shard").count().collect())  # one row per shard
    return [got.get(i, 0) for i in range(shards)]


def _by_shard(values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("shard") + 1)


def balanced_shards(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows``: _row, g (group or null), h (bigint hash). Returns them with ``shard`` and gapless ``slot``."""
    rows = saved(rows.withColumn("shard", F.pmod(F.xxhash64(F.lit("start"), "h"), F.lit(shards)).cast("int")), "shard-rows")
    total = rows.count()
    quota = [total // shards + (i < total % shards) for i in range(shards)]
    linked = rows.where(F.col("g").isNotNull()).groupBy("g").count().where("count > 1").select("g")
    members = saved(rows.join(linked, "g", "left_semi"), "shard-members")
    for turn in range(rounds):
        room = [max(0, q - n) for q, n in zip(quota, _loads(members, shards), strict=True)]
        counts = members.groupBy("g", "shard").agg(F.count(F.lit(1)).alias("n"))
        counts = saved(counts.withColumn("rank", F.struct("n", (-F.col("shard")).alias("s"))), "shard-counts")
        best = counts.where(_by_shard(room) > 0).groupBy("g").agg(F.max("rank").alias("best"))
        moves = counts.join(best, "g").where(F.col("rank") < F.col("best")).select("g", "shard", (-F.col("best.s")).alias("to"), "n")
        asked = dict(moves.groupBy("to").agg(F.sum("n")).collect())  # one row per shard
        if not asked:
            break
        share = [min(1.0, room[i] / asked[i]) if asked.get(i) else 0.0 for i in range(shards)]
        luck = F.shiftrightunsigned(F.xxhash64(F.lit(turn), "h"), 11) / 9007199254740992.0
        moved = members.join(moves.drop("n"), ["g", "shard"], "left")
        fits = luck < F.element_at(F.array(*[F.lit(x) for x in share]), F.col("to") + 1)
        members = saved(moved.withColumn("shard", F.when(F.col("to").isNotNull() & fits, F.col("to")).otherwise(F.col("shard"))).drop("to").select(*rows.columns), "shard-members")
    # Exact quotas: each shard keeps its first members, the rest and all unlinked rows fill what is left.
    ranked = saved(numbered(members, ["shard"], "h", "slot"), "shard-ranked")
    kept = [min(q, n) for q, n in zip(quota, _loads(members, shards), strict=True)]
    stay = ranked.where(F.col("slot") < _by_shard(kept)).select("_row", "shard", "slot")
    rest = rows.join(linked, "g", "left_anti").select("_row", "h").unionByName(ranked.where(F.col("slot") >= _by_shard(kept)).select("_row", "h"))
    rest = numbered(rest, [], "h", "place")
    place, at = F.lit(None).cast("struct<shard:int,slot:bigint>"), sum(quota) - sum(kept)
    for i in reversed(range(shards)):
        at -= quota[i] - kept[i]
        place = F.when((F.col("place") >= at) & (F.col("place") < at + quota[i] - kept[i]), F.struct(F.lit(i).alias("shard"), (F.col("place") - at + kept[i]).alias("slot"))).otherwise(place)
    return stay.unionByName(rest.select("_row", place.alias("p")).select("_row", "p.*"))


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document; equal texts are the links."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = saved(documents.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.md5(body)).alias("g")), "shard-docs")
    keyed = rows.withColumn("h", F.xxhash64("doc_id", "g"))
    placed = balanced_shards(keyed.select("_row", "g", "h"), shards)
    return rows.join(placed, "_row").drop("g", "_row")


def _digest(docs: DataFrame) -> DataFrame:
    return shard_documents(docs.select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op6_sharding(spark, sf_dir):
    return _digest(table(spark, sf_dir, "documents"))


def shard_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _digest(docs)
