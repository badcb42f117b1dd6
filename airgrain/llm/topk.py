"""Exact top-k inner-product search: tiled matrix products, selection per tile, tree merge.

Vectors are packed into tiles (a matrix and its ids per row, at most one Arrow batch). Query tiles meet every
candidate tile of their dimension; one matrix product per pair, of which only each query's k best leave the task.
The lists are merged in a tree of fan-in 16 by (score descending, vec_id ascending), each level a ranked window
that Spark cuts to k rows in the map tasks, so no task sees more than 16 lists of a query.

Query tiles are broadcast; if they exceed ``BROADCAST_MB`` they go in passes of that size, each a scan of the
candidates (a block nested loop, the candidates never shuffle).

Scores are exact integers: float64 products where the bound max|q| max|c| dim < 2^53 proves them exact, else
Python integers; a score beyond 64 bits raises. Vectors that are null, hold null or non-finite components, or
have a null vec_id take no part. A row whose vec_id is the query's is its own. Vectors meet those of their own dimension; a query with no partner
gives no row. Repeated rows are separate candidates and take separate ranks (a repeated query vec_id is searched once). Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import saved, table

TILE, FAN, BROADCAST_MB = 2048, 16, 64
TILE_SCHEMA = "dim int, tile bigint, ids binary, cells binary"
LIST_SCHEMA = "query_id bigint, vec_id bigint, score bigint, tile bigint"


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, cells: floor(scale * x) per component, x as double; unusable vectors left out."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("cells"))


def _tiles(rows: int):
    def pack(batches):
        part, count = TaskContext.get().partitionId(), 0
        for pdf in batches:
            dims = pdf["cells"].map(len).to_numpy()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                for at in range(0, len(own), rows):
                    some = pdf.iloc[own[at:at + rows]]
                    cells = np.stack(some["cells"].to_numpy()).astype(np.int64) if dim else np.zeros((len(some), 0), np.int64)
                    yield pd.DataFrame({"dim": [np.int32(dim)], "tile": [part << 32 | count], "ids": [some["vec_id"].to_numpy(np.int64).tobytes()], "cells": [cells.tobytes()]})
                    count += 1
    return pack


def _best(k: int):
    def product(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                q, c = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.ids, np.int64)
                qm, cm = (np.frombuffer(b, np.int64).reshape(len(i), r.dim) for b, i in ((r.q_cells, q), (r.cells, c)))
                top = [float(np.abs(m.astype(np.float64)).max(initial=0)) for m in (qm, cm)]
                exact = top[0] * top[1] * max(1, r.dim) < 2.0**53
                scores = qm.astype(np.float64) @ cm.T.astype(np.float64) if exact else qm.astype(object) @ cm.T.astype(object)
                own = q[:, None] == c[None, :]
                if exact:
                    scores = np.where(own, -np.inf, scores)
                    if len(c) > k:
                        least = np.partition(scores, len(c) - k, axis=1)[:, len(c) - k]
                        row, col = np.nonzero((scores >= least[:, None]) & ~own)
                    else:
                        row, col = np.nonzero(~own)
                    value = scores[row, col].astype(np.int64)
                else:
                    row, col = np.nonzero(~own)
                    value = np.array([int(x) for x in scores[row, col]], dtype=np.int64)
                order = np.lexsort((c[col], ~value, row))  # ~value = -value - 1: descending without overflow
                row, col, value = row[order], col[order], value[order]
                start = np.searchsorted(row, row, "left")
                keep = np.arange(len(row)) - start < k
                yield pd.DataFrame({"query_id": q[row[keep]], "vec_id": c[col[keep]], "score": value[keep], "tile": np.int64(r.tile)})
    return product


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, broadcast_mb: int = BROADCAST_MB) -> DataFrame:
    """``queries``, ``candidates``: vec_id, cells. Returns query_id, rank, vec_id, score."""
    packed = saved(queries.dropDuplicates(["vec_id"]).mapInPandas(_tiles(TILE), TILE_SCHEMA), "query-tiles").select(
        "dim", F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
    size = packed.agg(F.sum(F.octet_length("q_ids") + F.octet_length("q_cells"))).first()[0] or 0
    passes = max(1, -(-size // (broadcast_mb << 20)))
    tiles = candidates.mapInPandas(_tiles(TILE), TILE_SCHEMA)
    lists = None
    for i in range(passes):
        some = packed.where(F.pmod(F.xxhash64("q_tile"), F.lit(passes)) == i) if passes > 1 else packed
        met = tiles.join(F.broadcast(some), "dim").select("dim", "tile", "ids", "cells", "q_ids", "q_cells").mapInPandas(_best(k), LIST_SCHEMA)
        lists = met if lists is None else lists.unionByName(met)
    groups = max(1, candidates.count() // TILE + 1)
    order = W.orderBy(F.col("score").desc(), "vec_id")
    while groups > 1:
        groups = -(-groups // FAN)
        lists = lists.withColumn("tile", F.pmod(F.xxhash64("tile"), F.lit(groups)) if groups > 1 else F.lit(0).cast("long"))
        lists = lists.withColumn("rank", F.row_number().over(order.partitionBy("query_id", "tile"))).where(F.col("rank") <= k).drop("rank")
    ranked = lists.withColumn("rank", F.row_number().over(order.partitionBy("query_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op4_topk_search(spark, sf_dir):
    vectors = integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(vectors.where(F.col("vec_id") % 100 == 0), vectors)
