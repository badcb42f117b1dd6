"""Vector code compression: product quantisation with active-entry Lloyd rounds on integers.

Vectors become whole numbers floor(scale * x) and are cut into equal parts; each part position has a codebook, at first that part of the vectors with the smallest
ids. A round assigns every part to its nearest entry (squared distance, ties to the lower index) and moves each entry to the floored mean of its parts; an unused entry
stays. A part whose entry did not move in the last round keeps its exact distance, which no entry that stayed can beat: it is compared with the moved entries
only. Other parts rescan all entries. All arithmetic is in whole numbers, so the result does not depend on the order of rows or tasks.

Vectors are packed into tiles (a row of at most ``TILE_BYTES`` with ids, parts, codes and distances). A round is one pass over the tiles that writes the next
state and, per task, the counts and sums of each entry; these are added up in Spark, and parts x entries rows reach the driver. Tiles are never
shuffled, and a state's files go when the next one is written.

Left out: null vectors and those that hold null or non-finite components. A null id comes after all others, equal ids are ordered by their vectors. Fewer vectors than entries
give fewer entries; an empty table gives no rows. Repeated rows are vectors of their own. Kept vectors of different lengths, of a length that the parts do
not divide, or with a component of ``MOST`` or more after scaling raise an error (distances would leave 64 bits). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, left_join, saved, table

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
TILE_BYTES, MOST = 1 << 22, 1 << 29
TILE = "vec_id array<bigint>, label array<int>, cells binary, codes binary, distances binary, sums array<bigint>"
SCHEMA = pa.schema([("vec_id", pa.list_(pa.int64())), ("label", pa.list_(pa.int32())), ("cells", pa.binary()), ("codes", pa.binary()), ("distances", pa.binary()), ("sums", pa.list_(pa.int64()))])


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, cells: floor(scale * x) of every usable vector, x as double."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", finite))
    cells = F.transform("embedding", lambda x: F.floor(scale * x.cast("double")).cast("long"))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), cells.alias("cells"))


def scan(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, rows x entries."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        away = x[:, j, None] - entries[None, :, j]
        out += away * away
    return out


def assign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> int:
    """Nearest entries of one part position, in place. ``moved``: which entries changed since ``code`` and ``distance`` were exact. Returns the number of distances taken."""
    stale = moved[code]
    some = np.flatnonzero(stale)
    taken = 0
    if len(some):
        found = scan(x[some], entries)
        code[some] = found.argmin(1)  # the first of equal ones
        distance[some] = found[np.arange(len(some)), code[some]]
        taken += found.size
    active, rest = np.flatnonzero(moved), np.flatnonzero(~stale)
    if len(active) and len(rest):
        found = scan(x[rest], entries[active])
        best = found.argmin(1)
        near, index = found[np.arange(len(rest)), best], active[best]
        nearer = (near < distance[rest]) | ((near == distance[rest]) & (index < code[rest]))
        code[rest[nearer]], distance[rest[nearer]] = index[nearer], near[nearer]
        taken += found.size
    return taken


def _tiles(parts: int, dim: int):
    """Rows of vec_id, label, cells to tiles without an assignment."""
    rows = max(1, TILE_BYTES // max(1, 4 * dim))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                some = batch.slice(at, rows)
                n, cells = some.num_rows, some.column("cells")
                if (np.diff(cells.offsets.to_numpy()) != dim).any():
                    raise ValueError("vectors of different lengths")
                flat = cells.flatten().to_numpy(zero_copy_only=False)
                if len(flat) and max(-int(flat.min()), int(flat.max())) >= MOST:
                    raise ValueError(f"a scaled component of {MOST} or more")
                ends = pa.array([0, n], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(ends, some.column("vec_id")), pa.ListArray.from_arrays(ends, some.column("label")), pa.array([flat.astype("<i4").tobytes()], pa.binary()),
                    pa.array([b""], pa.binary()), pa.array([b""], pa.binary()), pa.array([None], pa.list_(pa.int64()))], schema=SCHEMA)

    return run


def _round(codebooks: np.ndarray, moved: np.ndarray):
    """The next state of the tiles and, as a last row, a task's count and sums of each entry (part, entry, 1 + components)."""
    parts, entries, width = codebooks.shape

    def run(batches):
        total = np.zeros((parts, entries, 1 + width), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                x = np.frombuffer(row.column("cells")[0].as_py(), "<i4").reshape(-1, parts, width).astype(np.int64)
                old = row.column("codes")[0].as_py()
                code = np.frombuffer(old, np.uint16).reshape(parts, -1).astype(np.int64) if old else np.zeros((parts, len(x)), np.int64)
                distance = np.frombuffer(row.column("distances")[0].as_py(), "<i8").reshape(parts, -1).copy() if old else np.zeros((parts, len(x)), np.int64)
                for p in range(parts):
                    assign(x[:, p], codebooks[p], moved[p] if old else np.ones(entries, bool), code[p], distance[p])
                    total[p, :, 0] += np.bincount(code[p], minlength=entries)
                    np.add.at(total[p, :, 1:], code[p], x[:, p])
                yield pa.RecordBatch.from_arrays([
                    row.column("vec_id"), row.column("label"), row.column("cells"), pa.array([code.astype(np.uint16).tobytes()], pa.binary()),
                    pa.array([distance.astype("<i8").tobytes()], pa.binary()), pa.array([None], pa.list_(pa.int64()))], schema=SCHEMA)
        yield pa.RecordBatch.from_pydict({"vec_id": [None], "label": [None], "cells": [None], "codes": [None], "distances": [None], "sums": [total.ravel()]}, SCHEMA)

    return run


def _updated(codebooks: np.ndarray, state: DataFrame) -> np.ndarray:
    """Entries moved to their floored means."""
    got = state.where("sums is not null").select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).toPandas()  # parts x entries x (1 + components) rows
    sums = np.zeros(codebooks.shape[0] * codebooks.shape[1] * (1 + codebooks.shape[2]), np.int64)
    sums[got["i"].to_numpy(np.int64)] = got["v"].to_numpy(np.int64)
    sums = sums.reshape(*codebooks.shape[:2], -1)
    count = sums[:, :, :1]
    return np.where(count > 0, sums[:, :, 1:] // np.maximum(count, 1), codebooks)


def first_codebooks(cells: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """parts x entries x components."""
    first = [r["cells"] for r in cells.orderBy(F.col("vec_id").isNull(), "vec_id", "cells").limit(entries).collect()]  # ``entries`` rows
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    if len({len(x) for x in first}) > 1 or len(first[0]) % parts:
        raise ValueError(f"vectors must have one length that {parts} parts divide")
    return np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()


def compress(cells: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``cells``: vec_id, label, cells. Returns vec_id, label, codes and distances of every vector's parts, and the final codebooks."""
    spark = cells.sparkSession
    codebooks = first_codebooks(cells, parts, entries)
    if not codebooks.size:
        return spark.createDataFrame([], "vec_id bigint, label int, codes array<int>, distances array<bigint>"), codebooks
    dim = codebooks.shape[0] * codebooks.shape[2]
    state = saved(cells.select("vec_id", "label", "cells").mapInArrow(_tiles(parts, dim), TILE), "code-tiles")
    moved = np.ones(codebooks.shape[:2], bool)
    for turn in range(rounds + 1):
        after = saved(state.where("cells is not null").mapInArrow(_round(codebooks, moved), TILE), "code-state")
        discard(state)
        state = after
        if turn < rounds:
            new = _updated(codebooks, state)
            moved = (new != codebooks).any(2)
            codebooks = new
            if not moved.any():  # further rounds would change nothing
                break

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                code = np.frombuffer(row.column("codes")[0].as_py(), np.uint16).reshape(parts, -1).T
                distance = np.frombuffer(row.column("distances")[0].as_py(), "<i8").reshape(parts, -1).T
                ends = pa.array(np.arange(len(code) + 1) * parts, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    row.column("vec_id").flatten(), row.column("label").flatten(), pa.ListArray.from_arrays(ends, pa.array(code.ravel().astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(distance.ravel()))], names=["vec_id", "label", "codes", "distances"])

    out = state.where("cells is not null").mapInArrow(rows, "vec_id bigint, label int, codes array<int>, distances array<bigint>")
    return out, codebooks


def op13_vector_codes(spark, sf_dir):
    found, codebooks = compress(integer_vectors(table(spark, sf_dir, "embeddings")))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    errors = saved(found.select("vec_id", "label", code.alias("code"), F.aggregate("distances", F.lit(0).cast("long"), lambda a, x: a + x).alias("error")), "code-errors")
    by_label = errors.groupBy("label").agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    return left_join(errors, by_label, ["label"]).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
