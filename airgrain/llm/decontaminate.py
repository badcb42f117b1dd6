"""Benchmark decontamination by winnowing.

Every text becomes word hashes. Of each run of consecutive k-grams the least hash is kept with its place (the
rightmost among equals), so any shared span of ``window`` words leaves the same k-gram on both sides: k + run - 1
equals the window, no shared window can be missed. Fingerprints of the benchmark's windows join those of the
documents, and each meeting is extended to the whole window by comparing the words around it. A window is 13
words; an item of fewer words is one window of its own length, and each such length is winnowed the same way.

Hot k-grams and passages: each distinct benchmark window is indexed once, whatever number of items hold it, and
document fingerprints that meet nothing are dropped in the map tasks while the index is small enough to
broadcast (``BROADCAST_ROWS``, counted first). Beyond that, a shuffled join finds the documents that meet any
fingerprint, and only those are compared, by a second shuffled join that Spark splits where keys are hot.

Null and empty texts have no words; a null item_id is left out. A document is (doc_id, text): repeated rows give one row, a
repeated doc_id with another text its own row. Words are compared by 64-bit hashes, 13 at a time. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import ascii_lower, free, left_join, let, saved, table

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM = 13, 5
BROADCAST_ROWS = 200_000


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(hashes: Column, k: int) -> Column:
    """Hash of the k-gram at each place; empty if there is none."""
    n = F.size(hashes)
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.xxhash64(F.slice(hashes, i, k)))).otherwise(F.array().cast("array<bigint>"))


def _order(grams: Column) -> Column:
    """One number per place: less for a smaller hash, and for the place further right among equals."""
    return F.transform(grams, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 32), 31).bitwiseOR(F.lit(2147483647).cast("long") - i))


def _place(order: Column) -> Column:
    return F.lit(2147483647).cast("long") - order.bitwiseAND(F.lit(2147483647).cast("long"))


def _sizes(length: int) -> tuple[int, int]:
    k = min(GRAM, length)
    return k, length - k + 1


def fingerprints(documents: DataFrame, keys: list[str], length: int, context: bool, own: bool) -> DataFrame:
    """Winnowed k-grams: keys, ``length``, ``h``, ``p`` and, on request, the words that any window over it can hold
    and a row of the document itself: ``length`` and ``h`` 0, ``p`` its number of words."""
    k, run = _sizes(length)

    def chosen(hashes):
        def picks(grams):
            n = F.size(grams) - run + 1
            least = lambda order: F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.array_min(F.slice(order, i, run))))
            def row(x):
                p = _place(x).cast("int")
                cells = [F.lit(length).alias("length"), F.element_at(grams, p + 1).alias("h"), p.alias("p")]
                if context:
                    first = F.greatest(p - (run - 1), F.lit(0))
                    cells += [(p - first).alias("off"), F.slice(hashes, first + 1, p + length - first).alias("around")]
                return F.struct(*cells)
            return F.when(n >= 1, F.transform(let(_order(grams), least), row))

        found = let(_grams(hashes, k), picks)
        if not own:
            return found
        itself_type = "array<struct<length:int,h:bigint,p:int,off:int,around:array<bigint>>>"
        itself = F.array(F.struct(F.lit(0).alias("length"), F.lit(0).cast("long").alias("h"), F.size(hashes).alias("p"), F.lit(0).alias("off"), F.array().cast("array<bigint>").alias("around")))
        return F.concat(itself, F.coalesce(found, F.array().cast(itself_type)))

    found = documents.select(*keys, F.explode(let(F.col("hashes"), chosen)).alias("f"))
    return found.select(*keys, "f.*")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def index_of(benchmark: DataFrame) -> tuple[DataFrame | None, DataFrame, list[int]]:
    """Distinct windows (length, h, x: place of the k-gram in the window, words), their items, and the lengths."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", word_hashes(F.col("text")).alias("hashes")).where(F.size("hashes") > 0)
    length = F.least(F.size("hashes"), F.lit(WINDOW))
    windows = items.select("item_id", F.explode(let(F.col("hashes"), lambda h: F.transform(
        F.sequence(F.lit(1), F.size(h) - F.least(F.size(h), F.lit(WINDOW)) + 1),
        lambda i: F.slice(h, i, F.least(F.size(h), F.lit(WINDOW)))))).alias("words"), length.alias("length"))
    windows = windows.withColumns({"w1": F.xxhash64("words"), "w2": F.xxhash64(F.lit("second"), "words")})
    windows = saved(windows, "bench-windows")
    members = windows.select("w1", "w2", "item_id").distinct()
    distinct = windows.groupBy("w1", "w2", "length").agg(F.first("words").alias("words"))
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most 13
    parts = []
    for n in lengths:
        k, _ = _sizes(n)
        of_length = distinct.where(F.col("length") == n)
        pick = let(_grams(F.col("words"), k), lambda g: let(_place(F.array_min(_order(g))).cast("int"), lambda x: F.struct(x.alias("x"), F.element_at(g, x + 1).alias("h"))))
        parts.append(of_length.withColumn("s", pick).select("w1", "w2", "length", "words", "s.*"))
    return (saved(_union(parts), "bench-index") if parts else None), members, lengths


def window_hits(documents: DataFrame, keys: list[str], index: DataFrame, lengths: list[int], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every occurrence of an indexed window: keys, start, length, w1, w2; and a row per document of ``length`` 0, its ``start`` the number of words.

    ``documents`` has keys and ``hashes``. With a broadcast index both come from one pass over the texts: the
    document's own row meets a row of length 0 that is added to the index.
    """
    own_row = documents.select(*keys, F.size("hashes").alias("start"), F.lit(0).alias("length"), F.lit(None).cast("long").alias("w1"), F.lit(None).cast("long").alias("w2"))
    if not lengths:
        return own_row
    small = index.count() <= broadcast_rows
    if small:
        nothing = index.sparkSession.range(1).select(*[F.lit(v).cast(index.schema[c].dataType).alias(c) for c, v in {"w1": None, "w2": None, "length": 0, "words": [], "x": 0, "h": 0}.items()])
        index = F.broadcast(index.unionByName(nothing))
    else:
        met = _union([fingerprints(documents, keys, n, False, False) for n in lengths]).join(index.select("length", "h").distinct(), ["length", "h"], "left_semi").select(*keys).distinct()
        documents = left_join(documents, met, keys, "left_semi")
    pairs = _union([fingerprints(documents, keys, n, True, small and n == lengths[0]) for n in lengths]).join(index, ["length", "h"])
    start = F.col("off") - F.col("x")
    whole = (start >= 0) & (F.slice("around", F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("words"))
    hits = pairs.where((F.col("length") == 0) | whole).select(*keys, (F.col("p") - F.col("x")).alias("start"), "length", "w1", "w2")
    return hits if small else hits.unionByName(own_row)


def contamination(documents: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, items (sorted ids as strings) of every document."""
    index, members, lengths = index_of(benchmark)
    keys = ["doc_id", "text_hash"]
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("hashes"))
    found = saved(window_hits(docs, keys, index, lengths, broadcast_rows).distinct(), "bench-hits")
    base = found.where("length = 0").select(*keys, F.col("start").cast("long").alias("n_words"))
    hits = found.where("length > 0")
    # Union of the intervals: what each adds beyond the furthest end before it.
    end = F.col("start") + F.col("length")
    before = F.max(end).over(W.partitionBy(*keys).orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1))
    covered = (
        hits.select(*keys, "start", "length").distinct()
        .withColumn("_add", F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(before, F.lit(0)))))
        .groupBy(*keys).agg(F.sum("_add").cast("long").alias("n_hit"))
    )
    items = (
        hits.select(*keys, "w1", "w2").distinct().join(members, ["w1", "w2"])
        .groupBy(*keys).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    out = left_join(left_join(base, covered, keys), items, keys)
    return out.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", F.array().cast("array<string>"))})


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op1_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, all columns."""
    name, = free(docs.columns, "text_hash")
    found = contamination(docs, table(spark, sf_dir, "benchmark")).where(is_contaminated()).select("doc_id", F.col("text_hash").alias(name))
    return left_join(docs.withColumn(name, F.xxhash64("text")), found, ["doc_id", name], "left_anti").drop(name)
