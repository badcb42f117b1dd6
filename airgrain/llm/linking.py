"""Links among members of candidate buckets, and their connected components, without a task per bucket.

Two items are candidates if they share a bucket. A bucket's least member is its pivot; buckets of one pivot form a
block, so items that meet often meet once. A block of more than ``size`` members is cut into parts by hash, each
with the pivot. ``compare`` finds the links inside a part, exactly. Pairs cut apart by the parts of a block need a look only if they are not
connected already, so only members outside its largest component matter then. Up to ``CHUNKS`` times ``size`` of them meet every part once more. More are dealt
anew with the rest of their block, by n-grams that are rare within it (prefix filter): rows grow with the members, not with their square. Only groups that even
these n-grams leave together have all outside members meet all parts, in chunks. No pair of candidates is lost, none is written out; only verified spanning links are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved

PART, CHUNKS = 128, 16
LINKS = "a bigint, b bigint"


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b (bigint). Returns id, component: the least id reachable, for every id in a link.

    Alternating large-star and small-star steps, each a partial aggregate and a join; the number of steps grows
    with the logarithm of the longest path.
    """
    pairs = saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-links")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        before, pairs = pairs, saved(small.select("e.*").where("u <> v").distinct(), "cc-links")
        discard(before)
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("v").alias("id")).distinct()
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))


def _compared(parts: DataFrame, texts: Callable[[DataFrame], DataFrame], prepare, compare) -> DataFrame:
    """``parts``: block, part, id, probe. Links of each part.

    Parts are small and many, so a task takes them from its sorted rows batch by batch: ``prepare`` turns all texts of
    a batch into items at once, ``compare`` gets the items of one part.
    """
    def run(batches):
        held = ([], [], [], [])  # keys, ids, probes, items of the part that may go on in the next batch

        def close(low, high, keys, ids, probes, items):
            own = {}
            for i in range(low, high):
                own.setdefault(ids[i], i)
            chosen = list(own.values())
            return compare([ids[i] for i in chosen], [items[i] for i in chosen], [probes[i] for i in chosen]) if len(chosen) > 1 else []

        for pdf in batches:
            keys = held[0] + list(zip(pdf["block"].tolist(), pdf["part"].tolist(), strict=True))
            ids, probes = held[1] + pdf["id"].tolist(), held[2] + pdf["probe"].tolist()
            items = held[3] + list(prepare(pdf["text"].fillna("").tolist()))
            pairs, low = [], 0
            for i in range(1, len(keys)):
                if keys[i] != keys[low]:
                    pairs += close(low, i, keys, ids, probes, items)
                    low = i
            held = (keys[low:], ids[low:], probes[low:], items[low:])
            if pairs:
                yield pd.DataFrame(pairs, columns=["a", "b"]).astype("int64")
        if held[0]:
            pairs = close(0, len(held[0]), *held)
            if pairs:
                yield pd.DataFrame(pairs, columns=["a", "b"]).astype("int64")

    arranged = texts(parts).select("block", "part", "id", "probe", "text").repartition("block", "part")
    return arranged.sortWithinPartitions("block", "part", "probe", "id").mapInPandas(run, LINKS)


def _blocks(buckets: DataFrame, ratio: float, size: int) -> tuple[DataFrame, DataFrame]:
    """Members of the blocks that are cut (block, id, parts, part), and what each part compares (block, part, id, probe)."""
    pivots = buckets.groupBy("key").agg(F.min("id").alias("block"), F.max("id").alias("_most")).where("block < _most").drop("_most")
    pivots = saved(pivots, "link-pivots")  # few as a rule: by its size Spark chooses between broadcast and shuffle
    met = saved(buckets.join(pivots, "key").select("block", "id", "n").distinct(), "link-members")
    counts = met.groupBy("block").agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("low"), F.max("n").alias("high"))
    counts = counts.where(F.col("members") > 1).withColumn("parts", F.ceil(F.col("members") / size).cast("int"))
    sized = met.join(counts, "block")
    hot = saved(sized.where("parts > 1").select("block", "id", "parts", F.pmod(F.xxhash64("block", "id"), F.col("parts")).cast("int").alias("part")), "link-hot")
    # In a small block an item without any other of a fitting size can be left out.
    by_size = "array_sort(transform(items, x -> struct(x.n as n, x.id as id)))"
    small = sized.where("parts = 1").groupBy("block").agg(F.collect_list(F.struct("id", "n")).alias("items")).withColumn("items", F.expr(by_size))
    fits = f"""filter(items, (x, i) -> (i > 0 and get(items, i - 1).n >= x.n * {ratio}) or (i < size(items) - 1 and x.n >= get(items, i + 1).n * {ratio}))"""
    small = small.select("block", F.explode(F.expr(fits)).alias("x")).select("block", F.lit(0).alias("part"), F.col("x.id").alias("id"), F.lit(False).alias("probe"))
    pivot_rows = hot.select("block", "parts").distinct().select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("block").alias("id"), F.lit(False).alias("probe"))
    first = saved(small.unionByName(hot.select("block", "part", "id", F.lit(False).alias("probe"))).unionByName(pivot_rows), "link-parts")
    return hot, first


def _outside(hot: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """block, id, parts, chunks (of ``size`` of them) of the members outside their block's largest component."""
    named = hot.join(found, "id", "left").select("block", "id", "parts", F.coalesce("component", "id").alias("component"))
    tally = named.groupBy("block", "component").agg(F.count(F.lit(1)).alias("n"))
    main = tally.groupBy("block").agg(F.max(F.struct("n", "component")).alias("m")).select("block", F.col("m.component").alias("main"))
    apart = saved(named.join(main, "block").where("component <> main").select("block", "id", "parts"), "link-outside")
    return apart.join(apart.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("chunks")), "block")


def _probed(hot: DataFrame, outside: DataFrame) -> DataFrame:
    """Parts in which every outside member meets every member of its block, ``chunks`` parts for each old one."""
    chunk = outside.withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "id"), F.col("chunks")).cast("int"))
    probes = chunk.select("block", "id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"), "chunk", "chunks", F.lit(True).alias("probe"))
    chunks = outside.select("block", "chunks").distinct()
    base = hot.join(chunks, "block").select("block", "id", F.col("part").alias("p"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "chunks", F.lit(False).alias("probe"))
    return probes.unionByName(base).select("block", (F.col("p") * F.col("chunks") + F.col("chunk")).alias("part"), "id", "probe")


def _reblocked(hot: DataFrame, outside: DataFrame, texts, grams, percent: int) -> DataFrame:
    """key, id, n: the hot members dealt anew, by n-grams that are rare within their block.

    Ordered by their number in the block, rarest first, the first n - ceil(percent n) + 1 n-grams of two linked sets share one, so each linked pair of a block meets
    again. Only groups with a member from outside matter.
    """
    members = hot.join(outside.select("block").distinct(), "block", "left_semi").select("block", "id")

    def sets(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "grams": [x.view(np.int64) for x in grams(pdf["text"].fillna("").tolist())]})

    asked = members.select("id").distinct().select(F.lit(0).cast("long").alias("block"), F.lit(0).alias("part"), "id", F.lit(False).alias("probe"))
    held = saved(texts(asked).select("id", "text").mapInPandas(sets, "id bigint, grams array<bigint>"), "link-grams")
    rows = members.join(held, "id").select("block", "id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    counts = rows.groupBy("block", "gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = rows.join(counts, ["block", "gram"]).groupBy("block", "id", "n").agg(F.collect_list(F.struct("df", "gram")).alias("grams"))
    room = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1 - (F.col("n") - F.size("grams"))  # n-grams of its own come first
    prefix = shared.where(room > 0).select("block", "id", "n", F.explode(F.slice(F.array_sort("grams"), F.lit(1), room)).alias("g"))
    prefix = prefix.join(outside.select("block", "id", F.lit(1).alias("apart")), ["block", "id"], "left")
    keyed = saved(prefix.select(F.xxhash64("block", "g.gram").alias("key"), "id", "n", "apart"), "link-keys")
    return keyed.join(keyed.where("apart = 1").select("key").distinct(), "key", "left_semi").drop("apart")


def linked_components(buckets: DataFrame, texts: Callable[[DataFrame], DataFrame], prepare, compare, ratio: float, size: int = PART, more: DataFrame | None = None, grams=None, percent: int = 100) -> DataFrame:
    """id, component of all items that link to another.

    ``buckets``: key, id, n, rows may repeat (sizes of linked items differ by the factor ``ratio`` at most). ``texts`` adds ``text``
    to rows with ``id``. ``prepare(texts)`` gives items; ``compare(ids, items, probe)`` returns linked pairs; if any
    item is a probe only pairs with a probe are asked for. ``more`` (a, b) are links that hold beside those found. ``grams(texts)``, where linked items are
    sets with a Jaccard similarity of ``percent`` or more, gives these sets as 64-bit hashes; without it hot blocks are not dealt anew.
    """
    def links_of(parts):
        return saved(_compared(parts, texts, prepare, compare), "links")

    hot, first = _blocks(buckets, ratio, size)
    links = links_of(first) if more is None else links_of(first).unionByName(more)
    found = saved(components(links), "link-components")
    while not hot.isEmpty():
        outside = saved(_outside(hot, found, size), "link-outside")
        if outside.isEmpty():
            break
        anew = outside.where(F.col("chunks") > CHUNKS) if grams else None
        if anew is not None and not anew.isEmpty():
            links = links.unionByName(links_of(_probed(hot, outside.where(F.col("chunks") <= CHUNKS))))
            hot, first = _blocks(_reblocked(hot, anew, texts, grams, percent), ratio, size)
            links, grams = links.unionByName(links_of(first)), None  # what these leave together meets whole
        else:
            links = links.unionByName(links_of(_probed(hot, outside)))
            hot = hot.where("false")
        found = saved(components(links), "link-components")
    return found
