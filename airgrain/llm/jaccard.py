"""N-gram Jaccard join with prefix trees.

A document's set holds the hashes of its word n-grams. Equal sets become one item first, known by their least doc_id, or by a 64-bit hash
of the set where that doc_id has several sets; its text comes from one row of it. Two different
sets with Jaccard similarity j or more share an n-gram among the first n - ceil(j n) + 1 of either in any global
order, so these prefixes are the candidate buckets. The order: n-grams whose hash lies in the lowest part of the
range, ``SHARE`` times 1 - j of it, by document frequency (counted exactly over all sets) and then hash, the rest by hash; so frequent passages come last, only a fifth
(at 0.9) of the n-grams is counted, and a document whose prefix is filled by n-grams of its own is out at once.

Buckets become parts (see ``linking``). Inside a part the whole sets, ordered by frequency in the part, go into a
radix tree; a set is looked up by walking the tree with the overlap so far, shared by all sets below a node,
and a subtree is left as soon as the remaining lengths cannot reach the needed overlap. Every link between
different texts is found: the result is that of all pairs (n-grams compared by 64-bit hashes).

Null and empty texts have an empty set and link with nothing. Repeated rows of one doc_id are one document; a doc_id with several texts has a row
per set and links through each: its sets are one component. A null doc_id never names a component. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, free, left_join, saved, table
from .linking import linked_components

WORDS, PERCENT, SHARE, FILTER = 3, 90, 2, 1 << 20
CHUNK = 1 << 20  # characters that are hashed together
U = np.uint64
GOLD, M1, M2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * M1
    x = (x ^ (x >> U(27))) * M2
    return x ^ (x >> U(31))


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of whitespace-separated bytes: a polynomial over mixed bytes, finalised."""
    table = _mix(np.arange(1, 257, dtype=U) * GOLD)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return start, np.zeros(0, U)
    place = np.arange(len(data), dtype=np.int64)
    place -= np.repeat(start, np.diff(np.append(start, len(data)))) if start[0] == 0 else np.concatenate((np.zeros(start[0], np.int64), np.repeat(start, np.diff(np.append(start, len(data))))))
    longest = int((end - start).max()) + 1
    powers = np.cumprod(np.full(longest, GOLD, U))
    value = table[data] * powers[np.minimum(place, longest - 1)]
    value[blank] = 0
    return start, _mix(np.add.reduceat(value, start) + (end - start).astype(U))


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; shorter texts are one n-gram of all their words."""
    out, at = [], 0
    factors = _mix(np.arange(11, 11 + words, dtype=U) * GOLD) | U(1)
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and (not some or size < CHUNK):
            some.append(texts[at].encode("utf-8", "surrogatepass").lower())
            size += len(some[-1])
            at += 1
        data = np.frombuffer(b"\n".join(some) + b"\n", np.uint8)
        first = np.concatenate(([0], np.cumsum([len(b) + 1 for b in some])))
        start, word = _hash_words(data)
        cut = np.searchsorted(start, first)
        grams = np.zeros(max(0, len(word) - words + 1), U)
        for i in range(words):
            grams += word[i:i + len(grams)] * factors[i]
        grams = _mix(grams)
        for i in range(len(some)):
            low, high = cut[i], cut[i + 1]
            if high - low >= words:
                out.append(np.unique(grams[low:high - words + 1]))
            elif high > low:
                out.append(_mix(np.array([(word[low:high] * factors[:high - low]).sum() + U(high - low)], U)))
            else:
                out.append(np.zeros(0, U))
    return out


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of n with any set that links to it."""
    return -(-percent * n // 100)


def can_link(n: int, percent: int) -> bool:
    """Whether a set of n can link to a different set: the one nearest to it has one n-gram more (one less is never nearer)."""
    return n > 0 and 100 * n >= percent * (n + 1)


class _Node:
    __slots__ = ("run", "children", "ends", "low", "high")

    def __init__(self, run, size):
        self.run, self.children, self.ends, self.low, self.high = run, {}, [], size, size


class PrefixTree:
    """Ordered sets (ascending ranks) in a radix tree; finds those whose Jaccard similarity reaches ``percent``."""

    def __init__(self, ranks: int, percent: int):
        self.root, self.percent = _Node(np.zeros(0, np.int64), 0), percent
        self.root.low, self.member = 1 << 60, np.zeros(ranks, bool)

    def insert(self, key, ranks: np.ndarray) -> None:
        node, at, n = self.root, 0, len(ranks)
        node.low, node.high = min(node.low, n), max(node.high, n)
        while at < n:
            child = node.children.get(ranks[at])
            if child is None:
                child = node.children[ranks[at]] = _Node(ranks[at:], n)
                node, at = child, n
                break
            run = child.run
            k = min(len(run), n - at)
            differ = np.flatnonzero(run[:k] != ranks[at:at + k])
            k = int(differ[0]) if len(differ) else k
            if k < len(run):  # split the edge
                upper = _Node(run[:k], n)
                upper.low, upper.high = child.low, child.high
                upper.children[run[k]] = child
                child.run = run[k:]
                node.children[ranks[at]] = upper
                child = upper
            child.low, child.high = min(child.low, n), max(child.high, n)
            node, at = child, at + k
        node.ends.append(key)

    def search(self, ranks: np.ndarray) -> list:
        n, p, found = len(ranks), self.percent, []
        self.member[ranks] = True
        stack = [(self.root, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            if len(node.run):
                overlap += int(self.member[node.run].sum())
                depth += len(node.run)
                rest = n - int(np.searchsorted(ranks, node.run[-1], "right"))
            else:
                rest = n
            # The most that a set below can still reach; best where its rest equals ours.
            best = min(max(depth + rest, node.low), node.high)
            most = overlap + min(best - depth, rest)
            if 100 * most < p * (n + best - most):
                continue
            if node.ends and 100 * overlap >= p * (n + depth - overlap):
                found += node.ends
            stack += [(c, overlap, depth) for c in node.children.values()]
        self.member[ranks] = False
        return found


def tree_links(ids, sets: list[np.ndarray], probe, percent: int) -> list[tuple[int, int]]:
    """Spanning links among the sets; with probes, only links that have one."""
    if not len(sets):
        return []
    tokens, seen, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, -count))] = np.arange(len(tokens))
    ordered = [np.sort(a) for a in np.split(rank[seen], np.cumsum([len(s) for s in sets])[:-1])]
    tree, top, links = PrefixTree(len(tokens), percent), list(range(len(sets))), []

    def root(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    some = bool(np.any(probe))
    for i in sorted(range(len(sets)), key=lambda i: (bool(probe[i]), len(sets[i]))):
        if len(sets[i]) == 0:
            continue
        if not some or probe[i]:
            for j in tree.search(ordered[i]):
                a, b = root(i), root(j)
                if a != b:
                    top[a] = b
                    links.append((int(ids[i]), int(ids[j])))
        tree.insert(i, ordered[i])
    return links


def _keys(percent: int, words: int, with_low: bool):
    """Size and 128-bit identity of each set; on request the n-grams that are counted."""
    limit = U(min(SHARE * (100 - percent) * 2**64 // 100, 2**64 - 1))

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 2000):
                part = pdf.iloc[at:at + 2000]
                sets = shingle_sets(part["text"].fillna("").tolist(), words)
                rows = {
                    "doc_id": part["doc_id"], "t": part["t"], "n": np.array([len(s) for s in sets], np.int32),
                    "k1": np.array([_mix(s + GOLD).sum(dtype=U) for s in sets], U).view(np.int64),
                    "k2": np.array([_mix(s ^ M2).sum(dtype=U) for s in sets], U).view(np.int64),
                }
                if with_low:
                    low = [s[:max(int(np.searchsorted(s, limit)), len(s) - needed(len(s), percent) + 1)] if can_link(len(s), percent) else s[:0] for s in sets]
                    rows["low"] = [s.view(np.int64) for s in low]
                yield pd.DataFrame(rows)

    return run


KEYS = "doc_id bigint, t bigint, n int, k1 bigint, k2 bigint"


def _set_components(documents: DataFrame, words: int, percent: int, of_ids: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per row doc_id, t (hash of the text), n and set; per set rep (its least doc_id) and id; per linked id its component and the least rep in it. ``of_ids``: the sets of one
    doc_id belong together."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    identity = F.when(F.col("n") > 0, F.xxhash64("n", "k1", "k2")).alias("set")
    keys = saved(docs.mapInPandas(_keys(percent, words, False), KEYS).select("doc_id", "t", "n", identity), "jaccard-keys")
    filled = keys.where("n > 0 and doc_id is not null")
    several = saved(filled.groupBy("doc_id").agg(F.min("set").alias("_a"), F.max("set").alias("_b")).where("_a < _b").select(F.col("doc_id").alias("_doc")), "jaccard-several")

    def with_id(of):
        # The least doc_id keeps a group's original in front as a pivot, so its copies share few blocks.
        return of.join(several, of["rep"] == several["_doc"], "left").withColumn("id", F.when(F.col("_doc").isNull(), F.col("rep")).otherwise(F.col("set"))).drop("_doc")

    # Of each set: a row that has it, that of the least doc_id.
    names = filled.groupBy("set").agg(F.min(F.struct("doc_id", "t")).alias("r")).select("set", F.col("r.doc_id").alias("rep"), F.col("r.t").alias("t"))
    names = saved(with_id(names), "jaccard-reps")
    # One row per distinct set, then one per counted n-gram of it.
    sets = docs.where("doc_id is not null").mapInPandas(_keys(percent, words, True), KEYS + ", low array<bigint>").where(F.size("low") > 0)
    sets = with_id(sets.groupBy("n", identity).agg(F.min("doc_id").alias("rep"), F.first("low").alias("low")))
    grams = saved(sets.select("id", "n", F.size("low").alias("m"), F.explode("low").alias("gram")), "jaccard-grams")
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = grams.join(counts, "gram")
    # The prefix has n - needed + 1 n-grams, those that no other set has come first.
    prefix = shared.groupBy("id", "n", "m").agg(F.collect_list(F.struct("df", "gram")).alias("grams"))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    room = length - (F.col("m") - F.size("grams"))
    prefix = prefix.where(room > 0).select("id", "n", F.explode(F.slice(F.array_sort("grams"), F.lit(1), room)).alias("g"))
    buckets = saved(prefix.select(F.col("g.gram").alias("key"), "id", "n"), "jaccard-prefixes")
    discard(grams)

    def texts(parts):
        # One text per distinct set that is asked for. At most FILTER hashes say which texts need not move; the join itself decides.
        wanted = saved(names.join(parts.select("id").distinct(), "id", "left_semi"), "jaccard-wanted")
        bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER))
        some = docs.join(F.broadcast(wanted.select(bucket("t").alias("_bucket")).distinct()), bucket("t") == F.col("_bucket"), "left_semi")
        once = some.join(wanted, (some["doc_id"] == wanted["rep"]) & (some["t"] == wanted["t"])).groupBy("id").agg(F.first("text").alias("text"))
        return once.join(parts, "id").select("block", "part", "id", "probe", "text")

    def compare(ids, sets, probe):
        return tree_links(ids, sets, probe, percent)

    own = filled.join(several, filled["doc_id"] == several["_doc"]).select("doc_id", "set").distinct().join(names.select("set", "id"), "set")
    hubs = own.groupBy("doc_id").agg(F.min("id").alias("a"))
    own = own.join(hubs, "doc_id").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    def whole(some):
        return shingle_sets(some, words)

    found = linked_components(buckets, texts, whole, compare, percent / 100, more=own if of_ids else None, grams=whole, percent=percent)
    # A component is named by the least doc_id of its sets.
    found = found.join(names.select("id", "rep"), "id")
    least = found.groupBy("component").agg(F.min("rep").alias("least"))
    return keys, names, saved(found.join(least, "component").select("id", "component", "least"), "jaccard-found")


def jaccard_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, component of every document (doc_id, set): n-grams of ``words`` words, Jaccard similarity of ``percent`` or more."""
    keys, names, found = _set_components(documents, words, percent, True)
    of_set = left_join(keys.select("doc_id", "n", "set").distinct(), names.select("set", "rep", "id"), ["set"])
    of_set = of_set.join(found, "id", "left")
    return of_set.select("doc_id", "n", F.coalesce("least", "rep", "doc_id").alias("component"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def without_near_copies(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each group: that of the smallest doc_id (null last), then of the least hash of its text. Rows without words stay.

    Rows are told apart by doc_id (a hash of the text where there is none) and the text's hash; of rows equal in both any one stays. Texts are not copied: only rows
    that are repeated so move.
    """
    key, t = free(documents.columns, "_id", "_t")
    text_hash = F.xxhash64("text")
    docs = documents.withColumns({t: text_hash, key: F.coalesce(F.col("doc_id").cast("long"), text_hash)})
    keys, names, found = _set_components(docs.select(F.col(key).alias("doc_id"), "text"), words, percent, False)
    rows = keys.where("n > 0").groupBy("doc_id", "t", "set").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.join(names.select("set", "id"), "set").join(found, "id", "left")
    # A set without a link has all its rows in one group too.
    order = F.struct((F.col("doc_id") == F.col("t")).alias("last"), "doc_id", "t")
    rows = saved(rows.select("doc_id", "t", "copies", "set", "component", order.alias("o")), "jaccard-rows")
    linked, alone = rows.where("component is not null"), rows.where("component is null")
    away = linked.join(linked.groupBy("component").agg(F.min("o").alias("first")), "component").where("o > first").select("doc_id", "t")
    away = away.unionByName(alone.join(alone.groupBy("set").agg(F.min("o").alias("first")), "set").where("o > first").select("doc_id", "t"))
    away = saved(away.select(F.col("doc_id").alias(key), F.col("t").alias(t)), "jaccard-away")
    repeated = rows.where("copies > 1").select(F.col("doc_id").alias(key), F.col("t").alias(t)).join(away, [key, t], "left_anti")
    repeated = saved(repeated, "jaccard-repeated")
    single = docs.join(away.unionByName(repeated), [key, t], "left_anti")
    one = docs.join(repeated, [key, t], "left_semi").dropDuplicates([key, t])
    return single.select(*documents.columns).unionByName(one.select(*documents.columns))


def jaccard_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five-word n-grams, Jaccard similarity 0.8) stays, repeated rows and rows without doc_id included."""
    return without_near_copies(docs)
