"""Secret scans: base patterns by position, and weak parts of a credential linked within a scope.

A credential comes in parts: an access identifier, a secret, an endpoint. Strong parts (``assign``, ``access``,
``hex``) are reported always. Weak parts - identifier-like and secret-like runs, addresses - mean nothing alone;
they are reported only where complementary parts lie within ``scope`` code points: an identifier needs a secret,
a secret an identifier, an endpoint both. Parts meet in an interval join on (row, bin): a part stands in every bin from its
start to its end, a weak part looks into every bin its scope touches, so a long text with many parts spreads over its bins.

Null text counts as empty; null ids stay; every row, also a repeated one, gives its own row; extra columns are
kept. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, let, saved, table


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


_KEYWORD = "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + f"|{_either('api')}_?{_either('key')}"
ASSIGN = rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LONG = ASSIGN[:-2] + "{12,})"
# Runs that reach the least length; a greedy run is the longest, so shorter ones need no look.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
IDENT = "[A-Z0-9]{16,}"
RANDOM = "[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"[a-z][a-z0-9+.-]{0,31}://[^\x00-\x20]+"  # bounded, so that a long run of letters is not read again from each of its places

# kind -> (rank in the listing, role); base kinds first.
KINDS = {"assign": (0, "secret"), "access": (1, "ident"), "hex": (2, "secret"), "ident": (3, "ident"), "random": (4, "secret"), "endpoint": (5, "endpoint")}
BASE = ("assign", "access", "hex")
SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"
CHUNK = 256


def _spans(text: Column, kind: str, pattern: str, guard: str, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches; the pieces between the matches give their places.

    ``keep`` sees a match's text. Rows without a match of ``guard`` skip the work. Places are summed in chunks of ``CHUNK`` matches, so no array is copied for
    each match.
    """
    rank = KINDS[kind][0]
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def measured(x):
        good = x["hit"].isNotNull() & (keep(x["hit"]) if keep else F.lit(True))
        return F.struct(F.length(x["gap"]).cast("long").alias("gap"), F.coalesce(F.length(x["hit"]), F.lit(0)).cast("long").alias("hit"), good.alias("good"))

    def step(state, x):
        start = state["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["hit"]).alias("end"))
        return F.struct((start + x["hit"]).alias("at"), F.when(x["good"], F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    def walked(pieces):
        chunk = lambda c: F.slice(pieces, c * CHUNK + 1, F.lit(CHUNK))
        numbers = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / CHUNK).cast("int"))
        sizes = F.transform(numbers, lambda c: F.aggregate(chunk(c), F.lit(0).cast("long"), lambda n, x: n + x["gap"] + x["hit"]))
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        begins = F.aggregate(sizes, zero, lambda state, n: F.struct((state["at"] + n).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out")), lambda state: state["out"])
        spans = lambda c, at: F.aggregate(chunk(c), F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")), step, lambda state: state["out"])
        return F.flatten(F.zip_with(numbers, begins, spans))

    return F.when(text.rlike(guard), let(F.transform(found, measured), walked)).otherwise(F.array().cast(SPAN))


def _mixed(hit: Column) -> Column:
    return hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")


def scan_secrets(documents: DataFrame, text: str = "text", scope: int = 256) -> DataFrame:
    """``documents`` without the text, with ``base_spans`` (strong parts) and ``spans`` (with linked weak ones): sorted arrays of (start, rank, end).

    A column of the caller keeps its name and content; a result whose name is taken gets an underscore after it.
    """
    row, base_spans, spans, weak_spans, key, linked_spans = free(documents.columns, "_row", "base_spans", "spans", "_weak", "_r", "_linked")
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        _spans(body, "assign", ASSIGN, ASSIGN_LONG, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12),
        _spans(body, "access", ACCESS, ACCESS),
        _spans(body, "hex", HEX, HEX),
    )
    weak = F.concat(
        _spans(body, "ident", IDENT, IDENT, _mixed),
        _spans(body, "random", RANDOM, RANDOM, _mixed),
        _spans(body, "endpoint", ENDPOINT, ENDPOINT),
    )
    others = [c for c in documents.columns if c != text]
    rows = saved(documents.select(*others, F.monotonically_increasing_id().alias(row), F.array_sort(base).alias(base_spans), weak.alias(weak_spans)), "secret-parts")

    role = F.element_at(F.create_map(*[F.lit(x) for r, k in KINDS.values() for x in (r, k)]), F.col("p.rank"))
    of = lambda spans: rows.select(F.col(row).alias(key), F.explode(spans).alias("p")).select(key, "p.*", role.alias("role"))
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))
    parts = of(F.concat(base_spans, weak_spans)).withColumn("bin", bins(F.col("start"), F.col("end")))
    left = of(F.col(weak_spans)).withColumn("bin", bins(F.col("start") - scope, F.col("end") + scope))
    other = parts.select(key, "bin", F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.col("role").alias("o_role"), F.col("rank").alias("o_rank"))
    near = (F.col("o_start") <= F.col("end") + scope) & (F.col("o_end") >= F.col("start") - scope)
    apart = (F.col("o_end") <= F.col("start")) | (F.col("o_start") >= F.col("end"))
    linked = near & apart & (F.col("role") != F.col("o_role"))
    covered = ~apart & (F.col("o_rank") < len(BASE))  # a weak run that touches a strong span is the same thing seen twice
    any_of = lambda condition: F.max(condition.cast("int"))
    told = (
        left.join(other, [key, "bin"]).where(linked | covered)
        .groupBy(key, "start", "rank", "end", "role")
        .agg(any_of(covered).alias("covered"), any_of(linked & (F.col("o_role") == "ident")).alias("ident"), any_of(linked & (F.col("o_role") == "secret")).alias("secret"))
        .where("covered = 0 and ((role = 'ident' and secret = 1) or (role = 'secret' and ident = 1) or (role = 'endpoint' and ident = 1 and secret = 1))")
        .groupBy(key).agg(F.collect_list(F.struct("start", "rank", "end")).alias(linked_spans))
    )
    found = rows.join(told, rows[row] == told[key], "left")
    both = F.array_sort(F.concat(F.col(base_spans), F.coalesce(linked_spans, F.array().cast(SPAN))))
    return found.select(*others, base_spans, both.alias(spans))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secret_scans(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda rank: F.size(F.filter("base_spans", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text(F.col("base_spans")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
    )
