"""Tool-call linking for chat formatting.

Calls and results meet in a hash join on (conversation, identifier). Dependencies between calls are ordered
topologically by peeling: each round resolves the calls whose dependencies are all resolved, so the rounds are the
longest chain; calls on a cycle keep a null ``level``. Arguments are parsed as JSON and checked against schemas,
field by field, and call and result are written as one canonical JSON line (keys sorted, no spaces).

One row per (conversation, identifier). Repeated rows count in ``n_calls`` / ``n_results``; the least (turn, name,
arguments) is the call, the least (turn, content) the result, chosen by partial aggregates so that a hot
identifier is reduced in the map tasks. A null identifier links nothing. A result without a call has status
``no_call``, a call without a result ``no_result``. A dependency that names no call is listed as ``after:id`` in ``errors`` and holds
nothing up. Text that is no JSON object (also one with a repeated key) gives ``not_object`` and null canonical
text. Extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import left_join, saved, table

KEYS = ["conv_id", "call_id"]
BROADCAST_ROWS = 100_000
# JSON type of a schema -> pattern of what Spark says about a parsed value.
TYPES = {"string": "STRING", "integer": "BIGINT|DECIMAL\\(\\d+,0\\)", "number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*", "null": "VOID"}


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """``level`` of each call: 0 without dependencies, else one more than the highest it depends on; null on or behind a cycle.

    ``edges``: conv_id, call_id, dep, all of them known calls.
    """
    children = edges.select(*KEYS).distinct()
    frontier = saved(left_join(calls.select(*KEYS), children, KEYS, "left_anti"), "tool-level")
    done, level = frontier.withColumn("level", F.lit(0)), 0
    edges = saved(edges, "tool-edges")
    while not edges.isEmpty():
        resolved = frontier.select("conv_id", F.col("call_id").alias("dep"))
        left = saved(left_join(edges, resolved, ["conv_id", "dep"], "left_anti"), "tool-edges")
        frontier = saved(left_join(edges.select(*KEYS).distinct(), left.select(*KEYS).distinct(), KEYS, "left_anti"), "tool-level")
        if frontier.isEmpty():
            break
        level += 1
        done, edges = done.unionByName(frontier.withColumn("level", F.lit(level))), left
    return done


def _argument_types(calls: DataFrame) -> DataFrame:
    """KEYS, ``given``: map of argument name to Spark's name of its type."""
    spark = calls.sparkSession
    fields = spark.sql("SELECT conv_id, call_id, f.key, schema_of_variant(f.value) AS kind FROM {c}, LATERAL variant_explode(parsed) AS f WHERE f.key IS NOT NULL", c=calls)
    return fields.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("key", "kind"))).alias("given"))


def _errors(given: Column, schema: Column) -> Column:
    kind = lambda s: F.element_at(given, s["field"])
    pattern = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    missing = F.transform(F.filter(schema, lambda s: s["required"] & kind(s).isNull()), lambda s: F.concat(F.lit("missing:"), s["field"]))
    wrong = F.transform(
        F.filter(schema, lambda s: kind(s).isNotNull() & ~F.regexp_like(kind(s), F.concat(F.lit("^("), F.element_at(pattern, s["type"]), F.lit(")$")))),
        lambda s: F.concat(F.lit("type:"), s["field"]))
    known = F.transform(schema, lambda s: s["field"])
    unknown = F.transform(F.filter(F.map_keys(given), lambda k: ~F.array_contains(known, k)), lambda k: F.concat(F.lit("unknown:"), k))
    return F.concat(missing, wrong, unknown)


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls``: conv_id, call_id, turn, name, arguments, after (array of identifiers); ``results``: conv_id, call_id,
    turn, content; ``schemas``: name, field, type, required. See the module text for the result."""
    called = calls.groupBy(*KEYS).agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("c"), F.count(F.lit(1)).alias("n_calls")).select(*KEYS, "c.*", "n_calls")
    called = saved(called.withColumn("parsed", F.try_parse_json("arguments")).withColumn(
        "parsed", F.when(F.schema_of_variant("parsed").startswith("OBJECT"), F.col("parsed"))).withColumn("args", F.to_json("parsed")).drop("parsed"), "tool-calls")
    named = called.where(F.col("call_id").isNotNull())
    wanted = named.select(*KEYS, F.explode(F.array_distinct("after")).alias("dep")).where(F.col("dep").isNotNull())
    known = left_join(wanted, named.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"], "left_semi")
    lost = left_join(wanted, named.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"], "left_anti").groupBy(*KEYS).agg(
        F.transform(F.collect_list("dep"), lambda d: F.concat(F.lit("after:"), d)).alias("lost"))
    level = levels(named, known)
    types = _argument_types(called.withColumn("parsed", F.try_parse_json("args")))
    shapes = schemas.groupBy("name").agg(F.collect_list(F.struct("field", "type", "required")).alias("schema"))
    if schemas.count() <= BROADCAST_ROWS:
        shapes = F.broadcast(shapes)
    rows = left_join(left_join(left_join(called, types, KEYS), level, KEYS), lost, KEYS).join(shapes, "name", "left")
    empty = F.array().cast("array<string>")
    given = F.coalesce("given", F.create_map().cast("map<string,string>"))
    faults = F.when(F.col("args").isNull(), F.array(F.lit("not_object"))).when(F.col("schema").isNull(), F.array(F.lit("no_schema"))).otherwise(_errors(given, F.col("schema")))
    rows = rows.withColumn("errors", F.array_sort(F.concat(faults, F.coalesce("lost", empty))))
    answered = results.groupBy(*KEYS).agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results")).select(
        F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), "n_results")
    joined = rows.join(answered, rows["conv_id"].eqNullSafe(answered["r_conv"]) & (rows["call_id"] == answered["r_call"]), "full_outer")
    is_call, is_result = F.col("n_calls").isNotNull(), F.col("n_results").isNotNull()
    status = F.when(is_call & is_result, "linked").when(is_call, "no_result").otherwise("no_call")
    rest = F.to_json(F.struct(F.col("id"), F.col("name"), F.col("content").alias("result")))
    return joined.select(
        F.coalesce("conv_id", "r_conv").alias("conv_id"), F.coalesce("call_id", "r_call").alias("id"),
        "name", "turn", "result_turn", "level", status.alias("status"), "content", "args",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.coalesce("errors", empty).alias("errors"),
    ).withColumn("line", F.when(F.col("args").isNotNull(), F.concat(F.lit('{"arguments":'), "args", F.lit(","), F.substring(rest, 2, 2147483647)))).drop("content", "args")


# Schemas of the calls that the query derives from conversations: a turn's role is the tool.
SCHEMAS = [(role, field, kind, True) for role in ("system", "user") for field, kind in (("text", "string"), ("turn", "integer"))] + [("user", "words", "integer", False)]


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of conversations: a turn that is not the assistant's asks, with its text as argument, and
    depends on the turn at half its number; an assistant turn answers the turn before it."""
    words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    asks = turns.where(F.coalesce(F.col("role") != "assistant", F.lit(True))).select(
        "conv_id", F.concat(F.lit("c"), F.col("turn")).alias("call_id"), "turn", F.col("role").alias("name"),
        F.to_json(F.struct(words.alias("words"), "turn", F.coalesce("text", F.lit("")).alias("text"))).alias("arguments"),
        F.when(F.col("turn") > 0, F.array(F.concat(F.lit("c"), F.floor(F.col("turn") / 2)))).alias("after"))
    answers = turns.where(F.col("role") == "assistant").select(
        "conv_id", F.concat(F.lit("c"), F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return asks, answers


def op10_tool_calls(spark, sf_dir):
    asks, answers = calls_of(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    return link_calls(asks, answers, schemas).withColumn("errors", F.array_join("errors", ","))
