"""Parquet store with versioned appends.

Layout::

    <root>/<table>/run_id=<run>/_period=<yyyy-MM>/part-*.parquet
    <root>/_commits/part-*.json            one line per (run, table)
    <root>/_batches/<run>/                 what a running refresh keeps of its batch

A run writes its rows to every table first and its commit lines, in one file, last. Readers take
committed runs only, so a failed run stays invisible. Commits are numbered; rows of a later commit
replace rows with the same key, whatever the run ids look like. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrain.functions.scalars import nan_to_null
from airgrain.operators.columns import conform, date_range
from airgrain.operators.merge import last_write_wins
from airgrain.schemas import PARTITION_COLUMN, TABLE_KEYS, TABLES
from airgrain.sources.files import read_jdbc, write_csv, write_jdbc

COMMIT = "seq long, run_id string, table string, kind string"
PERIOD = "_period"
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"  # Spark's name for the folder of rows without a value


class Store:
    """A folder of tables; any file system Spark can write to.

    ``period`` is the date pattern rows are partitioned by: months suit hourly runs on a long
    history, years suit small tables. It is fixed for the life of a store.
    """

    def __init__(self, spark: SparkSession, root: str, period: str = "yyyy-MM"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.period = period

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def exists(self, *parts: str) -> bool:
        return path_exists(self.spark, self.path(*parts))

    def runs(self, table: str) -> list[tuple[str, str]]:
        """Committed ``(run_id, kind)`` in commit order, from the newest base on; ``compact`` keeps
        the list short.

        Only commit lines come to the driver, as file listings do; no table rows.
        """
        mine = self.commits().where(F.col("table") == table)
        base = mine.where(F.col("kind") == "base").agg(F.max("seq")).first()[0]
        if base is not None:
            mine = mine.where(F.col("seq") >= base)
        found = mine.select("seq", "run_id", "kind").collect()
        return [(r["run_id"], r["kind"]) for r in sorted(found, key=lambda r: r["seq"])]

    def periods(self, table: str) -> list[str]:
        """Periods the table has rows in, newest first, from the names of folders alone. Rows without
        a date are in no period."""
        found = {
            name.removeprefix(f"{PERIOD}=")
            for run, _ in self.runs(table)
            for name in folder_names(self.spark, self.path(table, f"run_id={run}"))
            if name.startswith(f"{PERIOD}=") and name != f"{PERIOD}={NO_PERIOD}"
        }
        return sorted(found, reverse=True)

    def commits(self) -> DataFrame:
        if not self.exists("_commits"):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).json(self.path("_commits"))

    def committed_tables(self, run_id: str) -> set[str]:
        """Tables the run has written; at most one line per table."""
        mine = self.commits().where(F.col("run_id") == run_id)
        return {r["table"] for r in mine.select("table").distinct().collect()}

    def is_committed(self, run_id: str) -> bool:
        return bool(self.committed_tables(run_id))

    def refuse_reuse(self, run_id: str, tables: Sequence[str]) -> None:
        """A committed folder is never written again: readers and compactions may be reading it."""
        used = sorted(self.committed_tables(run_id) & set(tables))
        if used:
            raise ValueError(f"run {run_id!r} is committed already for {', '.join(used)}")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder, as after a write without rows."""
    if not path_exists(spark, path):
        return []
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    return [f.getPath().getName() for f in files]


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def append_rows(df: DataFrame, store: Store, table: str, run_id: str) -> None:
    """Write one run's rows of one table; invisible until committed. A run repeated before its
    commit overwrites its own folder."""
    rows = nan_to_null(conform(df, TABLES[table]))
    day = PARTITION_COLUMN[table]
    rows = rows.withColumn(PERIOD, F.date_format(F.col(day), store.period))
    # few files per period; a period too large for one task is split at run time
    rows = rows.hint("rebalance", PERIOD).sortWithinPartitions(PERIOD, day)
    rows.write.mode("overwrite").partitionBy(PERIOD).parquet(store.path(table, f"run_id={run_id}"))


def commit(store: Store, run_id: str, tables: Sequence[str], kind: str = "append") -> None:
    seq = (store.commits().agg(F.max("seq")).first()[0] or 0) + 1
    lines = store.spark.createDataFrame([(seq, run_id, t, kind) for t in tables], COMMIT)
    lines.coalesce(1).write.mode("append").json(store.path("_commits"))


def publish(tables: Mapping[str, DataFrame], store: Store, run_id: str) -> bool:
    """All tables of a run or none. A run that is committed already is left alone (False); an id
    that was committed with other tables is refused, since these rows would be lost."""
    done = store.committed_tables(run_id)
    if done >= set(tables) and done:
        return False
    if done:
        raise ValueError(f"run {run_id!r} is committed already, without {sorted(set(tables) - done)}")
    for table, df in tables.items():
        append_rows(df, store, table, run_id)
    commit(store, run_id, list(tables))
    return True


def current(
    store: Store, table: str, start=None, end=None, periods: Sequence[str] | None = None
) -> DataFrame:
    """The table as of the last commit: the newest row per key.

    The base is read as it is, duplicate keys of a loaded file included, and loses only the keys
    written since, by an anti-join against the recent runs; those alone are ranked. Of rows with
    the same key in one run one counts, chosen by its content. A date range reaches the scan, also
    as partition pruning; ``periods`` names single partitions.
    """
    schema = TABLES[table]
    runs = store.runs(table)
    if not runs:
        return store.spark.createDataFrame([], schema)
    keys = list(TABLE_KEYS[table])
    base = [r for r, kind in runs if kind == "base"]
    recent = [r for r, kind in runs if kind != "base"]
    changed = _scan(store, table, recent, start, end, periods) if recent else None
    if changed is not None:
        numbered = changed.withColumns({
            "_commit": F.array_position(F.lit(recent), F.col("run_id")),
            "_content": F.xxhash64(*schema.names),
        })
        changed = last_write_wins(numbered, keys, ["_commit", "_content"]).drop("_commit", "_content", "run_id")
    if not base:
        return changed
    rows = _scan(store, table, base, start, end, periods).drop("run_id")
    if changed is None:
        return rows
    return rows.join(changed.select(*keys), keys, "left_anti").unionByName(changed)


def runs_of(store: Store, table: str, runs: Sequence[str]) -> DataFrame:
    """All rows that the given runs have written."""
    return _scan(store, table, runs, None, None, None).drop("run_id")


def newest_period(store: Store, table: str) -> DataFrame:
    """``current`` of the newest period that holds rows; no other period is read. Later runs replace
    rows, they never remove any, so that period always has one. Empty if no row has a date."""
    return current(store, table, periods=store.periods(table)[:1])


def _scan(store: Store, table: str, runs: Sequence[str], start, end, periods) -> DataFrame:
    paths = [store.path(table, f"run_id={r}") for r in runs]
    reader = store.spark.read.schema(f"{_ddl(TABLES[table])}, run_id string, {PERIOD} string")
    df = reader.option("basePath", store.path(table)).parquet(*paths)
    col = PARTITION_COLUMN[table]
    if periods is not None:
        df = df.where(F.col(PERIOD).isin(list(periods)))
    if start is not None:
        df = df.where(F.col(PERIOD) >= F.date_format(F.lit(start).cast("date"), store.period))
    if end is not None:
        df = df.where(F.col(PERIOD) <= F.date_format(F.lit(end).cast("date"), store.period))
    return date_range(df, col, start, end).drop(PERIOD)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def compact(store: Store, table: str, run_id: str) -> None:
    """Write ``current`` as a new base; older runs are no longer read."""
    store.refuse_reuse(run_id, [table])
    append_rows(current(store, table), store, table, run_id)
    commit(store, run_id, [table], "base")


def replace_table(df: DataFrame, store: Store, table: str, run_id: str) -> None:
    """The rows become the whole table."""
    store.refuse_reuse(run_id, [table])
    append_rows(df, store, table, run_id)
    commit(store, run_id, [table], "base")


def load_table(spark: SparkSession, source: Store | Mapping, name: str) -> DataFrame:
    """Full scan of a stored table, or of a database table given JDBC settings."""
    if isinstance(source, Store):
        return current(source, name)
    return read_jdbc(spark, **{**source, "table": name})


def write_targets(
    tables: Mapping[str, DataFrame], targets: Mapping[str, Mapping], run_id: str
) -> None:
    """Write the same frames to several targets, under the target's own table names.

    A target is ``{"kind": "store"|"parquet"|"csv"|"jdbc", "names": {table: name}, ...}`` with
    ``store``, ``path`` or ``url``/``properties``; ``"enabled": False`` switches it off. The frames
    are persisted while they are written more than once.
    """
    active = [t for t in targets.values() if t.get("enabled", True)]
    for target in active:
        if target["kind"] == "store":
            target["store"].refuse_reuse(run_id, list(tables))
    frames = {n: df.persist() for n, df in tables.items()} if len(active) > 1 else dict(tables)
    try:
        for target in active:
            names = target.get("names", {})
            if target["kind"] == "store":
                for table, df in frames.items():
                    append_rows(df, target["store"], table, run_id)
                commit(target["store"], run_id, list(frames), "base")
                continue
            for table, df in frames.items():
                name = names.get(table, table)
                if target["kind"] == "parquet":
                    df.write.mode("overwrite").parquet(f"{target['path']}/{name}")
                elif target["kind"] == "csv":
                    write_csv(df, f"{target['path']}/{name}")
                elif target["kind"] == "jdbc":
                    write_jdbc(df, target["url"], name, "overwrite", target.get("properties"))
                else:
                    raise ValueError(f"unknown target kind {target['kind']!r}")
    finally:
        if len(active) > 1:
            for df in frames.values():
                df.unpersist()
