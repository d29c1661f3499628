"""Tables with history, kept as an append-only log of row changes.

A log row is a table row plus ``_version``, ``_commit_ts`` and ``_op`` ('I' insert, 'U' update,
'D' delete).  The state at a version is the last change of every key up to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION, COMMIT_TS, OP = "_version", "_commit_ts", "_op"
LOG_COLUMNS = (VERSION, COMMIT_TS, OP)


def changes(rows: DataFrame, version: int, commit_ts: str, op: str | Column) -> DataFrame:
    """Stamp ``rows`` as the changes of one commit."""
    return rows.select(
        "*",
        F.lit(version).alias(VERSION),
        F.lit(commit_ts).cast("timestamp_ntz").alias(COMMIT_TS),
        (F.lit(op) if isinstance(op, str) else op).alias(OP),
    )


def append_changes(log_rows: DataFrame, path: str) -> None:
    """Add one commit to a log on shared storage, one folder per version."""
    log_rows.write.mode("append").partitionBy(VERSION).parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def state_at(
    log: DataFrame, keys: Sequence[str], version: int | None = None, timestamp: str | None = None
) -> DataFrame:
    """The table as of a version or a moment; by default the latest state.

    The last change is picked by an aggregation, which combines on the map side, so that a key with
    a long history is never gathered whole in one task.
    """
    if version is not None:
        log = log.where(F.col(VERSION) <= version)
    if timestamp is not None:
        log = log.where(F.col(COMMIT_TS) <= F.lit(timestamp).cast("timestamp_ntz"))
    row = [c for c in log.columns if c not in LOG_COLUMNS]
    last = F.max_by(F.struct(OP, *(c for c in row if c not in keys)), F.col(VERSION)).alias("_last")
    latest = log.groupBy(*keys).agg(last).where(F.col(f"_last.{OP}") != "D")
    return latest.select(*(F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in row))


def history(log: DataFrame) -> DataFrame:
    """One row per commit with its operation counts."""
    return log.groupBy(F.col(VERSION).alias("version"), F.col(COMMIT_TS).alias("commit_ts")).agg(
        F.count_if(F.col(OP) == "I").alias("inserted"),
        F.count_if(F.col(OP) == "U").alias("updated"),
        F.count_if(F.col(OP) == "D").alias("deleted"),
    )


def between(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int, commit_ts: str) -> DataFrame:
    """The log rows of whatever operation led from one state of a table to the next.

    One full outer join on the keys; rows that are the same on both sides leave no log row.
    """
    rest = [c for c in new.columns if c not in keys]
    before = old.select(*(F.col(k).alias(f"__o_{k}") for k in keys), F.struct(*rest).alias("__old"))
    after = new.select(*keys, F.struct(*rest).alias("__new"))
    same = [F.col(k) == F.col(f"__o_{k}") for k in keys]
    op = F.when(F.col("__old").isNull(), "I").when(F.col("__new").isNull(), "D").when(
        ~F.col("__old").eqNullSafe(F.col("__new")), "U"
    )
    row = F.coalesce("__new", "__old")
    found = before.join(after, same, "full").withColumn("__op", op).where(F.col("__op").isNotNull())
    moved = found.select(
        *(F.coalesce(k, f"__o_{k}").alias(k) for k in keys), *(row[c].alias(c) for c in rest), "__op"
    )
    return changes(moved, version, commit_ts, F.col("__op")).drop("__op").select(*new.columns, *LOG_COLUMNS)


def log_of(states: Sequence[tuple[DataFrame, str]], keys: Sequence[str]) -> DataFrame:
    """The log of a table that was built up by operations: its states, each with the moment of its commit."""
    before = states[0][0].limit(0)
    log = None
    for version, (state, commit_ts) in enumerate(states):
        rows = between(before, state, keys, version, commit_ts)
        log = rows if log is None else log.unionByName(rows)
        before = state
    return log


# --- snapshots -------------------------------------------------------------------------------------

# Beside the log's folders ``_version=N``; Spark passes by folders that begin with an underscore and hold no "=".
_SNAPSHOTS = "_snapshots"


def _moment_of(timestamp: str) -> Column:
    return F.lit(timestamp).cast("timestamp_ntz")


def _hadoop(spark: SparkSession, path: str):
    """A path of the cluster's file system and the file system it is on."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """The versions of which there is a whole snapshot, in order; one whose writing was broken off does not count."""
    pattern, files = _hadoop(spark, f"{path}/{_SNAPSHOTS}/version=*/_SUCCESS")
    return sorted(int(found.getPath().getParent().getName().split("=")[1]) for found in files.globStatus(pattern) or [])


def versions(spark: SparkSession, path: str) -> list[int]:
    """All versions of a log, from the names of its folders."""
    pattern, files = _hadoop(spark, f"{path}/{VERSION}=*")
    return sorted(int(found.getPath().getName().split("=")[1]) for found in files.globStatus(pattern) or [])


def _log_schema(spark: SparkSession, path: str):
    """The schema of a log, from the files of its latest version."""
    latest = spark.read.option("basePath", path).parquet(f"{path}/{VERSION}={versions(spark, path)[-1]}")
    return latest.withColumn(VERSION, F.col(VERSION).cast("int")).schema


def write_snapshot(spark: SparkSession, path: str, keys: Sequence[str], version: int) -> None:
    """Keep the state of a log at ``version``, worked out from the snapshot before it and the changes since.

    Rows keep the version and the moment of their last change, so that a snapshot can stand for the log up to it.
    Writing it again gives the same rows.
    """
    rows = _live(_since_snapshot(spark, path, version), keys)
    rows.write.mode("overwrite").parquet(f"{path}/{_SNAPSHOTS}/version={version}")


def append_commit(log_rows: DataFrame, path: str, keys: Sequence[str], version: int, every: int = 10) -> None:
    """Add one commit, whose rows all have ``version``, and a snapshot after every ``every`` versions.

    The commit is there before its snapshot: a run that ends between the two has lost nothing, as readers take the
    snapshot before.
    """
    append_changes(log_rows, path)
    if version % every == every - 1:
        write_snapshot(log_rows.sparkSession, path, keys, version)


def _live(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change of every key that is not deleted, as a log row."""
    rest = [c for c in log.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col(VERSION)).alias("_last")
    latest = log.groupBy(*keys).agg(last).where(F.col(f"_last.{OP}") != "D")
    return latest.select(*(F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in log.columns))


def _since_snapshot(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Log rows that lead to ``version``: the nearest snapshot at or before it, and the changes after that."""
    schema = _log_schema(spark, path)
    before = [v for v in snapshots(spark, path) if v <= version]
    after = before[-1] if before else None
    log = spark.read.schema(schema).parquet(path).where(F.col(VERSION) <= version)
    if after is None:
        return log
    kept = spark.read.schema(schema).parquet(f"{path}/{_SNAPSHOTS}/version={after}")
    # A condition on the folder column: folders up to the snapshot are not read.
    return kept.unionByName(log.where(F.col(VERSION) > after))


def version_at(spark: SparkSession, path: str, timestamp: str) -> int | None:
    """The last version committed up to a moment.

    Commits are in the order of their moments, so the folders' versions are halved, one row of one folder at a time.
    """
    known = versions(spark, path)
    low, high = 0, len(known)
    while low < high:
        middle = (low + high) // 2
        folder = spark.read.parquet(f"{path}/{VERSION}={known[middle]}")
        if folder.select((F.col(COMMIT_TS) <= _moment_of(timestamp)).alias("is_before")).first().is_before:
            low = middle + 1
        else:
            high = middle
    return known[low - 1] if low else None


def read_at(spark: SparkSession, path: str, keys: Sequence[str], version: int | None = None, timestamp: str | None = None) -> DataFrame:
    """The table of a stored log as of a version or a moment, by default the latest, without replaying the whole log.

    The same rows as :func:`state_at` over the log, from the nearest snapshot and the folders after it alone.  A version
    beyond the last one is the last one; before the first one the table is empty.
    """
    known = versions(spark, path)
    if timestamp is not None:
        found = version_at(spark, path, timestamp)
        version = -1 if found is None else found if version is None else min(version, found)
    if version is None:
        version = known[-1]
    return _live(_since_snapshot(spark, path, version), keys).drop(*LOG_COLUMNS)
