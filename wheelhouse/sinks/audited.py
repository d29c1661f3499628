"""Constraints that are checked while a batch is written, before anybody can read it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wheelhouse.operators.joins import sized
from wheelhouse.sinks.batches import BatchTable
from wheelhouse.sinks.files import observed

_CLEAN, REASONS = "__clean", "reasons"


class AuditFailed(ValueError):
    """A batch that breaks more constraints than allowed; ``broken`` counts the rows by constraint."""

    def __init__(self, batch: str, bad: int, broken: Mapping[str, int]) -> None:
        super().__init__(f"batch {batch}: {bad} bad rows, {', '.join(f'{name}: {n}' for name, n in broken.items() if n)}")
        self.batch, self.bad, self.broken = batch, bad, dict(broken)


def known_keys(df: DataFrame, column: str, parent: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with a column ``name`` that tells whether a foreign key has a parent; NULL has none and needs none.

    The parent's keys are broadcast when they are measured to be small.
    """
    (side,) = sized(parent.select(F.col(key).alias("__parent")).where(F.col(key).isNotNull()).distinct())
    joined = df.join(side, F.col(column) == F.col("__parent"), "left")
    return joined.withColumn(name, F.col("__parent").isNotNull() | F.col(column).isNull()).drop("__parent")


class AuditedTable(BatchTable):
    """A :class:`BatchTable` whose batches are published only if their rows keep the constraints ``bad``.

    ``bad`` names each constraint and gives the condition of the rows that break it; an unknown condition breaks nothing,
    as in a CHECK constraint.  The write itself counts them, as observations of the one job that also parts the rows:
    clean ones to the folder that readers see, the others to a quarantine beside it, with the names of what they break.
    With more than ``allowed`` bad rows the batch is not published, and :class:`AuditFailed` tells the counts; its
    quarantine can be read all the same.  Columns that only the constraints need are not written for clean rows.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, bad: Mapping[str, Column], by: Sequence[str] = (), allowed: int = 0
    ) -> None:
        super().__init__(spark, path, schema, by)
        self.bad, self.allowed = dict(bad), allowed
        self._counts: dict[str, dict[str, int]] = {}

    def _stage(self, batch: str, rows: DataFrame) -> int:
        seen = Observation()
        broken = [F.when(condition, F.lit(name)) for name, condition in self.bad.items()]
        judged = rows.withColumn(REASONS, F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))
        judged = judged.select(*self.schema.names, REASONS).withColumn(_CLEAN, F.size(REASONS) == 0)
        counts = [F.count_if(F.array_contains(REASONS, name)).alias(f"c{i}") for i, name in enumerate(self.bad)]
        counted = judged.observe(seen, F.count_if(_CLEAN).alias("clean"), F.count_if(~F.col(_CLEAN)).alias("bad"), *counts)
        folders = [_CLEAN, *self.by]
        counted.hint("rebalance", *folders).write.mode("overwrite").partitionBy(*folders).parquet(f"{self.path}/{self._folder(batch)}")
        found = observed(seen)
        self._counts[batch] = {name: found[f"c{i}"] for i, name in enumerate(self.bad)} | {"": found["bad"]}
        return found["clean"]

    def _verify(self, batch: str, written: int) -> None:
        super()._verify(batch, written)
        broken = dict(self._counts.pop(batch))
        bad = broken.pop("")
        if bad > self.allowed:
            raise AuditFailed(batch, bad, broken)

    def _rows(self, batch: str, clean: bool) -> DataFrame:
        kind = T.StructType([*self.schema.fields, T.StructField(REASONS, T.ArrayType(T.StringType())), T.StructField(_CLEAN, T.BooleanType())])
        found = self.spark.read.schema(kind).parquet(f"{self.path}/{self._folder(batch)}").where(F.col(_CLEAN) == clean)
        return found.select(*self.schema.names, REASONS)

    def _open(self, batches: Sequence[str]) -> DataFrame:
        out = self.spark.createDataFrame([], self.schema)
        for batch in batches:
            out = out.unionByName(self._rows(batch, True).drop(REASONS))
        return out

    def quarantine(self, batch: str) -> DataFrame:
        """The bad rows of a staged or published batch, with the names of the constraints they break."""
        return self._rows(batch, False)
