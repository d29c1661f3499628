"""Columns computed batch by batch in Python, with all other columns passed through as they are."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wheelhouse.llm.shipping import ship

#: Bytes of a batch that Python looks at in one go; batches are cut to rows of about that much.
SLICE_BYTES = 3 << 20


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``limit`` bytes on average; a longer row stands alone."""
    if batch.num_rows == 0:
        return
    step = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [value or "" for value in column.to_pylist()]


def set_aside(df: DataFrame, taken: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns of the taken names renamed, and what gives its own columns back, in their order."""
    taken = set(taken)
    names = {name: f"__own_{name}" if name in taken else name for name in df.columns}
    renamed = df.select(*[F.col(f"`{name}`").alias(new) for name, new in names.items()])
    return renamed, lambda out: out.select(*[F.col(f"`{new}`").alias(name) for name, new in names.items()])


def with_batches(df: DataFrame, inputs: Sequence[str], outputs: str, prepare: Callable[[], Callable]) -> DataFrame:
    """``df`` with the columns of the schema string ``outputs``, which replace input columns of the same name.

    ``prepare()`` runs once per task and gives a function from the input columns (Arrow arrays) to the list of new
    columns (lists or Arrow arrays, one value per row).
    """
    added = StructType.fromDDL(outputs)
    kept = [field for field in df.schema if field.name not in added.names]
    schema = StructType(kept + list(added))
    names, kept_names = list(inputs), [field.name for field in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(StructType(list(added)))
        work = prepare()
        for batch in batches:
            for part in slices(batch):
                made = work(*[part.column(name) for name in names])
                new = [value if isinstance(value, pa.Array) else pa.array(value, field.type) for value, field in zip(made, target)]
                yield pa.RecordBatch.from_arrays([part.column(name) for name in kept_names] + new, names=schema.names)

    ship(df.sparkSession)
    columns = list(dict.fromkeys(kept_names + names))
    return df.select(*[f"`{name}`" for name in columns]).mapInArrow(run, schema)
