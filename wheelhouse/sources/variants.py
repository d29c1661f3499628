"""JSON documents whose shape changes over time, read without losing anything silently."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAULTS = "faults"


@dataclass(frozen=True)
class Field:
    """A column of a document: where it may stand, first choice first, its type, and whether it must be there."""

    paths: tuple[str, ...]
    kind: str
    required: bool = True


def _found(document: Column, field: Field) -> Column:
    """The value at the first path that the document has, as it stands; a JSON null counts as not there."""
    values = [F.try_variant_get(document, path, "variant") for path in field.paths]
    return F.coalesce(*(F.when(~F.is_variant_null(value), value) for value in values))


def typed_documents(df: DataFrame, text: str, fields: Mapping[str, Field]) -> DataFrame:
    """``df`` with a typed column for each field and ``faults``, what is wrong with the document.

    The text is parsed once, to a VARIANT, which takes any shape.  A fault is ``unreadable`` (no JSON; the only fault
    then), ``name: missing`` for a required field that stands nowhere, or ``name: not a kind`` for a value that is there
    but of no such type.  A NULL text is unreadable.  Columns of ``df`` named like a field are replaced.
    """
    document = F.try_parse_json(F.col(text))
    rows = df.withColumn("__document", document)
    rows = rows.withColumns({f"__{name}": _found(F.col("__document"), field) for name, field in fields.items()})
    typed = {name: F.try_variant_get(F.col(f"__{name}"), "$", field.kind) for name, field in fields.items()}
    rows = rows.withColumns(typed)
    faults = []
    for name, field in fields.items():
        there = F.col(f"__{name}").isNotNull()
        wrong = F.when(there & F.col(name).isNull(), F.lit(f"{name}: not a {field.kind}"))
        faults.append(wrong.when(~there, F.lit(f"{name}: missing")) if field.required else wrong)
    unreadable = F.col("__document").isNull()
    rows = rows.withColumn(FAULTS, F.when(unreadable, F.array(F.lit("unreadable"))).otherwise(F.array_compact(F.array(*faults))))
    return rows.drop("__document", *(f"__{name}" for name in fields))


def parted(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents without faults, and those for the quarantine."""
    good = F.size(FAULTS) == 0
    return documents.where(good).drop(FAULTS), documents.where(~good)


# Where weather documents of the older and the newer shape keep their fields.
WEATHER_FIELDS = {
    "zipcode": Field(("$.zipCode", "$.place.zip"), "string"),
    "epoch": Field(("$.dt", "$.observed"), "bigint"),
    "condition": Field(("$.weather[0].main", "$.sky"), "string"),
    "kelvin": Field(("$.main.temp", "$.temperature.kelvin"), "double"),
    "humidity": Field(("$.main.humidity", "$.humidity"), "int", required=False),
}
