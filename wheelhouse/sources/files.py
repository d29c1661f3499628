"""File readers.  Schemas are given, never inferred, so that no extra pass over the data is needed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, header: bool = True) -> DataFrame:
    """CSV with a header line.  Without a schema the types are inferred, at the price of a second pass."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per line in column ``value``; a folder or a glob works as well."""
    return spark.read.text(path)


def read_name_list(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A one-column CSV list whose header line may be repeated between the members."""
    return read_csv(spark, path, f"{column} string").where(F.col(column) != F.lit(column))


def parse_json(text: Column, schema: T.StructType | str) -> Column:
    return F.from_json(text, schema)


def json_paths(df: DataFrame, text: str, paths: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Pick ``{name: (path, type)}`` out of a JSON text column without a schema; an absent path is NULL."""
    return df.select(
        *(F.get_json_object(F.col(text), path).cast(kind).alias(name) for name, (path, kind) in paths.items())
    )


def json_fields(df: DataFrame, text: str, names: list[str]) -> DataFrame:
    """Several top-level JSON keys in one parse, beside the columns of ``df``."""
    return df.select("*", F.json_tuple(F.col(text), *names).alias(*names))


def open_views(spark: SparkSession, tables: Mapping[str, str]) -> dict[str, DataFrame]:
    """Open saved Parquet tables ``{view name: path}`` and register each as a temporary view."""
    opened = {}
    for name, path in tables.items():
        opened[name] = spark.read.parquet(path)
        opened[name].createOrReplaceTempView(name)
    return opened


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a Parquet dataset (reads its metadata only); any fault but "not found" is raised."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


WEATHER_SCHEMA = T.StructType(
    [
        T.StructField("zipCode", T.StringType()),
        T.StructField(
            "coord",
            T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]),
        ),
        T.StructField(
            "weather",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.IntegerType()),
                        T.StructField("main", T.StringType()),
                        T.StructField("description", T.StringType()),
                        T.StructField("icon", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "main",
            T.StructType(
                [
                    T.StructField("temp", T.DoubleType()),
                    T.StructField("feels_like", T.DoubleType()),
                    T.StructField("temp_min", T.DoubleType()),
                    T.StructField("temp_max", T.DoubleType()),
                    T.StructField("pressure", T.IntegerType()),
                    T.StructField("humidity", T.IntegerType()),
                ]
            ),
        ),
        T.StructField("dt", T.LongType()),
    ]
)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet dataset that may not be there yet; then it has no rows."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
