"""Readers of the tables that the sinks write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_folder(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet folder with its partition columns; filters on those prune whole folders."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_parts(
    spark: SparkSession, path: str, folders: Sequence[str], schema: T.StructType
) -> DataFrame:
    """The rows of some folders of a table, found without listing any other."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first n rows, for a look at the data."""
    return df.limit(n)
