"""Parquet tables of the layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False
) -> DataFrame:
    """Scan a table. ``merge`` unites the columns of parts written with different ones."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("mergeSchema", merge).parquet(path)


def read_optional(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False
) -> DataFrame | None:
    """``None`` when nothing was ever written there; any other failure is raised."""
    try:
        return read_table(spark, path, schema, merge)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
