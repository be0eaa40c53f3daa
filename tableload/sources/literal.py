"""Constant rows and parameterised rows, as SQL with bound arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def literal_source(spark: SparkSession, rows, columns: list[str] | tuple[str, ...],
                   schema: T.StructType | None = None) -> DataFrame:
    """Constant rows with named columns (all strings unless ``schema`` says otherwise)."""
    if schema is None:
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in columns])
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def bound_rows(spark: SparkSession, sql: str, args: dict, **sources: DataFrame) -> DataFrame:
    """Run SQL with named parameter markers (``:name``); a quote in a value is data.

    ``{name}`` in the text refers to a frame passed as ``name=frame``.
    """
    return spark.sql(sql, args=args or None, **sources)
