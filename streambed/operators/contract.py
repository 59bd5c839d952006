"""Output contracts of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [name for name in schema.names if name not in df.columns]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The contract's columns in the contract's order and types; a missing column is an error.

    A value that does not fit its type fails the load (ANSI casts); none turns into null.
    """
    missing = missing_columns(df, schema)
    if missing:
        raise ValueError(f"columns missing from the result: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
