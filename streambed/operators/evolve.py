"""Schemas that grow: the union of two schema trees, and rows brought to a wider one.

Columns are matched by name at every depth. A type is widened only to one that holds all values of
both; types without such a common type become text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed.operators import changelog

# Whole digits of the integer types.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
NESTED = (T.StructType, T.ArrayType, T.MapType)


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, merge_types(a.valueType, b.valueType))
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _wider_number(a, b)
    return T.StringType()


def _wider_number(a: T.DataType, b: T.DataType) -> T.DataType:
    if type(a) in DIGITS and type(b) in DIGITS:
        return max(a, b, key=lambda kind: DIGITS[type(kind)])
    if any(isinstance(kind, (T.FloatType, T.DoubleType)) for kind in (a, b)):
        return T.DoubleType()
    (whole_a, scale_a), (whole_b, scale_b) = _digits(a), _digits(b)
    whole, scale = max(whole_a, whole_b), max(scale_a, scale_b)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (DIGITS[type(kind)], 0)


def merge_schemas(first: T.StructType, second: T.StructType) -> T.StructType:
    """All columns of both, the first one's before what the second adds."""
    merged = [
        T.StructField(f.name, merge_types(f.dataType, second[f.name].dataType) if f.name in second.names else f.dataType)
        for f in first.fields
    ]
    added = [T.StructField(f.name, f.dataType) for f in second.fields if f.name not in first.names]
    return T.StructType(merged + added)


def without_nulls(kind: T.DataType) -> T.DataType | None:
    """The type without the parts that only ever were null; None if nothing is left."""
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.StructType):
        kept = [(f.name, without_nulls(f.dataType)) for f in kind.fields]
        fields = [T.StructField(name, part) for name, part in kept if part is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        element = without_nulls(kind.elementType)
        return None if element is None else T.ArrayType(element)
    return kind


def observed_schema(changes: DataFrame, image: str = "after") -> T.StructType:
    """The columns that the row images of all changes have, with types that hold all their values.

    A column that was null in every image is left out: it has no type yet.
    """
    text = changes.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(image))).alias("schema")).first()["schema"]
    if not text.startswith("OBJECT<"):
        return T.StructType([])
    return without_nulls(changelog.variant_type(text, void=T.NullType())) or T.StructType([])


def widened(value: Column, kind: T.DataType, wider: T.DataType) -> Column:
    """A value brought to the wider type; what is new in it is null."""
    if kind == wider:
        return value
    if isinstance(kind, T.StructType) and isinstance(wider, T.StructType):
        parts = [
            (widened(value[f.name], kind[f.name].dataType, f.dataType) if f.name in kind.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wider.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType) and isinstance(wider, T.ArrayType):
        return F.transform(value, lambda x: widened(x, kind.elementType, wider.elementType))
    if isinstance(kind, T.MapType) and isinstance(wider, T.MapType):
        return F.transform_values(value, lambda _, x: widened(x, kind.valueType, wider.valueType))
    if isinstance(kind, NESTED) and isinstance(wider, T.StringType):
        return F.to_json(value)
    return value.cast(wider)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with the columns and types of a schema that holds all of theirs."""
    return df.select(
        *[
            (widened(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def union_evolved(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union all under the merged schema."""
    schema = merge_schemas(first.schema, second.schema)
    return conform(first, schema).unionByName(conform(second, schema))
