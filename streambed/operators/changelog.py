"""From raw change messages to the bronze change log, and from snapshots to changes."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed import schemas
from streambed.functions import moments, wire

INSERT_OPS = ("c", "r")
WRITE_OPS = ("c", "r", "u")
DELETE_OP = "d"

Decoder = Callable[[Column], Column]


def json_envelope() -> Decoder:
    """Decode a JSON payload to the envelope; a bad payload gives a struct of nulls.

    Both images and ``source`` are variants: they keep all their fields, declared or not, and numbers up
    to 38 digits as they were sent. They get types in silver only.
    """
    return lambda payload: F.from_json(payload.cast("string"), schemas.ENVELOPE, {"mode": "PERMISSIVE"})


def avro_envelope(schema_json: str) -> Decoder:
    """Decode an Avro payload to structs; needs the spark-avro package on the session."""
    from pyspark.sql.avro.functions import from_avro

    return lambda payload: from_avro(payload, schema_json, {"mode": "PERMISSIVE"})


def drop_tombstones(raw: DataFrame) -> DataFrame:
    """Messages with a value; a null value only tells the broker to compact the key."""
    return raw.where(F.col("value").isNotNull())


def decode_messages(raw: DataFrame, decode: Decoder) -> DataFrame:
    """``data`` (the envelope), the record time and the untouched value of every live message."""
    return drop_tombstones(raw).select(
        decode(wire.frame_payload(F.col("value"))).alias("data"),
        moments.as_timestamp(F.col("timestamp")).alias("timestamp"),
        "value",
    )


def _part(decoded: DataFrame, name: str) -> T.DataType:
    return decoded.schema["data"].dataType[name].dataType


def _text(decoded: DataFrame, name: str) -> Column:
    """A part of the envelope as JSON text; of a variant the fields stand in order of their names."""
    part = F.col(f"data.{name}")
    if isinstance(_part(decoded, name), T.VariantType):
        return F.when(~F.is_variant_null(part), F.to_json(part))
    return F.to_json(part)


def _field(decoded: DataFrame, name: str, field: str, kind: str) -> Column:
    """One field of a part of the envelope, null where it is missing or does not fit."""
    whole = _part(decoded, name)
    if isinstance(whole, T.VariantType):
        return F.try_variant_get(F.col(f"data.{name}"), f"$.{field}", kind)
    return F.col(f"data.{name}")[field].try_cast(kind) if field in whole.names else F.lit(None).cast(kind)


def flatten_envelope(decoded: DataFrame, pk: str = "id") -> DataFrame:
    """Bronze columns of decoded messages, whose images and source are variants or structs: texts, key
    and position come out of the parsed message in one select. Narrow: no shuffle, so it also runs on
    streams."""
    return decoded.select(
        F.coalesce(*[_field(decoded, image, pk, "string") for image in ("after", "before")]).alias("id"),
        *[_text(decoded, part).alias(part) for part in ("before", "after", "source")],
        F.col("data.op").alias("op"),
        F.col("data.ts_ms").alias("ts_ms"),
        _field(decoded, "source", "lsn", "long").alias("seq"),
        *moments.calendar_parts(F.col("timestamp")),
    )


def to_bronze(raw: DataFrame, decode: Decoder) -> DataFrame:
    """Raw messages to bronze rows. Undecodable messages stay, as rows whose op is null; ``quarantine``
    has their bytes."""
    return flatten_envelope(decode_messages(raw, decode))


def quarantine(raw: DataFrame, decode: Decoder) -> DataFrame:
    """The messages that do not decode to a change, with their bytes, for repair and replay."""
    return decode_messages(raw, decode).where(F.col("data.op").isNull()).select("value", "timestamp")


def inserts(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("op").isin(*INSERT_OPS))


def updates(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("op") == "u")


def deletes(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("op") == DELETE_OP)


def union_changes(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union all, columns matched by name."""
    return first.unionByName(second)


def expand_payload(changes: DataFrame, row_schema: T.StructType, image: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The JSON row image as typed columns, after the kept change columns."""
    return changes.select(*keep, F.from_json(image, row_schema).alias("payload")).select(*keep, "payload.*")


def after_or_before() -> Column:
    return F.coalesce(F.col("after"), F.col("before"))


def first_image(changes: DataFrame, order: tuple[str, ...] = ("ts_ms", "seq")) -> DataFrame:
    """One row: the earliest after-image, or the earliest before-image if no row has an after."""
    return (
        changes.where(after_or_before().isNotNull())
        .orderBy(F.col("after").isNull(), *order)
        .limit(1)
        .select(after_or_before().alias("image"))
    )


def variant_type(text: str, void: T.DataType = T.StringType()) -> T.DataType:
    """The type that a variant's schema text names, e.g. ``OBJECT<id: BIGINT, `odd name`: ARRAY<VOID>>``.

    Values of mixed type become strings, and so do those that are always null unless ``void`` says else.
    """
    kind, rest = _variant_type(text, void)
    if rest:
        raise ValueError(f"not a type: {text}")
    return kind


def _variant_type(text: str, void: T.DataType) -> tuple[T.DataType, str]:
    """The type at the text's start, and the text after it."""
    if text.startswith("OBJECT<"):
        fields, rest = [], text[len("OBJECT<") :]
        while not rest.startswith(">"):
            name, rest = _field_name(rest)
            kind, rest = _variant_type(rest, void)
            fields.append(T.StructField(name, kind))
            rest = rest.removeprefix(", ")
        return T.StructType(fields), rest[1:]
    if text.startswith("ARRAY<"):
        kind, rest = _variant_type(text[len("ARRAY<") :], void)
        return T.ArrayType(kind), rest[1:]
    word = re.match(r"\w+(\([^)]*\))?", text)[0]
    named = {"VOID": void, "VARIANT": T.StringType()}
    return named[word] if word in named else T.DataType.fromDDL(word), text[len(word) :]


def _field_name(text: str) -> tuple[str, str]:
    """A field's name, quoted or not, and the text after its colon."""
    match = re.match(r"`((?:[^`]|``)*)`: |([^:]*): ", text)
    return (match[1].replace("``", "`") if match[1] is not None else match[2]), text[match.end() :]


def infer_json_schema(df: DataFrame, column: str) -> T.StructType:
    """Schema of a JSON column, merged over every row; texts that are not JSON are passed over.

    The result is one short string, so reading it on the driver is bounded.
    """
    text = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("schema")).first()["schema"]
    if not text.startswith("OBJECT<"):
        raise ValueError(f"{column} holds no JSON objects")
    return variant_type(text)


def row_image(columns: list[str]) -> Column:
    """A row as JSON text; null fields are left out."""
    return F.to_json(F.struct(*columns))


def snapshot_to_changes(snapshot: DataFrame, pk: str, ts_ms: int) -> DataFrame:
    """An initial snapshot as a change log of `r` rows."""
    return snapshot.select(
        F.col(pk).cast("string").alias("id"),
        F.lit(None).cast("string").alias("before"),
        row_image(snapshot.columns).alias("after"),
        F.lit("r").alias("op"),
        F.lit(ts_ms).cast("long").alias("ts_ms"),
        F.lit(0).cast("long").alias("seq"),
    )


def diff_snapshots(old: DataFrame, new: DataFrame, pk: str, ts_ms: int) -> DataFrame:
    """The c/u/d changes that turn one snapshot into the next.

    The key is unique on both sides, so the full outer join has no hot key.
    """
    columns = new.columns
    before = old.select(F.col(pk).alias("_old_key"), F.struct(*columns).alias("_old"))
    after = new.select(F.col(pk).alias("_new_key"), F.struct(*columns).alias("_new"))
    op = (
        F.when(F.col("_old_key").isNull(), "c")
        .when(F.col("_new_key").isNull(), "d")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "u")
    )
    return (
        before.join(after, F.col("_old_key") == F.col("_new_key"), "full_outer")
        .withColumn("op", op)
        .where(F.col("op").isNotNull())
        .select(
            F.coalesce("_new_key", "_old_key").cast("string").alias("id"),
            F.to_json("_old").alias("before"),
            F.to_json("_new").alias("after"),
            "op",
            F.lit(ts_ms).cast("long").alias("ts_ms"),
            F.lit(0).cast("long").alias("seq"),
        )
    )
