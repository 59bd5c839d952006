"""Messages decoded by the schema they were written with.

A frame names its writer's schema by id. A table of writer schemas (``schema_id``, ``schema``: the text of
an Avro-style record) is joined to the messages, and every row image is brought to the reader's fields:
by name, by one of the reader's aliases, or by the reader's default where the writer had no such field.
Fields that the reader does not know stay under their own names. A message whose id is not in the table
is no change yet and goes to quarantine, from where it can be replayed once its schema is known.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streambed.functions import moments, wire
from streambed.operators import changelog

REGISTRY = "schema_id INT, schema STRING"
RECORD = "fields ARRAY<STRUCT<name: STRING>>"
IMAGE = "map<string, variant>"
# Schemas whose names, some hundred bytes each, go to every task.
MOST_BROADCAST = 10_000


@dataclass(frozen=True)
class ReaderField:
    """A field as the reader names it, the names it had before, and its value where a writer lacks it."""

    name: str
    aliases: tuple[str, ...] = ()
    default: Any = None


def registry(spark: SparkSession, schemas: dict[int, str]) -> DataFrame:
    return spark.createDataFrame(list(schemas.items()), REGISTRY)


def resolved(writers: DataFrame, reader: list[ReaderField]) -> DataFrame:
    """Per schema id what each reader field is called there, as ``names`` (null: not there).

    One row per id: of several the schema that comes first as text. A schema that is no record has no row.
    """
    written = F.transform(F.from_json("schema", RECORD)["fields"], lambda f: f["name"])
    called = [
        F.coalesce(*[F.when(F.array_contains("written", name), F.lit(name)) for name in (field.name, *field.aliases)])
        for field in reader
    ]
    return (
        writers.groupBy("schema_id")
        .agg(F.min("schema").alias("schema"))
        .withColumn("written", written)
        .where(F.col("written").isNotNull() & F.col("schema_id").isNotNull())
        .select("schema_id", F.array(*called).alias("names"))
    )


def decode_messages(raw: DataFrame, decode: changelog.Decoder, writers: DataFrame, reader: list[ReaderField]) -> DataFrame:
    """``data`` (the envelope, its images under the reader's names), ``schema_id``, whether the id is
    ``known``, the record time and the untouched value of every live message.

    ``decode`` must give variants, as ``json_envelope`` does. Nearly all messages may carry one id, so they are
    not shuffled by it: a table of up to MOST_BROADCAST schemas (counted) is broadcast; a larger one
    is joined in a way whose hot keys Spark can split.
    """
    messages = changelog.drop_tombstones(raw).withColumn("schema_id", wire.frame_schema_id(F.col("value")))
    known = resolved(writers, reader)
    if writers.count() <= MOST_BROADCAST:
        known = F.broadcast(known)
    joined = messages.join(known, "schema_id", "left")
    parsed = joined.select(
        "schema_id",
        "names",
        decode(wire.frame_payload(F.col("value"))).alias("data"),
        moments.as_timestamp(F.col("timestamp")).alias("timestamp"),
        "value",
    )
    images = [read_image(F.col(f"data.{part}"), F.col("names"), reader).alias(part) for part in ("before", "after")]
    return parsed.select(
        F.struct(*images, "data.source", "data.op", "data.ts_ms").alias("data"),
        "schema_id",
        F.col("names").isNotNull().alias("known"),
        "timestamp",
        "value",
    )


def read_image(image: Column, names: Column, reader: list[ReaderField]) -> Column:
    """A row image under the reader's names, as a variant; null stays null.

    A field that the writer sent as null is null, also where the reader has a default.
    """
    sent = F.try_variant_get(image, "$", IMAGE)
    own = F.array(*[F.lit(field.name) for field in reader])
    nothing = F.lit(None).cast("variant")
    defaults = F.array(*[nothing if f.default is None else F.parse_json(F.lit(json.dumps(f.default))) for f in reader])

    def entry(_, place: Column) -> Column:
        called = names[place]
        value = F.when(called.isNotNull(), F.try_element_at(sent, called)).otherwise(defaults[place])
        return F.struct(own[place].alias("key"), value.alias("value"))

    entries = F.filter(F.transform(own, entry), lambda e: e["value"].isNotNull())
    known = F.array_union(own, F.coalesce(names, F.array().cast("array<string>")))
    others = F.map_entries(F.map_filter(sent, lambda name, _: ~F.coalesce(F.array_contains(known, name), F.lit(False))))
    return F.when(sent.isNotNull(), F.to_variant_object(F.map_from_entries(F.concat(entries, others))))


def to_bronze(raw: DataFrame, decode: changelog.Decoder, writers: DataFrame, reader: list[ReaderField], pk: str = "id") -> DataFrame:
    """Bronze rows of the messages whose schema is known."""
    decoded = decode_messages(raw, decode, writers, reader)
    return changelog.flatten_envelope(decoded.where("known"), pk)


def quarantine(raw: DataFrame, decode: changelog.Decoder, writers: DataFrame, reader: list[ReaderField]) -> DataFrame:
    """The messages of an unknown schema, and those that do not decode to a change, with their bytes."""
    decoded = decode_messages(raw, decode, writers, reader)
    return decoded.where(~F.col("known") | F.col("data.op").isNull()).select("value", "timestamp", "schema_id", "known")
