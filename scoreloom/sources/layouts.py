"""The four event layouts in use, brought to one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.model import EVENT


def _location(df: DataFrame) -> Column:
    """Location with every part, missing ones as null; a district is folded into the region when that is absent."""
    have = {f.name for f in df.schema["location"].dataType.fields}

    def part(name: str, kind: str) -> Column:
        return (F.col(f"location.{name}") if name in have else F.lit(None)).cast(kind)

    region = F.coalesce(part("region", "string"), part("district", "string"))
    return F.struct(part("city", "string").alias("city"), region.alias("region"),
                    part("country", "string").alias("country"), part("latitude", "double").alias("latitude"),
                    part("longitude", "double").alias("longitude"))


def from_wire(df: DataFrame) -> DataFrame:
    """snake_case layout with a free payload; also takes the variant with a district."""
    have = set(df.columns)
    cols = []
    for f in EVENT.fields:
        if f.name == "location":
            cols.append(_location(df).alias("location"))
        elif f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def from_record(df: DataFrame) -> DataFrame:
    """Binary-record layout: camelCase, epoch milliseconds, severity, fixed payload record, no country."""
    payload = F.to_json(F.struct("payload.amount", "payload.description", "payload.metadata",
                                 F.col("severity").alias("severity_num")))
    return from_wire(df.select(
        F.col("eventId").alias("event_id"), F.col("subjectId").alias("subject_id"),
        F.lower("eventType").alias("event_type"), F.lower("eventSubtype").alias("event_subtype"),
        F.col("sourceSystem").alias("source_system"), F.timestamp_millis("timestamp").alias("timestamp"), "location",
        "confidence", payload.alias("payload")))


def from_typed(df: DataFrame) -> DataFrame:
    """Typed layout: demographics on the event and no payload; they move into the payload."""
    payload = F.to_json(F.struct("age_group", "gender"))
    return from_wire(df.withColumn("payload", payload).drop("age_group", "gender"))


def unify(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def decode_record(df: DataFrame, column: str, schema_json: str) -> DataFrame:
    """Binary records to columns, where Spark's external Avro package is on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return from_record(df.select(from_avro(F.col(column), schema_json).alias("r")).select("r.*"))
