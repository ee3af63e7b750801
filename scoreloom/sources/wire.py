"""Event sources: JSON text from files or a topic, decoded and checked (A1-A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.model import EVENT

_CORRUPT = "_corrupt"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the file each came from."""
    return (spark.read.text(path)
            .select("value", F.col("_metadata.file_path").alias("source_path"),
                    F.col("_metadata.file_modification_time").alias("source_time")))


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same as a stream: new files in a folder, oldest first."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger)
            .option("latestFirst", "false").load(path)
            .select("value", F.col("_metadata.file_path").alias("source_path"),
                    F.col("_metadata.file_modification_time").alias("source_time")))


def stream_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """The same from a broker topic, from the earliest offset. Needs the Kafka connector on the class path."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("value").cast("string").alias("value"), F.col("key").cast("string").alias("topic_key"),
        F.col("partition").alias("topic_partition"), F.col("offset").alias("topic_offset"),
        F.col("timestamp").alias("source_time"))


def with_positions(rows: DataFrame) -> DataFrame:
    """Rows of a file source with a partition and an offset, as a topic has them: the file, and the row's number in it (A4)."""
    return rows.withColumns({"source_partition": F.col("_metadata.file_path"), "source_offset": F.col("_metadata.row_index")})


def position_report(seen: DataFrame, source: DataFrame) -> DataFrame:
    """Per partition of ``source``: its rows, and how many of their positions ``seen`` lacks and has too often.

    Both need source_partition and source_offset. Counts per position are made where the rows are and shuffled as one row each.
    """
    position = ["source_partition", "source_offset"]
    both = source.select(*position, F.lit(1).alias("there"), F.lit(0).alias("here")).unionAll(
        seen.select(*position, F.lit(0), F.lit(1)))
    counts = both.groupBy(*position).agg(F.sum("there").alias("there"), F.sum("here").alias("here"))
    return counts.groupBy("source_partition").agg(
        F.sum("there").alias("rows"), F.count_if((F.col("there") > 0) & (F.col("here") == 0)).alias("missing"),
        F.count_if(F.col("here") > 1).alias("repeated"), F.count_if(F.col("there") == 0).alias("unknown"))


def decode(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded events, and the lines that are not JSON of the event layout.

    The payload keeps its JSON text. Source columns (path, partition, offset, time) stay next to each event.
    """
    schema = T.StructType([*EVENT.fields, T.StructField(_CORRUPT, T.StringType())])
    doc = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    parsed = lines.withColumn("event", doc)
    bad = F.col("event").isNull() | F.col(f"event.{_CORRUPT}").isNotNull()
    source = [c for c in lines.columns if c != "value"]
    good = parsed.filter(~bad).select(*[F.col(f"event.{f.name}").alias(f.name) for f in EVENT.fields], *source)
    return good, parsed.filter(bad).select("value", *source)
