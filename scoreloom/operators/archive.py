"""Archive, profile upsert, retention and restore.

Files are only ever added or replaced by partition; readers always see whole versions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from scoreloom.functions.bands import config_tier
from scoreloom.model import ScoreConfig
from scoreloom.session import new_table_path

ARCHIVE_COLUMNS = ("subject_id", "ts", "event_id", "event_type", "event_subtype", "source_system", "city", "region",
                   "country", "confidence", "score_change", "new_score", "previous_score", "applied_rules")
ARCHIVE_KEY = ("subject_id", "ts", "event_id")

# Which dataset a backup type goes to, and how long each kind of table is kept (days).
TARGETS = {
    "processed_events": "stream-backups", "metrics": "stream-backups", "user_profiles": "stream-backups",
    "system_state": "stream-backups", "mongodb": "mongodb-backups", "influxdb": "influxdb-backups",
    "scylladb": "scylladb-backups", "dgraph": "dgraph-backups", "redpanda": "redpanda-backups",
}
RETENTION_DAYS = {"raw": 90, "derived": 365, "archive": 1825, "aggregates": 3650, "backups": 30}


def latest_per_key(rows: DataFrame, version: str = "processed_at") -> DataFrame:
    """Same key overwrites: the row with the latest version stays. Combines partially before the shuffle."""
    kept = [c for c in rows.columns if c not in ARCHIVE_KEY]
    return (rows.groupBy(*ARCHIVE_KEY).agg(F.max_by(F.struct(*kept), F.col(version)).alias("r"))
            .select(*ARCHIVE_KEY, "r.*"))


def archive_rows(pe: DataFrame, version: str = "processed_at") -> DataFrame:
    cols = [*ARCHIVE_COLUMNS, *([version] if version not in ARCHIVE_COLUMNS else [])]
    return latest_per_key(pe.select(*cols), version).withColumn("date", F.to_date("ts"))


def write_archive(spark: SparkSession, pe: DataFrame, path: str, version: str = "processed_at",
                  files: dict[str, str] | None = None) -> None:
    """Add processed events to the date-partitioned archive; rows with a known key are replaced.

    Only the dates in the batch are read back and rewritten. Inside a date, files are cut by subject range and
    sorted newest first, so a subject's recent events are in few row groups and one hot date is many tasks. Event ids lie
    anywhere, so row groups have bloom filters on them. ``files`` are further options of the files.
    """
    new = _batch_rows(spark, pe, version)
    dates = [r["date"] for r in new.select("date").distinct().collect()]
    if not dates:
        return
    if _exists(spark, path):
        # The files being replaced are also read; a dynamic overwrite replaces them when all new ones are whole.
        new = spark.read.parquet(path).filter(F.col("date").isin(dates)).select(*new.columns).unionByName(new)
    (_laid_out(new, version).write.mode("overwrite").options(**_bloom("event_id")).options(**files or {})
     .option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))


def _batch_rows(spark: SparkSession, pe: DataFrame, version: str) -> DataFrame:
    """The batch's rows, written: it is worked out once, and its dates, its range limits and its rows are read from there."""
    cols = [*ARCHIVE_COLUMNS, *([version] if version not in ARCHIVE_COLUMNS else [])]
    rows = pe.select(*cols).withColumn("date", F.to_date("ts"))
    staged = new_table_path(spark, "archive-batch")
    rows.write.option("compression", "zstd").parquet(staged)
    return spark.read.schema(rows.schema).parquet(staged)


def _laid_out(rows: DataFrame, version: str) -> DataFrame:
    """The latest row per key, cut and sorted as the files are. The date follows from the time, so all rows of a key are in one range
    and one shuffle does for both."""
    kept = [c for c in rows.columns if c not in (*ARCHIVE_KEY, "date")]
    latest = (rows.repartitionByRange("date", "subject_id", "ts").groupBy("date", *ARCHIVE_KEY)
              .agg(F.max_by(F.struct(*kept), F.col(version)).alias("r")).select(*ARCHIVE_KEY, "r.*", "date"))
    return latest.sortWithinPartitions("date", "subject_id", F.col("ts").desc(), "event_id")


def _bloom(column: str) -> dict[str, str]:
    """Parquet bloom filters on a column, each row group's sized by the values it really has."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true",
            "parquet.bloom.filter.max.bytes": str(2 << 20)}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def upsert_profiles(profiles: DataFrame, updates: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Profiles with score, tier and times replaced where the updates have a subject.

    ``updates`` has one row per subject (see ``latest_state``); profiles without an update stay as they are, and an
    update without a profile is not turned into one.
    """
    new = updates.select("subject_id", F.col("score").alias("u_score"), F.col("last_score_at").alias("u_at"))
    joined = profiles.join(new, "subject_id", "left")
    hit = F.col("u_score").isNotNull()
    changed = {"score": F.coalesce("u_score", "score"),
               "tier": F.when(hit, config_tier(F.col("u_score"), config)).otherwise(
                   F.col("tier") if "tier" in profiles.columns else config_tier(F.col("score"), config))}
    for name in ("last_updated", "last_score_at"):
        old = F.col(name) if name in profiles.columns else F.lit(None).cast("timestamp")
        changed[name] = F.coalesce("u_at", old)
    return joined.withColumns(changed).drop("u_score", "u_at")


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Write a table as a new numbered version; readers take the highest complete one."""
    path = f"{root}/v={version:010d}"
    df.write.mode("overwrite").parquet(path)
    return path


def target_dataset(data_type: Column, default: str = "stream-backups") -> Column:
    """Dataset a backup type is routed to."""
    table = F.create_map(*[F.lit(x) for pair in TARGETS.items() for x in pair])
    return F.coalesce(F.element_at(table, data_type), F.lit(default))


def backup_rows(rows: DataFrame, data_type: str, source: str, reason: str, at: Column | None = None) -> DataFrame:
    """Rows as backup records: one JSON text per row plus the columns it is partitioned by."""
    at = F.current_timestamp() if at is None else at
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}  # the default keeps milliseconds only
    return (rows.select(F.to_json(F.struct(*rows.columns), exact).alias("data"), at.alias("timestamp"))
            .withColumns({"data_type": F.lit(data_type), "source": F.lit(source), "backup_reason": F.lit(reason),
                          "year": F.date_format("timestamp", "yyyy"), "month": F.date_format("timestamp", "MM"),
                          "day": F.date_format("timestamp", "dd"), "hour": F.date_format("timestamp", "HH")}))


def write_backup(records: DataFrame, root: str) -> None:
    records.write.mode("append").partitionBy("data_type", "year", "month", "day", "hour").json(root)


BACKUP_SCHEMA = T.StructType([
    T.StructField("data", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("source", T.StringType()), T.StructField("backup_reason", T.StringType()),
    T.StructField("data_type", T.StringType()), T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()), T.StructField("day", T.StringType()),
    T.StructField("hour", T.StringType())])


def _backups(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(BACKUP_SCHEMA).json(root)


def list_backups(spark: SparkSession, root: str, data_type: str, limit: int | None = None) -> DataFrame:
    """Paths of a type's backup files in order (A14); the type is a partition, so others are not listed."""
    paths = (_backups(spark, root).filter(F.col("data_type") == data_type)
             .select(F.col("_metadata.file_path").alias("path")).distinct().orderBy("path"))
    return paths.limit(limit) if limit else paths


def restore_backup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a backup, from the engine's own files."""
    rows = spark.read.schema(T.StructType([T.StructField("data", T.StringType())])).json(path)
    return rows.select(F.from_json("data", schema).alias("d")).select("d.*")


def restore_envelope(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """Rows of a one-document backup: an object whose ``data`` is an array."""
    schema = T.StructType([
        T.StructField("timestamp", T.TimestampType()), T.StructField("data_type", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("data", T.ArrayType(row)),
        T.StructField("event_count", T.LongType()), T.StructField("backup_reason", T.StringType())])
    return (spark.read.schema(schema).option("multiLine", "true").json(path)
            .select("data_type", "source", F.explode("data").alias("d")).select("data_type", "source", "d.*"))


def backup_counts(spark: SparkSession, root: str) -> DataFrame:
    """Backup files per type."""
    return (_backups(spark, root).groupBy("data_type")
            .agg(F.count_distinct(F.col("_metadata.file_path")).alias("files"), F.count("*").alias("rows")))


def split_by_age(df: DataFrame, column: str, days: int, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Kept and removed rows around a cut-off (A16, A19). On a partition column both prune to whole folders."""
    cut = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp")
    col = F.col(column).cast("timestamp")
    return df.filter(col >= cut), df.filter(col < cut)


def retain(df: DataFrame, column: str, kind: str, as_of: dt.datetime) -> DataFrame:
    return split_by_age(df, column, RETENTION_DAYS[kind], as_of)[0]


def old_backups(spark: SparkSession, root: str, days: int, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Backup files to keep and to remove, by modification time."""
    files = (_backups(spark, root).select("data_type", F.col("_metadata.file_path").alias("path"),
                                          F.col("_metadata.file_modification_time").alias("modified")).distinct())
    return split_by_age(files, "modified", days, as_of)


def find_event(archive: DataFrame, event_id: object) -> DataFrame:
    """One event by its id (A21). On the archive the scan skips each row group whose bloom filter does not know the id; the id must
    have the column's type, as a cast of the column would keep the condition from the scan."""
    return archive.filter(F.col("event_id") == F.lit(event_id))


def write_event_lookup(spark: SparkSession, archive: DataFrame, table: str, buckets: int) -> None:
    """A table bucketed by event id, so that a lookup reads one bucket and joins on the id do not shuffle."""
    (archive.select("event_id", "subject_id", F.date_format("ts", "yyyyMM").cast("int").alias("year_month"), "ts")
     .write.mode("overwrite").bucketBy(buckets, "event_id").sortBy("event_id").saveAsTable(table))


def point_query(df: DataFrame, subject: object, since: dt.datetime, until: dt.datetime) -> DataFrame:
    """A subject's rows in a time range (C6); on the archive both limits prune dates and row groups."""
    out = df.filter((F.col("subject_id") == F.lit(subject)) & (F.col("ts") >= F.lit(since).cast("timestamp"))
                    & (F.col("ts") < F.lit(until).cast("timestamp")))
    if "date" in df.columns:
        out = out.filter((F.col("date") >= F.lit(since.date())) & (F.col("date") <= F.lit(until.date())))
    return out


def recent_events(df: DataFrame, subject: object, since: dt.datetime, until: dt.datetime, n: int | None = None) -> DataFrame:
    """Newest first (L1, L2); with a limit Spark keeps only the top rows of each task."""
    rows = point_query(df, subject, since, until).orderBy(F.col("ts").desc(), "event_id")
    return rows.limit(n) if n else rows


def add_subjects(base: DataFrame, new: DataFrame) -> DataFrame:
    """Base subjects plus new ones; a known subject keeps its base row."""
    ranked = base.withColumn("rank", F.lit(0)).unionByName(new.withColumn("rank", F.lit(1)), allowMissingColumns=True)
    first = F.row_number().over(W.partitionBy("subject_id").orderBy("rank"))
    return ranked.withColumn("first", first).filter("first = 1").drop("first", "rank")
