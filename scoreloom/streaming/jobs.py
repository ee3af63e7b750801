"""Streaming jobs.

Two forms of the running score are offered:

* :func:`running_score_stream` keeps one number per subject in Spark's state store and emits at once. A subject's
  rows of one micro-batch are held together, so the trigger's size limit bounds memory.
* :class:`ScoringJob` runs the batch operators on each micro-batch and keeps scores in a small change log. It splits
  a hot subject over tasks, spreads changes to neighbours, and feeds several sinks from one scored batch.

Both order events inside a micro-batch by (ts, event_id). An event that arrives in a later micro-batch than its
time would ask for is scored on arrival; it is not put back in time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from scoreloom.functions.bands import config_tier
from scoreloom.functions.numeric import GRID
from scoreloom.model import Rule, ScoreConfig
from scoreloom.operators import archive
from scoreloom.operators.constraints import split_valid
from scoreloom.operators.kernels import stream_fold
from scoreloom.operators.measures import flatten
from scoreloom.operators.propagate import neighbour_deltas, score_with_neighbours
from scoreloom.operators.rules import apply_rules
from scoreloom.operators.scoring import (error_rows_to_zero, latest_state, processing_id, rules_in_force, running_score,
                                         running_score_with_decay, score_events, with_profile)
from scoreloom.session import lasting_tables, remove, scratch_tables
from scoreloom.sources.wire import decode
from scoreloom.streaming.cooldown import regrouped, with_accepted

Sink = Callable[[DataFrame, int], None]


def events_from_lines(lines: DataFrame, dedup_within: str | None = None) -> DataFrame:
    """Decoded, valid, flat events of a line stream; optionally each event id once within a time span."""
    good, _ = decode(lines)
    valid, _ = split_valid(good)
    flat = flatten(valid)
    if dedup_within:
        flat = flat.withWatermark("ts", dedup_within).dropDuplicatesWithinWatermark(["event_id"])
    return flat


def running_score_stream(events: DataFrame, profiles: DataFrame, rules: Sequence[Rule],
                         config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Processed events as a stream, with the score in the state store."""
    scored = apply_rules(with_profile(events, profiles, config), rules)
    rows = scored.select("subject_id", "event_id", "ts", "score_change", "opening_score")
    types = {f.name: f.dataType for f in rows.schema.fields}
    out = T.StructType([T.StructField(c, types[c]) for c in ("subject_id", "event_id", "ts", "score_change")]
                       + [T.StructField(c, T.DoubleType()) for c in ("previous_score", "new_score")])
    return rows.groupBy("subject_id").applyInPandasWithState(
        stream_fold(config.low, config.high, config.baseline, GRID), out, "score double, events bigint", "append",
        GroupStateTimeout.NoTimeout)


def hourly_activity_stream(events: DataFrame, late_by: str = "10 minutes", width: str = "1 hour",
                           slide: str | None = None) -> DataFrame:
    """Activity per subject, region and window; rows later than the watermark are dropped and counted by Spark."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return (events.withWatermark("ts", late_by).groupBy("subject_id", "region", window.alias("w"))
            .agg(F.count("*").alias("event_count"), F.size(F.collect_set("event_type")).alias("unique_event_types"),
                 F.sum("confidence").alias("confidence_sum"))
            .select("subject_id", "region", F.col("w.start").alias("window_start"), "event_count",
                    "unique_event_types", "confidence_sum"))


def daily_from_hourly_stream(scored: DataFrame, late_by: str = "10 minutes") -> DataFrame:
    """Hours and then days per subject in one stream: the closed hours of the first aggregate feed the second.

    For append mode: a day comes once, when the watermark has passed its end. State is a row per open subject and hour, and one per
    open subject and day.
    """
    hours = (scored.withWatermark("ts", late_by).groupBy("subject_id", F.window("ts", "1 hour").alias("hour"))
             .agg(F.count("*").alias("event_count"), F.sum("score_change").alias("net_score_impact")))
    return (hours.groupBy("subject_id", F.window(F.window_time("hour"), "1 day").alias("w"))
            .agg(F.sum("event_count").alias("event_count"), F.sum("net_score_impact").alias("net_score_impact"),
                 F.count("*").alias("active_hours"), F.max("event_count").alias("busiest_hour"))
            .select("subject_id", F.to_date("w.start").alias("day"), "event_count", "net_score_impact", "active_hours", "busiest_hour"))


@dataclass
class LateSplit:
    """Parts the rows of each micro-batch at the watermark: those behind it are kept in a table of their own, with their delay.

    The watermark of a batch is the latest time in all batches before it, less ``late_by``, as Spark defines it; it is stored per batch, so a
    repeated batch is parted alike and replaces itself. A batch is written once, and its latest time comes from that write. Rows
    without a time are never late. For ``foreachBatch``.
    """

    spark: SparkSession
    path: str
    late_by: str = "10 minutes"
    time: str = "ts"

    def _latest(self, before: int) -> int | None:
        """Latest time, in microseconds, of all batches numbered below ``before``."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/latest")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return None
        marks = [s.getPath().getName().split("=") for s in fs.listStatus(root)]
        known = [(int(batch), int(at)) for batch, at in marks if int(batch) < before]
        return max(known)[1] if known else None

    def _mark(self, batch_id: int, latest: int) -> None:
        """An empty file that names the batch and the latest time so far; only the last two batches can be asked for again."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/latest")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(root) if fs.exists(root) else ():
            batch = int(status.getPath().getName().split("=")[0])
            if batch < batch_id - 2 or batch == batch_id:
                fs.delete(status.getPath(), False)
        fs.create(jvm.org.apache.hadoop.fs.Path(root, f"{batch_id:010d}={latest}"), True).close()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        latest = self._latest(batch_id)
        at = F.unix_micros(F.col(self.time).cast("timestamp"))
        allowed = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {self.late_by})")
        delay = (F.lit(latest).cast("bigint") - allowed) - at
        late = F.coalesce(delay >= 0, F.lit(False))
        seen = Observation()
        rows = batch.withColumns({"late": late, "delay_us": F.when(late, delay)}).observe(seen, F.max(at).alias("latest"))
        rows.write.mode("overwrite").partitionBy("late").parquet(f"{self.path}/rows/batch={batch_id:010d}")
        known = [t for t in (latest, seen.get["latest"]) if t is not None]
        if known:
            self._mark(batch_id, max(known))

    def rows(self) -> DataFrame:
        """All rows so far, with ``late`` (boolean) and ``delay_us``; a filter on ``late`` reads one side's files alone."""
        return self.spark.read.parquet(f"{self.path}/rows").drop("batch").withColumn("late", F.col("late").cast("boolean"))


@dataclass
class SinkLedger:
    """Which sinks have finished which micro-batch: an empty file each. A batch that is repeated after a crash goes only to the sinks it
    had not finished, so a sink that appends is not written twice unless the crash fell between its write and the mark."""

    spark: SparkSession
    path: str

    def _file(self, batch_id: int, sink: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={batch_id:010d}/{sink}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def finished(self, batch_id: int, sink: str) -> bool:
        fs, path = self._file(batch_id, sink)
        return fs.exists(path)

    def mark(self, batch_id: int, sink: str) -> None:
        fs, path = self._file(batch_id, sink)
        fs.create(path, True).close()

    def forget(self, before: int) -> None:
        """Marks of batches that are committed and can't be repeated."""
        fs, path = self._file(before - 1, "")
        if before > 0:
            fs.delete(path, True)


def fan_out(sinks: Mapping[str, Sink], ledger: SinkLedger | None = None, keep: bool = True) -> Callable[[DataFrame, int], None]:
    """One micro-batch to several sinks: computed once, written n times. For ``foreachBatch``.

    A batch that is a written table needs no ``keep``: each sink then reads the columns it wants, where a kept batch has all of them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        open_ = {name: sink for name, sink in sinks.items() if ledger is None or not ledger.finished(batch_id, name)}
        if not open_:
            return
        kept = batch.persist() if keep else batch
        try:
            for name, sink in open_.items():
                with lasting_tables():
                    sink(kept, batch_id)
                if ledger:
                    ledger.mark(batch_id, name)
        finally:
            if keep:
                kept.unpersist()

    return write


def replace_batch(path: str) -> Sink:
    """Sink that writes a micro-batch to its own folder, so that a repeated batch replaces itself."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id:010d}")

    return write


@dataclass
class ScoreLog:
    """Current scores as a base table plus one small table of changed subjects per micro-batch.

    A batch reads only versions before its own number and overwrites its own, so a repeated batch gives the same
    result. Every ``compact_every`` batches the log is folded into a new base, and versions that the base before it covers are removed: a
    batch that is repeated reads the base before at most.
    """

    spark: SparkSession
    path: str
    compact_every: int = 50

    _schema = "subject_id {0}, score double, last_score_at timestamp, version bigint"

    def _versions(self, kind: str) -> list[int]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        out = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("v=") and fs.exists(done):
                out.append(int(name[2:]))
        return sorted(out)

    def _path(self, kind: str, version: int) -> str:
        return f"{self.path}/{kind}/v={version:010d}"

    def scores(self, before: int, id_type: str, subjects: DataFrame | None = None) -> DataFrame | None:
        """Latest score per subject (of ``subjects``) from all batches numbered below ``before``."""
        bases = [v for v in self._versions("base") if v < before]
        start = bases[-1] if bases else -1
        parts = [self._path("base", start)] if bases else []
        parts += [self._path("change", v) for v in self._versions("change") if start < v < before]
        if not parts:
            return None
        rows = self.spark.read.schema(self._schema.format(id_type)).parquet(*parts)
        if subjects is not None:
            rows = rows.join(subjects, "subject_id", "left_semi")
        return (rows.groupBy("subject_id").agg(F.max_by(F.struct("score", "last_score_at", "version"), "version")
                                               .alias("s")).select("subject_id", "s.*"))

    def write(self, changed: DataFrame, version: int) -> None:
        id_type = changed.schema["subject_id"].dataType.simpleString()
        rows = changed.select("subject_id", "score", "last_score_at", F.lit(version).cast("bigint").alias("version"))
        rows.write.mode("overwrite").parquet(self._path("change", version))
        if version and version % self.compact_every == 0:
            self.scores(version + 1, id_type).write.mode("overwrite").parquet(self._path("base", version))
            for covered in self._versions("base")[-2:-1]:
                for kind, last in (("base", covered - 1), ("change", covered)):
                    for v in self._versions(kind):
                        if v <= last:
                            remove(self.spark, self._path(kind, v))


@dataclass
class ScoringJob:
    """Scores each micro-batch with the batch operators and feeds the sinks.

    ``cooldown`` is how late an event may come, as a text like "10 minutes": it turns on the rules' limits per subject and period, which are
    kept as stream state before the micro-batch is scored. ``late`` is that of :func:`score_events`.
    """

    spark: SparkSession
    profiles: DataFrame
    rules: Sequence[Rule]
    path: str
    edges: DataFrame | None = None
    config: ScoreConfig = ScoreConfig()
    sinks: dict[str, Sink] = field(default_factory=dict)
    chunks: int | None = None
    cooldown: str | None = None
    late: Callable[[DataFrame], DataFrame] | None = None

    def __post_init__(self) -> None:
        self.log = ScoreLog(self.spark, f"{self.path}/scores")
        self.ledger = SinkLedger(self.spark, f"{self.path}/ledger")

    def current_profiles(self, before: int, subjects: DataFrame | None = None) -> DataFrame:
        """Profiles with the scores of all batches before; only those of ``subjects`` (subject_id) if given."""
        id_type = self.profiles.schema["subject_id"].dataType.simpleString()
        scores = self.log.scores(before, id_type, subjects)
        people = self.profiles if subjects is None else self.profiles.join(subjects, "subject_id", "left_semi")
        if scores is None:
            return people
        new = scores.select("subject_id", F.col("score").alias("new_score"), F.col("last_score_at").alias("new_at"))
        joined = people.join(new, "subject_id", "full_outer")
        at = F.coalesce("new_at", "last_score_at") if "last_score_at" in self.profiles.columns else F.col("new_at")
        return joined.withColumns({"score": F.coalesce("new_score", "score"), "last_score_at": at}).drop("new_score", "new_at")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: score it, feed the sinks, and write the changed scores. Its intermediate tables go at the end."""
        with scratch_tables(self.spark):
            self._process(batch, batch_id)
        self.ledger.forget(batch_id)

    def _touched(self, batch: DataFrame) -> DataFrame:
        """Subjects of a batch, and those its changes can spread to."""
        own = batch.filter("subject_id is not null").select("subject_id").distinct()
        if self.edges is None:
            return own
        near = self.edges.join(own.withColumnRenamed("subject_id", "src"), "src", "left_semi").select(F.col("dst").alias("subject_id"))
        return own.union(near).distinct()

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        people = self.current_profiles(batch_id, self._touched(batch))
        if self.late and self.edges is not None and not self.cooldown:
            batch = self.late(batch)
        if self.edges is None:
            if self.cooldown:
                fold = running_score_with_decay if self.config.decay.enabled else running_score
                done = fold(self.spark, self._scored(batch, people), self.config, ["ts", "event_id"], self.chunks)
                pe = error_rows_to_zero(done).withColumn("processing_id", processing_id())
            else:
                pe = score_events(self.spark, batch, people, self.rules, self.config, chunks=self.chunks, late=self.late)
            changed = latest_state(pe, self.config).select("subject_id", "score", "last_score_at")
            fan_out(self.sinks, self.ledger, keep=False)(pe, batch_id)
            self.log.write(changed, batch_id)
            return
        scored = self._scored(batch, people).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            secondary = neighbour_deltas(scored, self.edges)
            every = score_with_neighbours(self.spark, scored, secondary, people, self.config, self.chunks)
        finally:
            scored.unpersist()  # the running score is a written table by now
        primary = every.filter("hop = 0").drop("hop", "rel", "origin_subject_id")
        fan_out(self.sinks, self.ledger, keep=False)(error_rows_to_zero(primary).withColumn("processing_id", processing_id()), batch_id)
        changed = (every.filter("hop = 1 or rule_seen").groupBy("subject_id")
                   .agg(F.max_by("new_score", "scan_order").alias("score"), F.max("ts").alias("last_score_at")))
        self.log.write(changed, batch_id)

    def _scored(self, batch: DataFrame, people: DataFrame) -> DataFrame:
        """Events of a micro-batch with their change and the score they start from."""
        if not self.cooldown:
            return apply_rules(with_profile(batch, people, self.config), self.rules)
        # The rules were applied in the stream, with the profiles' types; scores come from the log.
        known = regrouped(batch).drop("subject_type", "opening_score", "processing_error", "last_score_at")
        return with_profile(known, people, self.config)

    def start(self, events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        if self.cooldown:
            rules = rules_in_force(self.spark, self.rules, self.config)
            events = self.late(events) if self.late else events
            scored = apply_rules(with_profile(events, self.profiles, self.config), rules)
            events = with_accepted(self.spark, scored, rules, self.cooldown)
        return (events.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())

    def final_profiles(self) -> DataFrame:
        people = self.current_profiles(2**62)
        return people.withColumn("tier", config_tier(F.col("score"), self.config))


def archive_sink(spark: SparkSession, path: str) -> Sink:
    return lambda df, _: archive.write_archive(spark, df, path)


PROGRESS = ("query string, run string, batch_id bigint, timestamp string, rows_in bigint, rows_per_sec double, rows_late bigint, "
            "duration_ms bigint, observed map<string,string>")


class ProgressLog(StreamingQueryListener):
    """Appends what each micro-batch reports to a table, one small file per batch (A18), however many batches a query has.

    ``spark.streams.addListener(log)`` starts it for all queries of the session; metrics of ``DataFrame.observe`` in a query come along.
    A batch that is repeated replaces its report.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {f"{name}.{k}": str(v) for name, row in p.observedMetrics.items() for k, v in row.asDict().items()}
        doc = {"query": str(p.id), "run": str(p.runId), "batch_id": p.batchId, "timestamp": p.timestamp, "rows_in": p.numInputRows,
               "rows_per_sec": p.processedRowsPerSecond, "rows_late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               "duration_ms": p.durationMs.get("triggerExecution", 0), "observed": observed}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p.id}-{p.batchId:010d}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(json.dumps(doc).encode()))
        finally:
            out.close()

    def rows(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).json(self.path)


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame | None:
    """What the query reports about itself, one row per micro-batch (A18). The report keeps the last 100 at most; :class:`ProgressLog` keeps all."""
    rows = [(p["batchId"], p["timestamp"], int(p["numInputRows"]), float(p.get("processedRowsPerSecond") or 0.0),
             int(sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))),
             int(p.get("durationMs", {}).get("triggerExecution", 0))) for p in query.recentProgress]
    if not rows:
        return None
    return spark.createDataFrame(rows, "batch_id bigint, timestamp string, rows_in bigint, rows_per_sec double, "
                                       "rows_late bigint, duration_ms bigint")
