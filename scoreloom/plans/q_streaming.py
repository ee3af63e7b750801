"""Streaming queries over the event table, run to the end of the input (A1, T1, G2, 2.10)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from scoreloom.functions.numeric import on_grid
from scoreloom.model import ALL_RULES
from scoreloom.operators.rules import apply_rules
from scoreloom.operators.scoring import with_profile
from scoreloom.plans.q_state import COOLDOWN_RULES
from scoreloom.plans.registry import ORACLES, query
from scoreloom.plans.sqlbase import dstr, r6, sql, tier5, tstr
from scoreloom.plans.tables import CONFIG, edges, profiles
from scoreloom.session import new_table_path
from scoreloom.sources import star
from scoreloom.streaming.cooldown import regrouped, with_accepted
from scoreloom.streaming.jobs import (LateSplit, ProgressLog, ScoringJob, daily_from_hourly_stream, fan_out, hourly_activity_stream,
                                      replace_batch, running_score_stream)


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """The event table as a stream. A stream reads folders: a table that is one file is copied to a folder first."""
    path, schema = f"{d}/events.parquet", star.SCHEMAS["events"]
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        path = new_table_path(spark, "stream-input")
        spark.read.schema(schema).parquet(f"{d}/events.parquet").write.parquet(path)
    return star.map_events(spark, d, spark.readStream.schema(schema).parquet(path))


def _in_steps(spark: SparkSession, d: str, steps: int, start: Callable[[DataFrame], StreamingQuery], held_back: Column | None = None,
              mapping: Callable[[SparkSession, str, DataFrame], DataFrame] = star.map_events) -> None:
    """The event table as a stream that grows: in time order, ``steps`` times files are added and ``start``'s query runs to the end.
    Rows that are held back come one step later."""
    schema, path = star.SCHEMAS["events"], new_table_path(spark, "stream-input")
    rows = spark.read.schema(schema).parquet(f"{d}/events.parquet")
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()

    def within(k: int) -> Column:
        since, until = (F.lit(low + (high - low) * (k + i) / steps).cast("timestamp_ntz") for i in (0, 1))
        return (F.col("ts") >= since) & ((F.col("ts") < until) if k + 1 < steps else F.lit(True))

    for k in range(steps):
        wanted = within(k)
        if held_back is not None:
            on_time = wanted & ~held_back if k + 1 < steps else wanted
            wanted = on_time | (within(k - 1) & held_back) if k else on_time
        rows.filter(wanted).write.mode("append").parquet(path)
        start(mapping(spark, d, spark.readStream.schema(schema).parquet(path))).awaitTermination()


@query("t04_stream_cooldown", ORACLES["t04_cooldown"])
def _(spark, d):
    """Limits per subject and period as stream state, over four micro-batches and as many restarts."""
    path, check = new_table_path(spark, "stream-cooldown"), new_table_path(spark, "stream-check")

    def start(events: DataFrame) -> StreamingQuery:
        scored = apply_rules(with_profile(events, profiles(spark, d)), COOLDOWN_RULES)
        write = replace_batch(path)
        # Regrouping reads the micro-batch twice: fan_out keeps it, so the stateful step runs once.
        sink = fan_out({"changes": lambda batch, n: write(
            regrouped(batch).select("event_id", "subject_id", "applied_rules", "score_change"), n)})
        return (with_accepted(spark, scored, COOLDOWN_RULES).writeStream.foreachBatch(sink)
                .option("checkpointLocation", check).trigger(availableNow=True).start())

    _in_steps(spark, d, 4, start)
    return spark.read.parquet(path).drop("batch")


@query("a11_fan_out", sql("pe", """SELECT event_id, previous_score, new_score, sink FROM pe, (VALUES ('points'), ('second')) AS s(sink)"""))
def _(spark, d):
    """Two sinks that append; the second fails once, after the first has written. The repeated batch goes to the second one alone."""
    path, check = new_table_path(spark, "stream-fan-out"), new_table_path(spark, "stream-check")
    failed = []

    def append(name: str):
        def write(df: DataFrame, batch_id: int) -> None:
            if name == "second" and batch_id == 1 and not failed:
                failed.append(batch_id)
                raise RuntimeError("sink is down")
            df.select("event_id", "previous_score", "new_score", F.lit(name).alias("sink")).write.mode("append").parquet(path)

        return write

    job = ScoringJob(spark, profiles(spark, d), ALL_RULES, new_table_path(spark, "stream-job"), config=CONFIG,
                     sinks={n: append(n) for n in ("points", "second")}, late=star.with_details)

    def start(events: DataFrame) -> StreamingQuery:
        run = job.start(events, check)
        try:
            run.awaitTermination()
        except StreamingQueryException:
            run = job.start(events, check)
        return run

    _in_steps(spark, d, 3, start, mapping=star.base_events)
    return spark.read.parquet(path)


@query("a18_progress", sql("ev", """SELECT event_type, count(*) AS rows, 4 AS batches, (SELECT count(*) FROM ev) AS rows_in FROM ev GROUP BY 1"""))
def _(spark, d):
    """What a query reports on its micro-batches: rows read, and by ``observe`` the rows of each type."""
    log = ProgressLog(spark, new_table_path(spark, "progress"))
    check = new_table_path(spark, "stream-check")
    kinds = [r[0] for r in star.events(spark, d).select("event_type").distinct().collect()]
    spark.streams.addListener(log)
    try:
        _in_steps(spark, d, 4, lambda events: (
            events.observe("kinds", *[F.count_if(F.col("event_type") == k).alias(k) for k in kinds]).writeStream.format("noop")
            .option("checkpointLocation", check).trigger(availableNow=True).start()))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    rows = log.rows().filter("rows_in > 0")
    batches, rows_in = rows.agg(F.count("*"), F.sum("rows_in")).first()
    return (rows.select(F.explode("observed").alias("name", "n")).groupBy(F.substring_index("name", ".", -1).alias("event_type"))
            .agg(F.sum(F.col("n").cast("bigint")).alias("rows"))
            .withColumns({"batches": F.lit(batches), "rows_in": F.lit(rows_in)}))


@query("s01_stream_scores", sql("pe", "SELECT event_id, subject_id, score_change, previous_score, new_score FROM pe"))
def _(spark, d):
    """Running score in the state store."""
    out = running_score_stream(_stream(spark, d), profiles(spark, d), ALL_RULES, CONFIG)
    path = new_table_path(spark, "stream-scores")
    run = (out.writeStream.format("parquet").option("path", path)
           .option("checkpointLocation", new_table_path(spark, "stream-check")).trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.schema(out.schema).parquet(path).select(
        "event_id", "subject_id", "score_change", "previous_score", "new_score")


@query("s02_stream_hourly", sql("ev", f"""SELECT subject_id, region, {tstr("date_trunc('hour', ts)")} AS window_start,
  count(*) AS event_count, {r6('sum(confidence)')} AS confidence_sum,
  count(DISTINCT event_type) AS unique_event_types FROM ev GROUP BY subject_id, region, date_trunc('hour', ts)"""))
def _(spark, d):
    """Hourly windows with a watermark in update mode; the last version of each window counts."""
    out = hourly_activity_stream(_stream(spark, d), "1 hour")
    path = new_table_path(spark, "stream-hourly")
    run = (out.writeStream.outputMode("update").foreachBatch(replace_batch(path))
           .option("checkpointLocation", new_table_path(spark, "stream-check")).trigger(availableNow=True).start())
    run.awaitTermination()
    rows = spark.read.parquet(path)
    keys = ["subject_id", "region", "window_start"]
    last = F.max_by(F.struct("event_count", "confidence_sum", "unique_event_types"), "batch")
    return (rows.groupBy(*keys).agg(last.alias("l"))
            .select(*keys, "l.event_count", on_grid(F.col("l.confidence_sum")).alias("confidence_sum"),
                    "l.unique_event_types"))


@query("s04_stream_daily", sql("pe", f"""SELECT subject_id, {dstr('day')} AS day, sum(n)::BIGINT AS event_count,
  {r6('sum(change)')} AS net_score_impact, count(*) AS active_hours, max(n) AS busiest_hour
FROM (SELECT subject_id, ts::DATE AS day, date_trunc('hour', ts) AS hour, count(*) AS n, sum(score_change) AS change FROM pe GROUP BY 1, 2, 3)
WHERE day + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM pe) GROUP BY subject_id, day"""))
def _(spark, d):
    """Hours that close feed days in one stream, over four micro-batches and as many restarts; days still open are not there yet."""
    path, check = new_table_path(spark, "stream-daily"), new_table_path(spark, "stream-check")

    def start(events: DataFrame) -> StreamingQuery:
        days = daily_from_hourly_stream(apply_rules(with_profile(events, profiles(spark, d)), ALL_RULES))
        return (days.writeStream.outputMode("append").foreachBatch(replace_batch(path)).option("checkpointLocation", check)
                .trigger(availableNow=True).start())

    _in_steps(spark, d, 4, start)
    out = spark.read.parquet(path).drop("batch")
    return out.withColumn("net_score_impact", on_grid(F.col("net_score_impact")))


@query("s05_stream_sliding", sql("ev", f"""SELECT subject_id, region, {tstr('w')} AS window_start, count(*) AS event_count,
  {r6('sum(confidence)')} AS confidence_sum, count(DISTINCT event_type) AS unique_event_types
FROM (SELECT *, date_trunc('day', ts) + to_hours(6 * i) - INTERVAL 18 HOUR AS w FROM ev, range(0, 7) t(i))
WHERE ts >= w AND ts < w + INTERVAL 24 HOUR AND w + INTERVAL 24 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM ev)
GROUP BY subject_id, region, w"""))
def _(spark, d):
    """Days that slide by six hours, in append mode over four micro-batches: each window once, when the watermark has passed its end."""
    path, check = new_table_path(spark, "stream-sliding"), new_table_path(spark, "stream-check")
    _in_steps(spark, d, 4, lambda events: (
        hourly_activity_stream(events, width="24 hours", slide="6 hours").writeStream.outputMode("append").foreachBatch(replace_batch(path))
        .option("checkpointLocation", check).trigger(availableNow=True).start()))
    rows = spark.read.parquet(path).drop("batch")
    return rows.withColumn("confidence_sum", on_grid(F.col("confidence_sum")))


@query("s06_late_rows", sql("ev", """SELECT * FROM (WITH span AS (SELECT min(ts) AS low, epoch_us(max(ts)) - epoch_us(min(ts)) AS width FROM ev),
placed AS (SELECT event_id, epoch_us(ts) AS us, least(3, (epoch_us(ts) - epoch_us(low)) * 4 // width) AS own FROM ev, span),
came AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN least(3, own + 1) ELSE own END AS step FROM placed),
marks AS (SELECT step + 1 AS step, max(max(us)) OVER (ORDER BY step) - 600000000 AS mark FROM came GROUP BY step)
SELECT event_id, coalesce(us <= mark, false) AS late, CASE WHEN us <= mark THEN mark - us END AS delay_us
FROM came LEFT JOIN marks USING (step))"""))
def _(spark, d):
    """A seventh of the events comes a micro-batch late; what lies behind the watermark then is kept apart with its delay."""
    split, check = LateSplit(spark, new_table_path(spark, "stream-late")), new_table_path(spark, "stream-check")
    _in_steps(spark, d, 4, lambda events: (
        events.select("event_id", "ts").writeStream.foreachBatch(split.process).option("checkpointLocation", check)
        .trigger(availableNow=True).start()), held_back=F.col("event_id") % 7 == 0)
    return split.rows().select("event_id", "late", "delay_us")


@query("s03_stream_profiles", sql("both", f"""SELECT p.subject_id, coalesce(l.new_score, p.score) AS score,
  {tier5('coalesce(l.new_score, p.score)')} AS tier FROM prof p LEFT JOIN (
    SELECT subject_id, new_score FROM folded QUALIFY row_number() OVER (PARTITION BY subject_id
      ORDER BY ts DESC, event_id DESC, hop DESC, origin_subject_id DESC, rel DESC) = 1) l USING (subject_id)"""))
def _(spark, d):
    """Micro-batches through the batch operators, with neighbours, into the score log."""
    job = ScoringJob(spark, profiles(spark, d), ALL_RULES, new_table_path(spark, "stream-job"), edges(spark, d), CONFIG)
    job.start(_stream(spark, d), new_table_path(spark, "stream-check")).awaitTermination()
    return job.final_profiles().select("subject_id", "score", "tier")
