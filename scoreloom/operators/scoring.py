"""From events to processed events: profile join, rules, running score, decay."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.bands import closed_tier, config_tier
from scoreloom.functions.numeric import clamp, on_grid
from scoreloom.model import Rule, ScoreConfig
from scoreloom.operators.cooldown import accept, accepted_rules
from scoreloom.operators.rules import (active_list, active_rules, apply_rule_table, apply_rules, fired_rows,
                                       select_rule_rows, select_rules, sum_points)
from scoreloom.operators.kernels import DecayWalk, decay_kernel, resumed_decay_kernel
from scoreloom.operators.scan import PREFIX, apply_step, clamped_scan, scan_order
from scoreloom.session import new_table_path

MISSING_PROFILE = "subject profile not found"


def with_profile(events: DataFrame, profiles: DataFrame, config: ScoreConfig = ScoreConfig(),
                 strict: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Attach profile type and opening score.

    A subject without a profile starts at the baseline; in ``strict`` mode its events become error rows. With decay, the
    time of the profile's last score comes along, as the days since then count.
    The join strategy is left to Spark: profiles grow with the data, and adaptive execution splits the
    partition of a subject that holds a large share of all events.
    """
    known = [c for c in ("last_score_at",) if config.decay.enabled and c in profiles.columns and c not in events.columns]
    side = profiles.select("subject_id", F.col("type").alias("subject_type"),
                           F.col("score").alias("profile_score"), *known, *extra)
    joined = events.join(side, "subject_id", "left")
    missing = F.col("profile_score").isNull()
    error = F.when(missing, F.lit(MISSING_PROFILE)) if strict else F.lit(None).cast("string")
    return (joined.withColumn("opening_score", F.coalesce("profile_score", F.lit(config.baseline)))
            .withColumn("processing_error", error).drop("profile_score"))


def error_rows_to_zero(processed: DataFrame) -> DataFrame:
    """Rows with an error carry zero scores and no rules, and keep the error text."""
    bad = F.col("processing_error").isNotNull()
    zero = {c: F.when(bad, F.lit(0.0)).otherwise(F.col(c)) for c in ("score_change", "previous_score", "new_score")}
    return processed.withColumns({**zero, "applied_rules": F.when(~bad, F.col("applied_rules")),
                                  "status": F.when(bad, "error").otherwise("success")})


def processing_id() -> Column:
    return F.concat(F.lit("proc_"), F.substring(F.sha2(F.col("event_id").cast("string"), 256), 1, 16))


Prepare = Callable[[DataFrame], DataFrame]
_STEP = ("score_change", "step_low", "step_high")


def _with_bounds(config: ScoreConfig, prepare: Prepare | None) -> Prepare:
    def run(df: DataFrame) -> DataFrame:
        return (prepare(df) if prepare else df).withColumns(
            {"step_low": F.lit(config.low), "step_high": F.lit(config.high)})

    return run


def running_score(spark: SparkSession, deltas: DataFrame, config: ScoreConfig, order: Sequence[str],
                  chunks: int | None = None, prepare: Prepare | None = None, finish: Prepare | None = None) -> DataFrame:
    """Add ``previous_score`` and ``new_score``: the bounded running score per subject in ``order``.

    Needs ``subject_id``, ``opening_score`` and ``score_change``; the last may be added by ``prepare``. ``finish`` adds columns to the
    written rows.
    """
    scanned = clamped_scan(spark, deltas, ["subject_id"], order, _STEP, chunks, _with_bounds(config, prepare), finish)
    before = apply_step(F.col("opening_score"), tuple(F.col(c) for c in PREFIX))
    after = clamp(before + F.col("score_change"), config.low, config.high)
    return (scanned.withColumn("new_score", on_grid(after)).withColumn("previous_score", on_grid(before))
            .drop("step_low", "step_high", *PREFIX))


def running_score_with_decay(spark: SparkSession, deltas: DataFrame, config: ScoreConfig, order: Sequence[str],
                             chunks: int | None = None, prepare: Prepare | None = None) -> DataFrame:
    """As :func:`running_score`, with points lost per whole day above the decay floor (T5).

    Rows are range-partitioned by subject and time and walked once. A subject that goes on in the next chunk enters it with a score that
    the chunk does not know, so a chunk also gives its first subject's map of scores: monotone, piecewise linear, a few hundred pieces at
    most. The maps of a subject's chunks are applied one after another, and the first subjects of such chunks are walked anew from the
    score they really enter with. Each row is touched at most twice, at any length of history.
    """
    policy = config.decay
    walker = DecayWalk(config.low, config.high, policy.points_per_day, policy.floor)
    by = ["subject_id", *order]
    spread = deltas.repartitionByRange(chunks, *by) if chunks else deltas.repartitionByRange(*by)
    rows = spread.sortWithinPartitions(*by).withColumn("chunk", F.spark_partition_id())
    rows = prepare(rows) if prepare else rows
    since = F.unix_date(F.to_date("last_score_at")) if "last_score_at" in rows.columns else F.lit(None).cast("int")
    rows = rows.withColumns({"day": F.unix_date(F.to_date("ts")), "since": since})
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields]  # all may be null in the rows on chunks
    fields += T._parse_datatype_string("before double, chunk_pos bigint, head boolean, edge_map_x array<double>, edge_map_y array<double>, "
                                       "edge_score double, edge_first int, edge_last int, edge_whole boolean").fields
    staged = rows.mapInArrow(decay_kernel("subject_id", walker), T.StructType(fields))
    path = new_table_path(spark, "decay-rows")
    staged.write.parquet(path)
    staged = spark.read.schema(staged.schema).parquet(path)
    walked = _resume_decay(staged, walker)
    before = F.col("before")
    after = clamp(before + F.col("score_change"), config.low, config.high)
    inner = ("before", "head", "day", "since", "chunk", "chunk_pos", "last_score_at", *[c for c in staged.columns if c.startswith("edge_")])
    return (walked.withColumns({"new_score": on_grid(after), "previous_score": on_grid(before), "scan_order": scan_order()}).drop(*inner))


def _resume_decay(staged: DataFrame, walker: DecayWalk) -> DataFrame:
    """Rows of :func:`running_score_with_decay` with the right score before each, also where a subject's history began in an earlier chunk."""
    spark = staged.sparkSession
    rows = staged.filter("edge_score is null")
    # Two rows per chunk at most, so this is bounded by the number of partitions.
    edges = (staged.filter("edge_score is not null").select("subject_id", "chunk", *[c for c in staged.columns if c.startswith("edge_")])
             .collect())
    firsts = {r["chunk"]: r for r in edges if r["edge_map_x"] is not None}
    lasts = {r["chunk"]: r for r in edges if r["edge_map_x"] is None or r["edge_whole"]}
    carried, entered = [], {}
    chunks = sorted(firsts)
    for before, chunk in zip(chunks, chunks[1:]):
        last, first = lasts[before], firsts[chunk]
        if last["subject_id"] != first["subject_id"]:
            continue
        score = last["edge_score"]
        if last["edge_whole"] and before in entered:
            score = float(np.interp(entered[before], last["edge_map_x"], last["edge_map_y"]))
        carried.append((chunk, score, last["edge_last"]))
        entered[chunk] = walker.opened(score, first["edge_first"] - last["edge_last"])
    if not carried:
        return rows
    states = F.broadcast(spark.createDataFrame(carried, "chunk int, carried_score double, carried_day int"))
    joined = rows.join(states, "chunk", "left")
    again = F.col("carried_day").isNotNull() & F.col("head")
    anew = joined.filter(again)
    anew = (anew.repartitionById(1 + max(c[0] for c in carried), F.col("chunk")).sortWithinPartitions("chunk", "chunk_pos")
            .mapInArrow(resumed_decay_kernel(walker), anew.schema))
    return joined.filter(~again).unionByName(anew).drop("carried_score", "carried_day")


def score_events(spark: SparkSession, events: DataFrame, profiles: DataFrame, rules: Sequence[Rule] | DataFrame,
                 config: ScoreConfig = ScoreConfig(), strict_profiles: bool = False, strict_rules: bool = False,
                 chunks: int | None = None, cooldown: bool = False, as_of: dt.datetime | None = None,
                 details: Prepare | None = None, late: Prepare | None = None) -> DataFrame:
    """The whole scoring job in batch: events in, processed events out.

    ``rules`` is a list, which is compiled, or a rule table of any length; both score alike. Only rules that are active and
    valid at ``as_of`` (now) and belong to the configured subset count. ``cooldown`` enforces the
    rules' limits per subject and period; it decides which rules count, so it runs before the score and costs a
    join on the event id. ``details`` and then ``late`` add event columns that follow from the row alone: rules and the result have
    them, but they are not shuffled. Details are written with the score, and late columns are left to whoever reads them.
    """
    add_details, add_late = details or (lambda df: df), late or (lambda df: df)
    joined = with_profile(events, profiles, config, strict_profiles)
    rules = rules_in_force(spark, rules, config, as_of)

    def change(df: DataFrame) -> DataFrame:
        known = add_late(add_details(df))
        scored = apply_rule_table(known, rules, strict_rules) if isinstance(rules, DataFrame) else apply_rules(known, rules, strict_rules)
        if strict_profiles:
            bad = F.col("processing_error").isNotNull()
            scored = scored.withColumn("score_change", F.when(bad, 0.0).otherwise(F.col("score_change")))
        added = set(known.columns) - set(df.columns)
        return scored.drop(*added) if added else scored

    fold = running_score_with_decay if config.decay.enabled else running_score
    if cooldown:
        # Error rows fire nothing, so they must not use up a period either.
        known = change(joined).withColumn("rule_scores", F.when(F.col("processing_error").isNull(), F.col("rule_scores"))
                                          .otherwise(F.slice("rule_scores", 1, 0)))
        done = add_details(fold(spark, apply_cooldown(known, rules), config, ["ts", "event_id"], chunks))
    elif config.decay.enabled:
        done = add_details(fold(spark, joined, config, ["ts", "event_id"], chunks, change))
    else:
        done = running_score(spark, joined, config, ["ts", "event_id"], chunks, change, details)
    return add_late(error_rows_to_zero(done).withColumn("processing_id", processing_id()))


def rules_in_force(spark: SparkSession, rules: Sequence[Rule] | DataFrame, config: ScoreConfig,
                   as_of: dt.datetime | None = None) -> Sequence[Rule] | DataFrame:
    """The rules that are active, valid at ``as_of`` (now) and in the configured subset, in the form they came in."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if not isinstance(rules, DataFrame):
        return select_rules(active_list(rules, as_of), config)
    ids = None if config.rule_ids is None else spark.createDataFrame([(i,) for i in config.rule_ids], "rule_id string")
    return select_rule_rows(active_rules(rules, as_of), ids, config.include_tags, config.exclude_tags)


def time_order(pe: DataFrame) -> Column:
    """Order of a subject's events: the scan's own number where the table has it, else (ts, event_id)."""
    return F.col("scan_order") if "scan_order" in pe.columns else F.struct("ts", "event_id")


def latest_state(processed: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Last score per subject, with tier and times. Partial aggregation keeps one row per subject and task."""
    moved = processed.filter("rule_seen and processing_error is null")
    order = time_order(processed)
    return (moved.groupBy("subject_id")
            .agg(F.max_by("new_score", order).alias("score"), F.max("ts").alias("last_score_at"),
                 F.max_by("event_id", order).alias("last_event_id"))
            .select("subject_id", "score", config_tier(F.col("score"), config).alias("tier"), "last_score_at",
                    "last_event_id"))


def apply_cooldown(scored: DataFrame, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """Drop firings over a rule's limit per subject and period, and take the change from what is left (T4)."""
    fired = fired_rows(scored, "subject_id", "event_id", "ts")
    if isinstance(rules, DataFrame):
        limits = rules.select("rule_id", "cooldown_seconds", "max_in_period").dropDuplicates(["rule_id"])
        fired = fired.join(limits, "rule_id", "left")
    else:
        timed = [r for r in rules if r.cooldown_seconds]
        if not timed:
            return scored
        length, most = F.lit(None).cast("bigint"), F.lit(None).cast("int")
        for r in timed:
            hit = F.col("rule_id") == r.rule_id
            length = F.when(hit, F.lit(r.cooldown_seconds)).otherwise(length)
            most = F.when(hit, F.lit(r.max_in_period or 1)).otherwise(most)
        fired = fired.withColumns({"cooldown_seconds": length.cast("bigint"), "max_in_period": most})
    return with_rule_scores(scored, accepted_rules(accept(fired)))


def with_rule_scores(scored: DataFrame, accepted: DataFrame) -> DataFrame:
    """Events with the rules in ``accepted`` (event_id, accepted) instead of all that fired, and the change these give."""
    none = F.array().cast("array<struct<rule_id:string,points:double>>")
    left = (scored.drop("rule_scores").join(accepted, "event_id", "left")
            .withColumn("rule_scores", F.coalesce("accepted", none)).drop("accepted"))
    return left.withColumns({"applied_rules": F.transform("rule_scores", lambda r: r["rule_id"]),
                             "score_change": on_grid(sum_points(F.col("rule_scores")))})


def onboard(events: DataFrame, config: ScoreConfig = ScoreConfig()) -> tuple[DataFrame, DataFrame]:
    """New profiles from creation events, and the events rejected for a missing or badly typed field."""
    doc = F.try_parse_json("payload")

    def kind(field: str) -> Column:
        return F.coalesce(F.schema_of_variant(F.try_variant_get(doc, f"$.{field}", "variant")), F.lit("VOID"))

    def is_number(field: str) -> Column:
        return kind(field).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")

    created = events.filter((F.col("event_type") == "system") & (F.col("event_subtype") == "new_citizen"))
    good = ((kind("initial_age") == "BIGINT") & is_number("initial_score") & (kind("citizen_type") == "STRING")
            & (kind("initial_status") == "STRING"))
    checked = created.withColumn("good", good)
    first = F.min_by(F.struct("payload", "ts"), F.struct("ts", "event_id"))
    doc_of = F.try_parse_json("first.payload")
    score = F.try_variant_get(doc_of, "$.initial_score", "double")
    profiles = (checked.filter("good").groupBy("subject_id").agg(first.alias("first"))
                .select("subject_id", F.try_variant_get(doc_of, "$.initial_age", "int").alias("age"),
                        score.alias("score"), F.try_variant_get(doc_of, "$.citizen_type", "string").alias("type"),
                        F.try_variant_get(doc_of, "$.initial_status", "string").alias("status"),
                        closed_tier(score).alias("tier"), F.col("first.ts").alias("created_at")))
    return profiles, checked.filter("not good").drop("good")


def last_write(updates: DataFrame, interval: str = "1 second") -> DataFrame:
    """Only the last update per subject and interval is written."""
    order = time_order(updates)
    return (updates.groupBy("subject_id", F.window("ts", interval).alias("w"))
            .agg(F.max_by("new_score", order).alias("score"), F.max("ts").alias("last_score_at"),
                 F.max_by("event_id", order).alias("event_id"))
            .select("subject_id", F.col("w.start").alias("interval_start"), "score", "last_score_at", "event_id"))
