"""Rollups of processed events.

Every group-by combines partially before its shuffle, so a hot key sends one row per task. Distinct counts over
few values (event types) use a set in the same shuffle; over many values (subjects) Spark's two-step distinct.
Each level keeps sums and counts, so the next level is exact and never a mean of means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from scoreloom.functions import bands, risk
from scoreloom.functions.numeric import has_error
from scoreloom.model import ScoreConfig
from scoreloom.operators.measures import status
from scoreloom.operators.scoring import time_order
from scoreloom.operators.stats import discrete_of_counts, median_of_counts, mode_of_counts, value_counts

ALL = "ALL"

def _types() -> Column:
    return F.size(F.collect_set("event_type")).cast("bigint")


def _last(pe: DataFrame, value: str | Column) -> Column:
    """Value at the latest event of the group."""
    return F.max_by(value, time_order(pe))


def hourly_activity(pe: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return (pe.groupBy("subject_id", "region", window.alias("w"))
            .agg(F.count("*").alias("event_count"), _types().alias("unique_event_types"),
                 F.sum("score_change").alias("net_score_impact"), F.sum("severity_num").alias("severity_sum"),
                 F.avg("severity_num").alias("average_severity"))
            .withColumns({"window_start": F.col("w.start")}).drop("w"))


def daily_from_hourly(hourly: DataFrame) -> DataFrame:
    return (hourly.groupBy("subject_id", F.to_date("window_start").alias("day"))
            .agg(F.sum("event_count").alias("event_count"), F.sum("net_score_impact").alias("net_score_impact")))


def daily_subject(pe: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Daily totals per subject with the score at the end of the day, in one shuffle."""
    return (pe.groupBy("subject_id", "region", F.to_date("ts").alias("day"))
            .agg(F.count("*").alias("total_events"), F.sum("score_change").alias("score_change"),
                 F.max("severity_num").alias("max_severity"), _types().alias("unique_event_types"),
                 _last(pe, "new_score").alias("day_end_score"))
            .withColumn("tier", bands.config_tier(F.col("day_end_score"), config)))


def day_end_scores(pe: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Score history per subject and day: last score, tier, reason and first rule of that last change."""
    last = _last(pe, F.struct("new_score", "event_type", F.element_at(F.concat("applied_rules", F.array(F.lit(""))), 1)
                          .alias("rule_id")))
    return (pe.groupBy("subject_id", F.to_date("ts").alias("day")).agg(last.alias("last"))
            .select("subject_id", "day", F.col("last.new_score").alias("score"),
                    bands.config_tier(F.col("last.new_score"), config).alias("tier"),
                    F.col("last.event_type").alias("change_reason"), F.col("last.rule_id").alias("rule_id")))


def daily_with_scores(totals: DataFrame, scores: DataFrame) -> DataFrame:
    """Daily totals joined with a day-end snapshot taken elsewhere; both hash on (subject, day)."""
    return totals.join(scores.select("subject_id", "day", F.col("score").alias("day_end_score"),
                                     F.col("tier").alias("current_tier")), ["subject_id", "day"], "left")


def improved_worsened(history: DataFrame, key: str = "score") -> DataFrame:
    """Against the subject's previous day in the history (W8). The input has one row per subject and day."""
    order = [c for c in ("day", "region") if c in history.columns]
    before = F.lag(key).over(W.partitionBy("subject_id").orderBy(*order))
    return history.withColumn("previous_day_score", before).withColumns({
        "improved": F.coalesce(F.col(key) > F.col("previous_day_score"), F.lit(False)),
        "worsened": F.coalesce(F.col(key) < F.col("previous_day_score"), F.lit(False))})


def _tier_counts(config: ScoreConfig, tier: str = "tier") -> list[Column]:
    names = [t.name for t in config.tiers] + ["unknown"]
    return [F.count_if(F.col(tier) == n).alias(f"tier_{n}_count") for n in names]


def daily_system(daily: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Per region and day, with a region ``ALL`` row, from daily subject rows."""
    plain = (daily.groupingSets([["day", "region"], ["day"]], "day", "region")
             .agg(F.grouping("region").alias("is_all"), F.count("*").alias("active_subjects"),
                  F.sum("total_events").alias("total_events"), F.sum("day_end_score").alias("score_sum"),
                  F.avg("day_end_score").alias("average_score"), F.min("day_end_score").alias("min_score"),
                  F.max("day_end_score").alias("max_score"), F.var_pop("day_end_score").alias("score_variance"),
                  *_tier_counts(config))
             .withColumn("region", F.when(F.col("is_all") == 1, ALL).otherwise(F.col("region"))).drop("is_all"))
    counts = value_counts(daily, ["day", "region"], "day_end_score")
    whole = counts.groupBy("day", F.lit(ALL).alias("region"), "value").agg(F.sum("n").alias("n"))
    medians = median_of_counts(counts.unionByName(whole), ["day", "region"])
    return plain.join(medians.withColumnRenamed("median", "median_score"), ["day", "region"], "left")


def downsample(daily: DataFrame, period: Column) -> DataFrame:
    """Daily system rows to longer periods, from sums and counts."""
    return (daily.groupBy("region", period.alias("period"))
            .agg(F.sum("total_events").alias("total_events"), F.sum("active_subjects").alias("subject_days"),
                 F.sum("score_sum").alias("score_sum"), F.min("min_score").alias("min_score"),
                 F.max("max_score").alias("max_score"))
            .withColumn("average_score", F.col("score_sum") / F.col("subject_days")))


def thirty_days(day: str = "day") -> Column:
    """Start of the 30-day period, counted from 1970-01-01."""
    n = F.unix_date(day)
    return F.date_from_unix_date((n - F.pmod(n, F.lit(30))).cast("int"))


def calendar_month(day: str = "day") -> Column:
    return F.to_date(F.trunc(day, "month"))


def events_monthly(pe: DataFrame) -> DataFrame:
    return (pe.groupBy("subject_id", "event_type", thirty_days_of("ts").alias("period"))
            .agg(F.count("*").alias("event_count"), F.sum("score_change").alias("total_impact")))


def thirty_days_of(ts: str) -> Column:
    n = F.unix_date(F.to_date(ts))
    return F.date_from_unix_date((n - F.pmod(n, F.lit(30))).cast("int"))


def week_of(ts: str) -> Column:
    """Start of the 7-day period, counted from 1970-01-01 (a Thursday)."""
    n = F.unix_date(F.to_date(ts))
    return F.date_from_unix_date((n - F.pmod(n, F.lit(7))).cast("int"))


def daily_events(pe: DataFrame) -> DataFrame:
    return (pe.groupBy(F.to_date("ts").alias("day"), "subject_id", "event_type")
            .agg(F.count("*").alias("event_count"), F.sum("score_change").alias("total_score_impact"),
                 F.avg("score_change").alias("avg_score_impact"),
                 F.count_if(F.col("score_change") > 0).alias("positive_events"),
                 F.count_if(F.col("score_change") < 0).alias("negative_events")))


def weekly_changes(pe: DataFrame) -> DataFrame:
    return (pe.filter("score_change <> 0").groupBy(week_of("ts").alias("week"), "subject_id")
            .agg(F.sum("score_change").alias("total_change"), F.count("*").alias("change_count")))


def with_demographics(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Age group and gender next to each row."""
    return df.join(profiles.select("subject_id", bands.age_group(F.col("age")).alias("age_group"), "gender"),
                   "subject_id", "left")


def regional_scores(daily: DataFrame, profiles: DataFrame, keys: Sequence[str] = ("region", "day", "age_group", "gender"),
                    config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Regional score aggregates by day and demographics, with tier map and improved / worsened counts."""
    keys = list(keys)
    rows = improved_worsened(with_demographics(daily, profiles), "day_end_score")
    tiers = [t.name for t in config.tiers] + ["unknown"]
    agg = (rows.groupBy(*keys)
           .agg(F.count("*").alias("total_subjects"), F.avg("day_end_score").alias("avg_score"),
                F.min("day_end_score").alias("min_score"), F.max("day_end_score").alias("max_score"),
                F.var_pop("day_end_score").alias("score_variance"), *_tier_counts(config),
                F.count_if("improved").alias("score_improvement_count"),
                F.count_if("worsened").alias("score_deterioration_count"))
           .withColumn("tier_distribution", F.map_filter(
               F.create_map(*[x for t in tiers for x in (F.lit(t), F.col(f"tier_{t}_count"))]), lambda _, n: n > 0)))
    medians = median_of_counts(value_counts(rows, keys, "day_end_score"), keys)
    return agg.join(medians.withColumnRenamed("median", "median_score"), keys, "left")


def event_summary(pe: DataFrame, keys: Sequence[str] = ("event_type", "event_subtype", "region", "day")) -> DataFrame:
    rows = pe if "day" in pe.columns else pe.withColumn("day", F.to_date("ts"))
    return (rows.groupBy(*keys)
            .agg(F.count("*").alias("event_count"), F.sum("score_change").alias("total_score_impact"),
                 F.avg("score_change").alias("avg_score_impact"),
                 F.count_distinct("subject_id").alias("distinct_subjects"),
                 F.avg("severity_num").alias("average_severity")))


def subject_activity_metrics(pe: DataFrame, association: DataFrame) -> DataFrame:
    """Per subject: activity scores by family, totals, trend slope per day, association risk, current score."""
    def of(*kinds: str) -> Column:
        return F.sum(F.when(F.col("event_type").isin(*kinds), F.col("score_change")).otherwise(0.0))

    day = F.unix_date(F.to_date("ts")).cast("double")
    per_subject = (pe.groupBy("subject_id", "region")
                   .agg(of("financial").alias("financial_activity_score"), of("social").alias("social_activity_score"),
                        of("system").alias("online_activity_score"),
                        F.count_if(F.col("score_change") > 0).alias("total_positive_events"),
                        F.count_if(F.col("score_change") < 0).alias("total_negative_events"),
                        F.regr_slope(F.col("score_change"), day).alias("activity_trend"),
                        _last(pe, "new_score").alias("current_score")))
    return per_subject.join(association.select("subject_id", "association_risk"), "subject_id", "left")


def location_rollup(pe: DataFrame) -> DataFrame:
    return (pe.groupBy("event_type", "city", "region", "country", status().alias("status"))
            .agg(F.count("*").alias("event_count"), F.sum("score_change").alias("total_score_change"),
                 F.avg("confidence").alias("avg_confidence"), F.count_distinct("subject_id").alias("subject_count"),
                 F.count_if(has_error()).alias("error_count"), F.count_if(~has_error()).alias("success_count")))


def rule_rollup(executions: DataFrame) -> DataFrame:
    return (executions.groupBy("rule_name", "event_type")
            .agg(F.count("*").alias("executions"), F.sum("score_impact").alias("score_impact"),
                 F.sum("rule_impact").alias("rule_impact"), F.count_distinct("subject_id").alias("distinct_subjects")))


def comparison_segments(records: DataFrame) -> DataFrame:
    change = "total_score_change"
    return (records.groupBy("event_type", "score_tier", "score_change_dir", "region", "country", "time_bucket")
            .agg(F.count("*").alias("n"), F.sum(change).alias("total_score_change"), F.avg(change).alias("avg_score_change"),
                 F.max(change).alias("max_score_change"), F.min(change).alias("min_score_change"),
                 F.var_pop("new_score").alias("score_variance")))


def statistical_profile(records: DataFrame) -> DataFrame:
    keys, x = ["data_segment", "event_type", "region"], "mean_score"
    base = (records.groupBy(*keys)
            .agg(F.count("*").alias("sample_size"), F.avg(x).alias("mean_score"),
                 F.stddev_samp(x).alias("std_deviation"), F.var_samp(x).alias("variance"),
                 F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis"))
            .withColumn("margin_95", F.lit(1.96) * F.col("std_deviation") / F.sqrt("sample_size")))
    base = base.withColumns({"ci_low": F.col("mean_score") - F.col("margin_95"),
                             "ci_high": F.col("mean_score") + F.col("margin_95")}).drop("margin_95")
    counts = value_counts(records, keys, x)
    return (base.join(median_of_counts(counts, keys).withColumnRenamed("median", "median_score"), keys, "left")
            .join(mode_of_counts(counts, keys).withColumnRenamed("mode", "mode_score"), keys, "left"))


def segment_regression(records: DataFrame) -> DataFrame:
    """Correlation of score and confidence, and slope of score on confidence, per data segment."""
    return (records.groupBy("data_segment")
            .agg(F.count("*").alias("n"), F.corr("mean_score", "confidence").alias("correlation"),
                 F.regr_slope("mean_score", "confidence").alias("regression_coefficient")))


def geographic_density(records: DataFrame) -> DataFrame:
    return (records.groupBy("country", "region", "city", "geographic_tier")
            .agg(F.count("*").alias("geographic_density"), F.avg("regional_score_avg").alias("regional_score_avg")))


def operations(pe: DataFrame, width_seconds: int = 3600) -> DataFrame:
    """Throughput, rates and latency per source and window. Percentiles are exact, from counts per latency value."""
    ms = risk.latency_ms()
    keys = ["source_system", "w"]
    timed = pe.select("source_system", F.window("processed_at", f"{width_seconds} seconds").alias("w"), ms.alias("ms"))
    ranks = discrete_of_counts(value_counts(timed, keys, "ms"), keys, {"p50": 0.5, "p95": 0.95})
    figures = (pe.groupBy("source_system", F.window("processed_at", f"{width_seconds} seconds").alias("w"))
            .agg(F.count("*").alias("events"), (F.count("*") / F.lit(float(width_seconds))).alias("throughput_per_sec"),
                 (F.count_if(has_error()) * 100.0 / F.count("*")).alias("error_rate"),
                 (F.count_if(~has_error()) * 100.0 / F.count("*")).alias("success_rate"),
                 F.avg(ms).alias("latency_ms_mean"),
                 F.avg(risk.data_quality()).alias("data_quality_score")))
    return figures.join(ranks, keys, "left").select("source_system", F.col("w.start").alias("window_start"), "events", "throughput_per_sec", "error_rate",
                         "success_rate", "latency_ms_mean", F.col("p50").alias("latency_ms_p50"),
                         F.col("p95").alias("latency_ms_p95"), "data_quality_score")


def subject_summary(pe: DataFrame) -> DataFrame:
    """Daily activity summary per subject with its sorted set of types and its last place."""
    return (pe.groupBy("subject_id", F.to_date("ts").alias("day"))
            .agg(F.count("*").alias("event_count"), F.sum("score_change").alias("total_score_change"),
                 F.avg("confidence").alias("avg_confidence"), F.array_sort(F.collect_set("event_type")).alias("event_types"),
                 _last(pe, F.struct("city", "region")).alias("place"))
            .select("*", F.col("place.city").alias("location_city"), F.col("place.region").alias("location_region"))
            .drop("place"))


def system_summary(pe: DataFrame, top: int = 3) -> DataFrame:
    """Per day: totals, distinct subjects, top event types, active regions, latency.

    Types and regions are few; they are counted first and ranked afterwards on the small table.
    """
    rows = pe.withColumn("day", F.to_date("ts"))
    totals = rows.groupBy("day").agg(
        F.count("*").alias("total_events"), F.count_distinct("subject_id").alias("total_subjects"),
        F.avg("score_change").alias("avg_score_change"), F.avg(risk.latency_ms()).alias("avg_latency_ms"))
    regions = rows.groupBy("day").agg(F.array_sort(F.collect_set("region")).alias("active_regions"))
    return (totals.join(top_types(rows, ["day"], top), "day").join(regions, "day"))


def top_types(rows: DataFrame, keys: Sequence[str], top: int) -> DataFrame:
    per_type = rows.groupBy(*keys, "event_type").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("n").desc(), F.col("event_type")))
    best = per_type.withColumn("rank", rank).filter(F.col("rank") <= top)
    return (best.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "event_type"))).alias("t"))
            .select(*keys, F.transform("t", lambda x: x["event_type"]).alias("top_event_types")))


def rule_state(fired: DataFrame, cooldown: Column | None = None) -> DataFrame:
    """Applications per subject and rule: count, last time, and when the rule may fire again."""
    until = (F.col("last_applied") + F.make_dt_interval(secs=cooldown)) if cooldown is not None else (
        F.lit(None).cast("timestamp"))
    return (fired.groupBy("subject_id", "rule_id")
            .agg(F.count("*").alias("application_count"), F.max("ts").alias("last_applied"))
            .withColumn("cooldown_until", until))


def behaviour_rollup(records: DataFrame) -> DataFrame:
    return (records.groupBy("behaviour_pattern", "time_of_day", "day_of_week", "month")
            .agg(F.count("*").alias("n"), F.avg("score_impact").alias("mean_impact"),
                 F.avg("behaviour_consistency").alias("mean_consistency")))


def risk_rollup(records: DataFrame) -> DataFrame:
    return (records.groupBy("risk_category", "risk_level", "alert_level")
            .agg(F.count("*").alias("n"), F.avg("risk_score").alias("mean_risk"),
                 F.max("fraud_detection_score").alias("max_fraud")))


