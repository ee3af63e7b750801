"""Record families written for each processed event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import bands, behaviour, geography, risk
from scoreloom.functions.numeric import has_error, number, on_grid, pick, text
from scoreloom.model import ScoreConfig

TAG_BYTES = 50  # fixed value: shorter strings are tags, the rest are fields


def flatten(events: DataFrame) -> DataFrame:
    """Envelope and nested location as plain columns (B1)."""
    rest = [c for c in events.columns if c not in ("location", "timestamp")]
    return events.select(*rest, F.col("timestamp").alias("ts"),
                         *[F.col(f"location.{c}").alias(c)
                           for c in ("city", "region", "country", "latitude", "longitude")])


def measurement() -> Column:
    return F.concat(F.lit("event_"), F.lower(text("event_type")))


def payload_entries() -> Column:
    """Payload as an array of (key, kind, text, number, flag); evaluated inside the row."""
    entries = F.map_entries(F.from_json("payload", "map<string,variant>"))

    def entry(e: Column) -> Column:
        value = e["value"]
        kind = F.schema_of_variant(value)
        text_ = F.try_variant_get(value, "$", "string")
        name = pick((value.isNull(), "null"), (kind == "VOID", "null"), (kind == "BOOLEAN", "bool"),
                    (kind.startswith("OBJECT") | kind.startswith("ARRAY"), "nested"),
                    ((kind == "STRING") & (F.octet_length(text_) < TAG_BYTES), "tag"),
                    (kind == "STRING", "text"), default="number")
        return F.struct(e["key"].alias("key"), name.alias("kind"), text_.alias("text"),
                        F.try_variant_get(value, "$", "double").alias("number"),
                        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean")).alias("flag"))

    return F.transform(entries, entry)


def split_payload(df: DataFrame) -> DataFrame:
    """Short strings to ``tags`` (``p_key``), everything else to ``fields`` (``payload_key``) (B2).

    Nested values and null become JSON text. Field values are text; their kind is kept in ``field_kinds``.
    """
    with_entries = df.withColumn("entries", payload_entries())
    tags = F.filter("entries", lambda e: e["kind"] == "tag")
    fields = F.filter("entries", lambda e: e["kind"] != "tag")

    def field_text(e: Column) -> Column:
        return pick((e["kind"] == "bool", e["flag"].cast("string")), (e["kind"] == "number", e["number"].cast("string")),
                    (e["kind"] == "null", F.lit("null")), default=e["text"])

    return with_entries.withColumns({
        "tags": F.map_from_entries(F.transform(tags, lambda e: F.struct(
            F.concat(F.lit("p_"), e["key"]), e["text"]))),
        "fields": F.map_from_entries(F.transform(fields, lambda e: F.struct(
            F.concat(F.lit("payload_"), e["key"]), field_text(e)))),
        "field_kinds": F.map_from_entries(F.transform(fields, lambda e: F.struct(
            F.concat(F.lit("payload_"), e["key"]), e["kind"]))),
    }).drop("entries")


def payload_rows(df: DataFrame, *keep: str) -> DataFrame:
    """One row per payload key, for filtering on any key."""
    return df.select(*keep, F.inline(payload_entries()))


def payload_text(df: DataFrame) -> Column:
    """The whole payload as JSON text (B3); structs and maps are written out, text stays as it is."""
    kind = df.schema["payload"].dataType.typeName()
    return F.col("payload") if kind == "string" else F.to_json("payload")


def has_error_tag() -> Column:
    return F.when(has_error(), "true").otherwise("false")


def status() -> Column:
    return F.when(has_error(), "error").otherwise("success")


def rules_applied() -> Column:
    return F.greatest(F.size(F.coalesce("applied_rules", F.array().cast("array<string>"))), F.lit(0))


def event_points(pe: DataFrame) -> DataFrame:
    """Raw event point: tags and fields of one event with its scores (A10)."""
    return split_payload(pe).select(
        measurement().alias("measurement"), "subject_id", "event_subtype", "source_system", "city", "region",
        "country", "processing_id", has_error_tag().alias("has_error"), "tags", "event_id", "event_name",
        "confidence", "latitude", "longitude", "version", "previous_score", "new_score", "score_change",
        risk.latency_ms().alias("processing_time_ms"), "processing_error", "fields", "field_kinds",
        F.col("payload").alias("payload_full"), "ts")


def score_snapshots(pe: DataFrame) -> DataFrame:
    return pe.select("subject_id", F.col("event_type").alias("trigger_event"), "city", "region", "country",
                     "processing_id", F.col("new_score").alias("score"), "score_change", "previous_score",
                     "confidence", rules_applied().alias("rules_applied"), "event_id", status().alias("status"),
                     F.col("processing_error").alias("error"), F.col("processed_at").alias("time"))


def rule_executions(pe: DataFrame) -> DataFrame:
    """One row per applied rule. ``score_impact`` is the whole event's change, ``rule_impact`` the rule's own."""
    fired = pe.select("*", F.explode("rule_scores").alias("fired")).filter("processing_error is null")
    return fired.select(F.col("fired.rule_id").alias("rule_name"), "subject_id", "event_type", "event_subtype",
                        "city", "region", "country", "processing_id", F.lit(1).alias("execution_count"),
                        F.col("score_change").alias("score_impact"),
                        on_grid(F.col("fired.points")).alias("rule_impact"), "event_id",
                        F.col("new_score").alias("subject_score"), F.col("processed_at").alias("time"))


def location_records(pe: DataFrame) -> DataFrame:
    return pe.select("event_type", "city", "region", "country", "processing_id", status().alias("status"),
                     F.lit(1).alias("event_count"), F.col("score_change").alias("total_score_change"),
                     F.col("confidence").alias("avg_confidence"), F.lit(1).alias("subject_count"),
                     F.when(has_error(), 1).otherwise(0).alias("error_count"),
                     F.when(has_error(), 0).otherwise(1).alias("success_count"), "subject_id",
                     F.col("processed_at").alias("time"))


def behaviour_records(pe: DataFrame) -> DataFrame:
    return pe.select("subject_id", "event_type", "event_subtype",
                     bands.behaviour_pattern().alias("behaviour_pattern"), bands.time_of_day().alias("time_of_day"),
                     bands.weekday_name().alias("day_of_week"), bands.month_name().alias("month"), "processing_id",
                     F.col("score_change").alias("score_impact"), F.col("new_score").alias("cumulative_score"),
                     F.col("confidence").alias("confidence_level"),
                     rules_applied().alias("rules_triggered_count"),
                     behaviour.consistency().alias("behaviour_consistency"),
                     behaviour.location_mobility().alias("location_mobility"), "event_id", "ts")


def comparison_records(pe: DataFrame) -> DataFrame:
    return pe.select("event_type", bands.analytic_tier(number("new_score")).alias("score_tier"),
                     bands.change_direction().alias("score_change_dir"), "region", "country",
                     bands.hour_bucket().alias("time_bucket"), "processing_id",
                     F.col("score_change").alias("total_score_change"),
                     bands.percentile_estimate(number("new_score")).alias("percentile_rank"),
                     bands.z_estimate(number("score_change")).alias("z_score"), "new_score", "subject_id",
                     "event_id", "ts")


def trend_records(pe: DataFrame) -> DataFrame:
    tier = F.col("analytic_tier")
    pe = behaviour.with_trend_inputs(pe)
    return pe.select(bands.trend_category().alias("trend_category"), bands.week_label().alias("time_window"),
                     "event_type", bands.geographic_segment().alias("geographic_segment"),
                     tier.alias("score_tier"), "processing_id",
                     bands.trend_direction().alias("trend_direction"),
                     bands.trend_magnitude().alias("trend_magnitude"),
                     behaviour.trend_velocity(tier=tier).alias("trend_velocity"),
                     behaviour.trend_stability(tier=tier).alias("trend_stability_index"), "subject_id", "new_score",
                     "event_id", "ts")


def statistics_records(pe: DataFrame) -> DataFrame:
    return pe.select(bands.data_segment().alias("data_segment"), F.lit("real_time_stats").alias("analysis_type"),
                     "event_type", "region", "processing_id", F.lit(1).alias("sample_size"),
                     F.col("new_score").alias("mean_score"), "confidence", "event_id", "ts")


def geography_records(pe: DataFrame) -> DataFrame:
    pe = geography.with_place_classes(pe)
    return pe.select("country", "region", "city", "geographic_tier", F.col("urban_class").alias("urban_rural"), "processing_id", "latitude", "longitude",
                     F.col("new_score").alias("regional_score_avg"),
                     geography.geographic_mobility().alias("geographic_mobility"),
                     geography.distance_from_centre().alias("distance_from_center"),
                     geography.population_density().alias("population_density_est"),
                     geography.economic_index().alias("economic_indicator"), "event_id", "ts")


def risk_records(pe: DataFrame) -> DataFrame:
    return pe.select(risk.risk_category().alias("risk_category"), risk.risk_level().alias("risk_level"),
                     "event_type", bands.subject_segment().alias("subject_segment"),
                     risk.alert_level().alias("alert_level"), "processing_id",
                     risk.risk_score().alias("risk_score"),
                     risk.default_probability().alias("probability_default"),
                     risk.early_warning().alias("early_warning_signal"),
                     risk.mitigation().alias("risk_mitigation_factor"),
                     risk.fraud_score().alias("fraud_detection_score"), risk.anomaly().alias("anomaly_detection_score"),
                     risk.predictive_risk(30).alias("predictive_risk_30d"),
                     risk.predictive_risk(90).alias("predictive_risk_90d"),
                     risk.volatility().alias("volatility_index"), "subject_id", "event_id", "ts")


def performance_records(pe: DataFrame) -> DataFrame:
    return pe.select(F.lit("stream_processor").alias("system_component"),
                     F.lit("event_analysis").alias("processing_stage"), F.col("source_system").alias("data_source"),
                     "processing_id", risk.latency_ms().alias("processing_latency_ms"),
                     risk.latency_us().alias("processing_latency_us"),
                     F.when(has_error(), 100.0).otherwise(0.0).alias("error_rate"),
                     F.when(has_error(), 0.0).otherwise(100.0).alias("success_rate"),
                     F.when(has_error(), "processing_error").alias("error_type"),
                     risk.data_quality().alias("data_quality_score"),
                     risk.efficiency().alias("processing_efficiency"), "event_id",
                     F.col("processed_at").alias("time"))


# The seven analytic families: each is one projection over the same scored table.
ANALYTIC = {
    "behaviour": behaviour_records,
    "comparison": comparison_records,
    "trend": trend_records,
    "statistics": statistics_records,
    "geography": geography_records,
    "risk": risk_records,
    "performance": performance_records,
}


def score_changes(pe: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Score-change history with tiers before and after."""
    return pe.select("subject_id", "event_id", "event_type", "previous_score", "new_score", "score_change",
                     "applied_rules", "processing_id", "ts",
                     bands.config_tier(F.col("previous_score"), config).alias("previous_tier"),
                     bands.config_tier(F.col("new_score"), config).alias("new_tier"),
                     F.col("city").alias("location"), bands.change_direction().alias("change_type"),
                     F.lit("EVENT_IMPACT").alias("reason_category"),
                     F.element_at(F.concat("applied_rules", F.array(F.lit(""))), 1).alias("triggering_rule_id"))


def alerts(pe: DataFrame) -> DataFrame:
    """Events that call for attention: non-normal alert level, early warning, or high anomaly."""
    records = risk_records(pe)
    return records.filter((F.col("alert_level") != "normal") | (F.col("early_warning_signal") > 0)
                          | (F.col("anomaly_detection_score") > 0.1))
