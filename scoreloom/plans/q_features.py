"""Feature columns (F) and record families (A10, B, C8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.functions import bands, behaviour, geography, risk
from scoreloom.functions.numeric import number, on_grid
from scoreloom.functions.scoring import impact_factor, rule_score
from scoreloom.operators import measures as M
from scoreloom.operators.scoring import with_profile
from scoreloom.plans.registry import query
from scoreloom.plans.sqlbase import X, feature, features, r6, rule_points, sql, tier5, tstr
from scoreloom.plans.tables import events, processed, profiles


def _g(**cols):
    return [on_grid(c).alias(n) for n, c in cols.items()]


def _t(**cols):
    return [c.alias(n) for n, c in cols.items()]


@query("f01_f05_behaviour", sql("pe", "SELECT event_id, " + features(
    "behaviour_pattern", "time_of_day", "weekday", "month", "consistency", "location_mobility") + " FROM pe"))
def _(spark, d):
    return processed(spark, d).select("event_id", *_t(
        behaviour_pattern=bands.behaviour_pattern(), time_of_day=bands.time_of_day(), weekday=bands.weekday_name(),
        month=bands.month_name()), *_g(consistency=behaviour.consistency(),
                                       location_mobility=behaviour.location_mobility()))


@query("f06_f14_bands", sql("pe", "SELECT event_id, new_score, " + features(
    "analytic_tier", "config_tier", "change_direction", "percentile_estimate", "z_estimate", "hour_bucket",
    "week_label", "trend_category", "trend_direction", "trend_magnitude") + " FROM pe"))
def _(spark, d):
    s, c = number("new_score"), number("score_change")
    return processed(spark, d).select("event_id", "new_score", *_t(
        analytic_tier=bands.analytic_tier(s), config_tier=bands.config_tier(s),
        change_direction=bands.change_direction(), hour_bucket=bands.hour_bucket(), week_label=bands.week_label(),
        trend_category=bands.trend_category()), *_g(
        percentile_estimate=bands.percentile_estimate(s), z_estimate=bands.z_estimate(c),
        trend_direction=bands.trend_direction(), trend_magnitude=bands.trend_magnitude()))


@query("f15_f16_trend", sql("pe", "SELECT event_id, " + features("trend_velocity", "trend_stability") + " FROM pe"))
def _(spark, d):
    tier = F.col("analytic_tier")
    return behaviour.with_trend_inputs(processed(spark, d)).select("event_id", *_g(
        trend_velocity=behaviour.trend_velocity(tier=tier), trend_stability=behaviour.trend_stability(tier=tier)))


@query("f17_f22_geography", sql("pe", "SELECT event_id, " + features(
    "geographic_tier", "urban_class", "geographic_mobility", "distance_from_centre", "population_density",
    "economic_index") + " FROM pe"))
def _(spark, d):
    df = geography.with_place_classes(processed(spark, d))
    return df.select("event_id", "geographic_tier", "urban_class", *_g(
        geographic_mobility=geography.geographic_mobility(), distance_from_centre=geography.distance_from_centre(),
        population_density=geography.population_density(), economic_index=geography.economic_index()))


@query("f23_f33_risk", sql("pe", "SELECT event_id, " + features(
    "risk_category", "risk_level", "alert_level", "risk_score", "default_probability", "early_warning", "mitigation",
    "fraud_score", "anomaly", "predictive_risk_30d", "predictive_risk_90d", "volatility") + " FROM pe"))
def _(spark, d):
    return processed(spark, d).select("event_id", *_t(
        risk_category=risk.risk_category(), risk_level=risk.risk_level(), alert_level=risk.alert_level()), *_g(
        risk_score=risk.risk_score(), default_probability=risk.default_probability(),
        early_warning=risk.early_warning(), mitigation=risk.mitigation(), fraud_score=risk.fraud_score(),
        anomaly=risk.anomaly(), predictive_risk_30d=risk.predictive_risk(30),
        predictive_risk_90d=risk.predictive_risk(90), volatility=risk.volatility()))


@query("f34_f35_quality", sql("pe", "SELECT event_id, " + features(
    "latency_ms", "data_quality", "efficiency") + " FROM pe"))
def _(spark, d):
    return processed(spark, d).select("event_id", risk.latency_ms().alias("latency_ms"), *_g(
        data_quality=risk.data_quality(), efficiency=risk.efficiency()))


@query("f36_rule_score", sql("fired", f"SELECT event_id, {r6(rule_points('20.0', '1.2'))} AS rule_score FROM evp"))
def _(spark, d):
    df = with_profile(events(spark, d), profiles(spark, d))
    return df.select("event_id", on_grid(rule_score(F.lit(20.0), F.lit(1.2))).alias("rule_score"))


@query("f37_impact_factor", sql("ev", f"""SELECT event_id, {r6('''(CASE relationship_type WHEN 'family_event' THEN 0.3::DOUBLE
  WHEN 'workplace_event' THEN 0.2::DOUBLE WHEN 'community_event' THEN 0.15::DOUBLE ELSE 0.1::DOUBLE END) * intensity
  * (CASE WHEN is_positive THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END)''')} AS impact_factor
FROM ev WHERE event_type = 'relationship'"""))
def _(spark, d):
    return events(spark, d).filter("event_type = 'relationship'").select(
        "event_id", on_grid(impact_factor()).alias("impact_factor"))


@query("f38_f39_profile_bands", sql("prof", """SELECT subject_id,
  CASE WHEN score >= 800 THEN 'excellent' WHEN score >= 600 THEN 'good' WHEN score >= 400 THEN 'average'
       WHEN score >= 200 THEN 'poor' ELSE 'very_poor' END AS closed_tier,
  CASE WHEN age < 18 THEN 'under-18' WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35' WHEN age <= 45 THEN '36-45'
       WHEN age <= 55 THEN '46-55' WHEN age <= 65 THEN '56-65' ELSE '66+' END AS age_group FROM prof"""))
def _(spark, d):
    return profiles(spark, d).select("subject_id", bands.closed_tier(F.col("score")).alias("closed_tier"),
                                     bands.age_group(F.col("age")).alias("age_group"))


_PAYLOAD_KEYS = """kv AS (
  SELECT event_id, unnest(['amount', 'transaction_type', 'processing_time', 'memo']) AS key,
         unnest(['number', 'tag', 'number', CASE WHEN strlen(memo) < 50 THEN 'tag' ELSE 'text' END]) AS kind,
         unnest([NULL, transaction_type, NULL, memo]) AS txt,
         unnest([amount, NULL, k::DOUBLE, NULL]) AS num, unnest([NULL::BOOLEAN, NULL, NULL, NULL]) AS flag
  FROM (SELECT *, 'note ' || repeat('é', k % 40) AS memo FROM ev) WHERE event_type = 'financial'
  UNION ALL
  SELECT event_id, unnest(['transport_type', 'distance_km']), unnest(['tag', 'number']),
         unnest([transport_type, NULL]), unnest([NULL, k::DOUBLE]), unnest([NULL::BOOLEAN, NULL])
  FROM ev WHERE event_type = 'transportation'
  UNION ALL
  SELECT event_id, unnest(['relationship_type', 'is_positive', 'intensity', 'requires_relationship_processing', 'people']),
         unnest(['tag', 'bool', 'number', 'bool', 'nested']),
         unnest([relationship_type, NULL, NULL, NULL, '{"group_size":' || (k % 5) || '}']),
         unnest([NULL, NULL, intensity, NULL, NULL]),
         unnest([NULL, is_positive, NULL, requires_relationship_processing, NULL])
  FROM ev WHERE event_type = 'relationship'
  UNION ALL
  SELECT event_id, unnest(['severity_num', 'violation_type', 'fine_amount', 'case_note']),
         unnest(['number', 'tag', 'number', CASE WHEN strlen(memo) < 50 THEN 'tag' ELSE 'text' END]),
         unnest([NULL, 'traffic', NULL, memo]), unnest([severity_num, NULL, k * 10.0::DOUBLE, NULL]),
         unnest([NULL::BOOLEAN, NULL, NULL, NULL])
  FROM (SELECT *, 'note ' || repeat('é', k % 40) AS memo FROM ev) WHERE event_type = 'legal'
  UNION ALL
  SELECT event_id, unnest(['initial_age', 'initial_score', 'citizen_type', 'initial_status']),
         unnest(['number', 'number', 'tag', 'tag']),
         unnest([NULL, NULL, CASE WHEN k % 2 = 0 THEN 'regular' ELSE 'student' END, 'active']),
         unnest([(18 + k % 60)::DOUBLE, CASE WHEN k % 10 <> 1 THEN 300.0 + k * 5 END::DOUBLE, NULL, NULL]),
         unnest([NULL::BOOLEAN, NULL, NULL, NULL])
  FROM ev WHERE event_type = 'system'
  UNION ALL
  SELECT event_id, unnest(['activity_type', 'duration_hours', 'participants_count']), unnest(['tag', 'number', 'number']),
         unnest(['park', NULL, NULL]), unnest([NULL, (k % 8)::DOUBLE, k::DOUBLE]), unnest([NULL::BOOLEAN, NULL, NULL])
  FROM ev WHERE event_type = 'social'),
kvs AS (SELECT * FROM kv WHERE kind IN ('tag', 'text', 'nested', 'bool') OR num IS NOT NULL)"""


def _kv(body: str) -> str:
    return sql("ev", "").rstrip() + ",\n" + _PAYLOAD_KEYS + "\n" + body


@query("b01_flatten", sql("ev", f"""SELECT event_id, subject_id, event_type, {tstr('ts')} AS ts, city, region, country,
  {r6('latitude')} AS latitude, {r6('longitude')} AS longitude FROM ev"""))
def _(spark, d):
    nested = events(spark, d).select("event_id", "subject_id", "event_type", F.col("ts").alias("timestamp"), F.struct(
        "city", "region", "country", "latitude", "longitude").alias("location"))
    return M.flatten(nested).select("event_id", "subject_id", "event_type", "ts", "city", "region", "country",
                                    *_g(latitude=F.col("latitude"), longitude=F.col("longitude")))


@query("b02_payload_split", _kv(f"""SELECT event_id, CASE WHEN kind = 'tag' THEN 'p_' ELSE 'payload_' END || key AS name,
  kind, CASE WHEN kind IN ('tag', 'text', 'nested') THEN txt END AS text_value, {r6('num')} AS number_value,
  flag AS flag_value FROM kvs"""))
def _(spark, d):
    rows = M.payload_rows(events(spark, d, payload=True), "event_id")
    return rows.select("event_id", F.concat(F.when(F.col("kind") == "tag", "p_").otherwise("payload_"), "key")
                       .alias("name"), "kind",
                       F.when(F.col("kind").isin("tag", "text", "nested"), F.col("text")).alias("text_value"),
                       on_grid(F.when(F.col("kind") == "number", F.col("number"))).alias("number_value"),
                       F.col("flag").alias("flag_value"))


@query("b03_payload_text", sql("ev", """SELECT event_id, CASE event_type
  WHEN 'transportation' THEN '{"transport_type":"' || transport_type || '","distance_km":' || k || '}'
  WHEN 'relationship' THEN '{"relationship_type":"' || relationship_type || '","is_positive":' || is_positive ||
    ',"intensity":' || intensity || ',"requires_relationship_processing":' || requires_relationship_processing ||
    ',"people":{"group_size":' || (k % 5) || '}}'
  WHEN 'social' THEN '{"activity_type":"park","duration_hours":' || (k % 8) || ',"participants_count":' || k || '}'
  ELSE '{}' END AS payload FROM ev WHERE event_type NOT IN ('financial', 'legal', 'system')"""))
def _(spark, d):
    df = events(spark, d, payload=True).filter("event_type not in ('financial', 'legal', 'system')")
    return df.select("event_id", M.payload_text(df).alias("payload"))


@query("b04_measurement", sql("ev", "SELECT 'event_' || lower(event_type) AS measurement, count(*) AS n FROM ev GROUP BY 1"))
def _(spark, d):
    return events(spark, d).groupBy(M.measurement().alias("measurement")).agg(F.count("*").alias("n"))


@query("b06_latency", sql("ev", f"SELECT event_id, {feature('latency_ms')}, {feature('latency_us')} FROM ev"))
def _(spark, d):
    return events(spark, d).select("event_id", risk.latency_ms().alias("latency_ms"),
                                   risk.latency_us().alias("latency_us"))


@query("b07_b08_keys", sql("pe", f"""SELECT event_id, {feature('processing_id')}, country || '_' || region AS geographic_segment,
  event_type || '_' || {X['analytic_tier']} AS data_segment, 'segment_' || {X['analytic_tier']} AS subject_segment FROM pe"""))
def _(spark, d):
    return processed(spark, d).select("event_id", "processing_id", *_t(
        geographic_segment=bands.geographic_segment(), data_segment=bands.data_segment(),
        subject_segment=bands.subject_segment()))


@query("a10_event_points", _kv(f"""SELECT measurement, event_id, n_tags, n_fields, processing_time_ms, score FROM (
  SELECT 'event_' || event_type AS measurement, event_id, {X['latency_ms']} AS processing_time_ms, new_score AS score FROM pe) p
  JOIN (SELECT e.event_id, count(*) FILTER (kind = 'tag') AS n_tags, count(key) FILTER (kind <> 'tag') AS n_fields
        FROM ev e LEFT JOIN kvs USING (event_id) GROUP BY 1) USING (event_id)""").replace(
    sql("ev", "").rstrip(), sql("pe", "").rstrip(), 1))
def _(spark, d):
    return M.event_points(processed(spark, d)).select(
        "measurement", "event_id", F.size("tags").cast("bigint").alias("n_tags"),
        F.size("fields").cast("bigint").alias("n_fields"), "processing_time_ms", F.col("new_score").alias("score"))


@query("b10_score_snapshots", sql("pe", f"""SELECT subject_id, event_type AS trigger_event, city, region, country,
  {feature('processing_id')}, new_score AS score, score_change, previous_score, {r6('confidence')} AS confidence,
  n_rules::INT AS rules_applied, event_id, 'success' AS status, NULL::VARCHAR AS error, {tstr('processed_at')} AS time FROM pe"""))
def _(spark, d):
    return M.score_snapshots(processed(spark, d)).withColumn("confidence", on_grid(F.col("confidence")))


@query("b11_rule_executions", sql("pe", f"""SELECT f.rule_id AS rule_name, subject_id, event_type, event_id,
  score_change AS score_impact, {r6('f.rule_points')} AS rule_impact, new_score AS subject_score,
  {tstr('processed_at')} AS time FROM pe JOIN fired f USING (event_id)"""))
def _(spark, d):
    return M.rule_executions(processed(spark, d)).select(
        "rule_name", "subject_id", "event_type", "event_id", "score_impact", "rule_impact", "subject_score", "time")


@query("b12_location_records", sql("pe", f"""SELECT event_type, city, region, country, 'success' AS status,
  score_change AS total_score_change, 0 AS error_count, 1 AS success_count, {tstr('processed_at')} AS time FROM pe"""))
def _(spark, d):
    return M.location_records(processed(spark, d)).select(
        "event_type", "city", "region", "country", "status", "total_score_change", "error_count", "success_count",
        "time")


def _r(*pairs):
    return ", ".join(feature(a, b) for a, b in pairs)


@query("b13_behaviour", sql("pe", "SELECT subject_id, event_id, event_type, event_subtype, " + _r(
    ("behaviour_pattern", "behaviour_pattern"), ("time_of_day", "time_of_day"), ("weekday", "day_of_week"),
    ("month", "month"), ("consistency", "behaviour_consistency"), ("location_mobility", "location_mobility"))
    + ", score_change AS score_impact, new_score AS cumulative_score, n_rules::INT AS rules_triggered_count FROM pe"))
def _(spark, d):
    return M.behaviour_records(processed(spark, d)).select(
        "subject_id", "event_id", "event_type", "event_subtype", "behaviour_pattern", "time_of_day", "day_of_week",
        "month", *_g(behaviour_consistency=F.col("behaviour_consistency"),
                     location_mobility=F.col("location_mobility")),
        "score_impact", "cumulative_score", "rules_triggered_count")


@query("b13_comparison", sql("pe", "SELECT event_id, event_type, " + _r(
    ("analytic_tier", "score_tier"), ("change_direction", "score_change_dir"), ("hour_bucket", "time_bucket"),
    ("percentile_estimate", "percentile_rank"), ("z_estimate", "z_score"))
    + ", region, country, score_change AS total_score_change FROM pe"))
def _(spark, d):
    return M.comparison_records(processed(spark, d)).select(
        "event_id", "event_type", "score_tier", "score_change_dir", "time_bucket",
        *_g(percentile_rank=F.col("percentile_rank"), z_score=F.col("z_score")), "region", "country",
        "total_score_change")


@query("b13_trend", sql("pe", "SELECT event_id, event_type, country || '_' || region AS geographic_segment, " + _r(
    ("trend_category", "trend_category"), ("week_label", "time_window"), ("analytic_tier", "score_tier"),
    ("trend_direction", "trend_direction"), ("trend_magnitude", "trend_magnitude"),
    ("trend_velocity", "trend_velocity"), ("trend_stability", "trend_stability_index")) + " FROM pe"))
def _(spark, d):
    return M.trend_records(processed(spark, d)).select(
        "event_id", "event_type", "geographic_segment", "trend_category", "time_window", "score_tier",
        *_g(**{c: F.col(c) for c in ("trend_direction", "trend_magnitude", "trend_velocity",
                                     "trend_stability_index")}))


@query("b13_statistics", sql("pe", f"""SELECT event_id, event_type || '_' || {X['analytic_tier']} AS data_segment,
  'real_time_stats' AS analysis_type, event_type, region, 1 AS sample_size, new_score AS mean_score FROM pe"""))
def _(spark, d):
    return M.statistics_records(processed(spark, d)).select(
        "event_id", "data_segment", "analysis_type", "event_type", "region", "sample_size", "mean_score")


@query("b13_geography", sql("pe", "SELECT event_id, country, region, city, " + _r(
    ("geographic_tier", "geographic_tier"), ("urban_class", "urban_rural"),
    ("geographic_mobility", "geographic_mobility"), ("distance_from_centre", "distance_from_center"),
    ("population_density", "population_density_est"), ("economic_index", "economic_indicator"))
    + ", new_score AS regional_score_avg FROM pe"))
def _(spark, d):
    return M.geography_records(processed(spark, d)).select(
        "event_id", "country", "region", "city", "geographic_tier", "urban_rural",
        *_g(**{c: F.col(c) for c in ("geographic_mobility", "distance_from_center", "population_density_est",
                                     "economic_indicator")}), "regional_score_avg")


_RISK = (("risk_category", "risk_category"), ("risk_level", "risk_level"), ("alert_level", "alert_level"),
         ("risk_score", "risk_score"), ("default_probability", "probability_default"),
         ("early_warning", "early_warning_signal"), ("mitigation", "risk_mitigation_factor"),
         ("fraud_score", "fraud_detection_score"), ("anomaly", "anomaly_detection_score"),
         ("predictive_risk_30d", "predictive_risk_30d"), ("predictive_risk_90d", "predictive_risk_90d"),
         ("volatility", "volatility_index"))


def _risk_out(df):
    return df.select("event_id", "event_type", "subject_segment", "risk_category", "risk_level", "alert_level",
                     *_g(**{b: F.col(b) for a, b in _RISK[3:]}))


_RISK_SQL = ("SELECT event_id, event_type, 'segment_' || " + X["analytic_tier"] + " AS subject_segment, "
             + _r(*_RISK) + " FROM pe")


@query("b13_risk", sql("pe", _RISK_SQL))
def _(spark, d):
    return _risk_out(M.risk_records(processed(spark, d)))


@query("c08_alerts", sql("pe", f"{_RISK_SQL} WHERE abs(score_change) >= 50 OR score_change < -25"))
def _(spark, d):
    return _risk_out(M.alerts(processed(spark, d)))


@query("b13_performance", sql("pe", "SELECT event_id, source_system AS data_source, " + _r(
    ("latency_ms", "processing_latency_ms"), ("latency_us", "processing_latency_us"),
    ("data_quality", "data_quality_score"), ("efficiency", "processing_efficiency"))
    + ", 0.0::DOUBLE AS error_rate, 100.0::DOUBLE AS success_rate FROM pe"))
def _(spark, d):
    return M.performance_records(processed(spark, d)).select(
        "event_id", "data_source", "processing_latency_ms", "processing_latency_us",
        *_g(data_quality_score=F.col("data_quality_score"), processing_efficiency=F.col("processing_efficiency")),
        "error_rate", "success_rate")


@query("b14_score_changes", sql("pe", f"""SELECT subject_id, event_id, event_type, previous_score, new_score, score_change,
  applied_rules, {tier5('previous_score')} AS previous_tier, {tier5('new_score')} AS new_tier, city AS location,
  {X['change_direction']} AS change_type, split_part(applied_rules, ',', 1) AS triggering_rule_id FROM pe"""))
def _(spark, d):
    return M.score_changes(processed(spark, d)).select(
        "subject_id", "event_id", "event_type", "previous_score", "new_score", "score_change", "applied_rules",
        "previous_tier", "new_tier", "location", "change_type", "triggering_rule_id")
