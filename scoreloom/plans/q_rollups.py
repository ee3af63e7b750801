"""Rollups over processed events (G, D4, D7, W8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.functions.numeric import on_grid
from scoreloom.operators import measures as M
from scoreloom.operators import rollups as R
from scoreloom.operators.graph import association_risk
from scoreloom.operators.rules import fired_rows
from scoreloom.operators.scoring import latest_state
from scoreloom.plans.registry import query
from scoreloom.plans.sqlbase import CTES, X, dstr, r6, sql, tier5, tstr
from scoreloom.plans.tables import edges, processed, profiles


def _round(df, *names):
    return df.withColumns({n: on_grid(F.col(n)) for n in names})


CTES["daily"] = (("pe",), f"""daily AS MATERIALIZED (
  SELECT subject_id, region, ts::DATE AS day, count(*) AS total_events, sum(score_change) AS score_change,
         max(severity_num) AS max_severity, count(DISTINCT event_type) AS unique_event_types,
         arg_max(new_score, (ts, event_id)) AS day_end_score, {tier5('arg_max(new_score, (ts, event_id))')} AS tier
  FROM pe GROUP BY ALL)""")
CTES["system"] = (("daily",), """system AS MATERIALIZED (
  SELECT day, CASE WHEN grouping(region) = 1 THEN 'ALL' ELSE region END AS region, count(*) AS active_subjects,
         sum(total_events)::BIGINT AS total_events, sum(day_end_score) AS score_sum, avg(day_end_score) AS average_score,
         median(day_end_score) AS median_score, min(day_end_score) AS min_score, max(day_end_score) AS max_score,
         var_pop(day_end_score) AS score_variance,
         count(*) FILTER (tier = 'very_poor') AS tier_very_poor_count, count(*) FILTER (tier = 'poor') AS tier_poor_count,
         count(*) FILTER (tier = 'average') AS tier_average_count, count(*) FILTER (tier = 'good') AS tier_good_count,
         count(*) FILTER (tier = 'excellent') AS tier_excellent_count,
         count(*) FILTER (tier = 'unknown') AS tier_unknown_count
  FROM daily GROUP BY GROUPING SETS ((day, region), (day)))""")
_TIER_COUNTS = [f"tier_{t}_count" for t in ("very_poor", "poor", "average", "good", "excellent", "unknown")]


@query("g02_hourly_activity", sql("pe", f"""SELECT subject_id, region, {tstr("date_trunc('hour', ts)")} AS window_start,
  count(*) AS event_count, count(DISTINCT event_type) AS unique_event_types, {r6('sum(score_change)')} AS net_score_impact,
  {r6('avg(severity_num)')} AS average_severity FROM pe GROUP BY subject_id, region, date_trunc('hour', ts)"""))
def _(spark, d):
    return _round(R.hourly_activity(processed(spark, d)), "net_score_impact", "average_severity").drop("severity_sum")


@query("g02_sliding_day", sql("pe", f"""SELECT subject_id, region, {tstr('w')} AS window_start, count(*) AS event_count,
  count(DISTINCT event_type) AS unique_event_types, {r6('sum(score_change)')} AS net_score_impact,
  {r6('avg(severity_num)')} AS average_severity
FROM (SELECT *, date_trunc('day', ts) + to_hours(6 * i) - INTERVAL 18 HOUR AS w FROM pe, range(0, 7) t(i))
WHERE ts >= w AND ts < w + INTERVAL 24 HOUR GROUP BY subject_id, region, w"""))
def _(spark, d):
    out = R.hourly_activity(processed(spark, d), "24 hours", "6 hours")
    return _round(out, "net_score_impact", "average_severity").drop("severity_sum")


@query("g03_daily_subject", sql("daily", f"""SELECT subject_id, region, {dstr('day')} AS day, total_events,
  {r6('score_change')} AS score_change, {r6('max_severity')} AS max_severity, unique_event_types, day_end_score, tier
FROM daily"""))
def _(spark, d):
    return _round(R.daily_subject(processed(spark, d)), "score_change", "max_severity")


@query("g04_system_daily", sql("system", f"""SELECT {dstr('day')} AS day, region, active_subjects, total_events,
  {r6('score_sum')} AS score_sum, {r6('average_score')} AS average_score, {r6('median_score')} AS median_score, min_score,
  max_score, {r6('score_variance')} AS score_variance, {', '.join(_TIER_COUNTS)} FROM system"""))
def _(spark, d):
    return _round(R.daily_system(R.daily_subject(processed(spark, d))), "score_sum", "average_score", "median_score",
                  "score_variance")


_DOWN = ("region, sum(total_events)::BIGINT AS total_events, sum(active_subjects)::BIGINT AS subject_days, "
         f"{r6('sum(score_sum)')} AS score_sum, min(min_score) AS min_score, max(max_score) AS max_score, "
         f"{r6('sum(score_sum) / sum(active_subjects)')} AS average_score")


@query("g05_thirty_days", sql("system", f"""SELECT {dstr("time_bucket(INTERVAL 30 DAY, day, DATE '1970-01-01')")} AS period,
  {_DOWN} FROM system GROUP BY time_bucket(INTERVAL 30 DAY, day, DATE '1970-01-01'), region"""))
def _(spark, d):
    daily = R.daily_system(R.daily_subject(processed(spark, d)))
    return _round(R.downsample(daily, R.thirty_days()), "score_sum", "average_score")


@query("g05_calendar_month", sql("system", f"""SELECT {dstr("date_trunc('month', day)")} AS period, {_DOWN}
FROM system GROUP BY date_trunc('month', day), region"""))
def _(spark, d):
    daily = R.daily_system(R.daily_subject(processed(spark, d)))
    return _round(R.downsample(daily, R.calendar_month()), "score_sum", "average_score")


@query("g05_events_monthly", sql("pe", f"""SELECT subject_id, event_type,
  {dstr("time_bucket(INTERVAL 30 DAY, ts::DATE, DATE '1970-01-01')")} AS period, count(*) AS event_count,
  {r6('sum(score_change)')} AS total_impact FROM pe
GROUP BY subject_id, event_type, time_bucket(INTERVAL 30 DAY, ts::DATE, DATE '1970-01-01')"""))
def _(spark, d):
    return _round(R.events_monthly(processed(spark, d)), "total_impact")


@query("g06_daily_events", sql("pe", f"""SELECT {dstr('ts::DATE')} AS day, subject_id, event_type, count(*) AS event_count,
  {r6('sum(score_change)')} AS total_score_impact, {r6('avg(score_change)')} AS avg_score_impact,
  count(*) FILTER (score_change > 0) AS positive_events, count(*) FILTER (score_change < 0) AS negative_events
FROM pe GROUP BY ts::DATE, subject_id, event_type"""))
def _(spark, d):
    return _round(R.daily_events(processed(spark, d)), "total_score_impact", "avg_score_impact")


@query("g07_weekly_changes", sql("pe", f"""SELECT {dstr("time_bucket(INTERVAL 7 DAY, ts::DATE, DATE '1970-01-01')")} AS week,
  subject_id, {r6('sum(score_change)')} AS total_change, count(*) AS change_count
FROM pe WHERE score_change <> 0 GROUP BY time_bucket(INTERVAL 7 DAY, ts::DATE, DATE '1970-01-01'), subject_id"""))
def _(spark, d):
    return _round(R.weekly_changes(processed(spark, d)), "total_change")


@query("g08_daily_from_hourly", sql("pe", f"""SELECT subject_id, {dstr('ts::DATE')} AS day, count(*) AS event_count,
  {r6('sum(score_change)')} AS net_score_impact FROM pe GROUP BY subject_id, ts::DATE"""))
def _(spark, d):
    return _round(R.daily_from_hourly(R.hourly_activity(processed(spark, d))), "net_score_impact")


_AGE = """CASE WHEN age < 18 THEN 'under-18' WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35' WHEN age <= 45 THEN '36-45'
  WHEN age <= 55 THEN '46-55' WHEN age <= 65 THEN '56-65' ELSE '66+' END"""


@query("g09_regional_scores", sql(("daily", "prof"), f"""SELECT region, {dstr('day')} AS day, age_group, gender,
  count(*) AS total_subjects, {r6('avg(day_end_score)')} AS avg_score, {r6('median(day_end_score)')} AS median_score,
  min(day_end_score) AS min_score, max(day_end_score) AS max_score, {r6('var_pop(day_end_score)')} AS score_variance,
  {', '.join(f"count(*) FILTER (tier = '{t[5:-6]}') AS {t}" for t in _TIER_COUNTS)},
  count(*) FILTER (day_end_score > prev) AS score_improvement_count,
  count(*) FILTER (day_end_score < prev) AS score_deterioration_count,
  concat_ws(',', {', '.join(f"CASE WHEN count(*) FILTER (tier = '{t}') > 0 THEN '{t}=' || count(*) FILTER (tier = '{t}') END"
                            for t in ('average', 'excellent', 'good', 'poor', 'unknown', 'very_poor'))}) AS tier_distribution
FROM (SELECT d.*, {_AGE} AS age_group, gender, lag(day_end_score) OVER (PARTITION BY subject_id ORDER BY day) AS prev
      FROM daily d JOIN prof USING (subject_id)) GROUP BY region, day, age_group, gender"""))
def _(spark, d):
    out = R.regional_scores(R.daily_subject(processed(spark, d)), profiles(spark, d))
    return _round(out, "avg_score", "median_score", "score_variance")


_SUMMARY = f"""count(*) AS event_count, {r6('sum(score_change)')} AS total_score_impact,
  {r6('avg(score_change)')} AS avg_score_impact, count(DISTINCT subject_id) AS distinct_subjects,
  {r6('avg(severity_num)')} AS average_severity"""


@query("g10_event_summary", sql("pe", f"""SELECT event_type, event_subtype, region, {dstr('ts::DATE')} AS day, {_SUMMARY}
FROM pe GROUP BY event_type, event_subtype, region, ts::DATE"""))
def _(spark, d):
    return _round(R.event_summary(processed(spark, d)), "total_score_impact", "avg_score_impact", "average_severity")


@query("g10_event_summary_demographics", sql(("pe", "prof"), f"""SELECT event_type, event_subtype, region,
  {dstr('ts::DATE')} AS day, age_group, gender, {_SUMMARY}
FROM (SELECT pe.*, {_AGE} AS age_group, gender FROM pe JOIN prof USING (subject_id))
GROUP BY event_type, event_subtype, region, ts::DATE, age_group, gender"""))
def _(spark, d):
    rows = R.with_demographics(processed(spark, d), profiles(spark, d))
    out = R.event_summary(rows, ("event_type", "event_subtype", "region", "day", "age_group", "gender"))
    return _round(out, "total_score_impact", "avg_score_impact", "average_severity")


@query("g11_score_history", sql("pe", f"""SELECT subject_id, {dstr('ts::DATE')} AS day, new_score AS score,
  {tier5('new_score')} AS tier, event_type AS change_reason, split_part(applied_rules, ',', 1) AS rule_id
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, ts::DATE ORDER BY ts DESC, event_id DESC) AS back FROM pe)
WHERE back = 1"""))
def _(spark, d):
    return R.day_end_scores(processed(spark, d))


@query("d04_daily_with_scores", sql("daily", f"""SELECT subject_id, {dstr('day')} AS day, total_events,
  {r6('score_change')} AS score_change, day_end_score, tier AS current_tier FROM daily"""))
def _(spark, d):
    pe = processed(spark, d)
    totals = (pe.groupBy("subject_id", F.to_date("ts").alias("day"))
              .agg(F.count("*").alias("total_events"), on_grid(F.sum("score_change")).alias("score_change")))
    return R.daily_with_scores(totals, R.day_end_scores(pe))


@query("d07_demographics", sql(("ev", "prof"), f"""SELECT event_id, subject_id, event_type, {_AGE} AS age_group, gender
FROM ev LEFT JOIN prof USING (subject_id)"""))
def _(spark, d):
    return R.with_demographics(processed(spark, d).select("event_id", "subject_id", "event_type"), profiles(spark, d))


@query("w08_improved_worsened", sql("daily", f"""SELECT subject_id, {dstr('day')} AS day, score, previous_day_score,
  coalesce(score > previous_day_score, false) AS improved, coalesce(score < previous_day_score, false) AS worsened
FROM (SELECT subject_id, day, day_end_score AS score, lag(day_end_score) OVER (PARTITION BY subject_id ORDER BY day)
        AS previous_day_score FROM daily)"""))
def _(spark, d):
    return R.improved_worsened(R.day_end_scores(processed(spark, d))).drop("tier", "change_reason", "rule_id")


_ASSOC = """assoc AS (
  SELECT src AS subject_id, sum(strength * (1000.0::DOUBLE - score) / 1000.0::DOUBLE) / sum(strength) AS association_risk
  FROM (SELECT DISTINCT src, dst, rel, strength FROM edge) e JOIN latest l ON l.subject_id = e.dst GROUP BY src)"""


@query("g12_activity_metrics", sql(("latest", "edge"), "").rstrip() + ",\n" + _ASSOC + f"""
SELECT p.*, {r6('a.association_risk')} AS association_risk FROM (
  SELECT subject_id, region, {r6("sum(CASE WHEN event_type = 'financial' THEN score_change ELSE 0 END)")} AS financial_activity_score,
    {r6("sum(CASE WHEN event_type = 'social' THEN score_change ELSE 0 END)")} AS social_activity_score,
    {r6("sum(CASE WHEN event_type = 'system' THEN score_change ELSE 0 END)")} AS online_activity_score,
    count(*) FILTER (score_change > 0) AS total_positive_events, count(*) FILTER (score_change < 0) AS total_negative_events,
    {r6('regr_slope(score_change, date_diff(' + "'day', DATE '1970-01-01', ts::DATE)::DOUBLE)")} AS activity_trend,
    arg_max(new_score, (ts, event_id)) AS current_score
  FROM pe GROUP BY subject_id, region) p LEFT JOIN assoc a USING (subject_id)""")
def _(spark, d):
    pe = processed(spark, d)
    out = R.subject_activity_metrics(pe, association_risk(edges(spark, d), latest_state(pe)))
    return _round(out, "financial_activity_score", "social_activity_score", "online_activity_score", "activity_trend",
                  "association_risk")


@query("g13_location_rollup", sql("pe", f"""SELECT event_type, city, region, country, 'success' AS status,
  count(*) AS event_count, {r6('sum(score_change)')} AS total_score_change, {r6('avg(confidence)')} AS avg_confidence,
  count(DISTINCT subject_id) AS subject_count, 0::BIGINT AS error_count, count(*) AS success_count
FROM pe GROUP BY event_type, city, region, country"""))
def _(spark, d):
    return _round(R.location_rollup(processed(spark, d)), "total_score_change", "avg_confidence")


@query("g14_rule_rollup", sql("pe", f"""SELECT f.rule_id AS rule_name, event_type, count(*) AS executions,
  {r6('sum(score_change)')} AS score_impact, {r6('sum(' + r6('rule_points') + ')')} AS rule_impact,
  count(DISTINCT subject_id) AS distinct_subjects FROM pe JOIN fired f USING (event_id) GROUP BY f.rule_id, event_type"""))
def _(spark, d):
    return _round(R.rule_rollup(M.rule_executions(processed(spark, d))), "score_impact", "rule_impact")


@query("g15_comparison_segments", sql("pe", f"""SELECT event_type, {X['analytic_tier']} AS score_tier,
  {X['change_direction']} AS score_change_dir, region, country, {X['hour_bucket']} AS time_bucket, count(*) AS n,
  {r6('sum(score_change)')} AS total_score_change, {r6('avg(score_change)')} AS avg_score_change,
  max(score_change) AS max_score_change, min(score_change) AS min_score_change, {r6('var_pop(new_score)')} AS score_variance
FROM pe GROUP BY 1, 2, 3, 4, 5, 6"""))
def _(spark, d):
    return _round(R.comparison_segments(M.comparison_records(processed(spark, d))), "total_score_change",
                  "avg_score_change", "score_variance")


@query("g16_statistics", sql("pe", f"""SELECT data_segment, event_type, region, n AS sample_size, {r6('m')} AS mean_score,
  {r6('md')} AS median_score, mode_score, {r6('sd')} AS std_deviation, {r6('vs')} AS variance,
  {r6('m - 1.96::DOUBLE * sd / sqrt(n)')} AS ci_low, {r6('m + 1.96::DOUBLE * sd / sqrt(n)')} AS ci_high,
  CASE WHEN n > 2 AND vs > 1e-9 THEN {r6('sk * (n - 2) / sqrt(n * (n - 1.0::DOUBLE))')} END AS skewness,
  CASE WHEN n > 2 AND vs > 1e-9 THEN {r6('ku')} END AS kurtosis
FROM (SELECT data_segment, event_type, region, count(*) AS n, avg(new_score) AS m, median(new_score) AS md,
        stddev_samp(new_score) AS sd, var_samp(new_score) AS vs, skewness(new_score) AS sk, kurtosis_pop(new_score) AS ku
      FROM (SELECT *, event_type || '_' || {X['analytic_tier']} AS data_segment FROM pe) GROUP BY ALL)
JOIN (SELECT data_segment, event_type, region, new_score AS mode_score FROM (
        SELECT event_type || '_' || {X['analytic_tier']} AS data_segment, event_type, region, new_score, count(*) AS c
        FROM pe GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY data_segment, event_type, region ORDER BY c DESC, new_score) = 1)
USING (data_segment, event_type, region)"""))
def _(spark, d):
    out = R.statistical_profile(M.statistics_records(processed(spark, d)))
    usable = (F.col("sample_size") > 2) & (F.col("variance") > 1e-9)
    out = out.withColumns({c: F.when(usable, F.col(c)) for c in ("skewness", "kurtosis")})
    return _round(out, "mean_score", "median_score", "std_deviation", "variance", "skewness", "kurtosis", "ci_low",
                  "ci_high")


@query("g17_regression", sql("pe", f"""SELECT data_segment, count(*) AS n,
  CASE WHEN count(*) > 2 THEN {r6('corr(new_score, confidence)')} END AS correlation,
  CASE WHEN count(*) > 2 THEN {r6('regr_slope(new_score, confidence)')} END AS regression_coefficient
FROM (SELECT *, event_type || '_' || {X['analytic_tier']} AS data_segment FROM pe) GROUP BY data_segment"""))
def _(spark, d):
    out = R.segment_regression(M.statistics_records(processed(spark, d)))
    names = ("correlation", "regression_coefficient")
    return _round(out.withColumns({c: F.when(F.col("n") > 2, F.col(c)) for c in names}), *names)


@query("g18_geographic_density", sql("pe", f"""SELECT country, region, city, {X['geographic_tier']} AS geographic_tier,
  count(*) AS geographic_density, {r6('avg(new_score)')} AS regional_score_avg FROM pe GROUP BY 1, 2, 3, 4"""))
def _(spark, d):
    return _round(R.geographic_density(M.geography_records(processed(spark, d))), "regional_score_avg")


@query("g19_operations", sql("pe", f"""SELECT source_system, {tstr("date_trunc('hour', processed_at)")} AS window_start,
  count(*) AS events, {r6('count(*) / 3600.0::DOUBLE')} AS throughput_per_sec, 0.0::DOUBLE AS error_rate,
  100.0::DOUBLE AS success_rate, {r6('avg(' + X['latency_ms'] + ')')} AS latency_ms_mean,
  quantile_disc({X['latency_ms']}, 0.5) AS latency_ms_p50, quantile_disc({X['latency_ms']}, 0.95) AS latency_ms_p95,
  {r6('avg(' + X['data_quality'] + ')')} AS data_quality_score
FROM pe GROUP BY source_system, date_trunc('hour', processed_at)"""))
def _(spark, d):
    out = _round(R.operations(processed(spark, d)), "throughput_per_sec", "latency_ms_mean", "data_quality_score")
    return out.withColumns({c: F.col(c).cast("double") for c in ("error_rate", "success_rate")})


@query("g20_subject_summary", sql("pe", f"""SELECT subject_id, {dstr('ts::DATE')} AS day, count(*) AS event_count,
  {r6('sum(score_change)')} AS total_score_change, {r6('avg(confidence)')} AS avg_confidence,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types, arg_max(city, (ts, event_id)) AS location_city,
  arg_max(region, (ts, event_id)) AS location_region FROM pe GROUP BY subject_id, ts::DATE"""))
def _(spark, d):
    return _round(R.subject_summary(processed(spark, d)), "total_score_change", "avg_confidence")


@query("g21_system_summary", sql("pe", f"""SELECT {dstr('t.day')} AS day, total_events, total_subjects, avg_score_change,
  avg_latency_ms, top_event_types, active_regions
FROM (SELECT ts::DATE AS day, count(*) AS total_events, count(DISTINCT subject_id) AS total_subjects,
        {r6('avg(score_change)')} AS avg_score_change, {r6('avg(' + X['latency_ms'] + ')')} AS avg_latency_ms,
        string_agg(DISTINCT region, ',' ORDER BY region) AS active_regions FROM pe GROUP BY 1) t
JOIN (SELECT day, string_agg(event_type, ',' ORDER BY n DESC, event_type) AS top_event_types FROM (
        SELECT ts::DATE AS day, event_type, count(*) AS n FROM pe GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY ts::DATE ORDER BY count(*) DESC, event_type) <= 3) GROUP BY day) k
USING (day)"""))
def _(spark, d):
    return _round(R.system_summary(processed(spark, d)), "avg_score_change", "avg_latency_ms")


@query("l04_top_types", sql("pe", """SELECT region, string_agg(event_type, ',' ORDER BY n DESC, event_type) AS top_event_types
FROM (SELECT region, event_type, count(*) AS n FROM pe GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, event_type) <= 2) GROUP BY region"""))
def _(spark, d):
    return R.top_types(processed(spark, d), ["region"], 2)


@query("g22_rule_state", sql("pe", f"""SELECT subject_id, f.rule_id, count(*) AS application_count, {tstr('max(ts)')} AS last_applied,
  {tstr('max(ts) + INTERVAL 1 DAY')} AS cooldown_until FROM pe JOIN fired f USING (event_id) GROUP BY subject_id, f.rule_id"""))
def _(spark, d):
    return R.rule_state(fired_rows(processed(spark, d), "subject_id", "ts"), F.lit(86400.0).cast("decimal(18,6)"))


@query("g23_behaviour_rollup", sql("pe", f"""SELECT {X['behaviour_pattern']} AS behaviour_pattern, {X['time_of_day']} AS time_of_day,
  {X['weekday']} AS day_of_week, {X['month']} AS month, count(*) AS n, {r6('avg(score_change)')} AS mean_impact,
  {r6('avg(' + X['consistency'] + ')')} AS mean_consistency FROM pe GROUP BY 1, 2, 3, 4"""))
def _(spark, d):
    return _round(R.behaviour_rollup(M.behaviour_records(processed(spark, d))), "mean_impact", "mean_consistency")


@query("g24_risk_rollup", sql("pe", f"""SELECT {X['risk_category']} AS risk_category, {X['risk_level']} AS risk_level,
  {X['alert_level']} AS alert_level, count(*) AS n, {r6('avg(' + X['risk_score'] + ')')} AS mean_risk,
  {r6('max(' + X['fraud_score'] + ')')} AS max_fraud FROM pe GROUP BY 1, 2, 3"""))
def _(spark, d):
    return _round(R.risk_rollup(M.risk_records(processed(spark, d))), "mean_risk", "max_fraud")
