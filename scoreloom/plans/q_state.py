"""Running score, onboarding, cooldown, decay, propagation, graph (T, N, D3, D6, D8, B5, W)."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from scoreloom.functions import behaviour
from scoreloom.functions.numeric import on_grid
from scoreloom.model import ALL_RULES, Decay, ScoreConfig
from scoreloom.operators import graph as G
from scoreloom.operators import windows as Wn
from scoreloom.operators.propagate import neighbour_deltas, spreading_events
from scoreloom.operators.rules import apply_rules
from scoreloom.operators.scoring import (apply_cooldown, error_rows_to_zero, last_write, latest_state, onboard,
                                         running_score_with_decay, score_events, with_profile)
from scoreloom.plans.q_rollups import _ASSOC
from scoreloom.plans.registry import query
from scoreloom.plans.sqlbase import CTES, X, dstr, fired_sql, fold_sql, r6, sql, tier5, tstr
from scoreloom.sources import star
from scoreloom.plans.tables import CONFIG, edges, events, processed, processed_with_neighbours, profiles

_ORDER = ["ts", "event_id"]


@query("t01_tiers_by_region", sql(("latest", "prof", "place"), f"""SELECT coalesce(p.region, '') AS region,
  {tier5('l.score')} AS tier, count(*) AS subjects, {r6('avg(l.score)')} AS mean_score
FROM latest l LEFT JOIN prof f USING (subject_id) LEFT JOIN place p ON p.nk = f.nation_key GROUP BY 1, 2"""))
def _(spark, d):
    pe = processed(spark, d)
    homes = profiles(spark, d).select("subject_id", F.col("nation_key").alias("n_nationkey"))
    final = (latest_state(pe).join(homes, "subject_id", "left")
             .join(F.broadcast(star.places(spark, d)), "n_nationkey", "left"))
    return (final.groupBy(F.coalesce("region", F.lit("")).alias("region"), "tier")
            .agg(F.count("*").alias("subjects"), on_grid(F.avg("score")).alias("mean_score")))


@query("t01_running_score", sql("pe", f"""SELECT event_id, subject_id, {tstr('ts')} AS ts, score_change, previous_score, new_score
FROM pe"""))
def _(spark, d):
    """The whole job without the stored table: events, profiles, rules, running score."""
    pe = score_events(spark, events(spark, d), profiles(spark, d), ALL_RULES, CONFIG)
    return pe.select("event_id", "subject_id", "ts", "score_change", "previous_score", "new_score")


_MISSING = (f"""evm AS (SELECT e.*, p.type AS subject_type, coalesce(p.score, 500.0::DOUBLE) AS opening_score,
    p.subject_id IS NULL AS missing FROM ev e LEFT JOIN (SELECT * FROM prof WHERE balance >= 0) p USING (subject_id)),
firedm AS ({fired_sql('evm')}),
scm AS (SELECT e.*, {r6('coalesce(f.s, 0.0::DOUBLE)')} AS score_change, coalesce(f.ids, '') AS applied_rules
  FROM evm e LEFT JOIN (SELECT event_id, sum(rule_points ORDER BY ord) AS s, string_agg(rule_id, ',' ORDER BY ord) AS ids
                        FROM firedm GROUP BY event_id) f USING (event_id)),
""" + fold_sql("pem", "scm"))


def _known(spark, d):
    return profiles(spark, d).filter("balance >= 0")


@query("t02_baseline", sql(("ev", "prof"), "").rstrip() + ",\n" + _MISSING + """
SELECT event_id, subject_id, score_change, previous_score, new_score FROM pem""")
def _(spark, d):
    pe = score_events(spark, events(spark, d), _known(spark, d), ALL_RULES, CONFIG)
    return pe.select("event_id", "subject_id", "score_change", "previous_score", "new_score")


@query("b05_error_rows", sql(("ev", "prof"), "").rstrip() + ",\n" + _MISSING + """
SELECT event_id, subject_id, CASE WHEN missing THEN 0.0::DOUBLE ELSE score_change END AS score_change,
  CASE WHEN missing THEN NULL ELSE applied_rules END AS applied_rules,
  CASE WHEN missing THEN 'error' ELSE 'success' END AS status,
  CASE WHEN missing THEN 'subject profile not found' END AS processing_error FROM scm""")
def _(spark, d):
    joined = with_profile(events(spark, d), _known(spark, d), CONFIG, strict=True)
    scored = apply_rules(joined, ALL_RULES).withColumns({"previous_score": F.lit(0.0), "new_score": F.lit(0.0)})
    out = error_rows_to_zero(scored).withColumn("applied_rules", F.concat_ws(",", "applied_rules"))
    return out.select("event_id", "subject_id", "score_change",
                      F.when(F.col("status") == "success", F.col("applied_rules")).alias("applied_rules"), "status",
                      "processing_error")


@query("t03_onboard", sql("ev", f"""SELECT subject_id, 18 + k % 60 AS age, (300 + k * 5)::DOUBLE AS score,
  CASE WHEN k % 2 = 0 THEN 'regular' ELSE 'student' END AS type, 'active' AS status,
  CASE WHEN 300 + k * 5 >= 800 THEN 'excellent' WHEN 300 + k * 5 >= 600 THEN 'good' WHEN 300 + k * 5 >= 400 THEN 'average'
       ELSE 'poor' END AS tier, {tstr('ts')} AS created_at
FROM ev WHERE event_type = 'system' AND event_subtype = 'new_citizen' AND k % 10 <> 1
QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) = 1"""))
def _(spark, d):
    return onboard(events(spark, d, payload=True))[0]


@query("t03_onboard_rejects", sql("ev", """SELECT event_id, subject_id FROM ev
WHERE event_type = 'system' AND event_subtype = 'new_citizen' AND k % 10 = 1"""))
def _(spark, d):
    return onboard(events(spark, d, payload=True))[1].select("event_id", "subject_id")


_LIMITS = {"social_positive": (86400, 2), "financial_negative": (3 * 86400, 1), "relationship_positive": (43200, 1)}
COOLDOWN_RULES = tuple(replace(r, cooldown_seconds=_LIMITS[r.rule_id][0], max_in_period=_LIMITS[r.rule_id][1])
                       if r.rule_id in _LIMITS else r for r in ALL_RULES)

CTES["cool"] = (("pe",), f"""cf AS MATERIALIZED (
  SELECT f.*, p.subject_id, p.ts, epoch_us(p.ts)::BIGINT AS sec, l.len::BIGINT * 1000000 AS len, l.lim,
         row_number() OVER (PARTITION BY p.subject_id, f.rule_id ORDER BY p.ts, p.event_id) AS rn
  FROM fired f JOIN pe p USING (event_id)
  LEFT JOIN (VALUES {', '.join(f"('{r}', {s}, {n})" for r, (s, n) in _LIMITS.items())}) AS l(rule_id, len, lim) USING (rule_id)),
cw(subject_id, rule_id, rn, until, used, ok) AS (
  SELECT subject_id, rule_id, rn, sec + len, 1, true FROM cf WHERE rn = 1 AND len IS NOT NULL
  UNION ALL
  SELECT c.subject_id, c.rule_id, c.rn, CASE WHEN c.sec >= w.until THEN c.sec + c.len ELSE w.until END,
         CASE WHEN c.sec >= w.until THEN 1 WHEN w.used < c.lim THEN w.used + 1 ELSE w.used END,
         c.sec >= w.until OR w.used < c.lim
  FROM cw w JOIN cf c ON c.subject_id = w.subject_id AND c.rule_id = w.rule_id AND c.rn = w.rn + 1),
cool AS MATERIALIZED (
  SELECT cf.* FROM cf LEFT JOIN cw USING (subject_id, rule_id, rn) WHERE cf.len IS NULL OR cw.ok)""")


@query("t04_cooldown", sql("cool", f"""SELECT p.event_id, p.subject_id, coalesce(c.ids, '') AS applied_rules,
  {r6('coalesce(c.s, 0.0::DOUBLE)')} AS score_change FROM pe p LEFT JOIN (
  SELECT event_id, string_agg(rule_id, ',' ORDER BY ord) AS ids, sum(rule_points ORDER BY ord) AS s FROM cool GROUP BY event_id) c
USING (event_id)"""))
def _(spark, d):
    joined = with_profile(events(spark, d), profiles(spark, d))
    out = apply_cooldown(apply_rules(joined, COOLDOWN_RULES), COOLDOWN_RULES)
    return out.select("event_id", "subject_id", "applied_rules", "score_change")


DECAYING = ScoreConfig(decay=Decay(True, 3.0, 300.0))


@query("t05_decay", sql("sc", "").rstrip() + f""",
dseq AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) AS rn,
  date_diff('day', lag(ts::DATE) OVER (PARTITION BY subject_id ORDER BY ts, event_id), ts::DATE) AS idle FROM sc),
drun(subject_id, rn, before, after) AS (
  SELECT subject_id, rn, opening_score, least(greatest(opening_score + score_change, 0.0::DOUBLE), 1000.0::DOUBLE)
  FROM dseq WHERE rn = 1
  UNION ALL
  SELECT subject_id, rn, opened, least(greatest(opened + score_change, 0.0::DOUBLE), 1000.0::DOUBLE) FROM (
    SELECT s.subject_id, s.rn, s.score_change, CASE WHEN r.after <= 300 THEN r.after
             ELSE greatest(r.after - 3.0::DOUBLE * s.idle, 300.0::DOUBLE) END AS opened
    FROM drun r JOIN dseq s ON s.subject_id = r.subject_id AND s.rn = r.rn + 1))
SELECT event_id, subject_id, {r6('before')} AS previous_score, {r6('after')} AS new_score
FROM dseq JOIN drun USING (subject_id, rn)""")
def _(spark, d):
    scored = apply_rules(with_profile(events(spark, d), profiles(spark, d)), ALL_RULES).select(
        "event_id", "subject_id", "ts", "opening_score", "score_change")
    out = running_score_with_decay(spark, scored, DECAYING, _ORDER)
    return out.select("event_id", "subject_id", "previous_score", "new_score")


@query("d03_neighbour_changes", sql("sec", f"""SELECT event_id, origin_subject_id, subject_id, rel, score_change FROM sec"""))
def _(spark, d):
    return neighbour_deltas(processed(spark, d), edges(spark, d)).select(
        "event_id", "origin_subject_id", "subject_id", "rel", "score_change")


@query("t06_neighbour_scores", sql("both", """SELECT event_id, subject_id, origin_subject_id, rel, hop, score_change,
  previous_score, new_score FROM folded"""))
def _(spark, d):
    return processed_with_neighbours(spark, d).select(
        "event_id", "subject_id", "origin_subject_id", "rel", "hop", "score_change", "previous_score", "new_score")


@query("t07_spreading_events", sql("pe", """SELECT event_id, subject_id, relationship_type FROM pe
WHERE event_type = 'relationship' AND requires_relationship_processing"""))
def _(spark, d):
    return spreading_events(processed(spark, d)).select("event_id", "subject_id", "relationship_type")


@query("t08_last_write", sql("pe", f"""SELECT subject_id, {tstr("date_trunc('hour', ts)")} AS interval_start, new_score AS score,
  {tstr('ts')} AS last_score_at, event_id FROM pe
QUALIFY row_number() OVER (PARTITION BY subject_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1"""))
def _(spark, d):
    return last_write(processed(spark, d), "1 hour")


@query("w09_latest_state", sql("latest", f"""SELECT subject_id, score, {tier5('score')} AS tier,
  {tstr('last_score_at')} AS last_score_at, last_event_id FROM latest"""))
def _(spark, d):
    return latest_state(processed(spark, d))


# --- windows ---------------------------------------------------------------------------------------

@query("w01_moving_average", sql("pe", f"""SELECT event_id, subject_id, {r6('avg(new_score) OVER w7')} AS moving_average_7d,
  {r6('avg(new_score) OVER w30')} AS moving_average_30d FROM pe
WINDOW w7 AS (PARTITION BY subject_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY subject_id ORDER BY ts RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)"""))
def _(spark, d):
    out = Wn.moving_average(spark, processed(spark, d))
    return out.withColumns({c: on_grid(F.col(c)) for c in ("moving_average_7d", "moving_average_30d")})


@query("w02_w03_sequence", sql("pe", f"""SELECT event_id, subject_id, event_sequence_number, {r6('velocity')} AS velocity,
  {r6('velocity - lag(velocity) OVER (PARTITION BY subject_id ORDER BY ts, event_id)')} AS trend_acceleration
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) AS event_sequence_number,
        {X['trend_velocity']} AS velocity FROM pe)"""))
def _(spark, d):
    out = Wn.sequence_and_acceleration(spark, processed(spark, d), behaviour.trend_velocity())
    return out.withColumns({c: on_grid(F.col(c)) for c in ("velocity", "trend_acceleration")})


@query("w04_frequencies", sql("pe", """SELECT event_id, subject_id,
  count(*) OVER (PARTITION BY subject_id, date_trunc('hour', ts)) AS frequency_this_hour,
  count(*) OVER (PARTITION BY subject_id, ts::DATE) AS frequency_this_day FROM pe"""))
def _(spark, d):
    return Wn.frequencies(processed(spark, d))


@query("w05_percentile_rank", sql("latest", f"""SELECT subject_id, score,
  {r6('percent_rank() OVER (ORDER BY score) * 100')} AS percentile_rank FROM latest"""))
def _(spark, d):
    scores = latest_state(processed(spark, d)).select("subject_id", "score")
    return Wn.percentile_ranks(scores).withColumn("percentile_rank", on_grid(F.col("percentile_rank")))


@query("w06_z_scores", sql("pe", f"""SELECT event_id,
  {r6('(score_change - (SELECT avg(score_change) FROM pe)) / (SELECT stddev_pop(score_change) FROM pe)')} AS z_score,
  {r6('new_score - (SELECT avg(new_score) FROM pe)')} AS deviation_from_avg FROM pe"""))
def _(spark, d):
    return Wn.z_scores(processed(spark, d)).withColumns(
        {c: on_grid(F.col(c)) for c in ("z_score", "deviation_from_avg")})


@query("w07_regional_means", sql("pe", f"""SELECT event_id, region, new_score,
  {r6('avg(new_score) OVER (PARTITION BY region)')} AS regional_score_avg FROM pe"""))
def _(spark, d):
    return Wn.regional_means(processed(spark, d)).withColumn("regional_score_avg", on_grid(F.col("regional_score_avg")))


_SEASON = f"""SELECT (dayofweek(ts) + 6) % 7 AS weekday, hour(ts) AS hour, count(*) AS n,
  avg(new_score) / (SELECT avg(new_score) FROM pe) AS f FROM pe GROUP BY 1, 2"""


@query("w10_seasonal_factors", sql("pe", f"SELECT weekday, hour, n, {r6('f')} AS seasonal_factor FROM ({_SEASON})"))
def _(spark, d):
    return Wn.seasonal_factors(processed(spark, d)).withColumn("seasonal_factor", on_grid(F.col("seasonal_factor")))


@query("w10_seasonal_adjustment", sql("pe", f"""SELECT event_id, {r6('f')} AS seasonal_adjustment FROM pe
JOIN ({_SEASON}) s ON s.weekday = (dayofweek(ts) + 6) % 7 AND s.hour = hour(ts)"""))
def _(spark, d):
    return Wn.seasonal_adjustment(processed(spark, d))


# --- graph -----------------------------------------------------------------------------------------

@query("n01_undirected", sql("edge", """SELECT src, dst, rel FROM edge UNION SELECT dst, src, rel FROM edge"""))
def _(spark, d):
    return G.undirected(edges(spark, d))


@query("n02_relations_at", sql("edge", f"""SELECT src, dst, rel, {r6('strength')} AS strength, {dstr('start_date')} AS start_date,
  {dstr('end_date')} AS end_date FROM edge WHERE start_date <= DATE '2024-01-20'
  AND (end_date IS NULL OR end_date >= DATE '2024-01-20') AND strength >= 0.35"""))
def _(spark, d):
    out = G.relations_at(edges(spark, d), dt.date(2024, 1, 20), min_strength=0.35)
    return out.withColumn("strength", on_grid(F.col("strength")))


_TIERS = ("very_poor", "poor", "average", "good", "excellent")


@query("d06_n03_neighbour_statistics", sql(("latest", "edge"), f"""SELECT src AS subject_id, rel AS relation_type,
  count(*) AS related_count, {r6('avg(score)')} AS avg_relation_score,
  {r6("count(*) FILTER (tier IN ('very_poor', 'poor')) / count(*)::DOUBLE")} AS relation_risk_factor,
  {', '.join(f"count(*) FILTER (tier = '{t}') AS {t}_relations" for t in _TIERS)}
FROM edge JOIN (SELECT *, {tier5('score')} AS tier FROM latest) l ON l.subject_id = dst GROUP BY src, rel"""))
def _(spark, d):
    out = G.neighbour_statistics(edges(spark, d), latest_state(processed(spark, d)))
    return out.withColumns({c: on_grid(F.col(c)) for c in ("avg_relation_score", "relation_risk_factor")})


@query("n03_ego_metrics", sql(("latest", "edge"), f"""SELECT src AS subject_id, count(*) AS degree,
  {r6('avg(score)')} AS avg_neighbour_score,
  {r6("count(*) FILTER (tier IN ('very_poor', 'poor')) / count(*)::DOUBLE")} AS risk_factor
FROM (SELECT DISTINCT src, dst FROM edge) JOIN (SELECT *, {tier5('score')} AS tier FROM latest) l ON l.subject_id = dst
GROUP BY src"""))
def _(spark, d):
    out = G.ego_metrics(edges(spark, d), latest_state(processed(spark, d)))
    return out.withColumns({c: on_grid(F.col(c)) for c in ("avg_neighbour_score", "risk_factor")})


@query("n04_network_density", sql("edge", f""", nb AS MATERIALIZED (SELECT DISTINCT a, b FROM (
    SELECT src AS a, dst AS b FROM edge UNION ALL SELECT dst, src FROM edge) WHERE a <> b),
deg AS (SELECT a, count(*) AS degree FROM nb GROUP BY a)
SELECT deg.a AS subject_id, degree, coalesce(linked, 0) AS linked_pairs,
  {r6('CASE WHEN degree > 1 THEN coalesce(linked, 0) / (degree * (degree - 1) / 2.0::DOUBLE) ELSE 0.0::DOUBLE END')} AS density
FROM deg LEFT JOIN (SELECT x.a, count(*) AS linked FROM nb x JOIN nb y ON y.a = x.a AND x.b < y.b
                    JOIN nb z ON z.a = x.b AND z.b = y.b GROUP BY x.a) t ON t.a = deg.a""").replace(")\n, nb", "),\nnb"))
def _(spark, d):
    return G.network_density(edges(spark, d)).withColumn("density", on_grid(F.col("density")))


@query("n05_reach", sql("edge", """, st AS MATERIALIZED (SELECT DISTINCT src, dst FROM edge),
walk(src, node, h) AS (SELECT src, dst, 1 FROM st UNION SELECT w.src, s.dst, w.h + 1 FROM walk w JOIN st s ON s.src = w.node
  WHERE w.h < 3)
SELECT src, hops, count(*) AS reached FROM (SELECT src, node, min(h) AS hops FROM walk WHERE src <> node GROUP BY src, node)
GROUP BY src, hops""").replace(")\n, st", "),\nst"))
def _(spark, d):
    return G.reach_counts(edges(spark, d), 3)


@query("n05_reach_of_seeds", sql("edge", """, st AS MATERIALIZED (SELECT DISTINCT src, dst FROM edge),
walk(src, node, h) AS (SELECT src, dst, 1 FROM st WHERE src % 10 = 3 UNION SELECT w.src, s.dst, w.h + 1 FROM walk w JOIN st s ON s.src = w.node
  WHERE w.h < 3)
SELECT src, hops, count(*) AS reached FROM (SELECT src, node, min(h) AS hops FROM walk WHERE src <> node GROUP BY src, node)
GROUP BY src, hops""").replace(")\n, st", "),\nst"))
def _(spark, d):
    """Reach of every tenth subject as seeds, as counts."""
    links = edges(spark, d)
    return G.reach_counts(links, 3, links.select("src").filter("src % 10 = 3"))


@query("n06_association_risk", sql(("latest", "edge"), "").rstrip() + ",\n" + _ASSOC + f"""
SELECT subject_id, {r6('association_risk')} AS association_risk FROM assoc""")
def _(spark, d):
    out = G.association_risk(edges(spark, d), latest_state(processed(spark, d)))
    return out.select("subject_id", on_grid(F.col("association_risk")).alias("association_risk"))


@query("d08_with_relation", sql(("prof", "edge"), """SELECT subject_id, age FROM prof
WHERE subject_id IN (SELECT src FROM edge WHERE rel = 'friend')"""))
def _(spark, d):
    return G.subjects_with_relation(profiles(spark, d), edges(spark, d), "friend").select("subject_id", "age")
