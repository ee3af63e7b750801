"""Plain SQL for the test mapping, the scoring rules and every feature column.

Written independently of the DataFrame code; it is what results are compared with.
"""

from __future__ import annotations


def r6(x: str) -> str:
    return f"(floor(({x}) * 1e6 + 0.50001::DOUBLE) / 1e6)"


def tstr(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def dstr(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def case(*pairs: tuple[str, str], default: str = "0.0") -> str:
    return "(CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END)"


def anyof(x: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w.strip()}')" for w in words) + ")"


_PLACES = """(0,'New York','United States',40.7,-74.0),(1,'Manchester','United Kingdom',53.5,-2.2),
(2,'Munich','Germany',48.1,11.6),(3,'Lyon','France',45.8,4.8),(4,'Toronto','Canada',43.7,-79.4),
(5,'Tokyo','Japan',35.7,139.7),(6,'Busan','South Korea',35.2,129.1),(7,'Queenstown','Singapore',1.3,103.8),
(8,'Rotterdam','Netherlands',51.9,4.5),(9,'Ghent','Belgium',51.0,3.7),(10,'Sydney','Australia',-33.9,151.2),
(11,'Moscow','Russia',55.8,37.6),(12,'Milan','Italy',45.5,9.2),(13,'Madrid','Spain',40.4,-3.7),
(14,'Recife','Brazil',-8.1,-34.9),(15,'Shanghai','China',31.2,121.5),(16,'Mumbai','India',19.1,72.9),
(17,'Maple Farm','United States',0,0),(18,'Green Village','France',46.0,2.0),(19,'Park Heights','Canada',0,0),
(20,'','',0,0),(21,'Oak Grove','Germany',51.0,10.0),(22,'Metro Center','USA',34.1,-118.2),
(23,'Smallton','Kenya',0,0),(24,'Riverton','United Kingdom',0,0)"""

_TX = """['bankruptcy','default','large_transfer','major_purchase','regular_payment','salary_deposit','bill_payment',
'savings_deposit','large_withdrawal','cash_advance','loan_default','atm_withdrawal','card_payment','online_purchase',
'loan_payment']"""
_TR = "['flight','train_long_distance','bus','train_local','metro','taxi','rideshare']"
_REL = "['family_event','workplace_event','community_event']"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}

CTES["place"] = ((), f"""place AS (
  SELECT n.n_nationkey AS nk, t.city, r.r_name || CASE WHEN n.n_nationkey % 6 = 0 THEN ' Central' ELSE '' END AS region,
         t.country, t.lat::DOUBLE AS latitude, t.lon::DOUBLE AS longitude
  FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
  JOIN (VALUES {_PLACES}) AS t(nk, city, country, lat, lon) ON t.nk = n.n_nationkey)""")

CTES["prof"] = ((), """prof AS (
  SELECT c_custkey AS subject_id, (18 + (c_custkey * 7) % 65)::INT AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, (50 + (c_custkey * 137) % 900)::DOUBLE AS score,
         ['vip','regular','student','regular','senior','regular','veteran','regular','public_servant','regular']
           [(c_custkey % 10 + 1)::INT] AS type,
         'active' AS status, c_custkey % 3 = 0 AS is_public_official, c_nationkey AS nation_key, c_acctbal AS balance
  FROM customer)""")

CTES["ev"] = (("place",), f"""ev0 AS (
  SELECT event_id, user_id AS subject_id, ts, event_type AS raw_type, value, (props->>'$.k')::INT AS k FROM events),
ev1 AS (
  SELECT *, CASE WHEN k = 99 THEN 'identity' WHEN k = 97 THEN 'transportation' WHEN raw_type = 'purchase' THEN 'financial'
    WHEN raw_type = 'click' THEN 'social' WHEN raw_type = 'view' THEN 'relationship' WHEN raw_type = 'signup' THEN 'system'
    WHEN k < 10 OR k >= 85 THEN 'legal' ELSE 'civic' END AS event_type FROM ev0),
ev AS MATERIALIZED (
  SELECT e.event_id, e.subject_id, e.ts, e.event_type,
    CASE e.event_type WHEN 'financial' THEN CASE WHEN k % 10 < 7 THEN 'payment_completed' ELSE 'payment_failed' END
      WHEN 'social' THEN 'volunteering' WHEN 'legal' THEN 'violation'
      WHEN 'system' THEN CASE WHEN k % 3 = 0 THEN 'data_correction' ELSE 'new_citizen' END
      WHEN 'relationship' THEN {_REL}[k % 3 + 1] ELSE '' END AS event_subtype,
    'source_' || (e.event_id % 4) AS source_system, e.event_type || '_' || raw_type AS event_name,
    0.4::DOUBLE + (e.event_id % 100) * 0.006::DOUBLE AS confidence, k, 1 AS version,
    {_TX}[k % 15 + 1] AS transaction_type, {_TR}[(e.event_id % 7 + 1)::INT] AS transport_type,
    value * 10 AS amount, k / 100.0::DOUBLE AS severity_num,
    CASE WHEN e.event_type = 'relationship' THEN {_REL}[k % 3 + 1] END AS relationship_type,
    CASE WHEN e.event_type = 'relationship' THEN k % 10 < 7 END AS is_positive,
    CASE WHEN e.event_type = 'relationship' THEN k / 100.0::DOUBLE END AS intensity,
    CASE WHEN e.event_type = 'relationship' THEN k % 2 = 0 END AS requires_relationship_processing,
    ts + to_milliseconds(k * 10) AS processed_at, p.city, p.region, p.country, p.latitude, p.longitude
  FROM ev1 e LEFT JOIN customer c ON c.c_custkey = e.subject_id LEFT JOIN place p ON p.nk = c.c_nationkey)""")


def points(value: str) -> str:
    return f"({value} * (mult * (CASE WHEN subject_type = 'vip' THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END) * confidence))"


# (rule id, event type, condition, points, multiplier), in rule order.
RULES_SQL = (
    ("financial_positive", "financial", "event_subtype = 'payment_completed' AND amount > 0", "10.0", "1.0"),
    ("financial_negative", "financial", "event_subtype = 'payment_failed'", "-15.0", "1.0"),
    ("social_positive", "social", "event_subtype = 'volunteering'", "20.0", "1.2"),
    ("legal_violation", "legal", "event_subtype = 'violation'", "-50.0", "1.5"),
    ("relationship_positive", "relationship", "is_positive", "5.0", "1.0"),
    ("relationship_negative", "relationship", "NOT is_positive", "-8.0", "1.0"),
    ("stress_severe", "legal", "severity_num > 0.8", "-75.0", "1.0"),
    ("stress_identity", "identity", "true", "-220.0", "1.0"),
)
RULE_TYPES = "('financial', 'social', 'legal', 'relationship', 'identity')"


def rule_points(pts: str, mult: str) -> str:
    vip = "(CASE WHEN subject_type = 'vip' THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END)"
    return f"({pts}::DOUBLE * ({mult}::DOUBLE * {vip} * confidence))"


def fired_sql(source: str = "evp", rules=RULES_SQL) -> str:
    return " UNION ALL ".join(
        f"SELECT event_id, {i} AS ord, '{rid}' AS rule_id, {rule_points(p, m)} AS rule_points FROM {source} "
        f"WHERE event_type = '{t}' AND ({c})" for i, (rid, t, c, p, m) in enumerate(rules))


def fold_sql(name: str, source: str, order: str = "ts, event_id") -> str:
    """Bounded running score by recursion over each subject's rows."""
    return f"""{name}_seq AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY {order}) AS rn FROM {source}),
{name}_run(subject_id, rn, before, after) AS (
  SELECT subject_id, rn, opening_score, least(greatest(opening_score + score_change, 0.0::DOUBLE), 1000.0::DOUBLE)
  FROM {name}_seq WHERE rn = 1
  UNION ALL
  SELECT s.subject_id, s.rn, r.after, least(greatest(r.after + s.score_change, 0.0::DOUBLE), 1000.0::DOUBLE)
  FROM {name}_run r JOIN {name}_seq s ON s.subject_id = r.subject_id AND s.rn = r.rn + 1),
{name} AS MATERIALIZED (
  SELECT s.*, {r6('r.before')} AS previous_score, {r6('r.after')} AS new_score
  FROM {name}_seq s JOIN {name}_run r USING (subject_id, rn))"""


CTES["fired"] = (("ev", "prof"), f"""evp AS (
  SELECT e.*, p.type AS subject_type, coalesce(p.score, 500.0::DOUBLE) AS opening_score
  FROM ev e LEFT JOIN prof p USING (subject_id)),
fired AS MATERIALIZED ({fired_sql()})""")

CTES["sc"] = (("fired",), f"""sc AS MATERIALIZED (
  SELECT e.*, {r6('coalesce(f.s, 0.0::DOUBLE)')} AS score_change, coalesce(f.n, 0) AS n_rules,
         coalesce(f.ids, '') AS applied_rules, e.event_type IN {RULE_TYPES} AS rule_seen
  FROM evp e LEFT JOIN (SELECT event_id, sum(rule_points ORDER BY ord) AS s, count(*) AS n,
                               string_agg(rule_id, ',' ORDER BY ord) AS ids FROM fired GROUP BY event_id) f
  USING (event_id))""")

CTES["pe"] = (("sc",), fold_sql("pe", "sc"))

CTES["edge"] = ((), """edge AS MATERIALIZED (
  SELECT DISTINCT u AS src, dst % n AS dst, rel, 0.1::DOUBLE + (u % 9) * 0.1::DOUBLE AS strength,
         make_date(2020, (u % 12 + 1)::INT, 1) AS start_date,
         CASE WHEN u % 7 = 0 THEN make_date(2024, 1, 15) END AS end_date
  FROM (SELECT u, n, unnest([u + 1, u + 2, u + 3, u * 7 + 3, u * u + 1, u * 5 + 11, u * 3 + 7, u + 10]) AS dst,
               unnest(['family_member', 'family_member', 'family_member', 'friend', 'friend', 'colleague',
                       'colleague', 'neighbor']) AS rel
        FROM (SELECT c_custkey AS u FROM customer), (SELECT max(user_id) + 1 AS n FROM events) WHERE u < n)
  WHERE u <> dst % n)""")

CTES["sec"] = (("pe", "edge"), f"""sec AS MATERIALIZED (
  SELECT e.dst AS subject_id, p.subject_id AS origin_subject_id, p.event_id, p.ts, e.rel,
         {r6('p.score_change * p.factor')} AS score_change
  FROM (SELECT *, (CASE relationship_type WHEN 'family_event' THEN 0.3::DOUBLE WHEN 'workplace_event' THEN 0.2::DOUBLE
                     WHEN 'community_event' THEN 0.15::DOUBLE ELSE 0.1::DOUBLE END) * intensity
                   * (CASE WHEN is_positive THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END) AS factor
        FROM pe WHERE event_type = 'relationship' AND requires_relationship_processing AND score_change <> 0) p
  JOIN edge e ON e.src = p.subject_id AND (
       (p.relationship_type = 'family_event' AND e.rel = 'family_member')
    OR (p.relationship_type = 'workplace_event' AND e.rel = 'colleague')
    OR (p.relationship_type = 'community_event' AND e.rel IN ('neighbor', 'friend'))))""")

CTES["both"] = (("sec",), """both0 AS (
  SELECT subject_id, subject_id AS origin_subject_id, event_id, ts, '' AS rel, score_change, 0 AS hop FROM pe
  UNION ALL SELECT subject_id, origin_subject_id, event_id, ts, rel, score_change, 1 FROM sec),
both1 AS (SELECT b.*, coalesce(p.score, 500.0::DOUBLE) AS opening_score FROM both0 b LEFT JOIN prof p USING (subject_id)),
""" + fold_sql("folded", "both1", "ts, event_id, hop, origin_subject_id, rel"))

CTES["latest"] = (("pe",), """latest AS MATERIALIZED (
  SELECT subject_id, new_score AS score, ts AS last_score_at, event_id AS last_event_id FROM pe WHERE rule_seen
  QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY ts DESC, event_id DESC) = 1)""")


def sql(base: str | tuple[str, ...], body: str) -> str:
    """``body`` with the named base tables, and what they build on, in front."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for dep in CTES[name][0]:
            need(dep)
        if name not in wanted:
            wanted.append(name)

    for name in (base,) if isinstance(base, str) else base:
        need(name)
    return "WITH RECURSIVE " + ",\n".join(CTES[n][1] for n in wanted) + "\n" + body


# --- feature columns -------------------------------------------------------------------------------

def tier6(s: str) -> str:
    return (f"(CASE WHEN {s} >= 900 THEN 'excellent' WHEN {s} >= 800 THEN 'very_good' WHEN {s} >= 700 THEN 'good' "
            f"WHEN {s} >= 600 THEN 'fair' WHEN {s} >= 500 THEN 'poor' ELSE 'very_poor' END)")


def tier5(s: str) -> str:
    return (f"(CASE WHEN {s} BETWEEN 0 AND 199 THEN 'very_poor' WHEN {s} BETWEEN 200 AND 399 THEN 'poor' "
            f"WHEN {s} BETWEEN 400 AND 599 THEN 'average' WHEN {s} BETWEEN 600 AND 799 THEN 'good' "
            f"WHEN {s} BETWEEN 800 AND 1000 THEN 'excellent' ELSE 'unknown' END)")


def c01(x: str, hi: str = "1.0") -> str:
    return f"least(greatest({x}, 0.0::DOUBLE), {hi}::DOUBLE)"


_H = "hour(ts)"
_A = "abs(score_change)"
_T6 = tier6("new_score")
_WEEKEND = "dayofweek(ts) IN (0, 6)"
_CONF = "CASE WHEN confidence > 0.9 THEN {0} WHEN confidence < 0.7 THEN {1} ELSE {2} END"

X: dict[str, str] = {}
X["behaviour_pattern"] = case(("score_change > 0", "'positive_behavior'"), ("score_change < 0", "'negative_behavior'"),
                              default="'neutral_behavior'")
X["time_of_day"] = case((f"{_H} BETWEEN 6 AND 11", "'morning'"), (f"{_H} BETWEEN 12 AND 17", "'afternoon'"),
                        (f"{_H} BETWEEN 18 AND 21", "'evening'"), default="'night'")
X["weekday"] = "dayname(ts)"
X["month"] = "monthname(ts)"
X["consistency"] = c01(
    "0.5::DOUBLE + " + case((f"{_A} <= 10", "0.3"), (f"{_A} <= 50", "0.2"), (f"{_A} <= 100", "0.1"))
    + " + CASE event_type WHEN 'financial' THEN 0.1 WHEN 'social' THEN -0.1 WHEN 'legal' THEN -0.2 WHEN 'civic' THEN 0.15"
      " ELSE 0.0 END + " + _CONF.format("0.1", "-0.1", "0.0"))
X["location_mobility"] = c01(
    "0.3::DOUBLE + " + case((f"{_H} BETWEEN 7 AND 9", "0.3"), (f"{_H} BETWEEN 17 AND 19", "0.3"),
                            (f"{_H} BETWEEN 12 AND 14", "0.2"), (f"{_H} >= 22 OR {_H} <= 6", "-0.1"))
    + f" + CASE WHEN {_WEEKEND} THEN 0.2 ELSE 0.0 END + "
    + case(("event_type = 'transportation'", "0.4"),
           ("event_type = 'financial' AND transaction_type IN ('atm_withdrawal', 'card_payment')", "0.3"),
           ("event_type = 'social'", "0.2"), ("event_type = 'civic'", "0.1")))
X["analytic_tier"] = _T6
X["config_tier"] = tier5("new_score")
X["change_direction"] = case(("score_change > 0", "'increase'"), ("score_change < 0", "'decrease'"),
                             default="'unchanged'")
X["percentile_estimate"] = "new_score / 1000.0::DOUBLE * 100.0::DOUBLE"
X["z_estimate"] = "score_change / 50.0::DOUBLE"
X["hour_bucket"] = "strftime(ts, '%Y-%m-%d_%H')"
X["week_label"] = "printf('%04d-W%02d', year(ts), weekofyear(ts))"
X["trend_category"] = case((f"{_A} >= 100", "'significant_change'"), (f"{_A} >= 50", "'moderate_change'"),
                           default="'minor_change'")
X["trend_direction"] = "sign(score_change)::DOUBLE"
X["trend_magnitude"] = _A
X["trend_velocity"] = "least(" + f"{_A} / 100.0::DOUBLE * (" + _CONF.format("1.2::DOUBLE", "0.8::DOUBLE", "1.0::DOUBLE") + """)
 * (CASE WHEN event_type = 'legal' THEN 1.5::DOUBLE
    WHEN event_type = 'financial' AND transaction_type IN ('bankruptcy', 'default') THEN 2.0::DOUBLE
    WHEN event_type = 'financial' AND transaction_type IN ('large_transfer', 'major_purchase') THEN 1.3::DOUBLE
    WHEN event_type = 'financial' AND transaction_type = 'regular_payment' THEN 0.7::DOUBLE
    WHEN event_type = 'civic' THEN 1.1::DOUBLE WHEN event_type = 'social' THEN 0.9::DOUBLE
    WHEN event_type = 'system' AND event_subtype = 'new_citizen' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END)
 * (CASE WHEN hour(ts) BETWEEN 9 AND 17 THEN 1.1::DOUBLE WHEN hour(ts) >= 22 OR hour(ts) <= 6 THEN 0.8::DOUBLE
    ELSE 1.0::DOUBLE END)
 * (CASE """ + _T6 + """ WHEN 'excellent' THEN 0.8::DOUBLE WHEN 'very_good' THEN 0.9::DOUBLE WHEN 'good' THEN 0.9::DOUBLE
    WHEN 'poor' THEN 1.3::DOUBLE WHEN 'very_poor' THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END), 5.0::DOUBLE)"""
X["trend_stability"] = c01(
    "0.7::DOUBLE + " + case((f"{_A} <= 10", "0.2"), (f"{_A} <= 25", "0.1"), (f"{_A} <= 50", "-0.1"),
                            (f"{_A} <= 100", "-0.2"), default="-0.3")
    + " + (" + _CONF.format("0.15", "-0.15", "0.0") + ")"
    + f""" + (CASE {_T6} WHEN 'excellent' THEN 0.2 WHEN 'very_good' THEN 0.15 WHEN 'good' THEN 0.1 WHEN 'fair' THEN -0.05
       WHEN 'poor' THEN -0.15 ELSE -0.25 END)
    + (CASE WHEN event_type = 'civic' THEN 0.1
       WHEN event_type = 'financial' THEN CASE
         WHEN transaction_type IN ('regular_payment', 'salary_deposit', 'bill_payment') THEN 0.15
         WHEN transaction_type = 'savings_deposit' THEN 0.1
         WHEN transaction_type IN ('large_withdrawal', 'cash_advance') THEN -0.2
         WHEN transaction_type IN ('loan_default', 'bankruptcy') THEN -0.4 ELSE 0.0 END
       WHEN event_type = 'legal' THEN -0.3
       WHEN event_type = 'social' THEN CASE WHEN score_change > 0 THEN 0.05 ELSE -0.1 END
       WHEN event_type = 'system' AND event_subtype = 'data_correction' THEN -0.1 ELSE 0.0 END)
    + (CASE WHEN {_WEEKEND} THEN -0.05 ELSE 0.0 END) + (({X['consistency']}) - 0.5::DOUBLE) * 0.3::DOUBLE""")

_CITY = "lower(coalesce(city, ''))"
# City and place words.
_TIER1 = ("new york", "london", "paris", "tokyo", "berlin", "moscow", "beijing", "shanghai", "mumbai", "delhi", "los angeles",
          "chicago", "toronto", "sydney", "melbourne")
_TIER2 = ("manchester", "birmingham", "glasgow", "lyon", "marseille", "frankfurt", "hamburg", "munich", "barcelona", "madrid",
          "milan", "rome", "amsterdam", "rotterdam")
_URBAN = ("city", "york", "london", "paris", "berlin", "tokyo", "center", "downtown", "metro", "district")
_RURAL = ("village", "farm", "county", "rural", "countryside", "valley", "hill", "mountain", "lake")
_SUBURBAN = ("suburb", "gardens", "heights", "park", "grove", "meadow", "ridge", "estates")
X["geographic_tier"] = case((anyof(_CITY, _TIER1), "'tier_1'"), (anyof(_CITY, _TIER2), "'tier_2'"),
                            ("country IN ('United States', 'United Kingdom', 'Germany', 'France')", "'tier_3'"),
                            default="'tier_4'")
X["urban_class"] = case(
    (anyof(_CITY, _URBAN), "'urban'"),
    (anyof(_CITY, _RURAL), "'rural'"),
    (anyof(_CITY, _SUBURBAN), "'suburban'"),
    ("latitude <> 0 AND longitude <> 0", "'urban'"), default="'suburban'")
X["geographic_mobility"] = c01("""0.2::DOUBLE + (CASE WHEN event_type = 'transportation' THEN 0.6 ELSE 0.0 END)
 + (CASE WHEN event_type <> 'transportation' THEN 0.0 WHEN transport_type IN ('flight', 'train_long_distance') THEN 0.3
    WHEN transport_type IN ('bus', 'train_local', 'metro') THEN 0.2 WHEN transport_type IN ('taxi', 'rideshare') THEN 0.1
    ELSE 0.0 END)
 + (CASE WHEN event_type = 'financial' AND transaction_type IN ('atm_withdrawal', 'card_payment') THEN 0.3
    WHEN event_type = 'financial' AND transaction_type = 'online_purchase' THEN -0.1
    WHEN event_type = 'social' THEN 0.2 WHEN event_type = 'civic' THEN 0.15 ELSE 0.0 END)
 + (CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 THEN 0.2 ELSE 0.0 END)""")
_CENTRES = {"United States": ("39.8283", "-98.5795"), "United Kingdom": ("54.5973", "-2.7081"),
            "Germany": ("51.1657", "10.4515"), "France": ("46.6034", "1.8883"), "Canada": ("56.1304", "-106.3468")}


def _off(axis: int, col: str) -> str:
    return f"({col} - (CASE country " + " ".join(
        f"WHEN '{n}' THEN {c[axis]}::DOUBLE" for n, c in _CENTRES.items()) + " END))"


_KNOWN = "country IN (" + ", ".join(f"'{n}'" for n in _CENTRES) + ")"
X["distance_from_centre"] = case(
    (f"NOT ({_KNOWN}) AND latitude <> 0 AND longitude <> 0", "50.0::DOUBLE"), (f"NOT ({_KNOWN})", "100.0::DOUBLE"),
    ("latitude = 0 AND longitude = 0", "150.0::DOUBLE"),
    default=f"abs(111.32::DOUBLE * ({_off(0, 'latitude')} * {_off(0, 'latitude')} + "
            f"{_off(1, 'longitude')} * {_off(1, 'longitude')} * 0.5::DOUBLE))")
X["population_density"] = f"""((CASE {X['geographic_tier']} WHEN 'tier_1' THEN 8000.0::DOUBLE WHEN 'tier_2' THEN 3000.0::DOUBLE
  WHEN 'tier_3' THEN 1200.0::DOUBLE ELSE 400.0::DOUBLE END)
 * (CASE {X['urban_class']} WHEN 'urban' THEN 1.5::DOUBLE WHEN 'suburban' THEN 0.7::DOUBLE ELSE 0.2::DOUBLE END)
 * (CASE WHEN country IN ('Japan', 'South Korea', 'Singapore') THEN 2.0::DOUBLE
    WHEN country IN ('Netherlands', 'Belgium') THEN 1.5::DOUBLE
    WHEN country IN ('Canada', 'Australia', 'Russia') THEN 0.3::DOUBLE
    WHEN country = 'United States' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END))"""
X["economic_index"] = c01(f"""(CASE WHEN country IN ('United States', 'Canada') THEN 85.0::DOUBLE
    WHEN country IN ('Germany', 'United Kingdom', 'France', 'Netherlands') THEN 80.0::DOUBLE
    WHEN country IN ('Japan', 'South Korea', 'Australia') THEN 78.0::DOUBLE
    WHEN country IN ('Italy', 'Spain') THEN 70.0::DOUBLE WHEN country IN ('Russia', 'Brazil') THEN 60.0::DOUBLE
    WHEN country IN ('China', 'India') THEN 65.0::DOUBLE ELSE 55.0::DOUBLE END)
 + (CASE WHEN contains(lower(region), 'capital') OR contains(lower(region), 'central') THEN 10.0 ELSE 0.0 END)
 + (CASE {X['urban_class']} WHEN 'urban' THEN 5.0 WHEN 'rural' THEN -10.0 ELSE 0.0 END)
 + (CASE {X['geographic_tier']} WHEN 'tier_1' THEN 8.0 WHEN 'tier_2' THEN 3.0 WHEN 'tier_4' THEN -5.0 ELSE 0.0 END)""",
                          "100.0")
X["risk_category"] = case(("score_change < -50", "'high_risk'"), ("score_change < -20", "'medium_risk'"),
                          default="'low_risk'")
X["risk_level"] = _T6
X["alert_level"] = case((f"{_A} >= 100", "'critical'"), (f"{_A} >= 50", "'warning'"), default="'normal'")
X["default_probability"] = "((1000.0::DOUBLE - new_score) / 1000.0::DOUBLE)"
X["risk_score"] = f"(({X['default_probability']} + {_A} / 100.0::DOUBLE) / 2.0::DOUBLE)"
X["early_warning"] = case(("score_change < -75", "1.0::DOUBLE"), ("score_change < -25", "0.5::DOUBLE"),
                          default="0.0::DOUBLE")
X["mitigation"] = c01("""0.5::DOUBLE + (CASE WHEN new_score >= 800 THEN 0.3 WHEN new_score >= 600 THEN 0.2
    WHEN new_score >= 400 THEN 0.1 ELSE -0.1 END)
 + (CASE WHEN score_change > 0 THEN 0.15 WHEN score_change < -50 THEN -0.2 ELSE 0.0 END)
 + (""" + _CONF.format("0.1", "-0.1", "0.0") + """)
 + (CASE WHEN event_type = 'civic' THEN 0.2
    WHEN event_type = 'financial' AND transaction_type IN ('loan_payment', 'bill_payment') THEN 0.15
    WHEN event_type = 'financial' AND transaction_type = 'savings_deposit' THEN 0.1
    WHEN event_type = 'legal' THEN -0.3 WHEN event_type = 'social' THEN 0.05 ELSE 0.0 END)""")
X["fraud_score"] = c01(f"""0.05::DOUBLE + (CASE WHEN {_A} >= 200 THEN 0.4 WHEN {_A} >= 100 THEN 0.2 ELSE 0.0 END)
 + (CASE WHEN confidence < 0.5 THEN 0.3 WHEN confidence < 0.7 THEN 0.1 ELSE 0.0 END)
 + (CASE WHEN event_type = 'financial' THEN CASE WHEN transaction_type IN ('large_transfer', 'cash_advance') THEN 0.2
      WHEN transaction_type = 'atm_withdrawal' AND amount > 1000 THEN 0.15
      WHEN transaction_type = 'online_purchase' THEN 0.05 ELSE 0.0 END
    WHEN event_type = 'identity' THEN 0.25
    WHEN event_type = 'system' AND event_subtype = 'data_correction' THEN 0.15 ELSE 0.0 END)
 + (CASE WHEN hour(ts) BETWEEN 2 AND 5 THEN 0.1 ELSE 0.0 END)
 + (CASE WHEN country = '' OR city = '' THEN 0.1 ELSE 0.0 END)""")
X["anomaly"] = case((f"{_A} >= 200", "0.9::DOUBLE"), (f"{_A} >= 100", "0.5::DOUBLE"), default="0.1::DOUBLE")
X["predictive_risk_30d"] = f"({X['risk_score']} * (1.0::DOUBLE - 30 / 365.0::DOUBLE * 0.2::DOUBLE))"
X["predictive_risk_90d"] = f"({X['risk_score']} * (1.0::DOUBLE - 90 / 365.0::DOUBLE * 0.2::DOUBLE))"
X["volatility"] = f"({_A} / 50.0::DOUBLE)"
X["latency_ms"] = "((epoch_us(processed_at) - epoch_us(ts)) // 1000)"
X["latency_us"] = "(epoch_us(processed_at) - epoch_us(ts))"
X["data_quality"] = """(100.0::DOUBLE - (CASE WHEN confidence < 0.8 THEN 20.0 ELSE 0.0 END)
 - (CASE WHEN event_type IN ('civic', 'identity') THEN 10.0 ELSE 0.0 END))"""
X["efficiency"] = f"(CASE WHEN {X['latency_ms']} < 100 THEN 100.0::DOUBLE WHEN {X['latency_ms']} < 500 THEN 80.0::DOUBLE ELSE 60.0::DOUBLE END)"
X["processing_id"] = "'proc_' || sha256(event_id::VARCHAR)[1:16]"

_TEXT = {"behaviour_pattern", "time_of_day", "weekday", "month", "analytic_tier", "config_tier", "change_direction",
         "hour_bucket", "week_label", "trend_category", "geographic_tier", "urban_class", "risk_category", "risk_level",
         "alert_level", "processing_id", "latency_ms", "latency_us"}


def feature(name: str, alias: str | None = None) -> str:
    x = X[name] if name in _TEXT else r6(X[name])
    return f"{x} AS {alias or name}"


def features(*names: str) -> str:
    return ", ".join(feature(n) for n in names)
