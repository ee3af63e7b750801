"""Rules, filters, joins, layouts, archive and reads (C, D, G1, A, B9, L, U)."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from scoreloom.functions.numeric import on_grid
from scoreloom.model import ALL_RULES, Condition, Multiplier, Rule, ScoreConfig
from scoreloom.operators import archive as A
from scoreloom.operators import measures as M
from scoreloom.operators import rules as Ru
from scoreloom.operators.constraints import Constraint, split_valid, violations
from scoreloom.operators.scoring import latest_state, onboard, with_profile
from scoreloom.plans.registry import query
from scoreloom.plans.sqlbase import dstr, fired_sql, r6, rule_points, sql, tier5, tstr
from scoreloom.plans.tables import archive, events, processed, profiles
from scoreloom.session import new_table_path
from scoreloom.sources import layouts, wire

WILD = Rule("any_unsure", "*", -1.0, 1.0, (Condition("event_subtype", "CONTAINS", "tion"),))
WITH_WILD = (*ALL_RULES, WILD)
AS_OF = dt.datetime(2024, 1, 31)


def _joined(spark, d, payload=False):
    return with_profile(events(spark, d, payload), profiles(spark, d))


def _scored_sql(source: str) -> str:
    """Per event: sum and ids of the fired rules in ``source``."""
    return f"""SELECT e.event_id, coalesce(f.ids, '') AS applied_rules, {r6('coalesce(f.s, 0.0::DOUBLE)')} AS score_change
FROM evp e LEFT JOIN (SELECT event_id, string_agg(rule_id, ',' ORDER BY ord) AS ids, sum(rule_points ORDER BY ord) AS s
                      FROM ({source}) GROUP BY event_id) f USING (event_id)"""


def _out(df):
    return df.select("event_id", "applied_rules", "score_change")


@query("c01_type_match", sql("fired", """SELECT event_id, rule_id FROM evp JOIN (VALUES ('financial_positive', 'financial'),
  ('financial_negative', 'financial'), ('social_positive', 'social'), ('legal_violation', 'legal'),
  ('relationship_positive', 'relationship'), ('relationship_negative', 'relationship'), ('stress_severe', 'legal'),
  ('stress_identity', 'identity'), ('any_unsure', '*')) r(rule_id, t) ON r.t = evp.event_type OR r.t = '*'"""))
def _(spark, d):
    return Ru.matching_rules(events(spark, d), Ru.rules_frame(spark, WITH_WILD))


_STRICT = [
    ("financial_negative", "financial", "event_subtype = 'payment_failed'", "-15.0", "1.0"),
    ("social_positive", "social", "event_subtype = 'volunteering'", "20.0", "1.2"),
    ("legal_violation", "legal", "event_subtype = 'violation'", "-50.0", "1.5"),
    ("relationship_positive", "relationship", "is_positive", "5.0", "1.0"),
    ("relationship_negative", "relationship", "NOT is_positive", "-8.0", "1.0"),
    ("stress_identity", "identity", "true", "-220.0", "1.0")]


@query("c02_strict_conditions", sql("fired", _scored_sql(fired_sql("evp", _STRICT))))
def _(spark, d):
    """Equality-only comparison: rules with operator conditions never fire."""
    return _out(Ru.apply_rules(_joined(spark, d), ALL_RULES, strict=True))


def _table(spark, d, rules, **options):
    return _out(Ru.apply_rule_table(_joined(spark, d, payload=True), Ru.rules_frame(spark, rules), **options))


@query("c02_strict_conditions_table", sql("fired", _scored_sql(fired_sql("evp", _STRICT))))
def _(spark, d):
    return _table(spark, d, ALL_RULES, strict=True)


OPERATOR_RULES = (
    Rule("equals_number", "relationship", 1.0, 1.0, (Condition("intensity", "EQUALS", 0.5),)),
    Rule("equals_text_of_number", "legal", 2.0, 1.0, (Condition("fine_amount", "EQUALS", "50"),)),
    Rule("greater", "financial", 3.0, 1.0, (Condition("payload.amount", "GREATER_THAN", 300),)),
    Rule("contains", "financial", 4.0, 1.0, (Condition("transaction_type", "CONTAINS", "payment"),)),
    Rule("regex", "transportation", 5.0, 1.0, (Condition("transport_type", "REGEX_MATCH", "^train_"),)),
    Rule("wrong_type", "financial", 6.0, 1.0, (Condition("amount", "EQUALS", True),)),
    Rule("missing_key", "social", 7.0, 1.0, (Condition("no_such_key", "EQUALS", "x"),)),
    Rule("flag", "relationship", 8.0, 1.0, (Condition("is_positive", "EQUALS", True),)),
)
_OPERATORS = [
    ("equals_number", "relationship", "intensity = 0.5", "1.0", "1.0"),
    ("equals_text_of_number", "legal", "k * 10 = 50", "2.0", "1.0"),
    ("greater", "financial", "amount > 300", "3.0", "1.0"),
    ("contains", "financial", "contains(transaction_type, 'payment')", "4.0", "1.0"),
    ("regex", "transportation", "transport_type LIKE 'train\\_%' ESCAPE '\\'", "5.0", "1.0"),
    ("wrong_type", "financial", "false", "6.0", "1.0"), ("missing_key", "social", "false", "7.0", "1.0"),
    ("flag", "relationship", "is_positive", "8.0", "1.0")]


@query("c03_operators", sql("fired", _scored_sql(fired_sql("evp", _OPERATORS))))
def _(spark, d):
    """Every operator, on values taken from the JSON payload alone."""
    keep = ["event_id", "event_type", "event_subtype", "subject_type", "confidence", "payload"]
    return _out(Ru.apply_rules(_joined(spark, d, payload=True).select(*keep), OPERATOR_RULES))


@query("c03_operators_table", sql("fired", _scored_sql(fired_sql("evp", _OPERATORS))))
def _(spark, d):
    """The same rules from a rule table."""
    out = Ru.apply_rule_table(_joined(spark, d, payload=True), Ru.rules_frame(spark, OPERATOR_RULES))
    return _out(out)


EITHER = (
    Rule("either", "financial", 2.0, 1.0, (Condition("event_subtype", "EQUALS", "payment_failed"),
                                           Condition("amount", "GREATER_THAN", 500)), "OR"),
    Rule("both", "financial", 3.0, 1.0, (Condition("event_subtype", "EQUALS", "payment_failed"),
                                         Condition("amount", "GREATER_THAN", 500)), "AND"),
    Rule("simple", "social", 4.0, 1.0, (Condition("confidence", "GREATER_THAN", 0.9),), "SIMPLE"),
)


_EITHER_SQL = sql("fired", _scored_sql(fired_sql("evp", [
    ("either", "financial", "event_subtype = 'payment_failed' OR amount > 500", "2.0", "1.0"),
    ("both", "financial", "event_subtype = 'payment_failed' AND amount > 500", "3.0", "1.0"),
    ("simple", "social", "confidence > 0.9", "4.0", "1.0")])))


@query("c04_combination", _EITHER_SQL)
def _(spark, d):
    return _out(Ru.apply_rules(_joined(spark, d), EITHER))


@query("c04_combination_table", _EITHER_SQL)
def _(spark, d):
    return _table(spark, d, EITHER)


@query("c05_rule_subset", sql("fired", _scored_sql("""SELECT * FROM fired WHERE rule_id IN
  ('financial_positive', 'social_positive', 'relationship_positive', 'stress_severe', 'stress_identity')""")))
def _(spark, d):
    """Rules tagged reward or critical, but not penalty."""
    config = ScoreConfig(include_tags=("reward", "critical"), exclude_tags=("penalty",))
    return _out(Ru.apply_rules(_joined(spark, d), Ru.select_rules(ALL_RULES, config)))


_NIGHT_SQL = sql("fired", _scored_sql(fired_sql("evp", [
    ("night_spend", "financial", "hour(ts) < 5 AND amount > 100", "-3.0", "1.0")])))
_NIGHT = [Rule("night_spend", "financial", -3.0, custom_logic="night_spend")]


def _night_spend():
    return (F.hour("ts") < 5) & (F.col("amount") > 100)


@query("u01_custom_logic", _NIGHT_SQL)
def _(spark, d):
    Ru.register_logic("night_spend", _night_spend)
    return _out(Ru.apply_rules(_joined(spark, d), _NIGHT))


@query("u01_custom_logic_table", _NIGHT_SQL)
def _(spark, d):
    Ru.register_logic("night_spend", _night_spend)
    joined = _joined(spark, d, payload=True)
    return _out(Ru.apply_rule_table(joined, Ru.rules_frame(spark, _NIGHT)))


_VALID_SQL = sql("fired", _scored_sql("""SELECT * FROM fired JOIN ev USING (event_id)
WHERE ts >= TIMESTAMP '2024-01-05' AND (rule_id <> 'social_positive' OR ts <= TIMESTAMP '2024-01-20')"""))
_VALID = [replace(r, valid_from=dt.datetime(2024, 1, 5),
                  valid_to=dt.datetime(2024, 1, 20) if r.rule_id == "social_positive" else None) for r in ALL_RULES]


@query("a05_rule_validity", _VALID_SQL)
def _(spark, d):
    """Validity taken at the event's own time."""
    return _out(Ru.apply_rules(_joined(spark, d), _VALID, validity_by_event_time=True))


@query("a05_rule_validity_table", _VALID_SQL)
def _(spark, d):
    return _table(spark, d, _VALID, validity_by_event_time=True)


_WILD_POINTS = rule_points("-1.0", "1.0")


@query("d01_rule_join", sql("fired", f"""SELECT event_id, rule_id, {r6('rule_points')} AS rule_points FROM fired
UNION ALL SELECT event_id, 'any_unsure', {r6(_WILD_POINTS)} FROM evp WHERE contains(event_subtype, 'tion')"""))
def _(spark, d):
    """Events with a rule table, wildcard included, one row per fired rule."""
    out = Ru.apply_rule_table(_joined(spark, d, payload=True), Ru.rules_frame(spark, WITH_WILD))
    return Ru.fired_rows(out, "event_id").select("event_id", "rule_id", on_grid(F.col("rule_points")).alias("rule_points"))


@query("g01_event_sums", sql("sc", "SELECT event_id, applied_rules, score_change, rule_seen FROM sc"))
def _(spark, d):
    out = Ru.apply_rules(_joined(spark, d), ALL_RULES)
    return out.select("event_id", "applied_rules", "score_change", "rule_seen")


@query("d02_profile_join", sql("fired", "SELECT event_id, subject_id, subject_type, opening_score FROM evp"))
def _(spark, d):
    return _joined(spark, d).select("event_id", "subject_id", "subject_type", "opening_score")


_FLAG_SQL = sql(("fired", "prof"), f"""SELECT event_id, {r6('''f.rule_points
  * (CASE WHEN p.is_public_official THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END)
  * (CASE WHEN p.balance < 0 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END)''')} AS rule_points
FROM fired f JOIN ev USING (event_id) JOIN prof p USING (subject_id) WHERE rule_id = 'social_positive'""")
_FLAGGED = [replace(next(r for r in ALL_RULES if r.rule_id == "social_positive"), multipliers=(
    Multiplier("official", 1.5, "is_public_official"), Multiplier("debt", 0.8, "in_debt")))]


def _flagged(spark, d, apply):
    people = profiles(spark, d).withColumn("in_debt", F.col("balance") < 0)
    joined = with_profile(events(spark, d, True), people, extra=("is_public_official", "in_debt"))
    return Ru.fired_rows(apply(joined), "event_id").select("event_id", on_grid(F.col("rule_points")).alias("rule_points"))


@query("d05_flag_multipliers", _FLAG_SQL)
def _(spark, d):
    return _flagged(spark, d, lambda df: Ru.apply_rules(df, _FLAGGED))


@query("d05_flag_multipliers_table", _FLAG_SQL)
def _(spark, d):
    return _flagged(spark, d, lambda df: Ru.apply_rule_table(df, Ru.rules_frame(spark, _FLAGGED)))


@query("d09_unmatched", sql("ev", """SELECT event_id, event_type FROM ev
WHERE event_type NOT IN ('financial', 'social', 'legal', 'relationship', 'identity')"""))
def _(spark, d):
    return Ru.unmatched_events(events(spark, d), Ru.rules_frame(spark, ALL_RULES)).select("event_id", "event_type")


@query("c06_point_query", sql("pe", f"""SELECT event_id, {tstr('ts')} AS ts, event_type, new_score FROM pe
WHERE subject_id = 7 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'"""))
def _(spark, d):
    rows = A.point_query(processed(spark, d), 7, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20))
    return rows.select("event_id", "ts", "event_type", "new_score")


@query("l01_recent_events", sql("pe", f"""SELECT event_id, {tstr('ts')} AS ts, event_type FROM pe WHERE subject_id = 3
AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-31' ORDER BY ts DESC, event_id LIMIT 20"""))
def _(spark, d):
    rows = A.recent_events(processed(spark, d), 3, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 31), 20)
    return rows.select("event_id", "ts", "event_type")


@query("l02_archive_page", sql("pe", f"""SELECT event_id, subject_id, {tstr('ts')} AS ts, new_score FROM pe
WHERE ts > TIMESTAMP '2024-01-20' ORDER BY pe.ts DESC, event_id LIMIT 100"""))
def _(spark, d):
    rows = A.archive_rows(processed(spark, d)).filter(F.col("ts") > F.lit(dt.datetime(2024, 1, 20)).cast("timestamp"))
    return rows.orderBy(F.col("ts").desc(), "event_id").limit(100).select("event_id", "subject_id", "ts", "new_score")


_CHECKS = (Constraint("balance", "min", 0.0), Constraint("age", "max", 80), Constraint("type", "enum",
           ("vip", "regular", "student", "veteran")), Constraint("score", "required"))


@query("c07_profile_constraints", sql("prof", """SELECT subject_id AS key, violation FROM (
  SELECT subject_id, unnest([CASE WHEN balance < 0 THEN 'balance:min' END, CASE WHEN age > 80 THEN 'age:max' END,
    CASE WHEN type NOT IN ('vip', 'regular', 'student', 'veteran') THEN 'type:enum' END,
    CASE WHEN score IS NULL THEN 'score:required' END]) AS violation FROM prof) WHERE violation IS NOT NULL"""))
def _(spark, d):
    return violations(profiles(spark, d), "subject_id", _CHECKS)


def _gaps(spark, d):
    """Events with some required fields emptied, by arithmetic on the id."""
    n = F.col("event_id")
    return events(spark, d).select("event_id", "subject_id", F.when(n % 11 == 0, F.lit("")).otherwise(
        F.col("event_type")).alias("event_type"), "ts").withColumn(
        "subject_id", F.when(n % 13 == 0, F.lit(None)).otherwise(F.col("subject_id")))


@query("a03_valid_events", sql("ev", """SELECT event_id, subject_id, event_type FROM ev
WHERE event_id % 11 <> 0 AND event_id % 13 <> 0"""))
def _(spark, d):
    return split_valid(_gaps(spark, d))[0].select("event_id", "subject_id", "event_type")


@query("a03_rejected_events", sql("ev", """SELECT event_id, concat_ws(',', CASE WHEN event_id % 13 = 0 THEN 'subject_id' END,
  CASE WHEN event_id % 11 = 0 THEN 'event_type' END) AS missing FROM ev WHERE event_id % 11 = 0 OR event_id % 13 = 0"""))
def _(spark, d):
    return split_valid(_gaps(spark, d))[1].select("event_id", "missing")


@query("a08_profile_upsert", sql(("latest", "prof"), f"""SELECT p.subject_id, p.age, coalesce(l.score, p.score) AS score,
  {tier5('coalesce(l.score, p.score)')} AS tier, {tstr('l.last_score_at')} AS last_score_at
FROM prof p LEFT JOIN latest l USING (subject_id)"""))
def _(spark, d):
    out = A.upsert_profiles(profiles(spark, d), latest_state(processed(spark, d)))
    return out.select("subject_id", "age", "score", "tier", "last_score_at")


@query("a09_archive", sql("pe", f"""SELECT subject_id, {tstr('ts')} AS ts, event_id, event_type, city, region, country,
  score_change, new_score, previous_score, applied_rules, {dstr('ts::DATE')} AS date FROM pe"""))
def _(spark, d):
    """Every processed event is written twice, in two batches; the same key overwrites. Read back from the files."""
    return archive(spark, d).select(
        "subject_id", "ts", "event_id", "event_type", "city", "region", "country", "score_change", "new_score",
        "previous_score", "applied_rules", "date")


_DAYS = "date_trunc('day', ts)"


def _backup(spark, d):
    """Events as backups by type and day, one file for each."""
    ev = events(spark, d).select("event_id", "subject_id", "event_type", "ts", "confidence")
    root = new_table_path(spark, "backups")
    rows = A.backup_rows(ev, "processed_events", "job", "periodic_backup", F.date_trunc("day", "ts"))
    rows = rows.withColumn("data_type", F.concat(F.lit("type_"), F.from_json("data", ev.schema)["event_type"]))
    A.write_backup(rows.repartition("data_type", "year", "month", "day", "hour"), root)
    return root, ev.schema


@query("a12_a15_backup_round_trip", sql("ev", f"""SELECT event_id, subject_id, event_type, {tstr('ts')} AS ts, {r6('confidence')} AS confidence FROM ev"""))
def _(spark, d):
    """All backups of all types written as JSON, and restored."""
    root, schema = _backup(spark, d)
    return A.restore_backup(spark, root, schema).withColumn("confidence", on_grid(F.col("confidence")))


@query("a14_l03_listing", sql("ev", f"""SELECT strftime({_DAYS}, 'year=%Y/month=%m/day=%d/hour=%H') AS folder FROM ev
WHERE event_type = 'social' GROUP BY 1 ORDER BY 1 LIMIT 25"""))
def _(spark, d):
    """The first 25 backup files of a type, in order."""
    listed = A.list_backups(spark, _backup(spark, d)[0], "type_social", 25)
    return listed.select(F.regexp_extract("path", "year=.*hour=[0-9]+", 0).alias("folder"))


@query("a17_backup_counts", sql("ev", f"""SELECT 'type_' || event_type AS data_type, count(DISTINCT {_DAYS}) AS files, count(*) AS rows
FROM ev GROUP BY 1"""))
def _(spark, d):
    return A.backup_counts(spark, _backup(spark, d)[0])


def _lines(spark, d):
    """Events as lines of wire text in several files; each seventh line is cut, each eleventh is no JSON at all."""
    ev = events(spark, d, payload=True)
    doc = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), F.col("subject_id").cast("string").alias("subject_id"), "event_type",
        "event_subtype", "source_system", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.struct("city", "region", "country", "latitude", "longitude").alias("location"), "confidence", "version", "event_name"))
    n = F.col("event_id")
    value = F.when(n % 7 == 0, F.substring(doc, 1, 40)).when(n % 11 == 0, F.concat(F.lit("event "), n.cast("string"))).otherwise(doc)
    path = new_table_path(spark, "lines")
    ev.select(value.alias("value")).repartition(3).write.text(path)
    return wire.read_lines(spark, path)


@query("a02_decoded", sql("ev", f"""SELECT event_id::VARCHAR AS event_id, subject_id::VARCHAR AS subject_id, event_type, city,
  {tstr('ts')} AS timestamp FROM ev WHERE event_id % 7 <> 0 AND event_id % 11 <> 0"""))
def _(spark, d):
    return wire.decode(_lines(spark, d))[0].select("event_id", "subject_id", "event_type", F.col("location.city").alias("city"), "timestamp")


@query("a02_rejects", sql("ev", """SELECT CASE WHEN event_id % 7 = 0 THEN 'cut' ELSE 'event ' || event_id END AS value, count(*) AS n FROM ev
WHERE event_id % 7 = 0 OR event_id % 11 = 0 GROUP BY 1"""))
def _(spark, d):
    bad = wire.decode(_lines(spark, d))[1]
    return bad.groupBy(F.when(F.col("value").startswith("{"), "cut").otherwise(F.col("value")).alias("value")).agg(F.count("*").alias("n"))


@query("a04_positions", sql("ev", """SELECT count(*) AS rows, count(*) FILTER (event_id % 50 = 0) AS missing,
  count(*) FILTER (event_id % 70 = 0 AND event_id % 50 <> 0) AS repeated FROM ev"""))
def _(spark, d):
    """Events in several files; of what was taken from them some rows are lost and some came twice, and the report finds them."""
    path = new_table_path(spark, "positions")
    events(spark, d).select("event_id", "ts").repartition(5).write.parquet(path)
    source = wire.with_positions(spark.read.parquet(path))
    seen = source.filter("event_id % 50 <> 0")
    report = wire.position_report(seen.unionAll(seen.filter("event_id % 70 = 0")), source)
    return report.agg(*[F.sum(c).alias(c) for c in ("rows", "missing", "repeated")])


@query("b02_payload_null", sql("ev", """SELECT event_id, 'null' AS field, 'null' AS kind FROM ev WHERE event_type = 'system'"""))
def _(spark, d):
    """A JSON null in the payload becomes a field with the text null."""
    ev = events(spark, d, payload=True).filter("event_type = 'system'")
    ev = ev.withColumn("payload", F.concat(F.lit('{"nothing":null,'), F.substr("payload", F.lit(2))))
    return M.split_payload(ev).select("event_id", F.col("fields")["payload_nothing"].alias("field"),
                                      F.col("field_kinds")["payload_nothing"].alias("kind"))


@query("a13_backup_targets", sql("ev", """SELECT event_type, CASE event_type WHEN 'system' THEN 'stream-backups'
  WHEN 'social' THEN 'dgraph-backups' ELSE 'other' END AS target, count(*) AS n FROM ev GROUP BY 1, 2"""))
def _(spark, d):
    kind = F.when(F.col("event_type") == "system", "system_state").when(F.col("event_type") == "social", "dgraph") \
        .otherwise(F.col("event_type"))
    return (events(spark, d).groupBy("event_type", A.target_dataset(kind, "other").alias("target"))
            .agg(F.count("*").alias("n")))


@query("a16_expired", sql("ev", f"""SELECT event_id, {dstr('ts::DATE')} AS date FROM ev WHERE ts < TIMESTAMP '2024-01-17'"""))
def _(spark, d):
    return A.split_by_age(events(spark, d), "ts", 14, AS_OF)[1].select("event_id", F.to_date("ts").alias("date"))


@query("a19_retained", sql("ev", "SELECT event_id, event_type FROM ev WHERE ts >= TIMESTAMP '2024-01-15'"))
def _(spark, d):
    as_of = dt.datetime(2024, 1, 15) + dt.timedelta(days=A.RETENTION_DAYS["raw"])
    return A.retain(events(spark, d), "ts", "raw", as_of).select("event_id", "event_type")


@query("a21_find_event", sql("pe", f"""SELECT event_id, subject_id, {tstr('ts')} AS ts FROM pe WHERE event_id = 777"""))
def _(spark, d):
    return A.find_event(archive(spark, d), 777).select("event_id", "subject_id", "ts")


@query("b09_layouts", sql("ev", f"""SELECT event_id::VARCHAR AS event_id, subject_id::VARCHAR AS subject_id, event_type,
  {tstr("CASE WHEN event_id % 4 = 1 THEN date_trunc('millisecond', ts) ELSE ts END")} AS ts, city, region,
  CASE WHEN event_id % 4 = 1 THEN NULL ELSE country END AS country, {r6('confidence')} AS confidence FROM ev"""))
def _(spark, d):
    """Each event is put into one of the four layouts by its id, and all come back as one."""
    ev = events(spark, d, payload=True)
    ids = [F.col("event_id").cast("string").alias("event_id"), F.col("subject_id").cast("string").alias("subject_id")]
    plain = ["event_type", "event_subtype", "source_system", F.col("ts").alias("timestamp"), "confidence", "version"]
    place = F.struct("city", "region", "country", "latitude", "longitude").alias("location")
    which = F.col("event_id") % 4
    wire = ev.filter(which == 0).select(*ids, *plain, place, "payload", "event_name")
    record = ev.filter(which == 1).select(
        F.col("event_id").cast("string").alias("eventId"), F.col("subject_id").cast("string").alias("subjectId"),
        F.upper("event_type").alias("eventType"), F.upper("event_subtype").alias("eventSubtype"),
        F.col("source_system").alias("sourceSystem"), F.unix_millis("ts").alias("timestamp"),
        F.col("severity_num").alias("severity"), "confidence",
        F.struct("region", "city", "latitude", "longitude").alias("location"),
        F.struct("amount", F.lit(None).cast("string").alias("description"),
                 F.create_map(F.lit("k"), F.col("k").cast("string")).alias("metadata")).alias("payload"))
    typed = ev.filter(which == 2).select(*ids, *plain, place, F.lit("26-35").alias("age_group"),
                                         F.lit("F").alias("gender"))
    district = ev.filter(which == 3).select(*ids, *plain, F.struct(
        "city", F.col("region").alias("district"), "country", "latitude", "longitude").alias("location"), "payload")
    all_ = layouts.unify(layouts.from_wire(wire), layouts.from_record(record), layouts.from_typed(typed),
                         layouts.from_wire(district))
    return all_.select("event_id", "subject_id", "event_type", F.col("timestamp").alias("ts"), "location.city",
                       "location.region", "location.country", on_grid(F.col("confidence")).alias("confidence"))


@query("u01_add_subjects", sql(("ev", "prof"), """SELECT subject_id, age, type FROM prof WHERE balance >= 0
UNION ALL SELECT subject_id, 18 + k % 60, CASE WHEN k % 2 = 0 THEN 'regular' ELSE 'student' END FROM ev
  WHERE event_type = 'system' AND event_subtype = 'new_citizen' AND k % 10 <> 1
    AND subject_id NOT IN (SELECT subject_id FROM prof WHERE balance >= 0)
  QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) = 1"""))
def _(spark, d):
    base = profiles(spark, d).filter("balance >= 0").select("subject_id", "age", "type")
    new = onboard(events(spark, d, payload=True))[0].select("subject_id", "age", "type")
    return A.add_subjects(base, new)
