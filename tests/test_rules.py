"""Rule conditions, combination, validity, subsets, cooldown and spreading on hand-made events."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scoreloom.model import ALL_RULES, CONFIG_COLUMNS, Condition, Multiplier, Rule, ScoreConfig
from scoreloom.operators import measures, rules as R
from scoreloom.operators.constraints import CONFIG_CONSTRAINTS, RULE_CONSTRAINTS, split_valid, violations
from scoreloom.operators import cooldown
from scoreloom.operators.cooldown import accept
from scoreloom.operators.propagate import neighbour_deltas
from scoreloom.operators.scoring import latest_state, onboard, score_events

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("event_id int, subject_id string, ts timestamp, event_type string, event_subtype string, confidence double, "
          "payload string, subject_type string")


def frame(spark, *payloads, kind="financial", subtype=""):
    return spark.createDataFrame([(i, "a", T0 + dt.timedelta(hours=i), kind, subtype, 1.0, p, "regular")
                                  for i, p in enumerate(payloads)], SCHEMA)


def fired(df):
    return [r.applied_rules for r in df.orderBy("event_id").select("applied_rules").collect()]


PAYLOADS = ('{"amount":5,"ok":true,"name":"5"}', '{"amount":5.0,"ok":"true"}', '{"amount":"5","ok":false}',
            '{"amount":5.5,"name":"late fee"}', '{}', 'not json', '{"amount":null}')
CHECKS = [
    (Condition("amount", "EQUALS", 5), [1, 1, 0, 0, 0, 0, 0]),
    (Condition("amount", "EQUALS", "5"), [1, 1, 1, 0, 0, 0, 0]),
    (Condition("amount", "EQUALS", "5.5"), [0, 0, 0, 1, 0, 0, 0]),
    (Condition("ok", "EQUALS", True), [1, 0, 0, 0, 0, 0, 0]),
    (Condition("ok", "EQUALS", "true"), [1, 1, 0, 0, 0, 0, 0]),
    (Condition("amount", "GREATER_THAN", 5), [0, 0, 0, 1, 0, 0, 0]),
    (Condition("name", "CONTAINS", "fee"), [0, 0, 0, 1, 0, 0, 0]),
    (Condition("name", "REGEX_MATCH", "^l.*e$"), [0, 0, 0, 1, 0, 0, 0]),
    (Condition("payload.name", "EQUALS", "5"), [1, 0, 0, 0, 0, 0, 0]),
]


@pytest.mark.parametrize("condition,want", CHECKS)
def test_condition(spark, condition, want):
    df = frame(spark, *PAYLOADS)
    rule = Rule("r", "financial", 1.0, 1.0, (condition,))
    compiled = [len(x) for x in fired(R.apply_rules(df, [rule]))]
    table = [len(x) for x in fired(R.apply_rule_table(df, R.rules_frame(spark, [rule])))]
    assert compiled == want
    assert table == want


def test_strict_mode_never_evaluates_operators(spark):
    df = frame(spark, '{"amount":5}', subtype="payment_completed")
    assert fired(R.apply_rules(df, ALL_RULES)) == [["financial_positive"]]
    assert fired(R.apply_rules(df, ALL_RULES, strict=True)) == [[]]


def test_or_and_wildcard_and_order(spark):
    df = frame(spark, '{"x":1}', '{"y":1}', '{}')
    either = Rule("either", "financial", 2.0, 1.0, (Condition("x", "EQUALS", 1), Condition("y", "EQUALS", 1)), "OR")
    any_ = Rule("any", "*", -1.0)
    for out in (R.apply_rules(df, [any_, either]), R.apply_rule_table(df, R.rules_frame(spark, [any_, either]))):
        assert fired(out) == [["any", "either"], ["any", "either"], ["any"]]
        assert [r.score_change for r in out.orderBy("event_id").collect()] == [1.0, 1.0, -1.0]


def test_seen_but_not_fired(spark):
    df = frame(spark, "{}", subtype="other").unionByName(frame(spark, "{}", kind="civic").withColumn(
        "event_id", F.lit(9)))
    out = {r.event_id: (r.rule_seen, r.score_change) for r in R.apply_rules(df, ALL_RULES).collect()}
    assert out == {0: (True, 0.0), 9: (False, 0.0)}


def test_validity_and_loading(spark):
    rules = [Rule("on", "x", 1.0), Rule("off", "x", 1.0, status="inactive"),
             Rule("later", "x", 1.0, valid_from=dt.datetime(2030, 1, 1)),
             Rule("over", "x", 1.0, valid_to=dt.datetime(2020, 1, 1)),
             Rule("until", "x", 1.0, valid_to=T0, conditions=(Condition("a", "EQUALS", True),
                                                              Condition("b", "GREATER_THAN", 2.0)))]
    table = R.rules_frame(spark, rules)
    loaded = R.load_rules(table, T0)
    assert [r.rule_id for r in loaded] == ["on", "until"]
    assert loaded[1].conditions == rules[4].conditions
    assert R.active_list(rules, T0) == [rules[0], rules[4]]


LIKE_LISTS = [
    Rule("envelope", "financial", 1.0, conditions=(Condition("confidence", "GREATER_THAN", 0.5),)),
    Rule("number_part", "financial", 2.0, conditions=(Condition("name", "CONTAINS", 5.0),)),
    Rule("not_a_number", "financial", 3.0, conditions=(Condition("amount", "GREATER_THAN", "4"),)),
    Rule("factors", "financial", 4.0, 1.2, multipliers=(Multiplier("m", 2.0, "is_new"), Multiplier("n", 3.0, "is_old"))),
    Rule("logic", "*", 5.0, custom_logic="never"), Rule("off", "financial", 6.0, status="inactive"),
    Rule("either", "financial", 7.0, 1.0, (Condition("ok", "EQUALS", True), Condition("name", "REGEX_MATCH", "^l")), "OR"),
    Rule("other", "social", 8.0),
]


@pytest.mark.parametrize("strict", [False, True])
def test_lists_and_tables_score_alike(spark, strict):
    R.register_logic("never", lambda: F.col("confidence") < 0)
    df = frame(spark, *PAYLOADS).withColumns({"is_new": F.col("event_id") % 2 == 0, "is_old": F.lit(None).cast("boolean")})
    table = R.rules_frame(spark, LIKE_LISTS)
    forms = [R.apply_rules(df, LIKE_LISTS, strict), R.apply_rule_table(df, table, strict),
             R.apply_rules(df, R.load_rules(table, T0), strict)]
    rows = [[(r.applied_rules, r.score_change, r.rule_seen) for r in f.orderBy("event_id").collect()] for f in forms]
    assert rows[0] == rows[1] == rows[2]
    names = {n for r in rows[0] for n in r[0]}
    assert "factors" in names and ("envelope" in names) == (not strict) and not names & {"logic", "off", "other", "not_a_number"}
    for unknown in (Rule("u", "financial", 1.0, conditions=(Condition("a", "NO_SUCH", 1),)), Rule("u", "financial", 1.0, custom_logic="?")):
        with pytest.raises(Exception):
            R.apply_rules(df, [unknown]).collect()
        with pytest.raises(Exception):
            R.apply_rule_table(df, R.rules_frame(spark, [unknown])).collect()


def test_long_rule_table_with_cooldown(spark):
    rules = [Rule(f"r{i}", "social", 1.0, conditions=(Condition("event_subtype", "EQUALS", f"s{i}"),), cooldown_seconds=5400)
             for i in range(600)]
    events = spark.createDataFrame([event(i, "a", i, "social", "s599") for i in range(4)], EVENTS)
    people = spark.createDataFrame([("a", "regular", 500.0)], PEOPLE)
    out = score_events(spark, events, people, R.rules_frame(spark, rules), cooldown=True).orderBy("event_id").collect()
    assert [bool(r.applied_rules) for r in out] == [True, False, True, False]


def test_rules_out_of_force_do_not_score(spark):
    rules = [Rule("on", "social", 1.0), Rule("off", "social", 10.0, status="inactive"),
             Rule("over", "social", 100.0, valid_to=dt.datetime(2020, 1, 1))]
    events = spark.createDataFrame([event(0, "a", 0, "social")], EVENTS)
    people = spark.createDataFrame([("a", "regular", 500.0)], PEOPLE)
    for given in (rules, R.rules_frame(spark, rules)):
        assert score_events(spark, events, people, given).first().applied_rules == ["on"]


def test_subsets(spark):
    rules = [Rule("a", "x", 1.0, tags=("p",)), Rule("b", "x", 1.0, tags=("p", "q")), Rule("c", "x", 1.0)]
    assert [r.rule_id for r in R.select_rules(rules, ScoreConfig(include_tags=("p",), exclude_tags=("q",)))] == ["a"]
    assert [r.rule_id for r in R.select_rules(rules, ScoreConfig(rule_ids=("c",)))] == ["c"]
    table = R.rules_frame(spark, rules)
    ids = spark.createDataFrame([("b",), ("c",)], "rule_id string")
    assert {r.rule_id for r in R.select_rule_rows(table, ids).collect()} == {"b", "c"}
    assert {r.rule_id for r in R.select_rule_rows(table, include=["p"], exclude=["q"]).collect()} == {"a"}


def test_flag_multipliers(spark):
    df = frame(spark, "{}", "{}").withColumn("official", F.col("event_id") == 0).withColumn("none", F.lit(None).cast("boolean"))
    rule = Rule("r", "financial", 10.0, multipliers=(Multiplier("m", 1.5, "official"), Multiplier("n", 9.0, "none")))
    assert [r.score_change for r in R.apply_rules(df, [rule]).orderBy("event_id").collect()] == [15.0, 10.0]


def test_payload_split_counts_bytes(spark):
    short, long, wide = "a" * 49, "a" * 50, "é" * 25
    df = frame(spark, f'{{"s":"{short}","l":"{long}","w":"{wide}","v":"{"é" * 24}","n":2,"b":true,"o":{{"q":[1]}},"z":null}}')
    row = measures.split_payload(df).first()
    assert set(row.tags) == {"p_s", "p_v"}
    assert row.fields["payload_l"] == long and row.fields["payload_w"] == wide
    assert row.fields["payload_o"] == '{"q":[1]}' and row.fields["payload_b"] == "true"
    assert row.field_kinds["payload_n"] == "number" and row.field_kinds["payload_z"] == "null"


def brute_cooldown(rows, limits):
    """Accepted event ids of (subject, rule, ts, event_id), by walking each pair."""
    want, by = set(), defaultdict(list)
    for s, r, t, i in rows:
        by[s, r].append((t, i))
    for (_, r), items in by.items():
        length, most = limits[r]
        until, used = None, 0
        for t, i in sorted(items):
            if until is None or t >= until:
                until, used = t + dt.timedelta(seconds=length), 0
            if used < most:
                used += 1
                want.add(i)
    return want


def firings(spark, rows, limits):
    return spark.createDataFrame([(s, r, t, i, 0, 1.0, *limits[r]) for s, r, t, i in rows],
                                 "subject_id string, rule_id string, ts timestamp, event_id int, rule_pos int, "
                                 "rule_points double, cooldown_seconds long, max_in_period int")


@pytest.mark.parametrize("chunks", [None, 1, 13])
def test_cooldown_against_brute_force(spark, chunks):
    rng = random.Random(11)
    rows = [("s%d" % rng.randint(0, 3), "r%d" % rng.randint(0, 1), T0 + dt.timedelta(milliseconds=rng.randint(0, 400_000)), i)
            for i in range(1500)]
    limits = {"r0": (20, 3), "r1": (1, 1)}
    assert {r.event_id for r in accept(firings(spark, rows, limits), chunks).collect()} == brute_cooldown(rows, limits)


@pytest.mark.parametrize("length, most", [(30, 1), (7, 4), (900, 50), (5000, 2000)])
def test_cooldown_of_one_pair_without_gaps(spark, length, most):
    """95 in 100 firings on one pair, a firing a second or so, broadcasts off: periods shorter and longer than a chunk."""
    rng = random.Random(length)
    rows = [("hot" if rng.random() < 0.95 else f"s{i % 9}", "r0", T0 + dt.timedelta(seconds=i, milliseconds=rng.randint(0, 900)), i)
            for i in range(4000)]
    limits = {"r0": (length, most)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r.event_id for r in accept(firings(spark, rows, limits), 16).collect()} == brute_cooldown(rows, limits)
        walked = []
        keep = cooldown._resumed

        def watch(df):
            walked.append(df)
            return keep(df)

        cooldown._resumed = watch
        try:
            accept(firings(spark, rows, limits), 16)
        finally:
            cooldown._resumed = keep
        sizes = [r["count"] for r in walked[0].groupBy("chunk").count().collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cooldown_without_rows(spark):
    assert accept(firings(spark, [], {})).count() == 0


EVENTS = ("event_id int, subject_id string, ts timestamp, event_type string, event_subtype string, confidence double, "
          "payload string, processed_at timestamp, relationship_type string, is_positive boolean, intensity double, "
          "requires_relationship_processing boolean, amount double, severity_num double")


def event(i, subject, hours, kind, subtype="", confidence=1.0, rel=None, positive=None, intensity=None, spread=None):
    t = T0 + dt.timedelta(hours=hours)
    return (i, subject, t, kind, subtype, confidence, "{}", t, rel, positive, intensity, spread, 5.0, 0.0)


PEOPLE = "subject_id string, type string, score double"


def test_bounds_ties_and_unclamped_change(spark):
    events = spark.createDataFrame([
        event(2, "a", 1, "social", "volunteering"), event(1, "a", 1, "legal", "violation"),
        event(3, "b", 0, "social", "volunteering"), event(4, "b", 1, "legal", "violation"),
        event(5, "nobody", 0, "social", "volunteering")], EVENTS)
    people = spark.createDataFrame([("a", "regular", 30.0), ("b", "vip", 990.0)], PEOPLE)
    got = {r.event_id: (r.score_change, r.previous_score, r.new_score, r.status)
           for r in score_events(spark, events, people, ALL_RULES).collect()}
    assert got[1] == (-75.0, 30.0, 0.0, "success")       # change stays unclamped
    assert got[2] == (24.0, 0.0, 24.0, "success")        # same time: lower id first
    assert got[3] == (pytest.approx(26.4), 990.0, 1000.0, "success")
    assert got[4][2] == pytest.approx(917.5)
    assert got[5] == (24.0, 500.0, 524.0, "success")     # baseline
    strict = {r.event_id: r for r in score_events(spark, events, people, ALL_RULES, strict_profiles=True).collect()}
    assert strict[5].status == "error" and strict[5].new_score == 0.0 and strict[5].applied_rules is None
    assert strict[1].new_score == 0.0 and strict[2].new_score == 24.0


def test_latest_state_skips_unseen_types(spark):
    events = spark.createDataFrame([event(1, "a", 0, "social", "volunteering"), event(2, "a", 5, "civic")], EVENTS)
    people = spark.createDataFrame([("a", "regular", 400.0)], PEOPLE)
    row = latest_state(score_events(spark, events, people, ALL_RULES)).first()
    assert (row.score, row.tier, row.last_event_id) == (424.0, "average", 1)


def test_spreading(spark):
    events = spark.createDataFrame([
        event(1, "a", 0, "relationship", rel="family_event", positive=True, intensity=1.0, spread=True),
        event(2, "a", 1, "relationship", rel="community_event", positive=False, intensity=0.5, spread=True),
        event(3, "a", 2, "relationship", rel="family_event", positive=True, intensity=1.0, spread=False),
        event(4, "lonely", 2, "relationship", rel="family_event", positive=True, intensity=1.0, spread=True)], EVENTS)
    people = spark.createDataFrame([("a", "regular", 500.0)], PEOPLE)
    edges = spark.createDataFrame([("a", "b", "family_member"), ("a", "a", "family_member"), ("a", "c", "friend"),
                                   ("a", "c", "neighbor"), ("a", "d", "colleague")], "src string, dst string, rel string")
    out = neighbour_deltas(score_events(spark, events, people, ALL_RULES), edges)
    got = sorted((r.event_id, r.subject_id, r.rel, r.score_change) for r in out.collect())
    assert got == [(1, "b", "family_member", 1.5), (2, "c", "friend", pytest.approx(-8 * 0.15 * 0.5 * 0.7)),
                   (2, "c", "neighbor", pytest.approx(-0.42))]


def test_onboarding_types(spark):
    def made(i, **fields):
        base = {"initial_age": 20, "initial_score": 450.5, "citizen_type": "student", "initial_status": "active"}
        import json
        doc = {k: v for k, v in {**base, **fields}.items() if v is not ...}
        return (i, f"s{i}", T0, "system", "new_citizen", 1.0, json.dumps(doc), "x")

    df = spark.createDataFrame([made(1), made(2, initial_age="20"), made(3, initial_score="9"), made(4, citizen_type=1),
                                made(5, initial_status=...), made(6, initial_age=20.5)], SCHEMA)
    good, bad = onboard(df)
    assert [tuple(r)[:6] for r in good.collect()] == [("s1", 20, 450.5, "student", "active", "average")]
    assert sorted(r.event_id for r in bad.collect()) == [2, 3, 4, 5, 6]


def test_constraints(spark):
    rules = R.rules_frame(spark, [Rule("ok", "x", 1.0), Rule("", "x", 1.0, status="weird")])
    assert sorted(r.violation for r in violations(rules, "ord", RULE_CONSTRAINTS).collect()) == [
        "rule_id:required", "status:enum"]
    config = spark.createDataFrame([("c", None, 0.0, 1000.0, False, 0.1, 0.0, None, [], [])], CONFIG_COLUMNS)
    assert [r.violation for r in violations(config, "config_id", CONFIG_CONSTRAINTS).collect()] == ["baseline:required"]
    good, bad = split_valid(spark.createDataFrame([("1", "a", "t"), ("2", "", "t"), (None, "a", None)],
                                                  "event_id string, subject_id string, event_type string"))
    assert good.count() == 1 and sorted(r.missing for r in bad.collect()) == ["event_id,event_type", "subject_id"]


def test_unmatched(spark):
    df = frame(spark, "{}", kind="civic")
    table = R.rules_frame(spark, ALL_RULES)
    assert R.unmatched_events(df, table).count() == 1
    assert R.unmatched_events(df, R.rules_frame(spark, [*ALL_RULES, Rule("w", "*", 1.0)])).count() == 0


def test_score_events_with_cooldown_and_with_a_rule_table(spark):
    from dataclasses import replace

    events = spark.createDataFrame([event(i, "a", i, "social", "volunteering") for i in range(4)], EVENTS)
    people = spark.createDataFrame([("a", "regular", 500.0)], PEOPLE)
    limited = [replace(r, cooldown_seconds=7200, max_in_period=1) if r.rule_id == "social_positive" else r
               for r in ALL_RULES]
    out = score_events(spark, events, people, limited, cooldown=True).orderBy("event_id").collect()
    assert [r.new_score for r in out] == [524.0, 524.0, 548.0, 548.0]
    assert [r.applied_rules for r in out] == [["social_positive"], [], ["social_positive"], []]
    placed = events.withColumns({c: F.lit("x") for c in ("city", "region", "country")})
    assert measures.rule_executions(score_events(spark, placed, people, limited, cooldown=True)).count() == 2
    table = score_events(spark, events, people, R.rules_frame(spark, ALL_RULES)).orderBy("event_id").collect()
    assert [r.new_score for r in table] == [524.0, 548.0, 572.0, 596.0]


def test_details_are_not_shuffled_and_late_columns_not_written(spark):
    """Columns that follow from a row are the rules' and the result's, but the shuffle and the written table do without them."""
    events = spark.createDataFrame([event(i, "ab"[i % 2], i, "social", "volunteering") for i in range(1, 6)], EVENTS)
    people = spark.createDataFrame([("a", "regular", 30.0), ("b", "vip", 990.0)], PEOPLE)
    base, shown = events.drop("event_type", "event_subtype"), []

    def details(df):
        shown.append(df.columns)
        return df.withColumns({"event_type": F.lit("social"), "event_subtype": F.lit("volunteering")})

    got = score_events(spark, base, people, ALL_RULES, details=details, late=lambda df: df.withColumn("note", F.concat("event_type", F.lit("!"))))
    want = score_events(spark, events, people, ALL_RULES).withColumn("note", F.concat("event_type", F.lit("!")))
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(want.drop("scan_order").columns)
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.select(names).collect()))
    assert any("chunk_pos" in columns for columns in shown)  # behind the kernel, just before the write
    written = set().union(*[spark.read.parquet(f).columns for f in got.inputFiles()])
    assert "event_subtype" in written and "note" not in written
