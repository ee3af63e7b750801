"""Rule matching: type, conditions, combination, validity, subsets, multipliers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from scoreloom.functions.numeric import on_grid, pick
from scoreloom.functions.scoring import rule_score
from scoreloom.model import RULE, Condition, Multiplier, Rule, ScoreConfig
from scoreloom.operators.measures import payload_entries

ANY_TYPE = "*"
ACTIVE = "active"
DOCUMENT = "payload_document"

# User logic for a rule: identifier -> function that returns a boolean Column.
_custom: dict[str, Callable[[], Column]] = {}


def register_logic(identifier: str, build: Callable[[], Column]) -> None:
    """Register logic a rule may name in ``custom_logic``; it must be a Column expression."""
    _custom[identifier] = build


def rules_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame([r.row(i) for i, r in enumerate(rules)], RULE)


def active_rules(rules: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rules whose status is active and whose validity covers ``as_of``."""
    t = F.lit(as_of).cast("timestamp")
    return rules.filter((F.col("status") == ACTIVE) & (F.col("valid_from") <= t)
                        & (F.col("valid_to").isNull() | (F.col("valid_to") >= t)))


def load_rules(rules: DataFrame, as_of: dt.datetime) -> list[Rule]:
    """Active rules as a list, to be compiled into columns.

    A list and a table score alike (:func:`apply_rules`, :func:`apply_rule_table`); a long table is better left a table.
    """
    rows = active_rules(rules, as_of).orderBy("ord").collect()

    def value(c):
        return {"bool": c.flag, "number": c.number, "string": c.text, "nested": {}}[c.kind]

    return [Rule(r.rule_id, r.event_type, r.points, r.multiplier,
                 tuple(Condition(c.field, c.operator, value(c)) for c in r.conditions or ()),
                 r.logic or "AND", r.name or "", r.cooldown_seconds, r.max_in_period,
                 tuple(Multiplier(m.name, m.factor, m.flag) for m in r.multipliers or ()), tuple(r.tags or ()),
                 r.custom_logic, r.status, r.valid_from, r.valid_to) for r in rows]


def active_list(rules: Iterable[Rule], as_of: dt.datetime) -> list[Rule]:
    """:func:`active_rules` for a list."""
    return [r for r in rules if r.status == ACTIVE and r.valid_from <= as_of and (r.valid_to is None or r.valid_to >= as_of)]


def select_rules(rules: Iterable[Rule], config: ScoreConfig) -> list[Rule]:
    """The configured subset: by id list, else by included and excluded tags."""
    out = []
    for r in rules:
        if config.rule_ids is not None and r.rule_id not in config.rule_ids:
            continue
        if config.include_tags and not set(r.tags) & set(config.include_tags):
            continue
        if set(r.tags) & set(config.exclude_tags):
            continue
        out.append(r)
    return out


def select_rule_rows(rules: DataFrame, ids: DataFrame | None = None, include: Sequence[str] = (),
                     exclude: Sequence[str] = ()) -> DataFrame:
    """The same subset on a rule table; ``ids`` is a one-column table of rule ids."""
    if ids is not None:
        rules = rules.join(ids, "rule_id", "left_semi")
    if include:
        rules = rules.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in include])))
    if exclude:
        rules = rules.filter(~F.coalesce(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in exclude])),
                                         F.lit(False)))
    return rules


# --- compiled form -------------------------------------------------------------------------------

def _as_text(value: Column, kind: str) -> Column:
    """Text of a payload value; whole doubles print without a fraction."""
    if kind in ("double", "float"):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    return value.cast("string")


class Payload:
    """Finds a condition's field: a typed column if the table has one, else the JSON payload."""

    def __init__(self, df: DataFrame) -> None:
        self._types = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def _variant(self, field: str) -> tuple[Column, str]:
        doc = F.col(DOCUMENT) if DOCUMENT in self._types else F.try_parse_json(F.col("payload"))
        return doc, f"$['{field}']"

    def typed(self, field: str) -> str | None:
        return self._types.get(field)

    def exists(self, field: str) -> Column:
        if field in self._types:
            return F.col(field).isNotNull()
        doc, path = self._variant(field)
        return F.try_variant_get(doc, path, "variant").isNotNull()

    def _kind(self, field: str) -> Column:
        doc, path = self._variant(field)
        return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))

    def as_text(self, field: str) -> Column:
        kind = self._types.get(field)
        if kind:
            return _as_text(F.col(field), kind)
        doc, path = self._variant(field)
        is_number = ~self._kind(field).isin("STRING", "BOOLEAN")
        return F.when(is_number, _as_text(F.try_variant_get(doc, path, "double"), "double")).otherwise(
            F.try_variant_get(doc, path, "string"))

    def as_number(self, field: str) -> Column:
        kind = self._types.get(field)
        if kind:
            return F.lit(None).cast("double") if kind in ("string", "boolean") else F.col(field).cast("double")
        doc, path = self._variant(field)
        return F.when(~self._kind(field).isin("STRING", "BOOLEAN"), F.try_variant_get(doc, path, "double"))

    def as_flag(self, field: str) -> Column:
        kind = self._types.get(field)
        if kind:
            return F.col(field) if kind == "boolean" else F.lit(None).cast("boolean")
        doc, path = self._variant(field)
        return F.when(self._kind(field) == "BOOLEAN", F.try_variant_get(doc, path, "boolean"))


def _plain(value) -> str:
    """A condition's value as text; whole numbers without a fraction."""
    return str(int(value)) if isinstance(value, float) and value == int(value) else str(value)


def condition_column(c: Condition, payload: Payload, strict: bool = False) -> Column:
    """One condition as a never-null boolean.

    ``strict`` compares by equality only, so an operator condition such as ``{"$gt": 0}`` never holds;
    the default evaluates the operator.
    """
    field = c.field.removeprefix("payload.")
    if strict and c.operator != "EQUALS":
        return F.lit(False)
    if c.operator == "EQUALS":
        if isinstance(c.value, bool):
            hit = payload.as_flag(field) == F.lit(c.value)
        elif isinstance(c.value, (int, float)):
            hit = payload.as_number(field) == F.lit(float(c.value))
        elif isinstance(c.value, str):
            hit = payload.as_text(field) == F.lit(c.value)
        else:
            hit = F.lit(False)
    elif c.operator == "GREATER_THAN":
        number = isinstance(c.value, (int, float)) and not isinstance(c.value, bool)
        hit = payload.as_number(field) > F.lit(float(c.value)) if number else F.lit(False)
    elif c.operator == "CONTAINS":
        hit = payload.as_text(field).contains(_plain(c.value))
    elif c.operator == "REGEX_MATCH":
        hit = payload.as_text(field).rlike(_plain(c.value))
    else:
        raise ValueError(f"unknown operator {c.operator!r}")
    return F.coalesce(hit, F.lit(False))


def conditions_column(rule: Rule, payload: Payload, strict: bool = False) -> Column:
    if rule.custom_logic:
        return F.coalesce(_custom[rule.custom_logic](), F.lit(False))
    parts = [condition_column(c, payload, strict) for c in rule.conditions]
    if not parts:
        return F.lit(True)
    return reduce((lambda a, b: a | b) if rule.logic == "OR" else (lambda a, b: a & b), parts)


def type_column(rule: Rule) -> Column:
    return F.lit(True) if rule.event_type == ANY_TYPE else F.col("event_type") == rule.event_type


def _flag_factor(rule: Rule) -> Column:
    """Product of the factors whose profile flag is set."""
    factor = F.lit(1.0)
    for m in rule.multipliers:
        factor = factor * pick((F.coalesce(F.col(m.flag), F.lit(False)), float(m.factor)), default=1.0)
    return factor


def _valid_at_event(rule: Rule) -> Column:
    ok = F.col("ts") >= F.lit(rule.valid_from)
    return ok if rule.valid_to is None else ok & (F.col("ts") <= F.lit(rule.valid_to))


def apply_rules(df: DataFrame, rules: Sequence[Rule], strict: bool = False,
                validity_by_event_time: bool = False) -> DataFrame:
    """Add ``rule_scores`` (fired rules in rule order), ``applied_rules``, ``score_change`` and ``rule_seen``.

    Rules are compiled into column expressions, so this is one projection over the events: no join, no
    explode, no shuffle; the payload is parsed once. Rules that are not active are left out. ``rule_seen`` tells an event whose type no rule names (profile left alone) from one
    whose conditions failed (profile touched with change 0).
    """
    rules = [r for r in rules if r.status == ACTIVE]
    fields = {c.field.removeprefix("payload.") for r in rules for c in r.conditions}
    parsed = "payload" in df.columns and bool(fields - set(df.columns))
    if parsed:
        df = df.withColumn(DOCUMENT, F.try_parse_json("payload"))
    payload = Payload(df)
    cells, seen = [], []
    for rule in rules:
        matches = type_column(rule)
        if validity_by_event_time:
            matches = matches & _valid_at_event(rule)
        seen.append(matches)
        points = rule_score(F.lit(float(rule.points)), F.lit(float(rule.multiplier)))
        if rule.multipliers:
            points = points * _flag_factor(rule)
        cells.append(F.when(matches & conditions_column(rule, payload, strict),
                            F.struct(F.lit(rule.rule_id).alias("rule_id"), points.alias("points"))))
    if not cells:
        cells = [F.lit(None).cast("struct<rule_id:string,points:double>")]
    fired = F.array_compact(F.array(*cells))
    out = df.withColumn("rule_scores", fired)
    if parsed:
        out = out.drop(DOCUMENT)
    return out.withColumns({
        "applied_rules": F.transform("rule_scores", lambda r: r["rule_id"]),
        "score_change": on_grid(sum_points(F.col("rule_scores"))),
        "rule_seen": reduce(lambda a, b: a | b, seen, F.lit(False)),
    })


def sum_points(fired: Column) -> Column:
    return F.aggregate(fired, F.lit(0.0), lambda acc, r: acc + r["points"])


# --- table form ----------------------------------------------------------------------------------

def _typed_payload() -> Column:
    """Payload as map of key to (text, number, flag), worked out once per event; a value has one kind only."""
    def cell(e: Column) -> Column:
        number = F.when(e["kind"] == "number", e["number"])
        return F.struct(e["key"], F.struct(
            F.when(e["kind"] == "number", _as_text(number, "double")).otherwise(e["text"]).alias("text"),
            number.alias("number"), e["flag"].alias("flag")).alias("value"))

    return F.map_from_entries(F.transform(payload_entries(), cell))


def _scalar_columns(df: DataFrame) -> list[str]:
    """The table's scalar columns: what :class:`Payload` finds as typed."""
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() not in ("array", "map", "struct", "binary", "variant") and f.name != "payload"]


def _typed_columns(df: DataFrame, names: Iterable[str]) -> Column:
    """Map of column name to (text, number, flag) for some scalar columns."""
    entries = []
    for f in (df.schema[n] for n in names):
        kind = f.dataType.typeName()
        col = F.col(f"`{f.name}`")
        number = F.lit(None).cast("double") if kind in ("string", "boolean") or not isinstance(f.dataType, NumericType) else col.cast("double")
        flag = col if kind == "boolean" else F.lit(None).cast("boolean")
        entries += [F.lit(f.name), F.struct(_as_text(col, kind).alias("text"), number.alias("number"), flag.alias("flag"))]
    return F.create_map(*entries) if entries else F.lit(None).cast("map<string,struct<text:string,number:double,flag:boolean>>")


def _named(rules: DataFrame, fields: list[str], flags: list[str]) -> tuple[set[str], set[str], set[str], bool]:
    """(fields, flags and logic that rules name, of those given and registered; whether one names a field beside them).

    These are configuration, and no more than there are columns and registered names.
    """
    def some(names: Column, known: Iterable[str]) -> Column:
        return F.array_intersect(F.array_distinct(F.flatten(F.collect_list(names))), F.array(*map(F.lit, known)).cast("array<string>"))

    wanted = F.transform("conditions", lambda c: F.regexp_replace(c["field"], "^payload[.]", ""))
    row = rules.agg(some(wanted, fields).alias("fields"), some(F.transform("multipliers", lambda m: m["flag"]), flags).alias("flags"),
                    some(F.array("custom_logic"), _custom).alias("logic"),
                    F.coalesce(F.bool_or(F.exists(wanted, lambda f: ~f.isin(fields))), F.lit(False)).alias("other")).first()
    return set(row.fields), set(row.flags), set(row.logic), row.other


def _unknown(what: str, name: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"unknown {what} "), name)).cast("boolean")


def _condition_holds(typed: Column, payload: Column, c: Column, strict: bool) -> Column:
    field = F.regexp_replace(c["field"], "^payload[.]", "")
    value = F.coalesce(F.element_at(typed, field), F.element_at(payload, field))
    as_text, as_number, as_flag = value["text"], value["number"], value["flag"]
    equal = c["operator"] == "EQUALS"
    hit = (F.when(equal & (c["kind"] == "string"), as_text == c["text"])
           .when(equal & (c["kind"] == "number"), as_number == c["number"])
           .when(equal & (c["kind"] == "bool"), as_flag == c["flag"]).when(equal, F.lit(False)))
    if strict:
        hit = hit.otherwise(F.lit(False))
    else:
        # A number as pattern or part is the text it has in a list.
        wanted = F.coalesce(c["text"], _as_text(c["number"], "double"))
        hit = (hit.when(c["operator"] == "GREATER_THAN", as_number > c["number"])
               .when(c["operator"] == "CONTAINS", F.contains(as_text, wanted))
               .when(c["operator"] == "REGEX_MATCH", F.regexp_like(as_text, wanted))
               .otherwise(_unknown("operator", c["operator"])))
    return F.coalesce(hit, F.lit(False))


def rules_by_type(rules: DataFrame, entry: Column) -> tuple[Column, Column]:
    """(map of event type to its sorted rules with the wildcard rules, the wildcard rules alone), as scalars.

    Rules are configuration, far fewer than events: they go to the events as one value, and no event is shuffled for them.
    """
    wild = rules.filter(F.col("event_type") == ANY_TYPE).agg(F.sort_array(F.collect_list(entry)).alias("wild"))
    own = (rules.filter(F.col("event_type") != ANY_TYPE).groupBy("event_type").agg(F.collect_list(entry).alias("own"))
           .select("event_type", F.sort_array(F.concat("own", wild.scalar())).alias("rules")))
    table = own.agg(F.map_from_entries(F.collect_list(F.struct("event_type", "rules"))))
    return table.scalar(), wild.scalar()


def apply_rule_table(df: DataFrame, rules: DataFrame, strict: bool = False, validity_by_event_time: bool = False) -> DataFrame:
    """Same result as :func:`apply_rules`, for a rule table of any length.

    Rules come as one value per event type, sorted once. Conditions, factors and custom logic are evaluated inside the row,
    so events are neither shuffled nor multiplied.
    """
    entry = F.struct("ord", "rule_id", "logic", "conditions", "points", "multiplier", "multipliers", "custom_logic",
                     "valid_from", "valid_to")
    rules = rules.filter(F.col("status") == ACTIVE)
    # Only columns, flags and logic that a rule names are looked at, as an event has many columns and logic may need some it lacks.
    scalars = _scalar_columns(df)
    fields, named_flags, used, other = _named(rules, scalars, [c for c, kind in df.dtypes if kind == "boolean"])
    by_type, wild = rules_by_type(rules, entry)
    flags = [x for c in sorted(named_flags) for x in (F.lit(c), F.coalesce(F.col(f"`{c}`"), F.lit(False)))]
    parse = "payload" in df.columns and other
    helpers = {"payload_map": _typed_payload() if parse else F.lit(None).cast("map<string,struct<text:string,number:double,flag:boolean>>"),
               "typed_map": _typed_columns(df, sorted(fields)), "flag_map": F.create_map(*flags) if flags else F.lit(None).cast("map<string,boolean>"),
               "by_type": by_type, "wild": wild}
    matched = df.withColumns(helpers)

    def holds(r: Column) -> Column:
        def test(c: Column) -> Column:
            return _condition_holds(F.col("typed_map"), F.col("payload_map"), c, strict)

        empty = F.size(r["conditions"]) == 0
        own = F.when(r["logic"] == "OR", empty | F.exists(r["conditions"], test)).otherwise(F.forall(r["conditions"], test))
        logic = F.when(r["custom_logic"].isNull(), own)
        for name in sorted(used):
            logic = logic.when(r["custom_logic"] == name, F.coalesce(_custom[name](), F.lit(False)))
        return logic.otherwise(_unknown("custom logic", r["custom_logic"]))

    def cell(r: Column) -> Column:
        factor = F.aggregate(r["multipliers"], F.lit(1.0), lambda acc, m: acc * F.when(
            F.coalesce(F.element_at("flag_map", m["flag"]), F.lit(False)), m["factor"]).otherwise(1.0))
        return F.struct(r["rule_id"].alias("rule_id"), (rule_score(r["points"], r["multiplier"]) * F.coalesce(factor, F.lit(1.0))).alias("points"))

    found = F.coalesce(F.element_at("by_type", F.col("event_type")), F.col("wild"))
    if validity_by_event_time:
        found = F.filter(found, lambda r: (F.col("ts") >= r["valid_from"]) & F.coalesce(F.col("ts") <= r["valid_to"], F.lit(True)))
    out = (matched.withColumn("candidates", found)
           .withColumn("rule_scores", F.transform(F.filter("candidates", holds), cell)))
    return (out.withColumns({
        "applied_rules": F.transform("rule_scores", lambda r: r["rule_id"]),
        "score_change": on_grid(sum_points(F.col("rule_scores"))),
        "rule_seen": F.coalesce(F.size("candidates") > 0, F.lit(False)),
    }).drop("candidates", *helpers))


def matching_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Event and rule pairs whose types match."""
    by_type, wild = rules_by_type(rules, F.struct("ord", "rule_id"))
    found = df.select("event_id", "event_type").withColumns({"by_type": by_type, "wild": wild})
    mine = F.coalesce(F.element_at("by_type", F.col("event_type")), F.col("wild"))
    return found.select("event_id", F.explode(mine).alias("r")).select("event_id", F.col("r.rule_id").alias("rule_id"))


def fired_rows(scored: DataFrame, *keep: str) -> DataFrame:
    """One row per fired rule: its id, its own points and its place in rule order."""
    return scored.select(*keep, F.posexplode("rule_scores").alias("rule_pos", "fired")).select(
        *keep, "rule_pos", F.col("fired.rule_id").alias("rule_id"), F.col("fired.points").alias("rule_points"))


def unmatched_events(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Events whose type no rule names."""
    named = rules.agg(F.collect_set("event_type").alias("types"))
    known = F.array_contains("rule_types", F.col("event_type")) | F.array_contains("rule_types", ANY_TYPE)
    return df.withColumn("rule_types", named.scalar()).filter(~known).drop("rule_types")


def flag_multiplier(df: DataFrame, multipliers: Sequence[tuple[str, float]]) -> Column:
    """Product of factors for the boolean columns that are true; missing flags count as false."""
    factor = F.lit(1.0)
    for flag, value in multipliers:
        factor = factor * pick((F.coalesce(F.col(flag), F.lit(False)), float(value)), default=1.0)
    return factor
