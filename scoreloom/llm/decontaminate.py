"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens in which numbers, names and units are typed placeholders, so a question that was asked
again with other values keeps its template. Windows of six tokens are joined by hash. A document is probed for those windows of
items that hold three literal words. Documents that hit are compared window by window, with or without literal words, windows on one diagonal (same distance between the places in both texts) make a run, and a run counts when it has
13 tokens or the whole item. Then the values in the slots are compared: each value of the item must stand for one value of
the document throughout the run, else the likeness is of the form only, and what counts is the longest stretch in it that is word for
word the same, values too, if that has 13 tokens or the whole item.

Names are capitalised words inside a sentence, which a question's first word in mid-line or a lower-cased copy would be taken for
wrongly. So a window with a name has a second form, in which names are words in lower case; forms of either text meet those of
the other, and whether a word was a name is settled by what matches. Units are a fixed list behind a number. Items with fewer than eight tokens,
or with no window of three literal words, can't be told from chance and match nothing. Null and empty texts match nothing.
Repeated documents each get their rows; repeated items count once per item id, and an id with different texts has the best
match of any. Empty tables give empty results.

Everything is DataFrame functions. The benchmark's windows go to all tasks only when their number is under a stated bound.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import fresh, stored, text_key

WINDOW = 6
RUN = 13
MIN_ITEM = 8
MIN_LITERALS = 3
#: Benchmark windows (16 bytes each, tens of bytes in a hash table) sent to all tasks; above it the join is shuffled.
BROADCAST_WINDOWS = 500_000
#: Slots of a run that must keep one meaning; a run whose slots contradict each other in more than this share is dropped.
MAX_CONFLICTS = 0.0

# Placeholder marks (private-use characters) and the units told behind a number.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
UNITS = ("mm", "cm", "m", "km", "in", "ft", "mi", "miles", "meters", "metres", "kg", "g", "mg", "lb", "lbs", "oz", "pounds", "s",
         "sec", "seconds", "min", "minutes", "h", "hr", "hours", "days", "weeks", "months", "years", "l", "ml", "liters", "litres",
         "gallons", "mph", "kmh", "km/h", "dollars", "euros", "cents", "usd", "eur", "percent", "degrees")

_NAME = r"(?=\p{Lu})(?<=[\p{Ll}\p{N},;][ ])(\p{Lu}[\p{L}\p{M}]*+)"
_NUMBER = r"(\p{N}[\p{N}.,]*+)"
_UNIT = "([ ]?+)((?i:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{M}]))"


def _named(text: Column) -> Column:
    """Tokens with placeholders; names stand behind theirs, other values are gone."""
    t = F.regexp_replace(F.regexp_replace(text, _NAME, f"{NAME}$1"), _NUMBER, f" {NUMBER} ")
    t = F.regexp_replace(t, f"{NUMBER} {_UNIT}", f"{NUMBER} {UNIT} ")
    return F.filter(F.split(F.lower(t), rf"[^\p{{L}}\p{{M}}{NAME}-{UNIT}]+"), lambda w: w != "")


def _templated(text: Column) -> Column:
    """Tokens with placeholders, values gone."""
    return F.transform(_named(text), _shape)


def _valued(text: Column) -> Column:
    """The same tokens with the value behind each placeholder."""
    t = F.regexp_replace(F.regexp_replace(text, _NAME, f"{NAME}$1"), _NUMBER, f" {NUMBER}$1 ")
    t = F.regexp_replace(t, rf"({NUMBER}[\p{{N}}.,]*+) {_UNIT}", f"$1 {UNIT}$3 ")
    token = rf"{NUMBER}[\p{{N}}.,]*+|{UNIT}[\p{{L}}/]++|[{NAME}\p{{L}}\p{{M}}][\p{{L}}\p{{M}}]*+"
    return F.regexp_extract_all(F.lower(t), F.lit(f"({token})"), F.lit(1))


def _shape(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    return F.when(first.isin(NAME, NUMBER, UNIT), first).otherwise(token)


def _bare(token: Column) -> Column:
    """A token without the mark of a name."""
    return F.when(F.substring(token, 1, 1) == NAME, F.substring(token, 2, 1 << 30)).otherwise(token)


def _word(token: Column) -> Column:
    """A token's shape where names are words."""
    first = F.substring(token, 1, 1)
    return F.when(first == NAME, F.substring(token, 2, 1 << 30)).when(first.isin(NUMBER, UNIT), first).otherwise(token)


def _let(value: Column, body) -> Column:
    """body(value) with the value worked out once, also where the body uses it inside a loop over an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(tokens: Column) -> Column:
    """(place, hash, whether names are words in it) of every window of an array of tokens with values, and of its form without names if it has one."""
    def build(shapes: Column, words: Column) -> Column:
        last = F.size(shapes) - WINDOW
        places = F.when(last >= 0, F.sequence(F.lit(0), last))
        named = F.filter(places, lambda i: F.array_contains(F.slice(shapes, i + 1, WINDOW), NAME))
        form = lambda t, i, f: F.struct(i.alias("at"), F.xxhash64(F.slice(t, i + 1, WINDOW)).alias("hash"), F.lit(f).alias("words"))
        plain = F.transform(places, lambda i: form(shapes, i, False))
        return F.when(F.array_contains(shapes, NAME), F.concat(plain, F.transform(named, lambda i: form(words, i, True)))).otherwise(plain)

    return _let(F.transform(tokens, _shape), lambda shapes: _let(F.transform(tokens, _word), lambda words: build(shapes, words)))


def _probes(docs: DataFrame) -> DataFrame:
    """(key, hash) of the windows, in both forms, of rows (key, tokens); the hashes are those of ``_windows``.

    Places become rows before they are hashed, as compiled code reaches rows and not the inside of array functions.
    """
    last = F.size("tokens") - WINDOW
    # Two numbers a place: the even one for its plain form, the odd one for that in which names are words. Short texts get a null that
    # goes afterwards: a filter before, which a plain explode brings along too, would make the tokens twice.
    numbered = docs.select("key", "tokens", F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), 2 * last + 1))).alias("n"))
    odd = F.col("n").bitwiseAND(F.lit(1)) == 1
    window = [F.get("tokens", F.shiftright("n", 1) + k) for k in range(WINDOW)]
    named = functools.reduce(operator.or_, [t.startswith(NAME) for t in window])
    form = [F.when(~t.startswith(NAME), t).when(odd, F.substring(t, 2, 1 << 30)).otherwise(NAME) for t in window]
    return numbered.where(F.col("n").isNotNull() & (~odd | named)).select("key", F.xxhash64(*form).alias("hash"))


def _hinted(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_WINDOWS else df


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """Rows (key, item_id, run_tokens, item_tokens, n_slots, n_changed) per different text and item; key is text_key."""
    items = (benchmark.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").alias("t")).where("t is not null")
             .distinct().withColumn("item", F.struct(F.col("item").alias("id"), text_key(F.col("t")).alias("of"))).withColumn("values", _valued(F.col("t")))
             .withColumn("tokens", F.transform("values", _shape)).where(F.size("tokens") >= MIN_ITEM).drop("t"))
    items = stored(items, "bench-items")
    part = F.slice("values", F.col("w.at") + 1, WINDOW)
    marks = F.size(F.filter(part, lambda v: F.substring(v, 1, 1).isin(NUMBER, UNIT) | (~F.col("w.words") & v.startswith(NAME))))
    windows = (items.select("item", "values", F.explode(_windows(F.col("values"))).alias("w"))
               .select("item", F.col("w.at").alias("item_at"), F.col("w.hash").alias("hash"),
                       (WINDOW - marks >= MIN_LITERALS).alias("telling")))
    windows = stored(windows, "bench-windows")
    telling = windows.where("telling")
    n_windows = telling.count()

    # Probe: which texts have a window of which item. A text is probed as often as it stands in the table.
    whole = docs.select(F.col(f"`{text}`").alias("text")).where("text is not null")
    probes = _probes(whole.select(text_key(F.col("text")).alias("key"), _named(F.col("text")).alias("tokens")))
    known = telling.groupBy("hash").agg(F.collect_set("item").alias("items"))
    hits = stored(probes.join(_hinted(known, n_windows), "hash").select("key", F.explode("items").alias("item")).distinct(),
                  "bench-hits")

    # Compare: all windows of the texts that hit, each text once.
    keys = hits.select("key").distinct()
    chosen = (whole.withColumn("key", text_key(F.col("text"))).join(keys, "key", "left_semi").dropDuplicates(["key"])
              .withColumn("values", _valued(F.col("text"))).select("key", "values"))
    chosen = stored(chosen, "bench-texts")
    places = chosen.select("key", F.explode(_windows(F.col("values"))).alias("w")).select("key", F.col("w.at").alias("at"),
                                                                                          F.col("w.hash").alias("hash"))
    # Windows without literal words are common, so only those of the items that hit the text are looked up in it.
    same = places.join(hits.join(windows.select("item", "item_at", "hash"), "item"), ["key", "hash"])
    diagonal = (same.groupBy("key", "item", (F.col("at") - F.col("item_at")).alias("shift"))
                .agg(F.array_sort(F.collect_set("item_at")).alias("places")))
    # A run is windows whose places follow each other by at most a window; it spans from its first to its last token.
    runs = F.aggregate("places", F.expr("array(named_struct('low', -1, 'high', -100))"), lambda acc, p: F.when(
        p - F.element_at(acc, -1)["high"] <= WINDOW, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["low"].alias("low"), p.alias("high"))))).otherwise(
        F.concat(acc, F.array(F.struct(p.alias("low"), p.alias("high"))))))
    spans = (diagonal.select("key", "item", "shift", F.explode(runs).alias("r")).where("r.low >= 0")
             .join(items.withColumnRenamed("values", "item_values"), "item")
             .select("key", "item", "shift", F.col("r.low").alias("low"), (F.col("r.high") + WINDOW).alias("high"),
                     "item_values", F.size("item_values").alias("item_tokens"))
             .where("high - low >= least(13, item_tokens)".replace("13", str(RUN))))
    pairs = (spans.join(chosen.select("key", "values"), "key")
             .withColumn("_a", F.slice("item_values", F.col("low") + 1, F.col("high") - F.col("low")))
             .withColumn("_b", F.slice("values", F.col("low") + F.col("shift") + 1, F.col("high") - F.col("low")))
             .withColumn("slots", F.filter(F.arrays_zip("_a", "_b"), lambda z: F.substring(z["_a"], 1, 1).isin(NAME, NUMBER, UNIT)))
             .withColumn("slots", F.transform("slots", lambda z: F.struct(_bare(z["_a"]).alias("_a"), _bare(z["_b"]).alias("_b"))))
             .withColumn("links", F.array_distinct("slots"))
             .withColumn("conflicts", F.size("links") - F.size(F.array_distinct(F.transform("links", lambda z: z["_a"]))))
             .withColumn("changed", F.size(F.filter("slots", lambda z: z["_a"] != z["_b"]))))
    whole_run = pairs.where(F.col("conflicts") <= F.lit(MAX_CONFLICTS) * F.size("slots")).select(
        "key", "item", "item_tokens", "low", "shift", (F.col("high") - F.col("low")).alias("run"), F.size("slots").alias("n_slots"), "changed")
    # Of a run that contradicts itself: its stretches without a difference, longest first, as (-tokens, place, end).
    alike = F.transform(F.arrays_zip("_a", "_b"), lambda z: _bare(z["_a"]).eqNullSafe(_bare(z["_b"])))
    breaks = F.concat(F.array(F.lit(-1)), F.filter(F.transform("alike", lambda x, i: F.when(~x, i)), lambda i: i.isNotNull()),
                      F.array(F.size("alike")))
    stretches = F.zip_with("breaks", F.slice("breaks", 2, F.size("breaks")), lambda x, y: F.struct(
        (x + 1 - y).alias("less"), (x + 1).alias("from"), y.alias("to")))
    torn = (pairs.where(F.col("conflicts") > F.lit(MAX_CONFLICTS) * F.size("slots")).withColumn("alike", alike).withColumn("breaks", breaks)
            .withColumn("best", F.array_min(F.filter(stretches, lambda z: z["to"].isNotNull())))
            .where(-F.col("best.less") >= F.least(F.lit(RUN), F.col("item_tokens"))))
    mark = lambda w: F.substring(w, 1, 1).isin(NAME, NUMBER, UNIT)
    stretch = torn.select("key", "item", "item_tokens", (F.col("low") + F.col("best.from")).alias("low"), "shift", (-F.col("best.less")).alias("run"),
                          F.size(F.filter(F.slice("_a", F.col("best.from") + 1, -F.col("best.less")), mark)).alias("n_slots"),
                          F.lit(0).alias("changed"))
    good = whole_run.union(stretch)
    best = good.groupBy("key", F.col("item.id").alias("item_id")).agg(F.max_by(
        F.struct(F.col("run").alias("run_tokens"), "item_tokens", "n_slots", F.col("changed").alias("n_changed")),
        F.struct("run", -F.col("changed"), -F.col("low"), -F.col("shift"), "item_tokens", "item.of")).alias("m"))
    return best.select("key", "item_id", *[F.col(f"m.{c}").cast("long").alias(c) for c in
                                                               ("run_tokens", "item_tokens", "n_slots", "n_changed")])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """One row per document and item found in it: id, item, length of the run, and how many slot values changed."""
    found = stored(matches(docs, benchmark, text, **names), "bench-matches")
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("key"))
    return (keyed.join(found, "key").drop("key")
            .withColumn("reparameterised", F.col("n_changed") > 0))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs in which no item was found, with their columns."""
    found = stored(matches(docs, benchmark, text).select("key").distinct(), "bench-keys")
    key = fresh("text_key", docs.columns)
    return (docs.withColumn(key, text_key(F.col(f"`{text}`")))
            .join(found.withColumnRenamed("key", key), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]))
