"""Mixing sources to target weights by Pareto order sampling.

Targets. The words of all documents are shared among the sources by weight; no source gets more than ``max_copies`` times
its own words, and what it can't take goes to the others by weight. That is water filling: every source gets
``min(max_copies * size, level * weight)`` with one level for all, found from running sums over the sources in the order in
which they fill up (one row per source).

Copies. A document's expected number of copies is its source's target over the source's words, times the document's own
weight if there is one. The whole part is certain. The fraction p is an inclusion probability, and Pareto order sampling
(Rosen 1997) draws the fixed-size sample: documents are ranked by random odds over inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, and the lowest ranks are taken until their words come nearest to what the source still
lacks. Random numbers come from a hash of seed, id and text, so reruns agree.

The cut in a source's ranking is found without sorting the source: ranks are counted in bins of log odds (a bin near the cut
holds under 0.02 % of a source, however large), and only the bin that holds the cut is ordered.

Null or empty texts have size 0: they fall under the ranking like others and take no words. A null source is a source of its
own and comes last. Rows that repeat id and text share one random number and are taken alike. Sources without words
have target 0 and are left out of a mix. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import fresh, stored, without, word_count

WEIGHT_CYCLE = (1, 2, 3)
MAX_COPIES = 3
SEED = 20_261
BINS_PER_OCTAVE = 1024
#: A table of one row per source goes to all tasks up to this many rows (at most some tens of MB); beyond it rows are salted.
BROADCAST_ROWS = 100_000
SALTS = 64


def join_sources(df: DataFrame, sources: DataFrame, salt: Column) -> DataFrame:
    """df with the columns of its source's row; ``_source`` is the key on both sides (null equals null)."""
    key = [c for c in sources.columns if c != "_source"]
    named = sources.withColumnRenamed("_source", "_of")
    if sources.count() <= BROADCAST_ROWS:
        joined = df.join(F.broadcast(named), F.col("_source").eqNullSafe(F.col("_of")))
        return joined.select(*df.columns, *key)
    left = df.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    right = named.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = left.join(right, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_salt") == F.col("_other")))
    return joined.select(*df.columns, *key)


def source_targets(sized: DataFrame, weights: DataFrame | None = None, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: size, weight and target in words, from rows of (_source, _size).

    ``weights`` has (_source, weight); without it sources weigh 1, 2, 3 in turn, in the order of their names.
    """
    totals = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    if weights is None:
        cycle = F.array(*[F.lit(float(w)) for w in WEIGHT_CYCLE])
        turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHT_CYCLE)))
        totals = totals.withColumn("weight", F.get(cycle, turn))
    else:
        given = weights.select(F.col("_source").alias("_of"), F.col("weight").cast("double").alias("weight"))
        totals = (totals.join(given, F.col("_source").eqNullSafe(F.col("_of")), "left")
                  .select("_source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight")))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy("_full", F.col("_source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    most = F.lit(max_copies) * F.col("source_size")
    total = lambda c: F.sum(c).over(everything).cast("double")
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("double")
    level = (F.col("_all") - F.col("_filled")) / F.greatest(F.col("_weights") - F.col("_spent"), F.lit(1e-300))
    return (totals.withColumn("_most", most)
            .withColumn("_full", F.when(F.col("weight") > 0, F.col("_most") / F.col("weight")).otherwise(F.lit(1e300)))
            .withColumn("_all", total("source_size")).withColumn("_weights", total("weight"))
            .withColumn("_filled", earlier("_most")).withColumn("_spent", earlier("weight"))
            .withColumn("_level", F.when(F.col("weight") > 0, level))
            .withColumn("_level", F.when(F.col("_full") >= F.col("_level"), F.col("_level")))
            .withColumn("_level", F.coalesce(F.min_by("_level", F.when(F.col("_level").isNotNull(), F.col("_full")))
                                             .over(everything), F.lit(0.0)))
            .select("_source", "source_size", "weight", F.least(
                F.col("_most").cast("double"), F.col("_level") * F.col("weight")).alias("target")))


def _with_capped_weights(sized: DataFrame, max_copies: int) -> DataFrame:
    """Expected copies with document weights, the excess over ``max_copies`` reshared until none is above."""
    df = sized.withColumn("_capped", F.lit(False))
    while True:
        free = (df.groupBy("_source").agg(
            F.max("target").alias("_t"),
            F.sum(F.when(F.col("_capped"), F.col("_size") * float(max_copies)).otherwise(0.0)).alias("_used"),
            F.sum(F.when(~F.col("_capped"), F.col("_size") * F.col("_weight")).otherwise(0.0)).alias("_room")))
        rate = (F.col("_t") - F.col("_used")) / F.when(F.col("_room") > 0, F.col("_room"))
        free = stored(free.select("_source", F.coalesce(rate, F.lit(0.0)).alias("_rate")), "mix-rates")
        joined = join_sources(df.drop("_rate"), free, F.col("_hash"))
        over = ~F.col("_capped") & (F.col("_rate") * F.col("_weight") > max_copies)
        df = stored(joined.withColumn("_over", over), "mix-weights")
        if df.where("_over").limit(1).count() == 0:
            return df.withColumn("expected", F.when(F.col("_capped"), F.lit(float(max_copies))).otherwise(
                F.col("_rate") * F.col("_weight"))).drop("_over", "_rate", "_capped")
        df = df.withColumn("_capped", F.col("_capped") | F.col("_over")).drop("_over")


def _order(df: DataFrame) -> DataFrame:
    """Certain copies, the Pareto rank and its bin, from ``expected`` and ``_hash``."""
    u = (F.shiftrightunsigned("_hash", 11).cast("double") + 0.5) / float(1 << 53)
    p = F.col("expected") - F.floor("expected")
    rank = F.log2(u / (1 - u)) - F.log2(F.col("_p") / (1 - F.col("_p")))
    return (df.withColumn("_whole", F.floor("expected").cast("long")).withColumn("_p", p)
            .withColumn("_rank", F.when(F.col("_p") > 0, rank))
            .withColumn("_bin", F.floor(F.col("_rank") * BINS_PER_OCTAVE).cast("long")))


def copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None,
           weights: DataFrame | None = None, max_copies: int = MAX_COPIES, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Two tables with one row per document: (_id, _source, _size, _hash), and those with source_size, target and copies."""
    columns = {"_id": F.col(f"`{id_col}`"), "_source": F.col(f"`{source}`"), "_size": word_count(F.col(f"`{text}`")),
               "_hash": F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text}`"))}
    if weight:
        columns["_weight"] = F.greatest(F.coalesce(F.col(f"`{weight}`").cast("double"), F.lit(0.0)), F.lit(0.0))
    narrow = stored(docs.select(*[c.alias(n) for n, c in columns.items()]), "mix-sizes")
    targets = stored(source_targets(narrow, weights, max_copies), "mix-targets")
    df = join_sources(narrow, targets, F.col("_hash"))
    if weight:
        df = _with_capped_weights(stored(df, "mix-start"), max_copies)
    else:
        df = df.withColumn("expected", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                           .otherwise(F.lit(0.0)))
    ranked = _order(df)

    drawn = ranked.where("_p > 0")
    need = ranked.groupBy("_source").agg((F.max("target") - F.sum(F.col("_whole") * F.col("_size"))).alias("_need"))
    bins = drawn.groupBy("_source", "_bin").agg(F.sum("_size").alias("_words"))
    running = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    counted = bins.withColumn("_upto", F.sum("_words").over(running))
    edge = (counted.join(need.withColumnRenamed("_source", "_of"), F.col("_source").eqNullSafe(F.col("_of")))
            .where(F.col("_upto") >= F.col("_need"))
            .groupBy("_source").agg(F.min_by(F.struct("_bin", (F.col("_upto") - F.col("_words")).alias("_before"), "_need"),
                                             "_bin").alias("e"))
            .select("_source", F.col("e._bin").alias("_edge"), F.col("e._before").alias("_before"), F.col("e._need").alias("_need")))
    edge = stored(edge, "mix-edges")
    at_edge = join_sources(drawn, edge, F.col("_hash")).where("_bin = _edge")
    inside = Window.partitionBy("_source").orderBy("_rank", "_hash", "_id").rowsBetween(Window.unboundedPreceding, 0)
    cut = (at_edge.withColumn("_middle", F.col("_before") + F.sum("_size").over(inside) - F.col("_size") / 2)
           .groupBy("_source").agg(F.max("_edge").alias("_edge"),
                                   F.max(F.when(F.col("_middle") <= F.col("_need"), F.col("_rank"))).alias("_cut")))
    # A source all of whose documents are needed has no edge: everything with p > 0 is taken.
    known = targets.select("_source").join(
        cut.withColumnRenamed("_source", "_of"), F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")
    cut = stored(known, "mix-cuts")
    taken = (F.col("_p") > 0) & (F.col("_edge").isNull() | (F.col("_bin") < F.col("_edge")) | F.coalesce(
        (F.col("_bin") == F.col("_edge")) & (F.col("_rank") <= F.col("_cut")), F.lit(False)))
    decided = join_sources(ranked, cut, F.col("_hash")).withColumn("copies", F.col("_whole") + taken.cast("long"))
    return narrow, decided


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns of docs.

    A row's decision depends on its id, text and source only, so decisions are joined back on a hash of the three and the id.
    """
    id_col, text = options.get("id_col", "doc_id"), options.get("text", "text")
    source, seed = options.get("source", "source"), options.get("seed", SEED)
    _, decided = copies(docs, **options)
    taken = stored(decided.where("copies > 0").groupBy("_id", "_source", "_hash").agg(F.max("copies").alias("_copies")), "mix-taken")
    named = {c: fresh(c, docs.columns) for c in ("_hash", "_id2", "_source2", "_copies", "_n")}
    hashed = docs.withColumn(named["_hash"], F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text}`")))
    right = taken.select(F.col("_hash").alias("_h2"), F.col("_id").alias(named["_id2"]),
                         F.col("_source").alias(named["_source2"]), F.col("_copies").alias(named["_copies"]))
    joined = hashed.join(right, (F.col(named["_hash"]) == F.col("_h2")) & F.col(f"`{id_col}`").eqNullSafe(F.col(named["_id2"]))
                         & F.col(f"`{source}`").eqNullSafe(F.col(named["_source2"])))
    return (joined.withColumn(named["_n"], F.explode(F.sequence(F.lit(1).cast("long"), F.col(named["_copies"]))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
