"""Relationship graph: edges, neighbour statistics, density, reach, association risk."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.bands import config_tier
from scoreloom.model import ScoreConfig
from scoreloom.operators.scan import ordered_sums
from scoreloom.session import new_table_path, shared_dir

LOW_TIERS = ("very_poor", "poor")


def undirected(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, once."""
    one = edges.select("src", "dst", "rel")
    return one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "rel")).distinct()


def relations_at(edges: DataFrame, day: dt.date, rel: str | None = None, min_strength: float | None = None) -> DataFrame:
    """Relations valid on a day, with optional type and strength limits (N2). All limits reach the scan."""
    at = F.lit(day)
    out = edges.filter((F.col("start_date").isNull() | (F.col("start_date") <= at))
                       & (F.col("end_date").isNull() | (F.col("end_date") >= at)))
    if rel is not None:
        out = out.filter(F.col("rel") == rel)
    if min_strength is not None:
        out = out.filter(F.col("strength") >= min_strength)
    return out


def subjects_with_relation(subjects: DataFrame, edges: DataFrame, rel: str) -> DataFrame:
    """Subjects that have at least one relation of a type."""
    have = edges.filter(F.col("rel") == rel).select(F.col("src").alias("subject_id"))
    return subjects.join(have, "subject_id", "left_semi")


def _scored_edges(edges: DataFrame, scores: DataFrame, config: ScoreConfig) -> DataFrame:
    to = scores.select(F.col("subject_id").alias("dst"), F.col("score").alias("dst_score"))
    return edges.join(to, "dst").withColumn("dst_tier", config_tier(F.col("dst_score"), config))


def neighbour_statistics(edges: DataFrame, scores: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Per subject and relation type: count, mean score, tier counts, share in the low tiers."""
    rows = _scored_edges(edges, scores, config)
    tier: dict[str, Column] = {t.name: F.col("dst_tier") == t.name for t in config.tiers}
    low = F.col("dst_tier").isin(*LOW_TIERS)
    return (rows.groupBy(F.col("src").alias("subject_id"), F.col("rel").alias("relation_type"))
            .agg(F.count("*").alias("related_count"), F.avg("dst_score").alias("avg_relation_score"),
                 (F.count_if(low) / F.count("*")).alias("relation_risk_factor"),
                 *[F.count_if(cond).alias(f"{name}_relations") for name, cond in tier.items()]))


def ego_metrics(edges: DataFrame, scores: DataFrame, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Per subject over distinct neighbours of any type: degree, mean score, risk share."""
    rows = _scored_edges(edges.select("src", "dst").distinct(), scores, config)
    return (rows.groupBy(F.col("src").alias("subject_id"))
            .agg(F.count("*").alias("degree"), F.avg("dst_score").alias("avg_neighbour_score"),
                 (F.count_if(F.col("dst_tier").isin(*LOW_TIERS)) / F.count("*")).alias("risk_factor")))


def network_density(edges: DataFrame) -> DataFrame:
    """Share of a subject's neighbour pairs that are linked themselves (N4), exact at any degree.

    Linked neighbour pairs of a subject are the triangles through it. Each undirected link is pointed from the
    end with fewer links to the end with more, so no subject points to more than sqrt(2 * links) others;
    a hub's neighbour pairs are therefore never listed. Every triangle is found once and counted for its corners.
    """
    a, b = F.least("src", "dst"), F.greatest("src", "dst")
    links = edges.filter("src <> dst").select(a.alias("a"), b.alias("b")).distinct()
    ends = links.select(F.explode(F.array("a", "b")).alias("subject_id"))
    degree = ends.groupBy("subject_id").agg(F.count("*").alias("degree"))
    da = degree.select(F.col("subject_id").alias("a"), F.col("degree").alias("da"))
    db = degree.select(F.col("subject_id").alias("b"), F.col("degree").alias("db"))
    forward = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    pointed = (links.join(da, "a").join(db, "b")
               .select(F.when(forward, F.col("a")).otherwise(F.col("b")).alias("u"),
                       F.when(forward, F.col("b")).otherwise(F.col("a")).alias("v")))
    uv, vw, uw = (pointed, pointed.select(F.col("u").alias("v"), F.col("v").alias("w")),
                  pointed.select("u", F.col("v").alias("w")))
    triangles = uv.join(vw, "v").join(uw, ["u", "w"])
    corners = (triangles.select(F.explode(F.array("u", "v", "w")).alias("subject_id"))
               .groupBy("subject_id").agg(F.count("*").alias("linked_pairs")))
    pairs = F.col("degree") * (F.col("degree") - 1) / 2
    return (degree.join(corners, "subject_id", "left").na.fill(0, ["linked_pairs"])
            .withColumn("density", F.when(F.col("degree") > 1, F.col("linked_pairs") / pairs).otherwise(F.lit(0.0))))


def reach(edges: DataFrame, hops: int, seeds: DataFrame | None = None) -> DataFrame:
    """Subjects reached within ``hops`` steps, with the fewest steps needed (N5), as pairs; for counts alone see :func:`reach_counts`.

    ``seeds`` is an optional one-column table of starting subjects. Each round joins only the newest frontier,
    drops pairs already seen, and cuts the lineage with a reliable checkpoint before the next round.
    """
    shared_dir(edges.sparkSession)  # names the checkpoint folder
    step = edges.filter("src <> dst").select("src", "dst").distinct()
    first = step.join(seeds.select(F.col(seeds.columns[0]).alias("src")), "src", "left_semi") if seeds is not None else step
    found = first.select("src", F.col("dst").alias("reached"), F.lit(1).alias("hops"))
    frontier = found
    for hop in range(2, hops + 1):
        onward = step.select(F.col("src").alias("reached"), F.col("dst").alias("next"))
        fresh = (frontier.select("src", "reached").join(onward, "reached").filter("src <> next")
                 .select("src", F.col("next").alias("reached")).distinct()
                 .join(found.select("src", "reached"), ["src", "reached"], "left_anti"))
        frontier = fresh.withColumn("hops", F.lit(hop))
        if hop < hops:
            frontier = frontier.checkpoint()
        found = found.unionByName(frontier)
    return found


def reach_counts(edges: DataFrame, hops: int, seeds: DataFrame | None = None) -> DataFrame:
    """How many others each subject reaches in exactly 1, 2, ... ``hops`` steps at least (N5): src, hops, reached.

    Reached subjects are bits: subjects are numbered, and a row holds 64 of them as one word per (subject, block of numbers). What a
    subject reaches in one step more is the union of what its neighbours reach, so a round joins links with words and unites them by
    ``bit_or``, which combines before its shuffle: rows grow with links x blocks, and no pair is ever listed. With ``seeds`` (one
    column) each round holds only the subjects whose words a later round still needs.
    """
    spark = edges.sparkSession
    step = _kept(edges.filter("src <> dst").select("src", "dst").distinct(), "reach-links")
    nodes = step.select("src").union(step.select("dst")).distinct().select(
        F.col("src").alias("node"), F.lit(0).alias("all"), F.lit(1).cast("bigint").alias("one"))
    numbers = ordered_sums(spark, nodes, ["all"], ["node"], ["one"]).select("node", F.col("before_one").alias("number"))
    own = numbers.select("node", F.expr("number div 64").alias("block"), F.expr("shiftleft(1L, cast(number % 64 as int))").alias("word"))
    own = _kept(own, "reach-numbers")
    needed: list[DataFrame | None] = [None] * hops
    if seeds is not None:
        needed[-1] = seeds.select(F.col(seeds.columns[0]).alias("src")).distinct()
        for h in range(hops - 2, -1, -1):
            onward = step.join(needed[h + 1], "src", "left_semi").select(F.col("dst").alias("src"))
            needed[h] = _kept(needed[h + 1].union(onward).distinct(), "reach-needed")
    words, counts = None, None
    for h in range(hops):
        links = step if needed[h] is None else step.join(needed[h], "src", "left_semi")
        # A subject's own bit and what it had before stay in, so a word only grows.
        ends = own.withColumnRenamed("node", "dst") if words is None else words.select(F.col("src").alias("dst"), "block", "word")
        met = links.join(ends, "dst").select("src", "block", "word")
        mine = own.withColumnRenamed("node", "src") if words is None else words.select("src", "block", "word")
        if needed[h] is not None:
            mine = mine.join(needed[h], "src", "left_semi")
        both = met.withColumn("old", F.lit(0).cast("bigint")).unionByName(mine.withColumn("old", F.col("word")))
        words = _kept(both.groupBy("src", "block").agg(F.bit_or("word").alias("word"), F.bit_or("old").alias("old")), "reach-words")
        new = F.bit_count(F.col("word").bitwiseAND(F.bitwise_not("old")))
        found = words.groupBy("src").agg(F.sum(new).alias("reached")).select("src", F.lit(h + 1).alias("hops"), "reached")
        if needed[-1] is not None:
            found = found.join(needed[-1], "src", "left_semi")
        counts = found if counts is None else counts.unionByName(found)
    return counts.filter("reached > 0")


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def association_risk(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """Strength-weighted mean risk of a subject's neighbours, risk = (1000 - score) / 1000."""
    rows = edges.join(scores.select(F.col("subject_id").alias("dst"), F.col("score").alias("dst_score")), "dst")
    risk = (F.lit(1000.0) - F.col("dst_score")) / F.lit(1000.0)
    weight = F.coalesce("strength", F.lit(1.0))
    return (rows.groupBy(F.col("src").alias("subject_id"))
            .agg((F.sum(weight * risk) / F.sum(weight)).alias("association_risk"),
                 F.count("*").alias("relations")))
