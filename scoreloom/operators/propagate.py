"""Spreading a share of a relationship event's change to graph neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.numeric import on_grid
from scoreloom.functions.scoring import impact_factor
from scoreloom.model import ScoreConfig
from scoreloom.operators.scoring import running_score, running_score_with_decay

# Which edge labels a kind of relationship event reaches.
REACHED = {
    "family_event": ("family_member",),
    "workplace_event": ("colleague",),
    "community_event": ("neighbor", "friend"),
}
REACHED_OTHERWISE = ("friend",)


def reached_labels() -> Column:
    kind = F.coalesce(F.col("relationship_type"), F.lit(""))
    out = F
    for name, labels in REACHED.items():
        out = out.when(kind == name, F.array(*[F.lit(x) for x in labels]))
    return out.otherwise(F.array(*[F.lit(x) for x in REACHED_OTHERWISE]))


def spreading_events(processed: DataFrame) -> DataFrame:
    """Relationship events that ask for spreading, and whose type some rule names."""
    return processed.filter((F.col("event_type") == "relationship")
                            & F.coalesce(F.col("requires_relationship_processing"), F.lit(False))
                            & F.col("rule_seen") & F.col("processing_error").isNull())


def neighbour_deltas(processed: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per (event, neighbour): the secondary change. Secondary changes never spread further.

    Only spreading events with a change are joined, on (subject, label); both sides hash on that pair and
    adaptive execution splits a hot subject. A neighbour reached over two labels is affected once per label.
    """
    sources = (spreading_events(processed).filter("score_change <> 0")
               .select(F.col("subject_id").alias("src"), "event_id", "ts",
                       on_grid(F.col("score_change") * impact_factor()).alias("score_change"),
                       F.explode(reached_labels()).alias("rel")))
    return (sources.join(edges.select("src", "dst", "rel"), ["src", "rel"]).filter("src <> dst")
            .select(F.col("dst").alias("subject_id"), F.col("src").alias("origin_subject_id"), "event_id", "ts",
                    "rel", "score_change"))


_RESULT = ("previous_score", "new_score", "scan_order", "status", "processing_id")


def score_with_neighbours(spark: SparkSession, scored: DataFrame, secondary: DataFrame, profiles: DataFrame,
                          config: ScoreConfig, chunks: int | None = None) -> DataFrame:
    """One running score over primary (``hop`` 0) and secondary (``hop`` 1) changes.

    ``scored`` has a change and an opening score per event, from rules alone or from an earlier run; its other
    columns are kept on the primary rows. A rule's points do not depend on the current score, so all changes are
    known beforehand and no iteration is needed. Order per subject: time, event, primary before secondary, origin,
    label.
    """
    first = scored.drop(*_RESULT).withColumns({"origin_subject_id": F.col("subject_id"), "rel": F.lit(""),
                                               "hop": F.lit(0)})
    known = ["last_score_at"] if config.decay.enabled and "last_score_at" in profiles.columns else []
    if known and "last_score_at" not in first.columns:
        first = first.join(profiles.select("subject_id", *known), "subject_id", "left")
    opened = (secondary.join(profiles.select("subject_id", F.col("score").alias("opening"), *known), "subject_id", "left")
              .withColumns({"opening_score": F.coalesce("opening", F.lit(config.baseline)), "hop": F.lit(1)})
              .drop("opening"))
    both = first.unionByName(opened, allowMissingColumns=True)
    fold = running_score_with_decay if config.decay.enabled else running_score
    return fold(spark, both, config, ["ts", "event_id", "hop", "origin_subject_id", "rel"], chunks)
