"""Per-event and per-subject analytic columns.

Ordered per-subject columns are built on :func:`scoreloom.operators.scan.ordered_sums`, which splits a hot
subject over many tasks; columns that need one figure per group use an aggregate and a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from scoreloom.functions.numeric import GRID, on_grid
from scoreloom.operators.scan import ordered_sums
from scoreloom.operators.stats import value_counts

_ORDER = ("ts", "event_id")


def _units(x: Column) -> Column:
    """A value on the 1e-6 grid as a whole number, so that sums of it are exact."""
    return F.round(x * F.lit(GRID)).cast("bigint")


def moving_average(spark: SparkSession, pe: DataFrame, days: Sequence[int] = (7, 30), value: str = "new_score",
                   chunks: int | None = None) -> DataFrame:
    """Mean of ``value`` over each subject's trailing days, up to and including the event.

    The mean is a difference of two running sums: at the event, and at the window's start. The start is found by
    a probe row put into the same order, so one pass serves all widths and the cost per row does not depend on how
    many events a window holds (a sliding frame would re-add them for every row).
    """
    row = F.struct(F.lit(0).alias("width"), F.col("ts").alias("at"), _units(F.col(value)).alias("units"),
                   F.lit(1).cast("bigint").alias("one"))
    probes = [F.struct(F.lit(d).alias("width"), (F.col("ts") - F.expr(f"INTERVAL {d} DAYS")).alias("at"),
                       F.lit(0).cast("bigint").alias("units"), F.lit(0).cast("bigint").alias("one")) for d in days]
    marks = (pe.select("subject_id", "event_id", F.explode(F.array(row, *probes)).alias("m"))
             .select("subject_id", "event_id", "m.*")
             # a probe stands before events of the same instant: the window includes its start
             .withColumn("is_event", (F.col("width") == 0).cast("int")))
    sums = ordered_sums(spark, marks, ["subject_id"], ["at", "is_event", "event_id", "width"], ["units", "one"],
                        chunks=chunks)

    def at(width: int, name: str) -> Column:
        return F.max(F.when(F.col("width") == width, F.col(f"before_{name}")
                            + (F.col(name) if width == 0 else F.lit(0))))

    totals = sums.groupBy("subject_id", "event_id").agg(
        *[at(w, n).alias(f"{n}_{w}") for w in (0, *days) for n in ("units", "one")])
    return totals.select("subject_id", "event_id", *[
        ((F.col("units_0") - F.col(f"units_{d}")) / (F.col("one_0") - F.col(f"one_{d}")) / F.lit(GRID))
        .alias(f"moving_average_{d}d") for d in days])


def sequence_and_acceleration(spark: SparkSession, pe: DataFrame, velocity: Column,
                              chunks: int | None = None) -> DataFrame:
    """Event number per subject (W3) and change of velocity against the event before (W2), in one pass."""
    rows = pe.select("subject_id", "ts", "event_id", velocity.alias("velocity"), F.lit(1).cast("bigint").alias("one"))
    out = ordered_sums(spark, rows, ["subject_id"], list(_ORDER), ["one"], ["velocity"], chunks)
    return out.select("subject_id", "event_id", (F.col("before_one") + 1).alias("event_sequence_number"), "velocity",
                      (F.col("velocity") - F.col("previous_velocity")).alias("trend_acceleration"))


def frequencies(pe: DataFrame) -> DataFrame:
    """Events of the subject in this hour and this day (W4): counts per hour, joined back.

    The count table has one row per subject and hour; its day totals come from it, not from the events.
    """
    hour = F.date_trunc("hour", "ts")
    hours = pe.groupBy("subject_id", hour.alias("hour")).agg(F.count("*").alias("frequency_this_hour"))
    day = W.partitionBy("subject_id", F.to_date("hour"))
    counts = hours.withColumn("frequency_this_day", F.sum("frequency_this_hour").over(day))
    return (pe.select("subject_id", "event_id", hour.alias("hour")).join(counts, ["subject_id", "hour"])
            .drop("hour"))


def percentile_ranks(scores: DataFrame, value: str = "score") -> DataFrame:
    """True percentile rank of each row's score: share of other rows with a lower score.

    Ranking is done on distinct scores, inside unit buckets whose own offsets come from a histogram of at most
    about a thousand rows, so no window runs over the whole population.
    """
    counts = value_counts(scores, [], value).withColumn("bucket", F.floor("value"))
    buckets = counts.groupBy("bucket").agg(F.sum("n").alias("bn"))
    whole = W.orderBy("bucket")  # over the histogram only
    placed = buckets.select("bucket", (F.sum("bn").over(whole) - F.col("bn")).alias("below_bucket"),
                            F.sum("bn").over(W.partitionBy()).alias("total"))
    inside = W.partitionBy("bucket").orderBy("value")
    ranked = (counts.join(placed, "bucket")
              .withColumn("below", F.col("below_bucket") + F.sum("n").over(inside) - F.col("n"))
              .select(F.col("value").alias(value), F.when(F.col("total") > 1, F.col("below") * 100.0
                                                          / (F.col("total") - 1)).otherwise(0.0)
                      .alias("percentile_rank")))
    return scores.join(ranked, value)


def z_scores(pe: DataFrame) -> DataFrame:
    """True z-score of each change and deviation of each score from the mean (W6); the totals are one scalar."""
    whole = pe.agg(F.struct(F.avg("score_change").alias("mean_change"), F.stddev_pop("score_change").alias("sd_change"),
                            F.avg("new_score").alias("mean_score")).alias("w")).scalar()
    return (pe.select("event_id", "score_change", "new_score", whole.alias("w"))
            .select("event_id", ((F.col("score_change") - F.col("w.mean_change")) / F.col("w.sd_change")).alias("z_score"),
                    (F.col("new_score") - F.col("w.mean_score")).alias("deviation_from_avg")))


def regional_means(pe: DataFrame) -> DataFrame:
    """Regional mean score next to each event (W7). The means are one value, a row per region; no event is shuffled for them."""
    means = pe.filter("region is not null").groupBy("region").agg(F.avg("new_score").alias("m"))
    table = means.agg(F.map_from_entries(F.collect_list(F.struct("region", "m")))).scalar()
    return (pe.select("region", "event_id", "new_score", table.alias("means"))
            .select("region", "event_id", "new_score", F.element_at("means", F.col("region")).alias("regional_score_avg")))


def seasonal_factors(pe: DataFrame) -> DataFrame:
    """Mean score per hour of the week over the mean of all (W10). At most 168 rows, from sums and counts."""
    parts = (pe.groupBy(F.weekday("ts").alias("weekday"), F.hour("ts").alias("hour"))
             .agg(F.sum("new_score").alias("s"), F.count("*").alias("n")))
    overall = parts.agg(F.sum("s") / F.sum("n")).scalar()
    return parts.select("weekday", "hour", "n", (F.col("s") / F.col("n") / overall).alias("seasonal_factor"))


def seasonal_adjustment(pe: DataFrame) -> DataFrame:
    """The factor of its hour of week next to each event; the side joined has at most 168 rows."""
    factors = seasonal_factors(pe).drop("n")
    keyed = pe.select("event_id", F.weekday("ts").alias("weekday"), F.hour("ts").alias("hour"))
    return keyed.join(F.broadcast(factors), ["weekday", "hour"]).select(
        "event_id", on_grid(F.col("seasonal_factor")).alias("seasonal_adjustment"))
