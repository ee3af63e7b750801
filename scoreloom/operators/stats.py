"""Order statistics per group without holding a group in memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Rows per (group, distinct value). Everything below starts from this pre-aggregated table."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*groups, F.col(value).alias("value"))
            .agg(F.count("*").alias("n")))


def median_of_counts(counts: DataFrame, groups: Sequence[str], weight: str = "n") -> DataFrame:
    """Exact median per group, as the mean of the two middle values.

    A built-in exact percentile keeps all distinct values of a group in one task. Here a histogram over whole
    numbers finds the unit bucket of each middle rank first; only inside those buckets are values ordered.
    Scores lie on a 1e-6 grid, so a bucket has at most a million distinct values at any data size.
    """
    keys = list(groups)
    bucketed = counts.withColumn("bucket", F.floor("value"))
    buckets = bucketed.groupBy(*keys, "bucket").agg(F.sum(weight).alias("bn"))
    along = W.partitionBy(*keys).orderBy("bucket")
    placed = (buckets.withColumns({"upto": F.sum("bn").over(along), "total": F.sum("bn").over(W.partitionBy(*keys))})
              .withColumns({"low_rank": F.floor((F.col("total") + 1) / 2),
                            "high_rank": F.floor((F.col("total") + 2) / 2),
                            "before": F.col("upto") - F.col("bn")}))
    hit = placed.filter(((F.col("low_rank") > F.col("before")) & (F.col("low_rank") <= F.col("upto")))
                        | ((F.col("high_rank") > F.col("before")) & (F.col("high_rank") <= F.col("upto"))))
    inside = bucketed.join(hit.select(*keys, "bucket", "before", "low_rank", "high_rank"), [*keys, "bucket"])
    ordered = W.partitionBy(*keys, "bucket").orderBy("value")
    ranked = inside.withColumn("last", F.col("before") + F.sum(weight).over(ordered)).withColumn(
        "first", F.col("last") - F.col(weight))

    def at(rank: str):
        return F.max(F.when((F.col(rank) > F.col("first")) & (F.col(rank) <= F.col("last")), F.col("value")))

    return (ranked.groupBy(*keys).agg(at("low_rank").alias("lo"), at("high_rank").alias("hi"))
            .select(*keys, ((F.col("lo") + F.col("hi")) / 2).alias("median")))


def mode_of_counts(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Most frequent value per group; of several, the smallest."""
    return counts.groupBy(*groups).agg(F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("mode"))


def discrete_of_counts(counts: DataFrame, groups: Sequence[str], parts: dict[str, float]) -> DataFrame:
    """Exact discrete percentiles per group: the least value at or below which the given part of the rows lies."""
    keys = list(groups)
    along = W.partitionBy(*keys).orderBy("value")
    placed = counts.withColumns({"upto": F.sum("n").over(along), "total": F.sum("n").over(W.partitionBy(*keys))})
    return placed.groupBy(*keys).agg(*[
        F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * F.col("total")), F.col("value"))).alias(name) for name, p in parts.items()])
