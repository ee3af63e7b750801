"""At most n applications of a rule per subject and period (T4).

The first accepted firing opens a period of the rule's length; up to ``n`` firings are accepted until it ends; the
next firing at or after its end opens a new one. The clock has microseconds, like the timestamps.

Which firing opens a period depends on the one before, so one (subject, rule) is a chain. It is not walked by one task: firings are
range-partitioned by key and time, and each partition ("chunk") walks its keys from opener to opener. Only a key that goes on in
the next chunk needs more. An opener in one chunk leads to one firing in a later chunk, the first one past the end of its chunk's last period;
the firings of a chunk that can be met so lie within one period of its start. These form a table (node, next), and squaring it
log2(chunks) times, from the key's first firing on, marks the nodes that the chain really meets: one per chunk. With the period that comes
in with them the chunks' first keys are walked anew. No task holds more than a chunk, and nothing depends on gaps.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.operators.kernels import next_openers, period_kernel, resumed_kernel, target_kernel
from scoreloom.session import new_table_path

KEYS = ("subject_id", "rule_id")


def accept(fired: DataFrame, chunks: int | None = None) -> DataFrame:
    """Accepted firings of ``fired``, which needs subject, rule, ts, event_id, cooldown_seconds and max_in_period."""
    timed = fired.withColumn("clock", F.unix_micros(F.col("ts").cast("timestamp")))
    free = timed.filter(F.coalesce("cooldown_seconds", F.lit(0)) <= 0).drop("clock")
    bound = timed.filter(F.coalesce("cooldown_seconds", F.lit(0)) > 0).withColumns(
        {"max_in_period": F.coalesce("max_in_period", F.lit(1)), "period": F.col("cooldown_seconds") * 1_000_000})
    by = [*KEYS, "clock", "event_id"]
    spread = bound.repartitionByRange(chunks, *by) if chunks else bound.repartitionByRange(*by)
    rows = spread.sortWithinPartitions(*by).withColumn("chunk", F.spark_partition_id())
    extra = {"accepted": T.BooleanType(), "at": T.LongType(), "until": T.LongType(), "rest": T.LongType(), "near": T.BooleanType(),
             "begins": T.BooleanType(), "chunk_pos": T.LongType(), "chunk_end": T.BooleanType()}
    walked = _written(rows.mapInArrow(period_kernel(KEYS), T.StructType(
        [*rows.schema.fields, *[T.StructField(n, t) for n, t in extra.items()]])), "cooldown-rows")
    kept = _resumed(walked).filter("accepted").select(*free.columns)
    return kept.unionByName(free)


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _chains(walked: DataFrame) -> list[list[tuple[int, int, int]]]:
    """For each key that stands in several chunks: (chunk, its rows there, its last clock there) in order, the last chunk's unknown.

    Read from the first and last row of each chunk, so it is bounded by the number of partitions.
    """
    ends = walked.filter("chunk_pos = 0 or chunk_end").select("chunk", "chunk_pos", "chunk_end", "at", "clock", *KEYS).collect()
    first = {r["chunk"]: tuple(r[k] for k in KEYS) for r in ends if r["chunk_pos"] == 0}
    last = {r["chunk"]: (tuple(r[k] for k in KEYS), r["at"] + 1, r["clock"]) for r in ends if r["chunk_end"]}
    chains: list[list[tuple[int, int, int]]] = []
    order = sorted(first)
    for before, chunk in zip(order, order[1:]):
        if last[before][0] == first[chunk]:
            if not (chains and chains[-1][-1][0] == before and first[before] == first[chunk]):
                chains.append([(before, *last[before][1:])])
            chains[-1].append((chunk, *last[chunk][1:]))
    return chains


def _resumed(walked: DataFrame) -> DataFrame:
    """``walked`` with ``accepted`` right also where a key's history began in an earlier chunk."""
    spark = walked.sparkSession
    chains = _chains(walked)
    if not chains:
        return walked
    later = {(c[0], i == 0): ([x[0] for x in chain[i + 1:]], [x[2] for x in chain[i + 1: -1]]) for chain in chains for i, c in enumerate(chain)}
    roles = F.broadcast(spark.createDataFrame(  # one row per chunk at most
        [(c, i > 0) for chain in chains for i, (c, _, _) in enumerate(chain)], "chunk int, goes_on boolean")
        .groupBy("chunk").agg(F.max("goes_on").alias("goes_on"), (~F.min("goes_on")).alias("starts")))
    node = (F.shiftleft(F.col("chunk").cast("bigint"), 40) + F.col("chunk_pos")).alias("node")
    nodes = (walked.filter("near or begins").join(roles, "chunk").filter("(near and goes_on) or (begins and starts)")
             .select(node, "chunk", "clock", "until", "rest", "near", (F.col("begins") & F.col("starts")).alias("start")))
    nodes = _written(nodes, "cooldown-nodes")
    asking = nodes.select("node", "chunk", "start", "until").mapInArrow(
        target_kernel(later), "node bigint, chunk int, start boolean, until bigint, target bigint")
    jump = _written(asking.filter("target is not null").select("target", "node", "until").groupBy("target").cogroup(
        nodes.filter("near").select(F.col("chunk").cast("bigint").alias("target"), "node", "clock").groupBy("target"))
        .applyInArrow(next_openers(), "node bigint, next bigint"), "cooldown-jumps")
    met = _written(nodes.filter("start").select("node"), "cooldown-met")
    rounds = math.ceil(math.log2(max(map(len, chains))))
    for i in range(rounds):
        met = _written(met.union(met.join(jump, "node").select(F.col("next").alias("node"))).distinct(), "cooldown-met")
        if i + 1 < rounds:
            onward = jump.select(F.col("node").alias("next"), F.col("next").alias("after"))
            jump = _written(jump.join(onward, "next").select("node", F.col("after").alias("next")), "cooldown-jumps")
    # One row per chunk at most: where the chain enters, when its last period ends there, and the rows from that opener on.
    entered = {(r["chunk"], r["start"]): r for r in nodes.join(met, "node").select("chunk", "start", "until", "rest").collect()}
    carried = []
    for chain in chains:
        opening = entered[chain[0][0], True]
        until, used = opening["until"], opening["rest"]
        for chunk, n, _ in chain[1:]:
            carried.append((chunk, until, used))
            entry = entered.get((chunk, False))
            until, used = (entry["until"], entry["rest"]) if entry else (until, used + n)
    states = F.broadcast(spark.createDataFrame(carried, "chunk int, carried_until bigint, carried_used bigint"))
    joined = walked.join(states, "chunk", "left")
    again = F.col("carried_until").isNotNull() & (F.col("at") == F.col("chunk_pos"))
    heads = joined.filter(again)
    anew = (heads.repartitionById(1 + max(c for c, _, _ in carried), F.col("chunk")).sortWithinPartitions("chunk", "chunk_pos")
            .mapInArrow(resumed_kernel(), heads.schema))
    return joined.filter(~again).unionByName(anew).select(*walked.columns)


def accepted_rules(accepted: DataFrame) -> DataFrame:
    """Accepted rules with their points per event, in rule order."""
    return (accepted.groupBy("event_id")
            .agg(F.array_sort(F.collect_list(F.struct("rule_pos", "rule_id", "rule_points"))).alias("r"))
            .select("event_id", F.transform("r", lambda x: F.struct(
                x["rule_id"].alias("rule_id"), x["rule_points"].alias("points"))).alias("accepted")))
