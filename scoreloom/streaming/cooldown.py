"""Cooldown in streams (T4): at most n firings of a rule per subject and period, across micro-batches.

The open period of a (subject, rule) is state: when it ends and how many firings it has accepted. Pairs are dealt to buckets, and a bucket's
open periods are one state, so a micro-batch takes a call per bucket and not per pair. Periods that the watermark has passed are dropped
whenever their bucket is called, at the latest by an event-time timer at the end of its last one, as no firing can fall into them any
more; so state holds the periods that are open, not all pairs ever seen.

Inside a micro-batch firings go in (ts, event_id) order. A firing that arrives in a later micro-batch than its time would ask for
counts into the period that is open on arrival. One that lies behind the watermark is dropped by Spark, as any late row of a stateful operator.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING, Any

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scoreloom.model import Rule
from scoreloom.operators.cooldown import KEYS
from scoreloom.operators.kernels import walk_periods
from scoreloom.operators.rules import fired_rows

from scoreloom.operators.scoring import with_rule_scores

if TYPE_CHECKING:
    import pandas as pd

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Buckets that the pairs are dealt to; each takes one call and one state per micro-batch.
BUCKETS = 4096
_PERIODS = "who array<string>, until array<bigint>, used array<int>"


def open_periods(names: Sequence[str]):
    """The new firings of one bucket of keys, key by key, against the periods that are open; ``names`` are the columns of what is accepted."""

    def run(_: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import pandas as pd

        passed = state.getCurrentWatermarkMs() * 1000  # no firing before this can come any more
        open_ = {k: (until, used) for k, until, used in zip(*state.get) if until > passed} if state.exists else {}
        parts = list(frames)
        new = pd.concat(parts, ignore_index=True) if parts else None
        if new is not None and len(new):
            new = new.sort_values(["who", "clock", "event_id"], kind="stable", ignore_index=True)
            who = new["who"].to_numpy()
            clock, period, limit = (new[c].to_numpy(np.int64) for c in ("clock", "period", "max_in_period"))
            starts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
            accepted = np.zeros(len(new), bool)
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(new)]):
                run_ = slice(low, high)
                accepted[run_], until, used = walk_periods(clock[run_], period[run_], limit[run_], *open_.get(who[low], (None, 0)))
                open_[who[low]] = until, int(used)
            yield new.loc[accepted, list(names)]
        last = -(-max((until for until, _ in open_.values()), default=0) // 1000)
        if last > state.getCurrentWatermarkMs():
            state.update((list(open_), [u for u, _ in open_.values()], [n for _, n in open_.values()]))
            state.setTimeoutTimestamp(last)
        elif state.exists:
            state.remove()

    return run


def accepted_stream(spark: SparkSession, scored: DataFrame, rules: Sequence[Rule], late_by: str = "10 minutes") -> DataFrame:
    """Accepted firings (subject, rule, event, rule_pos, rule_points) of a stream of events with their ``rule_scores``.

    Firings of rules without a cooldown pass by the state.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    fired = fired_rows(scored.withWatermark("ts", late_by), "subject_id", "event_id", "ts")
    timed = {r.rule_id: r for r in rules if r.cooldown_seconds}
    columns = ("subject_id", "rule_id", "event_id", "rule_pos", "rule_points")
    free = fired.filter(~F.col("rule_id").isin(*timed)).select(*columns)
    if not timed:
        return free
    length, most = (F.create_map(*[F.lit(x) for r in timed.values() for x in (r.rule_id, value(r))]) for value in (
        lambda r: r.cooldown_seconds * 1_000_000, lambda r: r.max_in_period or 1))
    bound = fired.filter(F.col("rule_id").isin(*timed)).select(
        *columns, "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("clock"),
        F.element_at(length, F.col("rule_id")).cast("bigint").alias("period"),
        F.element_at(most, F.col("rule_id")).cast("int").alias("max_in_period"))
    out = T.StructType([fired.schema[c] for c in columns])
    # A pair's name as text: ids of any type, null as well, keep apart and whole in the state.
    named = bound.withColumns({"who": F.to_json(F.struct(*KEYS)), "bucket": F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS))})
    kept = named.groupBy("bucket").applyInPandasWithState(
        open_periods(columns), out, _PERIODS, "append", GroupStateTimeout.EventTimeTimeout)
    return kept.unionByName(free)


def with_accepted(spark: SparkSession, scored: DataFrame, rules: Sequence[Rule], late_by: str = "10 minutes") -> DataFrame:
    """A stream of scored events and, as rows with only ``firing`` and ``event_id``, of their accepted firings.

    Both come from one source, so a micro-batch holds an event and its firings; only firings pass through the state.
    """
    firing = F.struct("rule_pos", "rule_id", "rule_points")
    kept = accepted_stream(spark, scored, rules, late_by).select("event_id", firing.alias("firing"))
    kind = kept.schema["firing"].dataType
    events = scored.withColumn("firing", F.lit(None).cast(kind))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields if f.name not in ("event_id", "firing")]
    return events.unionByName(kept.select("event_id", "firing", *missing))


def regrouped(batch: DataFrame) -> DataFrame:
    """The events of one micro-batch of :func:`with_accepted`, with the rules that were accepted and the change these give."""
    kept = (batch.filter("firing is not null").groupBy("event_id").agg(F.array_sort(F.collect_list("firing")).alias("r"))
            .select("event_id", F.transform("r", lambda x: F.struct(x["rule_id"].alias("rule_id"), x["rule_points"].alias("points")))
                    .alias("accepted")))
    return with_rule_scores(batch.filter("firing is null").drop("firing"), kept)
