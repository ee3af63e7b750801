"""Ordered scans, order statistics and graph density against brute force, with a hot key."""

import random
from collections import Counter, defaultdict
from itertools import combinations
from statistics import median

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreloom.model import Decay, ScoreConfig
from scoreloom.operators.graph import network_density
from scoreloom.operators.scan import clamped_scan, ordered_sums
from scoreloom.operators.scoring import running_score, running_score_with_decay
from scoreloom.operators.stats import median_of_counts, mode_of_counts, value_counts

CONFIG = ScoreConfig()


def step(x, a, lo=0.0, hi=1000.0):
    return min(max(x + a, lo), hi)


def merge(f, g):
    (a, lo, hi), (b, m, n) = f, g
    return (a + b, min(max(lo + b, m), n), min(max(hi + b, m), n))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-900, 900), min_size=1, max_size=30), st.integers(0, 1000), st.data())
def test_clamp_steps_compose(changes, start, data):
    """Any split of a history into two parts gives the same score."""
    x = start
    for c in changes:
        x = step(x, c)
    cut = data.draw(st.integers(0, len(changes)))
    parts = []
    for part in (changes[:cut], changes[cut:]):
        f = (0, float("-inf"), float("inf"))
        for c in part:
            f = merge(f, (c, 0, 1000))
        parts.append(f)
    a, lo, hi = merge(*parts)
    assert min(max(start + a, lo), hi) == x


@pytest.fixture(scope="module")
def skewed():
    """Subject 0 has half of all rows; some subjects have one; equal times occur."""
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        subject = 0 if i % 2 == 0 else rng.randint(1, 400)
        rows.append((subject, rng.randint(0, 900) * 3600, i, float(rng.randint(-400, 400)) / 4, 500.0))
    return rows


@pytest.fixture(scope="module")
def frame(spark, skewed):
    df = spark.createDataFrame(skewed, "subject_id long, sec long, event_id long, score_change double, opening_score double")
    return df.withColumn("ts", F.timestamp_seconds("sec")).repartition(7)


def histories(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in by.items()}


@pytest.mark.parametrize("chunks", [1, 5, 37])
def test_running_score_at_any_chunking(spark, frame, skewed, chunks):
    got = {r.event_id: (r.previous_score, r.new_score)
           for r in running_score(spark, frame, CONFIG, ["ts", "event_id"], chunks).collect()}
    assert len(got) == len(skewed)
    for rows in histories(skewed).values():
        x = 500.0
        for _, _, eid, c, _ in rows:
            before, x = x, step(x, c)
            assert got[eid] == pytest.approx((before, x), abs=2e-6)


def test_hot_key_is_spread(spark, frame):
    """No chunk holds the hot subject alone, and its rows lie in many chunks."""
    by = ["subject_id", "ts", "event_id"]
    sizes = (frame.repartitionByRange(16, *by).withColumn("chunk", F.spark_partition_id())
             .groupBy("chunk").count().collect())
    assert len(sizes) >= 14 and max(r["count"] for r in sizes) < 4000 / 16 * 3


def test_decay(spark, frame, skewed):
    config = ScoreConfig(decay=Decay(True, 5.0, 300.0))
    got = {r.event_id: r.new_score
           for r in running_score_with_decay(spark, frame, config, ["ts", "event_id"], 9).collect()}
    for rows in histories(skewed).values():
        x, day = 500.0, None
        for _, sec, eid, c, _ in rows:
            today = sec // 86400
            if day is not None and x > 300.0:
                x = max(x - 5.0 * (today - day), 300.0)
            day = today
            x = step(x, c)
            assert got[eid] == pytest.approx(x, abs=2e-6)


@pytest.mark.parametrize("chunks", [1, 11])
def test_ordered_sums(spark, frame, skewed, chunks):
    df = frame.withColumn("units", (F.col("score_change") * 4).cast("long")).withColumn("tag", F.concat(F.lit("e"), "event_id"))
    out = ordered_sums(spark, df, ["subject_id"], ["ts", "event_id"], ["units"], ["tag"], chunks)
    got = {r.event_id: (r.before_units, r.previous_tag) for r in out.collect()}
    for rows in histories(skewed).values():
        total, tag = 0, None
        for _, _, eid, c, _ in rows:
            assert got[eid] == (total, tag)
            total, tag = total + int(c * 4), f"e{eid}"


def test_string_keys_and_two_keys(spark):
    rows = [(f"s{i % 3}", i % 2, i, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "a string, b int, i int, x double").withColumns(
        {"lo": F.lit(0.0), "hi": F.lit(5.0)})
    out = clamped_scan(spark, df, ["a", "b"], ["i"], ["x", "lo", "hi"], 6).collect()
    seen = Counter()
    for r in sorted(out, key=lambda r: r.i):
        assert r.prefix_add == seen[r.a, r.b]
        seen[r.a, r.b] += 1


def test_median_and_mode(spark):
    rng = random.Random(3)
    rows = [(g, rng.choice([0.0, 1000.0, rng.randint(0, 4000) / 4])) for g in range(5) for _ in range(51 + g)]
    df = spark.createDataFrame(rows, "g int, x double")
    counts = value_counts(df, ["g"], "x")
    med = {r.g: r["median"] for r in median_of_counts(counts, ["g"]).collect()}
    mode = {r.g: r["mode"] for r in mode_of_counts(counts, ["g"]).collect()}
    for g in range(5):
        values = [x for k, x in rows if k == g]
        assert med[g] == median(values)
        best = max(Counter(values).values())
        assert mode[g] == min(v for v, n in Counter(values).items() if n == best)


def test_density_with_a_hub(spark):
    rng = random.Random(5)
    edges = {(0, i) for i in range(1, 120)} | {(rng.randint(1, 119), rng.randint(1, 119)) for _ in range(300)} | {(3, 3)}
    got = {r.subject_id: (r.degree, r.linked_pairs) for r in network_density(
        spark.createDataFrame(sorted(edges), "src int, dst int").withColumn("rel", F.lit("friend"))).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {k: (len(v), sum(1 for x, y in combinations(sorted(v), 2) if y in near[x])) for k, v in near.items()}
    assert got == want
