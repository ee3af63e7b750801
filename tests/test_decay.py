"""Decay over long histories, in chunks, against walking each subject; reach as bits against pairs."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from scoreloom.model import Decay, ScoreConfig
from scoreloom.operators import graph
from scoreloom.operators.kernels import DecayMap, DecayWalk
from scoreloom.operators.scoring import running_score_with_decay


@pytest.mark.parametrize("chunks", [1, 9, 40])
def test_five_years_of_a_hot_subject(spark, chunks):
    rng = random.Random(chunks)
    config = ScoreConfig(decay=Decay(True, 2.5, 300.0))
    start = dt.datetime(2019, 1, 1)
    rows = []
    for i in range(3000):
        subject = "hot" if rng.random() < 0.7 else f"s{rng.randrange(40)}"
        known = dt.datetime(2018, 12, 1) if subject in ("hot", "s3") else None
        rows.append((i, subject, start + dt.timedelta(days=rng.randrange(5 * 365), seconds=rng.randrange(86400)),
                     450.0 if subject == "hot" else 200.0, rng.choice((-90.0, -20.0, 1.5, 8.0, 30.0, 120.0)), known))
    df = spark.createDataFrame(rows, "event_id int, subject_id string, ts timestamp, opening_score double, score_change double, last_score_at timestamp")
    got = {r.event_id: (r.previous_score, r.new_score) for r in running_score_with_decay(spark, df, config, ["ts", "event_id"], chunks).collect()}
    want, state = {}, {}
    for i, subject, ts, opening, change, known in sorted(rows, key=lambda r: (r[2], r[0])):
        score, day = state.get(subject, (opening, known.date() if known else None))
        idle = (ts.date() - day).days if day else 0
        before = score if score <= 300 else max(score - 2.5 * idle, 300.0)
        after = min(max(before + change, config.low), config.high)
        state[subject] = (after, ts.date())
        want[i] = (before, after)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], abs=2e-6) for i in want)


@hyp(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(-300, 300)), min_size=1, max_size=40), st.integers(0, 1000), st.integers(0, 900),
       st.integers(1, 9))
def test_map_equals_walk(steps, score, floor, points):
    walker = DecayWalk(0.0, 1000.0, float(points), float(floor))
    days, day = [], 0
    for idle, _ in steps:
        day += idle
        days.append(day)
    changes = [float(c) for _, c in steps]
    so_far = DecayMap(0.0, 1000.0)
    half = len(steps) // 2
    if half:
        walker.extend(so_far, None, np.array(days[:half]), changes[:half])
    walker.extend(so_far, days[half - 1] if half else None, np.array(days[half:]), changes[half:])
    assert np.interp(score, so_far.x, so_far.y) == pytest.approx(walker.walk(float(score), None, days, changes)[1], abs=1e-6)
    assert (np.diff(so_far.x) > 0).all() and (np.diff(so_far.y) >= 0).all() and len(so_far.x) <= 2 * (1000 // points + 3)


def test_reach_as_bits_equals_pairs(spark):
    rng = random.Random(6)
    links = [(f"n{rng.randrange(150)}", f"n{rng.randrange(150)}", "x") for _ in range(260)]
    links += [("hub", f"n{i}", "x") for i in range(0, 150, 2)] + [(f"n{i}", "hub", "y") for i in range(0, 150, 5)]
    links += [("a", "b", "x"), ("b", "a", "x"), ("a", "a", "x"), ("a", "b", "z")]
    edges = spark.createDataFrame(links, "src string, dst string, rel string")
    seeds = edges.select("src").filter(F.col("src").isin("hub", "a", "n7", "n8"))
    for chosen in (None, seeds):
        pairs = graph.reach(edges, 3, chosen).groupBy("src", "hops").count()
        want = {(r.src, r.hops): r["count"] for r in pairs.collect()}
        assert {(r.src, r.hops): r.reached for r in graph.reach_counts(edges, 3, chosen).collect()} == want
    assert graph.reach_counts(edges.limit(0), 2).count() == 0
