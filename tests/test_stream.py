"""Streams from files: decoding, restart, late rows, and equality with the batch result."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scoreloom.model import ALL_RULES, Decay, ScoreConfig
from scoreloom.operators.propagate import neighbour_deltas, score_with_neighbours
from scoreloom.operators.scoring import score_events
from scoreloom.sources import settings, star, wire
from scoreloom.streaming import cooldown, jobs

T0 = dt.datetime(2024, 1, 1)
KINDS = (("financial", "payment_completed", {"amount": 5.0}), ("financial", "payment_failed", {"amount": 1.0}),
         ("social", "volunteering", {}), ("legal", "violation", {"severity_num": 0.9}), ("civic", "", {}))


def line(i, minutes=None, **over):
    kind, subtype, payload = KINDS[i % len(KINDS)]
    t = T0 + dt.timedelta(minutes=i * 7 if minutes is None else minutes)
    doc = {"event_id": f"e{i:04d}", "subject_id": f"s{i % 6}", "event_type": kind, "event_subtype": subtype,
           "source_system": "bank", "timestamp": t.strftime("%Y-%m-%dT%H:%M:%SZ"),
           "location": {"city": "Lyon", "region": "EAST", "country": "France", "latitude": 1.0, "longitude": 2.0},
           "confidence": 0.5 + (i % 5) / 10, "payload": payload, "version": 1, "event_name": "n", **over}
    return json.dumps(doc)


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(f"s{i}", "vip" if i == 0 else "regular", 100.0 + 150 * i) for i in range(5)],
                                 "subject_id string, type string, score double")


def batch_result(spark, folder, people):
    good, _ = wire.decode(wire.read_lines(spark, str(folder)))
    from scoreloom.operators.measures import flatten
    pe = score_events(spark, flatten(good).withColumn("processed_at", F.col("ts")), people, ALL_RULES)
    return {r.event_id: (r.previous_score, r.new_score) for r in pe.collect()}


def test_decode_keeps_rejects_and_sources(spark, tmp_path):
    put(tmp_path / "in", "a.json", [line(1), "{broken", line(2, payload={"deep": {"x": [1, True]}}), '"text"'])
    good, bad = wire.decode(wire.read_lines(spark, str(tmp_path / "in")))
    rows = {r.event_id: r for r in good.collect()}
    assert set(rows) == {"e0001", "e0002"}
    assert json.loads(rows["e0002"].payload) == {"deep": {"x": [1, True]}}
    assert rows["e0001"].timestamp == T0 + dt.timedelta(minutes=7)
    assert rows["e0001"].source_path.endswith("a.json") and rows["e0001"].source_time is not None
    assert {r.value for r in bad.collect()} == {"{broken", '"text"'}


def test_state_store_score_equals_batch_over_restarts(spark, tmp_path, people):
    folder, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"

    def run():
        lines = wire.stream_lines(spark, str(folder), files_per_trigger=1)
        events = jobs.events_from_lines(lines)
        query = (jobs.running_score_stream(events, people, ALL_RULES).writeStream.format("parquet")
                 .option("path", str(out)).option("checkpointLocation", str(check)).trigger(availableNow=True).start())
        query.awaitTermination()
        return query

    put(folder, "a.json", [line(i) for i in range(0, 60)])
    first = run()
    put(folder, "b.json", [line(i) for i in range(60, 90)] + ["{oops", line(99, event_type="")])
    run()
    got = {r.event_id: (r.previous_score, r.new_score) for r in spark.read.parquet(str(out)).collect()}
    put(tmp_path / "all", "x.json", [line(i) for i in range(90)])
    assert got == batch_result(spark, tmp_path / "all", people)
    progress = jobs.progress_rows(spark, first)
    assert progress.agg(F.sum("rows_in")).first()[0] == 60


def test_duplicates_are_dropped_when_asked(spark, tmp_path, people):
    put(tmp_path / "in", "a.json", [line(1), line(1), line(2)])
    events = jobs.events_from_lines(wire.stream_lines(spark, str(tmp_path / "in")), dedup_within="1 hour")
    seen = []
    query = (events.writeStream.foreachBatch(lambda df, _: seen.extend(r.event_id for r in df.collect()))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(seen) == ["e0001", "e0002"]


def test_late_rows_are_counted(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.json", [line(1, minutes=0), line(2, minutes=600)])
    events = jobs.events_from_lines(wire.stream_lines(spark, str(folder), 1))
    out = jobs.hourly_activity_stream(events, "30 minutes")
    got = {}

    def keep(df, _):
        got.update({(r.subject_id, r.window_start): r.event_count for r in df.collect()})

    def run():
        query = (out.writeStream.outputMode("update").foreachBatch(keep)
                 .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
        query.awaitTermination()
        return query

    run()
    put(folder, "b.json", [line(7, minutes=5), line(8, minutes=610)])
    late = jobs.progress_rows(spark, run()).agg(F.sum("rows_late")).first()[0]
    assert late >= 1
    assert got == {("s1", T0): 1, ("s2", T0 + dt.timedelta(hours=10)): 2}


def test_scoring_job_equals_batch_and_survives_repeats(spark, tmp_path, people):
    folder = tmp_path / "in"
    for n in range(3):
        put(folder, f"{n}.json", [line(i) for i in range(n * 30, n * 30 + 30)])
    points = str(tmp_path / "points")
    job = jobs.ScoringJob(spark, people, ALL_RULES, str(tmp_path / "job"),
                          sinks={"points": jobs.replace_batch(points),
                                 "archive": jobs.archive_sink(spark, str(tmp_path / "archive"))})
    job.log.compact_every = 2
    seen = []
    lines = wire.stream_lines(spark, str(folder), 1)
    events = jobs.events_from_lines(lines).withColumn("processed_at", F.col("ts"))

    def process(df, batch_id):
        job.process(df, batch_id)
        if batch_id == 1:  # as after a crash between the write and the commit
            job.process(df, batch_id)
        seen.append(batch_id)

    query = (events.writeStream.foreachBatch(process).option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert len(seen) == 3
    want = batch_result(spark, folder, people)
    for path in (points, str(tmp_path / "archive")):
        assert {r.event_id: (r.previous_score, r.new_score) for r in spark.read.parquet(path).collect()} == want
    final = {r.subject_id: r.score for r in job.final_profiles().collect()}
    assert len(final) == 6 and final["s0"] == [want[e] for e in sorted(want) if int(e[1:]) % 6 == 0
                                               and int(e[1:]) % 5 != 4][-1][1]


def test_scoring_job_with_neighbours_equals_batch(spark, tmp_path, sf_dir):
    people, edges = star.profiles(spark, sf_dir), star.edges(spark, sf_dir)
    source = tmp_path / "in"
    star.table(spark, sf_dir, "events").repartitionByRange(3, "ts").write.parquet(str(source))
    raw = spark.readStream.schema(star.SCHEMAS["events"]).parquet(str(source))
    job = jobs.ScoringJob(spark, people, ALL_RULES, str(tmp_path / "job"), edges)
    job.start(star.map_events(spark, sf_dir, raw), str(tmp_path / "c")).awaitTermination()
    pe = score_events(spark, star.events(spark, sf_dir), people, ALL_RULES)
    every = score_with_neighbours(spark, pe, neighbour_deltas(pe, edges), people, ScoreConfig())
    order = F.struct("ts", "event_id", "hop", "origin_subject_id", "rel")
    want = {r.subject_id: r.s for r in every.groupBy("subject_id").agg(F.max_by("new_score", order).alias("s")).collect()}
    got = {r.subject_id: r.score for r in job.final_profiles().collect()}
    assert {k: got[k] for k in want} == pytest.approx(want, abs=2e-6)


def test_settings_round_trip(spark):
    main, tiers = settings.config_frames(spark, ScoreConfig())
    assert settings.load_config(main, tiers) == ScoreConfig()
    own = ScoreConfig("own", decay=Decay(True, 0.5, 100.0), rule_ids=("a", "b"), include_tags=("x",), exclude_tags=("y",))
    assert settings.load_config(*settings.config_frames(spark, own), "own") == own
    with pytest.raises(ValueError):
        settings.load_config(main, tiers, "other")


def test_decay_runs_on_between_batches(spark, tmp_path):
    """Two events ten days apart: one batch, two micro-batches, and both with neighbours give the same score."""
    import datetime as dt

    config = ScoreConfig(decay=Decay(True, 3.0, 0.0))
    people = spark.createDataFrame([("a", "regular", 500.0)], "subject_id string, type string, score double")
    edges = spark.createDataFrame([], "src string, dst string, rel string, strength double, start_date date, end_date date")
    events = spark.createDataFrame(
        [(i, "a", dt.datetime(2024, 1, 1 + 10 * i), "social", "volunteering", 1.0, "{}", dt.datetime(2024, 1, 1 + 10 * i), None, None,
          None, None, 5.0, 0.0) for i in range(2)],
        "event_id int, subject_id string, ts timestamp, event_type string, event_subtype string, confidence double, payload string, "
        "processed_at timestamp, relationship_type string, is_positive boolean, intensity double, "
        "requires_relationship_processing boolean, amount double, severity_num double")
    want = score_events(spark, events, people, ALL_RULES, config).orderBy("event_id").collect()[1]
    assert want.previous_score == 494.0
    for name, own in (("plain", None), ("edges", edges)):
        job = jobs.ScoringJob(spark, people, ALL_RULES, str(tmp_path / name), own, config)
        for i in range(2):
            job.process(events.where(f"event_id = {i}"), i)
        assert job.final_profiles().first().score == want.new_score


def cooled_rules():
    return [replace(r, cooldown_seconds=3600, max_in_period=2) if r.rule_id == "financial_positive" else r for r in ALL_RULES]


def test_cooldown_over_batches_and_restarts(spark, tmp_path, people):
    """Four runs of a scoring job with limits give the scores of one batch, and state of ended periods goes."""
    folder, check = tmp_path / "in", str(tmp_path / "c")
    rules = cooled_rules()
    job = jobs.ScoringJob(spark, people, rules, str(tmp_path / "job"), sinks={"points": jobs.replace_batch(str(tmp_path / "points"))},
                          cooldown="10 minutes")
    states = []
    for n in range(4):
        put(folder, f"{n}.json", [line(i, minutes=i / 2) for i in range(n * 40, n * 40 + 40)])
        events = jobs.events_from_lines(wire.stream_lines(spark, str(folder))).withColumn("processed_at", F.col("ts"))
        query = job.start(events, check)
        query.awaitTermination()
        states.append(max(int(s["numRowsTotal"]) for p in query.recentProgress for s in p["stateOperators"]))
    put(tmp_path / "all", "x.json", [line(i, minutes=i / 2) for i in range(160)])
    good, _ = wire.decode(wire.read_lines(spark, str(tmp_path / "all")))
    from scoreloom.operators.measures import flatten
    want = score_events(spark, flatten(good).withColumn("processed_at", F.col("ts")), people, rules, cooldown=True)
    free = score_events(spark, flatten(good).withColumn("processed_at", F.col("ts")), people, rules)
    rows = lambda df: sorted((r.event_id, r.score_change, r.previous_score, r.new_score, *r.applied_rules) for r in df.collect())
    assert rows(spark.read.parquet(str(tmp_path / "points"))) == rows(want) != rows(free)
    assert len(set(states)) == 1  # a period and its timer for each pair, not for each period there was


def test_cooldown_state_ends_with_its_period(spark, tmp_path, people):
    folder, check = tmp_path / "in", str(tmp_path / "c")
    seen, states = {}, []

    def run(name, lines):
        put(folder, name, lines)
        events = jobs.events_from_lines(wire.stream_lines(spark, str(folder)))
        scored = jobs.apply_rules(jobs.with_profile(events, people), cooled_rules())
        out = cooldown.accepted_stream(spark, scored, cooled_rules(), "1 minute")
        query = (out.writeStream.foreachBatch(lambda df, _: seen.setdefault(name, set()).update(r.event_id for r in df.collect()))
                 .option("checkpointLocation", check).trigger(availableNow=True).start())
        query.awaitTermination()
        states.append(int(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]))

    run("a", [line(0, minutes=0), line(5, minutes=1), line(10, minutes=2, subject_id="s0"), line(15, minutes=3, subject_id="s0"),
              line(20, minutes=4, subject_id="s0")])
    run("b", [line(30, minutes=500)])
    run("c", [line(35, minutes=501, subject_id="s0"), line(40, minutes=502, subject_id="s0")])
    assert seen["a"] == {"e0000", "e0005", "e0010"} and seen["b"] == {"e0030"} and seen["c"] == {"e0035"}
    assert states[0] == 2 * states[-1]  # of two pairs one has ended


def test_cooldown_takes_a_call_per_bucket_not_per_pair(spark, tmp_path, people, monkeypatch):
    """Forty subjects in three buckets, over two runs: the limits hold for each subject, and there are three states."""
    monkeypatch.setattr(cooldown, "BUCKETS", 3)
    folder, check, seen, states = tmp_path / "in", str(tmp_path / "c"), [], []
    for part in range(2):
        put(folder, f"{part}.json", [line(5 * i, minutes=i / 40, subject_id=f"s{i % 40}") for i in range(part * 80, part * 80 + 80)])
        events = jobs.events_from_lines(wire.stream_lines(spark, str(folder)))
        out = cooldown.accepted_stream(spark, jobs.apply_rules(jobs.with_profile(events, people), cooled_rules()), cooled_rules(), "1 minute")
        query = (out.writeStream.foreachBatch(lambda df, _: seen.extend(r.event_id for r in df.collect()))
                 .option("checkpointLocation", check).trigger(availableNow=True).start())
        query.awaitTermination()
        states.append(int(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]))
    assert sorted(seen) == [f"e{5 * i:04d}" for i in range(80)]  # two of four firings of each subject, all in one hour
    assert states == [3, 3]


def test_twenty_batches_keep_a_constant_number_of_tables(spark, tmp_path, people):
    import pathlib

    from scoreloom.session import shared_dir
    good, _ = wire.decode(spark.createDataFrame([(line(i),) for i in range(60)], "value string"))
    from scoreloom.operators.measures import flatten
    events = flatten(good).withColumn("processed_at", F.col("ts")).cache()
    job = jobs.ScoringJob(spark, people, ALL_RULES, str(tmp_path / "job"), sinks={"points": jobs.replace_batch(str(tmp_path / "points"))})
    job.log.compact_every = 3
    made = pathlib.Path(shared_dir(spark), "scoreloom", spark.sparkContext.applicationId)
    counts = []
    for n in range(20):
        job.process(events.where(f"cast(substring(event_id, 2) as int) between {n * 3} and {n * 3 + 2}"), n)
        tables = len(list(made.glob("*"))) if made.exists() else 0
        counts.append((tables, len(job.log._versions("change")) <= 6, len(job.log._versions("base")) <= 2,
                       len(list((tmp_path / "job" / "ledger").glob("*")))))
    assert len({c[0] for c in counts}) == 1 and all(c[1] and c[2] and c[3] == 1 for c in counts)
    want = score_events(spark, events, people, ALL_RULES)
    assert ({r.event_id: r.new_score for r in spark.read.parquet(str(tmp_path / "points")).collect()}
            == {r.event_id: r.new_score for r in want.collect()})


def test_progress_of_more_than_a_hundred_batches(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(120):
        (folder / f"{n:03d}.txt").write_text("x\n" * (n % 5 + 1))
    log = jobs.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        query = (wire.stream_lines(spark, str(folder), 1).observe("seen", F.count("*").alias("n")).writeStream.format("noop")
                 .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    rows = log.rows().filter("rows_in > 0").collect()
    assert sorted(r.batch_id for r in rows) == list(range(120))
    assert sum(r.rows_in for r in rows) == sum(n % 5 + 1 for n in range(120))
    assert all(r.rows_in == int(r.observed["seen.n"]) for r in rows)


def test_late_rows_are_kept_apart_and_a_repeat_changes_nothing(spark, tmp_path):
    split = jobs.LateSplit(spark, str(tmp_path / "late"), "30 minutes")

    def batch(*rows):
        return spark.createDataFrame([(i, None if m is None else T0 + dt.timedelta(minutes=m)) for i, m in rows], "id long, ts timestamp")

    batches = [batch((1, 0), (2, 600), (3, None)), batch(), batch((4, 570), (5, 571), (6, 900)), batch((7, 569), (8, 871), (8, 871))]
    for n, rows in enumerate(batches):
        split.process(rows, n)
        split.process(rows, n)  # as after a crash before the commit
    got = sorted((r.id, r.late, r.delay_us) for r in split.rows().collect())
    minute = 60_000_000
    assert got == [(1, False, None), (2, False, None), (3, False, None), (4, True, 0), (5, False, None), (6, False, None),
                   (7, True, 301 * minute), (8, False, None), (8, False, None)]


def test_days_from_hours_come_when_closed(spark, tmp_path):
    folder, seen = tmp_path / "in", []

    def run():
        lines = wire.stream_lines(spark, str(folder), 1)
        scored = jobs.events_from_lines(lines).withColumn("score_change", F.lit(1.5))
        query = (jobs.daily_from_hourly_stream(scored).writeStream.outputMode("append")
                 .foreachBatch(lambda df, _: seen.extend(tuple(r) for r in df.collect()))
                 .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
        query.awaitTermination()

    put(folder, "a.json", [line(0, minutes=10), line(6, minutes=20), line(12, minutes=1000)])
    run()
    assert seen == []
    put(folder, "b.json", [line(18, minutes=1439), line(1, minutes=1440 + 30)])
    run()
    assert seen == [("s0", T0.date(), 4, 6.0, 3, 2)]


def test_sinks_of_a_job_read_the_written_batch(spark, tmp_path, people):
    """The scored batch is a written table: it is not cached whole for the sinks, and each reads the columns it wants."""
    put(tmp_path / "in", "a.json", [line(i) for i in range(12)])
    kept, read = [], []

    def narrow(df, _):
        kept.append(df.is_cached)
        read.append(df.select("event_id", "new_score")._jdf.queryExecution().executedPlan().toString())

    events = jobs.events_from_lines(wire.stream_lines(spark, str(tmp_path / "in"), 1))
    job = jobs.ScoringJob(spark, people, ALL_RULES, str(tmp_path / "job"), sinks={"narrow": narrow},
                          late=lambda df: df.withColumn("processed_at", F.col("ts")))
    job.start(events, str(tmp_path / "c")).awaitTermination()
    assert kept == [False] and "InMemoryTableScan" not in read[0] and "confidence" not in read[0]
