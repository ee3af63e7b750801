"""Archive, backups, retention, upsert, reads and layouts on written files."""

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.model import RECORD_EVENT
from scoreloom.operators import archive as A
from scoreloom.sources import layouts

T0 = dt.datetime(2024, 1, 1)


def processed(spark, *rows):
    df = spark.createDataFrame([(s, T0 + dt.timedelta(hours=h), e, v, T0 + dt.timedelta(days=40 + v)) for s, h, e, v in rows],
                               "subject_id string, ts timestamp, event_id string, new_score double, processed_at timestamp")
    rest = {c: F.lit("x") for c in A.ARCHIVE_COLUMNS if c not in df.columns + ["applied_rules", "confidence",
                                                                              "score_change", "previous_score"]}
    return df.withColumns({**rest, "applied_rules": F.array(F.lit("r")), "confidence": F.lit(1.0),
                           "score_change": F.lit(1.0), "previous_score": F.lit(0.0)})


def test_archive_overwrites_same_key_and_leaves_other_dates(spark, tmp_path):
    path = str(tmp_path / "archive")
    A.write_archive(spark, processed(spark, ("a", 1, "1", 1.0), ("a", 30, "2", 1.0), ("b", 2, "3", 1.0)), path)
    A.write_archive(spark, processed(spark, ("a", 1, "1", 2.0), ("a", 3, "4", 2.0), ("b", 2, "3", 0.0)), path)
    rows = {r.event_id: r.new_score for r in spark.read.parquet(path).collect()}
    assert rows == {"1": 2.0, "2": 1.0, "3": 1.0, "4": 2.0}
    assert sorted(p.name for p in (tmp_path / "archive").glob("date=*")) == ["date=2024-01-01", "date=2024-01-02"]
    got = A.recent_events(spark.read.parquet(path), "a", T0, T0 + dt.timedelta(days=1), 1).collect()
    assert [r.event_id for r in got] == ["4"]
    plan = A.point_query(spark.read.parquet(path), "a", T0, T0 + dt.timedelta(days=1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "EqualTo(subject_id,a)" in plan


def test_archive_rows_are_shuffled_once(spark, tmp_path, monkeypatch):
    """One shuffle by range finds the latest row per key and lays out the files, and nothing goes to checkpoints."""
    pe, plans, real = processed(spark, ("a", 1, "1", 1.0), ("a", 1, "1", 2.0), ("a", 3, "4", 2.0)), [], A._laid_out

    def laid_out(rows, version):
        out = real(rows, version)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    def no_checkpoint(*_):
        raise AssertionError("rows are checkpointed")

    monkeypatch.setattr(A, "_laid_out", laid_out)
    monkeypatch.setattr(type(pe), "checkpoint", no_checkpoint)
    for _ in range(2):
        A.write_archive(spark, pe, str(tmp_path / "archive"))
    assert [p.count("Exchange ") for p in plans] == [1, 1] and all("rangepartitioning(date" in p for p in plans)
    assert {r.event_id: r.new_score for r in spark.read.parquet(str(tmp_path / "archive")).collect()} == {"1": 2.0, "4": 2.0}


def test_event_lookup_skips_row_groups(spark, tmp_path):
    """Small row groups without dictionaries: minima and maxima can't tell where an id is, bloom filters can."""
    path = str(tmp_path / "archive")
    pe = processed(spark, *[(f"s{i % 7}", i % 24, f"{i * 7919 % 100_003:06d}", 1.0) for i in range(20_000)]).coalesce(1)
    small = {"parquet.block.size": "40000", "parquet.block.size.row.check.min": "100", "parquet.enable.dictionary#event_id": "false"}
    A.write_archive(spark, pe, path, files=small)

    def scanned(df):
        rows = df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return len(rows), scan.metrics().apply("numOutputRows").value()

    stored = spark.read.parquet(path)
    assert scanned(stored.select("event_id"))[1] == 20_000
    found, read = scanned(A.find_event(stored, "007919"))
    assert found == 1 and 0 < read < 4000
    found, read = scanned(A.find_event(stored, "050000x"))
    assert found == 0 and read < 2000


def test_backups(spark, tmp_path):
    root = str(tmp_path / "backup")
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string").coalesce(1)
    for hour in (1, 2):
        at = F.lit(dt.datetime(2024, 1, 1, hour)).cast("timestamp")
        A.write_backup(A.backup_rows(rows, "processed_events", "job", "periodic_backup", at), root)
    A.write_backup(A.backup_rows(rows, "metrics", "job", "metrics_backup", F.lit(T0).cast("timestamp")), root)
    assert {r.data_type: (r.files, r.rows) for r in A.backup_counts(spark, root).collect()} == {
        "processed_events": (2, 4), "metrics": (1, 2)}
    listed = [r.path for r in A.list_backups(spark, root, "processed_events").collect()]
    assert len(listed) == 2 and "month=01/day=01/hour=01" in listed[0]
    assert A.list_backups(spark, root, "processed_events", 1).count() == 1
    back = A.restore_backup(spark, listed[0], rows.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "x"), (2, "y")]
    kept, old = A.old_backups(spark, root, 30, dt.datetime.now() + dt.timedelta(days=31))
    assert kept.count() == 0 and old.count() == 3
    kept, old = A.old_backups(spark, root, 30, dt.datetime.now())
    assert kept.count() == 3 and old.count() == 0


def test_envelope(spark, tmp_path):
    doc = {"timestamp": "2024-01-01T00:00:00Z", "data_type": "metrics", "source": "s", "event_count": 2,
           "backup_reason": "r", "data": [{"id": 1}, {"id": 2}]}
    (tmp_path / "e.json").write_text(json.dumps(doc, indent=2))
    rows = A.restore_envelope(spark, str(tmp_path / "e.json"), T.StructType([T.StructField("id", T.IntegerType())]))
    assert sorted(r.id for r in rows.collect()) == [1, 2]


def test_targets_and_retention(spark):
    df = spark.createDataFrame([("metrics",), ("dgraph",), ("zzz",)], "t string")
    assert [r.x for r in df.select(A.target_dataset(F.col("t")).alias("x")).collect()] == [
        "stream-backups", "dgraph-backups", "stream-backups"]
    days = spark.createDataFrame([(d,) for d in range(100)], "d int").withColumn(
        "ts", F.lit(T0).cast("timestamp") + F.make_dt_interval("d"))
    kept, gone = A.split_by_age(days, "ts", 30, T0 + dt.timedelta(days=99))
    assert kept.count() == 31 and gone.count() == 69
    assert A.retain(days, "ts", "raw", T0 + dt.timedelta(days=99)).count() == 91


def test_upsert_and_versions(spark, tmp_path):
    people = spark.createDataFrame([("a", 5, 100.0, "very_poor"), ("b", 6, 700.0, "good")],
                                   "subject_id string, age int, score double, tier string")
    news = spark.createDataFrame([("a", 450.0, T0), ("ghost", 1.0, T0)], "subject_id string, score double, last_score_at timestamp")
    out = {r.subject_id: r for r in A.upsert_profiles(people, news).collect()}
    assert set(out) == {"a", "b"}
    assert (out["a"].score, out["a"].tier, out["a"].age) == (450.0, "average", 5)
    assert (out["b"].score, out["b"].tier, out["b"].last_updated) == (700.0, "good", None)
    path = A.write_version(people, str(tmp_path / "p"), 3)
    assert spark.read.parquet(path).count() == 2


def test_lookup_table_is_bucketed(spark):
    A.write_event_lookup(spark, processed(spark, ("a", 1, "1", 1.0), ("a", 30, "2", 1.0)), "event_lookup", 4)
    table = spark.table("event_lookup")
    assert A.find_event(table, "2").first().year_month == 202401
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.join(table.select("event_id"), "event_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_add_subjects_keeps_base(spark):
    base = spark.createDataFrame([("a", 1)], "subject_id string, age int")
    new = spark.createDataFrame([("a", 9), ("b", 2)], "subject_id string, age int")
    assert sorted(map(tuple, A.add_subjects(base, new).collect())) == [("a", 1), ("b", 2)]


def test_record_layout(spark):
    row = ("e", "s", "FINANCIAL", None, 1704067200123, "bank", 0.4, 0.9, ("R", "C", 1.0, 2.0), (5.0, "d", {"k": "v"}))
    out = layouts.from_record(spark.createDataFrame([row], RECORD_EVENT)).first()
    assert out.event_type == "financial" and out.location.country is None and out.location.city == "C"
    assert out.timestamp == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert json.loads(out.payload) == {"amount": 5.0, "description": "d", "metadata": {"k": "v"}, "severity_num": 0.4}
