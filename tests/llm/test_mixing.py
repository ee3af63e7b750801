from pyspark.sql import functions as F

from scoreloom.llm import mixing


def brute_targets(sizes):
    """Sources in order of their names, weights in turn, the excess reshared until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / max(1e-300, sum(weight[s] for s in names if s not in full))
        new = {s for s in names if s not in full and level * weight[s] > 3 * sizes[s]}
        if not new:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= new


def test_targets_and_sizes(docs):
    rows = mixing.copies(docs)[1].select("_id", "_source", "_size", "target", "copies").collect()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r._source] = sizes.get(r._source, 0) + r._size
        taken[r._source] = taken.get(r._source, 0) + r._size * r.copies
        largest[r._source] = max(largest.get(r._source, 0), r._size)
        assert 0 <= r.copies <= 3
    want = brute_targets(sizes)
    for r in rows:
        assert abs(r.target - want[r._source]) < 1e-6 * want[r._source]
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)


def test_saturated_sources(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, "d": 5, None: 50}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r._source: r.target for r in mixing.copies(df)[1].collect()}
    want = brute_targets(sizes)
    assert all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in sizes)


def test_reruns_and_partitions_agree(docs, monkeypatch):
    first = mixing.copies(docs)[1].select("_id", "copies")
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    again = mixing.copies(docs.repartition(5))[1].select("_id", "copies")
    assert first.exceptAll(again).count() == 0


def test_weights_per_document(docs):
    df = docs.withColumn("w", F.length("text") % 7)
    rows = mixing.copies(df, weight="w")[1].agg(F.max("copies").alias("most"), F.sum(F.expr("copies * _size")).alias("taken"),
                                                F.sum("_size").alias("all")).first()
    assert rows.most <= 3 and abs(rows.taken - rows["all"]) < 0.2 * rows["all"]


def test_awkward(awkward):
    mix = mixing.mixture(awkward)
    assert mix.columns == awkward.columns
    decided = mixing.copies(awkward)[1]
    assert decided.count() == 8 and mix.count() == decided.agg(F.sum("copies")).first()[0]
    assert mixing.mixture(awkward.limit(0)).count() == 0


def test_native(docs):
    plan = mixing.mixture(docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("MapInArrow", "MapInPandas", "PythonUDF", "CartesianProduct"))
