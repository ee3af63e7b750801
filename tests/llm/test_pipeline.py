import corpus_pipeline as cp
from scoreloom.llm import decontaminate, mixing, near_dups, quality


def test_stages_and_run(spark, sf_dir):
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "mixture", "token_output"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = []
    for _, stage in cp.STAGES[:4]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        counts.append((docs.count(), after.count()))
        docs = after
    assert all(a > 0 and b > 0 for a, b in counts) and all(b <= a for a, b in counts[:3])
    out = cp.run(spark, sf_dir).collect()
    assert len(out) == counts[3][1] and min(r.start for r in out) == 0
    ids = sorted(r.start for r in out)
    assert sorted(r.start + r.n_tokens for r in out)[:-1] == ids[1:]


def test_stages_agree_with_the_operators(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in quality.verdicts(docs.select("doc_id", "text")).where("kept").collect()}
    one = cp.quality_rules(spark, docs, sf_dir)
    assert {r.doc_id for r in one.collect()} == kept
    classes = near_dups.classes(one).collect()
    two = cp.near_duplicates(spark, one, sf_dir)
    assert sorted(r.doc_id for r in two.collect()) == sorted({r.class_id for r in classes})
    leaked = {r.doc_id for r in decontaminate.contaminated(two, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    three = cp.decontamination(spark, two, sf_dir)
    assert {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect()} - leaked
    copies = {r._id: r.copies for r in mixing.copies(three)[1].collect()}
    four = cp.mixture(spark, three, sf_dir).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in four} == {i: c for i, c in copies.items() if c}


def test_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} | {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
