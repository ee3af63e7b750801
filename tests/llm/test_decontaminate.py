import re

from pyspark.sql import functions as F

from scoreloom.llm import decontaminate as D

QUESTION = ("A farmer named Anna bought 12 apples and 30.5 kg of corn from Peter, and then Anna sold 12 apples to Maria for 7 "
            "dollars.")


def items(spark):
    return spark.createDataFrame([(1, QUESTION), (2, "too short"), (3, None)], "item_id long, text string")


def test_finds_what_is_planted(spark, docs, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain = lambda t: " " + " ".join(re.findall(r"[^\W\d_]+", (t or "").lower())) + " "
    planted = [(b.item_id, plain(b.text)) for b in benchmark.collect()]
    want = {(d.doc_id, i) for d in docs.collect() for i, b in planted if b in plain(d.text)}
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, benchmark).collect()}
    assert got == want and want


def test_other_values_same_template(spark):
    swapped = QUESTION.replace("Anna", "Otto").replace("12", "99").replace("Peter", "Klaus").replace("7", "3")
    torn = QUESTION.replace("Anna bought", "Otto bought").replace("then Anna", "then Hans")
    df = spark.createDataFrame([(1, f"Intro. {swapped} End"), (2, torn), (3, None), (4, ""), (5, QUESTION), (5, QUESTION)],
                               "doc_id long, text string")
    rows = sorted((r.doc_id, r.n_changed > 0, r.reparameterised) for r in D.contaminated(df, items(spark)).collect())
    assert rows == [(1, True, True), (5, False, False), (5, False, False)]
    assert D.drop_contaminated(df, items(spark)).count() == 3
    assert D.contaminated(df.limit(0), items(spark)).count() == 0
    assert D.contaminated(df, items(spark).limit(0)).count() == 0


def test_short_items_with_many_numbers_and_ids_with_two_texts(spark):
    short = "Compute 12 * 7 - 5 + 3 and then divide by 2"
    bench = spark.createDataFrame([(1, short), (2, QUESTION), (2, "A different text of the same item comes here first")],
                                  "item_id long, text string")
    df = spark.createDataFrame([(i, "filler " * i + short) for i in range(4)] + [(9, QUESTION), (10, "nothing of it at all " * 5)],
                               "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in D.contaminated(df, bench).collect())
    assert got == [(0, 1), (1, 1), (2, 1), (3, 1), (9, 2)]


def test_names_are_settled_by_what_matches(spark):
    short, first = "Compute 12 * 7 - 5 + 3 and then divide by 2", "In the small town of Arden a farmer named Anna bought 12 apples and 30.5 kg of corn"
    long = f"{first} from Peter, and then Anna sold 12 apples to Maria for 7 dollars."
    bench = spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")
    cases = {short: (1, 0), f"see problem 12 {short}": (1, 0), f"so, {short}": (1, 0), f"so, {short.upper()}": (1, 0),
             f"so, {short.replace('12', '15')}": (1, 1), long.lower(): (2, 0), f"yes, {long.lower()} end": (2, 0),
             long.replace("then Anna", "then Hans"): (2, 0),  # contradicts itself; what stands before the change is word for word the same
             first.replace("Anna", "Otto") + " of his own and no more than that": (2, 1)}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_changed) for r in D.contaminated(df, bench).collect()}
    assert got == {(i, *want) for i, want in enumerate(cases.values())}


def test_both_canonical_forms_agree(docs):
    same = F.transform(D._valued(F.col("text")), D._shape) == D._templated(F.col("text"))
    assert docs.where(~same).count() == 0


def test_awkward(spark, awkward):
    assert D.drop_contaminated(awkward, items(spark)).columns == awkward.columns
    assert D.drop_contaminated(awkward, items(spark)).count() == 8


def test_native(spark, docs, sf_dir):
    plan = D.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("MapInArrow", "MapInPandas", "PythonUDF", "CartesianProduct"))
