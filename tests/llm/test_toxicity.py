import pytest
from pyspark.sql import functions as F

from scoreloom.llm import toxicity as tx
from scoreloom.llm.common import crc_of


def test_readings():
    assert tx.fold("1D10T's l0ser! $cum idi​ot іdіot") == " idiot s loser scum idiot idiot "
    assert " clown " in tx.readings("c1own")[1]
    assert tx.fold("") == "  " and tx.fold("THE!! a|b éÀü anor***") == " the a b éàü anor "


def test_exception_phrases_shield_hits():
    key = tx.Lexicon({" clown ": 2.0, " idiot": 3.0}).key()
    assert [e for _, _, e in tx.hits(tx.fold("a clown and a clown fish, idiotic"), key)] == [" clown ", " idiot"]


@pytest.fixture(scope="module")
def larger(spark):
    return "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, larger):
    docs, labels = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("documents", "labels"))
    lexicon = tx.learn(docs, labels)
    scored = tx.score(docs.select("doc_id", "text"), lexicon).join(labels, "doc_id")
    held = scored.where(F.pmod(crc_of(F.col("doc_id")), F.lit(5)) == 0).collect()
    hits = [r for r in held if r.predicted == 1]
    assert all(r.toxic == 1 for r in hits) and len(hits) >= 0.6 * sum(r.toxic for r in held)
    assert all(0 <= r.score <= 1 for r in held)


def test_awkward(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0)):
        rows = tx.score(awkward, tx.learn(awkward, given)).collect()
        assert len(rows) == 8 and all(r.predicted == 0 and 0 <= r.score < 0.5 for r in rows)
    assert tx.score(awkward.limit(0), tx.Lexicon()).count() == 0
