import random
from collections import Counter

import numpy as np
import pytest

from scoreloom.llm import near_dups as nd
from scoreloom.llm.common import components


def test_alignment_is_a_longest_common_subsequence():
    rnd = random.Random(3)
    for _ in range(80):
        a = [rnd.randint(0, 60) for _ in range(rnd.randint(5, 40))]
        b = [x for x in a if rnd.random() > 0.1] + [rnd.randint(0, 60) for _ in range(rnd.randint(0, 5))]
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert sum(nd.aligned_runs(np.array(a, "<u4"), np.array(b, "<u4"), 1000)) == table[-1, -1]


def shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


@pytest.fixture(scope="module")
def copies():
    """Bases with copies that differ in a few words, each pair's similarity known, and unrelated texts."""
    rnd, rows = random.Random(5), []
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    for base in range(12):
        text = [word() for _ in range(150)]
        rows.append((base * 100, " ".join(text)))
        for c in range(1, 8):
            copy = list(text)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(150)] = word()
            rows.append((base * 100 + c, " ".join(copy)))
    return rows


def test_all_similar_pairs_meet(spark, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string")
    cls = {r.doc_id: r.class_id for r in nd.classes(df).collect()}
    sets = {i: shingles(t) for i, t in copies}
    for i in sets:
        for j in sets:
            if i < j:
                s = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
                if s >= 0.8:
                    assert cls[i] == cls[j]
                if i // 100 != j // 100:
                    assert cls[i] != cls[j]


def test_large_group_has_no_all_pairs(spark):
    rnd = random.Random(6)
    text = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    rows = [(i, " ".join([*text[:i % 190], f"w{i}", *text[i % 190 + 1:]])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.selectExpr("unhex(md5(cast(text as binary))) key", "text")
    assert nd.candidates(nd._sketch_rows(keyed)).count() < 300 * 2 * nd.SKETCHES + 300 * nd.SMALL
    assert {r.class_id for r in nd.classes(df).collect()} == {0}


def joined_by_all_pairs(texts):
    """The least text number of each text's class, by every pair of shingle sets."""
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("kind", ["chain", "cloud"])
def test_classes_of_large_buckets(spark, kind):
    rnd, word = random.Random(8), lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    base, texts = [word() for _ in range(250)], []
    for _ in range(400):
        if kind == "chain":  # the next revision, or a leap to one that is just too far or just near enough
            for _ in range(rnd.choice([1, 1, 1, 1, 5, 6, 7])):
                base[rnd.randrange(250)] = word()
            texts.append(" ".join(base))
        else:  # pairs are about as similar as the threshold
            copy = list(base)
            for at in rnd.sample(range(250), rnd.choice([2, 3, 4, 5])):
                copy[at] = word()
            texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in nd.classes(df).collect()}
    assert [got[i] for i in range(len(texts))] == joined_by_all_pairs(texts)


def test_no_pair_is_lost_in_buckets_that_are_split_again(spark, monkeypatch):
    """Thirty pairs of near copies, all in one bucket by two sketches and by no third: splitting on never parts them into smaller ones."""
    from pyspark.sql import functions as F

    rnd, real, texts = random.Random(9), nd._sketch_rows, []
    for _ in range(30):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(7)) for _ in range(100)]
        texts += [" ".join(words), " ".join([*words[:-1], "other"])]
    same_two = [F.when(F.lit(i < 2), F.lit(i)).otherwise(F.xxhash64("key", F.lit(i))).cast("bigint") for i in range(nd.SKETCHES)]
    monkeypatch.setattr(nd, "_sketch_rows", lambda docs: real(docs).withColumn("sketches", F.array(*same_two)))
    monkeypatch.setattr(nd, "SMALL", 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in nd.classes(df).collect()} == {i: i - i % 2 for i in range(60)}


def test_tables_grow_with_the_texts_and_not_with_their_pairs(spark, monkeypatch):
    """Texts that share a passage and no more: all pairs share sketches, none is a link. Two are near copies."""
    rnd, word = random.Random(10), lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    passage = [word() for _ in range(120)]
    texts = [" ".join([*passage, *[word() for _ in range(60)]]) for _ in range(200)]
    texts.append(texts[7] + " " + word())
    real, made = nd.stored, []

    def stored(df, name):
        out = real(df, name)
        made.append((out.count(), name))
        return out

    monkeypatch.setattr(nd, "stored", stored)
    monkeypatch.setattr(nd, "SMALL", 8)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in nd.classes(df).collect()} == {i: i if i < 200 else 7 for i in range(201)}
    assert max(made)[0] <= nd.SKETCHES * len(texts), max(made)


def test_common_kmers_of_all_pairs():
    rnd = np.random.default_rng(11)
    names = rnd.integers(1 << 31, 1 << 32, 3).astype("<u4")
    left, right = ([names[rnd.integers(0, 3, rnd.integers(1, 30))] for _ in range(n)] for n in (40, 30))

    def counts(t):
        return Counter(tuple(t[i:i + nd.K]) for i in range(len(t) - nd.K + 1)) if len(t) >= nd.K else Counter([("whole", *t)])

    assert nd.shared_kmers(left, right).tolist() == [[(counts(a) & counts(b)).total() for b in right] for a in left]


def test_blocks_and_split_buckets_lose_no_link(spark, monkeypatch):
    """Copies about as similar as the threshold, in blocks of a few texts and in buckets that are split by a second sketch."""
    rnd, word = random.Random(12), lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    base, texts = [word() for _ in range(250)], []
    for _ in range(150):
        copy = list(base)
        for at in rnd.sample(range(250), rnd.choice([3, 4, 5, 6])):
            copy[at] = word()
        texts.append(" ".join(copy))
    for name, value in (("SMALL", 4), ("TILE", 16), ("SPLIT", 64)):
        monkeypatch.setattr(nd, name, value)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in nd.classes(df).collect()}
    assert [got[i] for i in range(len(texts))] == joined_by_all_pairs(texts)


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a int, b int")
    labels = {r.key: r.label for r in components(chain).collect()}
    assert all(labels[i] == 0 for i in range(41)) and labels[101] == 100


def test_awkward(spark, awkward):
    rows = nd.classes(awkward).collect()
    assert len(rows) == 8
    cls = {(r.doc_id, r.class_id) for r in rows}
    assert (2, 2) in cls and (None, 2) in cls  # equal texts, also with a null id
    kept = nd.keep_one(awkward)
    assert kept.columns == awkward.columns and kept.count() == 5
    assert nd.classes(awkward.limit(0)).count() == 0 and nd.keep_one(awkward.limit(0)).count() == 0
