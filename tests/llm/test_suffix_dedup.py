import collections
import hashlib
import random

import numpy as np
import pytest

from scoreloom.llm import suffix_dedup as sd


def brute(rows, length):
    count, out = collections.Counter(), []
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        count.update(b[k:k + length] for k in range(len(b) - length + 1))
    for i, b in texts:
        step = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                step[k] += 1
                step[k + length] -= 1
        gone = np.cumsum(step)[:len(b)] > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i is None, i or 0, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(df, length=sd.LENGTH):
    return sorted((r[0] is None, r[0] or 0, *r[1:]) for r in sd.digests(df, length=length).collect())


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    base = ["".join(rnd.choice("ab cd") for _ in range(900)) for _ in range(4)]
    out = [(i, rnd.choice(base)[rnd.randint(0, 300): rnd.randint(500, 900)] + "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 50)))
            + rnd.choice(base)[: rnd.randint(300, 900)]) for i in range(50)]
    return out + [(100, None), (101, ""), (None, "a" * 1500), (103, "ab" * 700), (104, "é" * 199), (104, "é" * 200 + "x"),
                  (105, "q" * 399), (106, base[0] + "z" * 30 + base[0]), (107, "same" * 120), (107, "same" * 120)]


@pytest.mark.parametrize("hot", [4000, 5, 0])
def test_against_brute_force(spark, rows, hot, monkeypatch):
    monkeypatch.setattr(sd, "HOT_BLOCKS", hot)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, 400)


def test_documents(docs):
    assert run(docs.select("doc_id", "text")) == brute([(r.doc_id, r.text) for r in docs.collect()], 400)


def test_copies_of_a_text_are_not_listed(spark, rows):
    text = rows[0][1] * 3
    df = spark.createDataFrame([(i, text) for i in range(500)] + rows[:3], "doc_id long, text string")
    assert run(df) == brute([(i, text) for i in range(500)] + rows[:3], 400)
    _, copies = sd.repeated(df)
    plan = copies._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan and "collect_list" not in plan


def test_factors():
    rnd = np.random.default_rng(1)
    data = rnd.integers(0, 2, 400).astype(np.uint8)
    starts = np.arange(400 - 9)
    earlier, later = sd.factors(data, starts, 9)
    strings = [data[i: i + 9].tobytes() for i in starts]
    assert earlier.tolist() == [strings[i] in strings[:i] for i in starts]
    assert later.tolist() == [strings[i] in strings[i + 1:] for i in starts]


def test_awkward(awkward):
    assert run(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()], 400)
    assert sd.digests(awkward.limit(0)).count() == 0
