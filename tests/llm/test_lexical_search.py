import math
import random
import re
from collections import Counter

import pytest

from scoreloom.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    docs = [(i, Counter(w), len(w)) for i, t in docs if (w := words(t))]
    n_docs, length = len(docs), sum(d[2] for d in docs)
    df = Counter(t for d in docs for t in d[1])
    out = []
    for item, text in set(items):
        scores = []
        for i, tf, n in docs:
            m = 25 + 75 * n * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t in words(text) if tf[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, n int, terms string")
    q = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, digest string, block int")
    return sorted(map(tuple, ls.search(d, q, **options).collect()), key=str)


@pytest.fixture(scope="module")
def tables():
    rnd = random.Random(5)
    some = [f"w{i}" for i in range(30)] + ["Été", "x9", "don't"]
    text = lambda n: " ".join(rnd.choice(some) for _ in range(n))
    docs = [(i, text(rnd.randint(1, 60))) for i in range(300)]
    docs += [(i + 300, docs[i % 7][1]) for i in range(40)]  # ties
    docs += [(None, docs[3][1]), (3, docs[3][1]), (1000, None), (1001, ""), (1002, "... --"), (1003, text(30_000)), (1004, "W1" * 3000)]
    items = [(i, text(rnd.randint(1, 25))) for i in range(40)]
    items += [(40, None), (41, ""), (42, "unknown"), (None, "w1 w1 w2"), (3, items[3][1]), (3, "w5 w6 w5"), (43, "W1, w1! ÉTÉ")]
    return docs, items


def test_against_brute_force(spark, tables):
    docs, items = tables
    want = brute(docs, [i for i in items if i[1]])
    assert run(spark, docs, items) == want


def test_small_blocks_and_groups(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(ls, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(ls, "HELD", 1)
    assert run(spark, docs[:120], items, top=3) == brute(docs[:120], [i for i in items if i[1]], 3)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, "")], [(1, "a")]) == []
    assert run(spark, [(1, "a")], [(1, "...")]) == []


def test_shared_terms_keep_sums():
    rnd = random.Random(1)
    items = [{rnd.randrange(20): rnd.choice((1, 1, 2)) for _ in range(12)} for _ in range(30)]
    nodes, left = ls.share_terms(items)
    value = {t: rnd.random() for t in range(20)}
    first = 1 + max(t for i in items for t in i)
    for k, (a, b) in enumerate(nodes):
        value[first + k] = value[a] + value[b]
    for item, parts in zip(items, left):
        assert math.isclose(sum(value[t] * c for t, c in item.items()), sum(value[p] * c for p, c in parts.items()))
    assert nodes and sum(map(len, left)) + len(nodes) < sum(map(len, items))
