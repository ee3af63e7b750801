import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.llm import ngram_lm as lm
from scoreloom.llm.common import crc_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, held, discount=0.75):
    texts = [(i, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), "\n"]) for i, t in rows]
    count, pairs, behind, after = (collections.Counter() for _ in range(4))
    for (_, t), h in zip(texts, held, strict=True):
        if not h:
            count.update(t)
            for v, w in zip(["\n\n", *t], t, strict=False):
                pairs[v, w] += 1
                behind[v] += 1
    for v, _ in pairs:
        after[v] += 1
    total, words, out = sum(count.values()), len(count), []
    for (i, t), h in zip(texts, held, strict=True):
        base = score = 0.0
        for v, w in zip(["\n\n", *t], t, strict=False):
            p = (count[w] + 0.5) / (total + 0.5 * (words + 1))
            base += math.log10(p)
            score += math.log10((max(pairs[v, w] - discount, 0) + discount * after[v] * p) / behind[v] if behind[v] else p)
        out.append((i is None, i or 0, h, len(t), sum(count[w] > 0 for w in t), total, base, score))
    return sorted(out)


def compare(df, rows, held):
    got = sorted((r[0] is None, r[0] or 0, *r[1:]) for r in df.collect())
    want = brute(rows, held)
    assert [g[:6] for g in got] == [w[:6] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[6] == pytest.approx(w[6], rel=1e-9) and g[7] == pytest.approx(w[7], rel=2e-3)


@pytest.mark.parametrize("batch, share", [(4 << 20, 0.25), (40_000, 0.02)])
def test_against_brute_force(docs, batch, share, monkeypatch):
    monkeypatch.setattr(lm, "BATCH_BYTES", batch)
    monkeypatch.setattr(lm, "SPLIT_SHARE", share)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    compare(lm.scores(docs.repartition(3), F.pmod(crc_of(F.col("doc_id")), F.lit(5)) == 1), rows, held)


def test_elias_fano():
    rnd = np.random.default_rng(2)
    for n, top in ((0, 5), (1, 1), (50, 60), (1000, 10**9), (300, 2**50)):
        values = np.sort(rnd.integers(0, top, n)).astype(np.uint64)
        assert lm.decode(*lm.elias_fano(values, top)).tolist() == values.tolist()


def test_awkward(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    held = [r[0] == 3 for r in rows]
    compare(lm.scores(awkward, F.coalesce(F.col("doc_id") == 3, F.lit(False))), rows, held)
    assert [r.score for r in lm.scores(awkward, F.lit(True)).collect()] == [0.0] * 8
    assert lm.scores(awkward.limit(0), F.lit(False)).count() == 0
