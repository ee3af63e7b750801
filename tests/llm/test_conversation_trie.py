import hashlib
import random
import re
import zlib

import pytest

from scoreloom.llm import conversation_trie as ct

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
    nodes = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    out = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m != n and m[:len(n)] == n and len(m) == len(n) + 1 for m in below)]
        saved = sum((len(nodes[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(node))
        out.append((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, length=ct.BLOCK):
    df = spark.createDataFrame([(*r, "theirs", 1, "k") for r in rows], "conv_id long, turn long, role string, text string, pos string, n int, node string")
    got = ct.trie(*ct.rebuilt(ct.turns(df)), length=length)
    assert tuple(got.columns) == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    say = [(rnd.choice(("user", "assistant", None)), rnd.choice(("a b", "c", "", None, "d  e\nf g"))) for _ in range(6)]
    out = []
    for c in range(90):
        if c in (40, 61):  # absent: nothing is lent, the others lose their first turns
            continue
        out += [(c, t, *say[rnd.randrange(2 if t < 5 else 6)]) for t in range(rnd.choice((1, 1, 2, 3, 5, 9, 12)))]
    out += [(7, None, "user", "z"), (7, None, "user", "y"), (7, 1, "user", "a b"), (7, 1, "user", "a b"), (None, 1, "user", "x")]
    return out + [(80, t, "user", f"long {t % 3}") for t in range(20, 100)]


@pytest.mark.parametrize("length", [ct.BLOCK, 1, 3])
def test_against_brute_force(spark, rows, length):
    assert run(spark, rows, length) == brute(rows)


def test_pieces_of_ends(spark, monkeypatch):
    monkeypatch.setattr(ct, "PIECE", 3)
    rows = [(c, 0, "user", "same words here") for c in range(60)]
    assert run(spark, rows) == brute(rows)


def test_empty_and_turnless(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 1)
    assert run(spark, [(turnless, 0, "user", "x")]) == brute([(turnless, 0, "user", "x")])
