"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, look-alike letters of other scripts to plain ones, invisible characters removed, and digits and signs inside words read as the letters they stand for (``1`` as i and as l).
A reading without accents is tried for whole words. One Aho-Corasick pass
finds all entries: stems at a word's beginning, whole words, and exception phrases, which cancel the hits inside them.
Weighted hits, normalised by the text's length, give the score through a logistic curve.

The lexicon, its weights and the curve are learned from labelled rows: at most ``MAX_TRAINING`` of them, chosen by a hash of
the id. Candidates are stems and words of toxic rows; the lexicon is built greedily, each entry being the one that adds to most
toxic texts that have fewer than ``COVER`` entries, so that words which toxic near copies merely share seldom enter. Phrases of an entry and a
neighbour that stand in clean rows only become exceptions.

Null and empty texts have no hits and get the curve's lowest score. Repeated texts count once in training and are scored
alike. Without labels of both kinds, or without an entry that tells them apart, every score is 0. Empty tables give
empty results.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import crc_of, stored, text_key

#: Labelled rows used for learning, at most.
MAX_TRAINING = 20_000
#: Entries of the lexicon, at most; each adds to at least MIN_GAIN toxic training texts that have fewer than COVER entries.
MAX_ENTRIES = 500
COVER = 4
MIN_SUPPORT = 4
MIN_GAIN = 3
#: An entry's odds ratio must be above this at the lower end of a one-sided 95 % interval.
MIN_ODDS = 8.0
STEMS = (4, 5, 6, 7)

# Phrases in which an abusive word is not abuse.
EXCEPTIONS = ("idiot proof", "idiot light", "trash can", "trash bag", "trash bin", "pond scum", "clown fish", "class clown",
              "rodeo clown", "sore loser", "loser bracket")

# Letters of other scripts that look like Latin ones, and the digits and signs written for letters.
HOMOGLYPHS = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "к": "k",
              "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ո": "n", "ɡ": "g", "ӏ": "l", "α": "a", "ο": "o", "ρ": "p",
              "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "ε": "e", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d"}
DIGITS = {"0": "o", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
INVISIBLE = "\u00ad\u034f\u200b\u200c\u200d\u2060\ufeff"

_MIXED = re.compile(r"(?=[^ ]*[^\W\d_])[^\W_]*(?:[0-9@$!][^\W_]*)+(?<=[^\W_])")
_SUBSTITUTES = re.compile(r"[0-9@$!]")


class _Folding(dict):
    """Code point to what it is read as; worked out when first met."""

    def __missing__(self, code: int) -> str | None:
        char = chr(code)
        if char in INVISIBLE:
            out = None
        elif char in HOMOGLYPHS:
            out = HOMOGLYPHS[char]
        elif char in DIGITS or char.isdigit() and char.isascii():
            out = char
        elif char.isalnum():
            out = "".join(HOMOGLYPHS.get(c, c) for c in unicodedata.normalize("NFKC", char).lower())
        elif unicodedata.combining(char):
            out = None
        else:
            out = " "
        self[code] = out
        return out


_FOLDING = _Folding()
_READ = {ord(k): v for k, v in DIGITS.items()}
_AS_I, _AS_L = _READ | {ord("1"): "i"}, _READ | {ord("1"): "l"}


def _spaced(text: str) -> str:
    return f" {' '.join(_SUBSTITUTES.sub(' ', text).split())} "


def fold(text: str) -> str:
    """The folded text, with one space between and around words."""
    return readings(text)[0]


def readings(text: str) -> list[str]:
    """The folded text; and, where they differ, the one with 1 read as l inside words, and the one without accents."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    plain = text.lower().translate(_FOLDING)
    out = []
    if _SUBSTITUTES.search(plain):
        out = [_spaced(_MIXED.sub(lambda m: m[0].translate(_AS_I), plain))]
        if "1" in plain:
            out.append(_spaced(_MIXED.sub(lambda m: m[0].translate(_AS_L), plain)))
    else:
        out = [f" {' '.join(plain.split())} "]
    if not out[0].isascii():
        bare = unicodedata.normalize("NFD", out[0]).encode("ascii", "ignore").decode()
        out.append(bare)
    return out


def features(folded: str) -> set[str]:
    """Stems (" stem") and words (" word ") of a folded text."""
    out = set()
    for word in set(folded.split()):
        if len(word) >= 3:
            out.add(f" {word} ")
            out.update(f" {word[:n]}" for n in STEMS if n < len(word))
    return out


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, ...] = ()

    def key(self) -> tuple:
        return tuple(sorted(self.weights.items())), tuple(self.exceptions)


@lru_cache(maxsize=4)
def _automaton(key: tuple) -> ahocorasick.Automaton:
    weights, exceptions = key
    machine = ahocorasick.Automaton()
    for entry, weight in weights:
        machine.add_word(entry, (len(entry), weight, entry))
    for phrase in exceptions:
        machine.add_word(f" {phrase} ", (len(phrase) + 2, None, phrase))
    machine.make_automaton()
    return machine


def hits(folded: str, key: tuple) -> list[tuple[int, float, str]]:
    """(first letter's place, weight, entry) of the entries found outside exception phrases; one for each word, the heaviest."""
    if not any(key):
        return []
    found, shields = {}, []
    for end, (size, weight, entry) in _automaton(key).iter(folded):
        start = end - size + 2
        if weight is None:
            shields.append((start, end))
        elif start not in found or found[start][0] < weight:
            found[start] = (weight, entry)
    return [(at, w, e) for at, (w, e) in sorted(found.items()) if not any(a <= at < b for a, b in shields)]


def measures(text: str | None, key: tuple) -> tuple[float, float, float]:
    """What the curve sees: 1, weighted hits, and weighted hits per root of the length."""
    folded, *others = readings(text or "")
    total = sum(w for _, w, _ in hits(folded, key))
    for other in others:  # a bare reading blurs what tells other languages' words apart: whole words count only
        total = max(total, sum(w for _, w, e in hits(other, key) if e[-1] == " " and e.isascii()))
    n_words = max(1, folded.count(" ") - 1)
    return 1.0, float(np.log1p(total)), float(np.log1p(total / np.sqrt(n_words)))


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Logistic regression by Newton steps; classes weigh alike to within the root of their ratio."""
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        grad = x.T @ (y - p) - ridge * beta
        step = np.linalg.solve((x * w[:, None]).T @ x + ridge * np.eye(x.shape[1]), grad)
        beta += step
        if np.abs(step).max() < 1e-7:
            break
    return tuple(float(b) for b in beta)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str) -> DataFrame:
    """(text, y) of at most about MAX_TRAINING labelled rows outside the held-out fifth, each different text once."""
    usable = (labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("y"))
              .where("_id is not null and y in (0, 1)").where(F.pmod(crc_of(F.col("_id")), F.lit(5)) != 0)
              .groupBy("_id").agg(F.max("y").alias("y")))
    n = usable.count()
    if n > MAX_TRAINING:
        usable = usable.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * MAX_TRAINING / n))
    chosen = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    # The labels are bounded by MAX_TRAINING rows of two numbers, so they go to the texts and not the texts to them.
    rows = chosen.join(F.broadcast(usable), "_id").select("text", "y", text_key(F.col("text")).alias("key"))
    return rows.groupBy("key").agg(F.first("text").alias("text"), F.max("y").alias("y")).select("text", "y")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Lexicon:
    """A lexicon from labelled rows. What reaches the driver is bounded by MAX_TRAINING, not by the tables."""
    rows = stored(training_rows(docs, labels, id_col, text, label), "tox-training")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(sorted(features(fold(value))))], names=["feature"])

    support = (rows.where("y = 1").select("text").mapInArrow(words, "feature string").groupBy("feature").count()
               .where(F.col("count") >= MIN_SUPPORT))
    candidates = {f: i for i, f in enumerate(sorted(r[0] for r in support.select("feature").collect()))}
    names = sorted(candidates)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, len(names)), np.int64)
        texts = np.zeros(2, np.int64)
        for batch in batches:
            for value, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts[y] += 1
                n[y, [candidates[f] for f in features(fold(value)) if f in candidates]] += 1
        if texts.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(names) + 1)), pa.array(np.append(n[0], texts[0])),
                                              pa.array(np.append(n[1], texts[1]))], names=["i", "clean", "toxic"])

    totals = {r["i"]: (r["c"], r["t"]) for r in rows.mapInArrow(counted, "i bigint, clean bigint, toxic bigint").groupBy("i").agg(
        F.sum("clean").alias("c"), F.sum("toxic").alias("t")).collect()}
    clean_texts, toxic_texts = totals.get(len(names), (0, 0))
    if not clean_texts or not toxic_texts:
        return Lexicon()
    likely = {}
    for feature, i in candidates.items():
        clean, toxic = totals[i]
        odds = np.log((toxic + 0.5) / (toxic_texts + 1)) - np.log((clean + 0.5) / (clean_texts + 1))
        if odds - 1.64 * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)) >= np.log(MIN_ODDS):
            likely[feature] = float(odds)

    def incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted(f for f in features(fold(v)) if f in likely) for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string()))], names=["found"])

    holders = defaultdict(set)
    for i, row in enumerate(rows.where("y = 1").select("text").mapInArrow(incidence, "found array<string>").collect()):
        for f in row[0]:
            holders[f].add(i)
    weights: dict[str, float] = {}
    cover: Counter = Counter()
    while holders and len(weights) < MAX_ENTRIES:
        gain = {f: sum(cover[i] < COVER for i in h) for f, h in holders.items()}
        most = max(gain.values())
        if most < MIN_GAIN:
            break
        # Of entries that add nearly as much, the one with the best odds, then the longest.
        best = max((f for f, g in gain.items() if g >= 0.95 * most), key=lambda f: (round(likely[f], 1), len(f), f))
        weights[best] = likely[best]
        texts = holders.pop(best)
        cover.update(texts)
        # What stands in the same texts and begins alike is the same word again.
        holders = {f: h for f, h in holders.items()
                   if not ((f.startswith(best.rstrip()) or best.startswith(f.rstrip())) and len(h - texts) < MIN_GAIN)}
    if not weights:
        return Lexicon()
    lexicon = Lexicon(weights)
    lexicon.exceptions = (*EXCEPTIONS, *_exceptions(rows, lexicon))
    key = lexicon.key()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray([measures(v, key) for v in batch.column(0).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), batch.column(1)], names=["a", "b", "c", "y"])

    points = np.asarray(rows.mapInArrow(measured, "a double, b double, c double, y int").collect(), float)
    lexicon.curve = _curve(points[:, :3], points[:, 3])
    return lexicon


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> list[str]:
    """Phrases of a hit word and a neighbour found in MIN_SUPPORT clean texts or more, and in no toxic one."""
    key = lexicon.key()

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = fold(value)
                seen: Counter = Counter()
                for at, _, _ in hits(folded, key):
                    before = folded[max(0, at - 60): at].split()[-1:]
                    here = folded[at: at + 200].split()[:2]
                    seen.update([" ".join(before + here[:1])] if before else [])
                    seen.update([" ".join(here)] if len(here) == 2 else [])
                yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string()), pa.array([y] * len(seen), pa.int32())],
                                                 names=["phrase", "y"])

    counts = rows.mapInArrow(phrases, "phrase string, y int").groupBy("phrase").agg(
        F.sum("y").alias("toxic"), F.count("*").alias("all"))
    found = counts.where(f"toxic = 0 and all >= {MIN_SUPPORT}").select("phrase").collect()
    return sorted(r[0] for r in found if len(r[0].split()) == 2)


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Columns of docs but the text, with score and predicted (columns of those names are replaced)."""
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), "score", "predicted")]
    key, curve = lexicon.key(), np.asarray(lexicon.curve)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(curve):
                x = np.asarray([measures(v, key) for v in batch.column(len(keep)).to_pylist()]).reshape(-1, 3)
                p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
            else:
                p = np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             names=[*keep, "score", "predicted"])

    chosen = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"))
    schema = chosen.drop(text).schema.add("score", T.DoubleType()).add("predicted", T.IntegerType())
    return chosen.mapInArrow(over, schema)
