"""Quality rules by repetition coverage.

Rolling hashes of word n-grams of several lengths, and of lines, are taken for all texts of a batch at once; characters
inside duplicated n-grams and lines are measured against all word characters. The rules and most of their limits are
those published for the Gopher and MassiveText corpora (Rae et al. 2021, appendix A.1.1). Lines count by their characters
only: a short text with one repeated short line is not junk.

Null and empty texts have no words: all counts are 0 and they fail the base rule. Repeated rows are measured alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import Words, fresh, hash_spans, mix, slices, text_bytes, without

# N-gram lengths and limits of the published repetition rules.
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
DUPLICATE_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHARACTER_LIMIT = 0.20
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
BASE_WINDOW = 5

_ROLL = np.uint64(0xD6E8FEB86659FD93)
_BUCKET_BITS = 22

FIELDS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
          "n_repeat_words": pa.int64(), "n_lines": pa.int64(), "dup_line_chars": pa.int64(),
          **{f"top_{n}gram_chars": pa.int64() for n in TOP_LIMITS},
          **{f"dup_{n}gram_chars": pa.int64() for n in DUPLICATE_LIMITS}}
METRIC_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in FIELDS])


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of keys that occur twice or more, grouped and ascending inside a group, and where each group begins."""
    bucket = (keys >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    shared = np.flatnonzero(np.bincount(bucket, minlength=1 << _BUCKET_BITS)[bucket] > 1)
    order = shared[np.argsort(keys[shared], kind="stable")]
    ordered = keys[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    twin = same[:-1] | same[1:]
    begins = ~same[:-1][twin]
    return order[twin], np.flatnonzero(begins)


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside an n-word window that begins at one of ``starts``."""
    step = np.zeros(words + 1, np.int32)
    step[starts] = 1
    reach = np.zeros(words + 1, np.int64)
    np.cumsum(step, out=reach)
    back = np.zeros(words + 1, np.int64)
    back[n:] = reach[:-n] if words + 1 > n else 0
    return (reach - back)[:words] > 0


def _same_bytes(data: np.ndarray, a: tuple[int, int], b: tuple[int, int]) -> bool:
    return a[1] - a[0] == b[1] - b[0] and data[a[0]: a[1]].tobytes() == data[b[0]: b[1]].tobytes()


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of FIELDS for each text."""
    n_texts = len(offsets) - 1
    words = Words(data, offsets)
    text, count = words.text, len(words.start)
    out = {name: np.zeros(n_texts, np.int64) for name in FIELDS}
    out["n_words"] += np.bincount(text, minlength=n_texts)

    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])  # code points before each byte
    chars = lead[words.end] - lead[words.start]
    before = np.zeros(count + 1, np.int64)
    np.cumsum(chars, out=before[1:])
    total = lambda weight, of: np.bincount(of, weight, minlength=n_texts).astype(np.int64)
    out["word_chars"] += total(chars, text)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    at = np.flatnonzero(symbol[data])
    out["n_symbols"] += np.bincount(np.searchsorted(offsets, at, "right") - 1, minlength=n_texts)

    word_hash = words.hashes()
    salt = mix(np.arange(n_texts, dtype=np.uint64) + np.uint64(1))
    roll = word_hash.copy()
    for n in range(2, max(DUPLICATE_LIMITS) + 1):
        if count < n:
            break
        roll = roll[:-1] * _ROLL + word_hash[n - 1:]
        whole = np.flatnonzero(text[: count - n + 1] == text[n - 1:])
        keys = mix(roll[whole] ^ salt[text[whole]])
        member, begin = _groups(keys)
        member = whole[member]
        if n in TOP_LIMITS and len(member):
            size = np.diff(np.append(begin, len(member)))
            head = member[begin]
            np.maximum.at(out[f"top_{n}gram_chars"], text[head], size * (before[head + n] - before[head]))
        if n in DUPLICATE_LIMITS and len(member):
            later = np.ones(len(member), bool)
            later[begin] = False
            inside = _covered(member[later], n, count)
            out[f"dup_{n}gram_chars"] += total(chars * inside, text)
            if n == BASE_WINDOW:
                inside = _covered(member, n, count)
                out["n_repeat_words"] += np.bincount(text[inside], minlength=n_texts)

    # Lines with a word: the span between line feeds, or the ends of the text.
    cut = np.flatnonzero(data == 10)
    line_start = np.union1d(cut + 1, offsets[:-1])
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start, len(data))[1:]
    line_end = line_end - (data[line_end - 1] == 10)
    solid = np.zeros(len(data) + 1, np.int64)
    np.cumsum(words.solid, out=solid[1:])
    real = solid[line_end] > solid[line_start]
    line_start, line_end = line_start[real], line_end[real]
    line_text = np.searchsorted(offsets, line_start, "right") - 1
    out["n_lines"] += np.bincount(line_text, minlength=n_texts)
    keys = mix(hash_spans(data, line_start, line_end, words.window) ^ salt[line_text])
    member, begin = _groups(keys)
    limits = np.append(begin, len(member))
    for low, high in zip(limits[:-1], limits[1:], strict=True):
        first = (line_start[member[low]], line_end[member[low]])
        for i in member[low + 1: high]:
            span = (line_start[i], line_end[i])
            if _same_bytes(data, first, span):
                out["n_dup_lines"][line_text[i]] += 1
                inside = slice(np.searchsorted(words.start, span[0]), np.searchsorted(words.start, span[1]))
                out["dup_line_chars"][line_text[i]] += chars[inside].sum()
    return out


def repetition(docs: DataFrame, text: str = "text", into: str = "repetition") -> DataFrame:
    """All columns of ``docs`` and a struct of counts per text; a column named like ``into`` is replaced."""
    keep = without(docs, [into])
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add(into, METRIC_TYPE)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(keep.index(text)))
            for low, high in slices(offsets):
                part = measure(data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low])
                counts = pa.StructArray.from_arrays([pa.array(part[f]) for f in FIELDS], names=list(FIELDS))
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*rows.columns, counts], names=[*keep, into])

    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(over, schema)


def base_failed(m: str = "repetition"):
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > 20 * F.col(f"{m}.n_words"))


def rejected(m: str = "repetition"):
    """The method's verdict: too many characters in repeated n-grams or lines."""
    chars = F.greatest(F.col(f"{m}.word_chars"), F.lit(1))
    rules = [F.col(f"{m}.top_{n}gram_chars") > F.lit(limit) * chars for n, limit in TOP_LIMITS.items()]
    rules += [F.col(f"{m}.dup_{n}gram_chars") > F.lit(limit) * chars for n, limit in DUPLICATE_LIMITS.items()]
    rules += [F.col(f"{m}.dup_line_chars") > LINE_CHARACTER_LIMIT * chars]
    any_rule = rules[0]
    for rule in rules[1:]:
        any_rule = any_rule | rule
    return any_rule


def verdicts(docs: DataFrame, text: str = "text", into: str = "repetition") -> DataFrame:
    """``repetition`` with the verdict columns base_failed and kept (replacing columns of those names)."""
    df = repetition(docs.select(*[F.col(f"`{c}`") for c in without(docs, ["base_failed", "kept"])]), text, into)
    return df.withColumn("base_failed", base_failed(into)).withColumn("kept", ~base_failed(into) & ~rejected(into))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass all rules, with their columns."""
    into = fresh("repetition", docs.columns)
    df = repetition(docs, text, into)
    return df.where(~base_failed(into) & ~rejected(into)).select(*[F.col(f"`{c}`") for c in docs.columns])
