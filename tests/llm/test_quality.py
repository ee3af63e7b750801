import collections
import re

from scoreloom.llm import quality

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, inside = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            inside.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def brute_rejected(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    chars = max(1, sum(map(len, words)))
    for n, limit in quality.TOP_LIMITS.items():
        count = collections.Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        if any(c > 1 and c * sum(map(len, g)) > limit * chars for g, c in count.items()):
            return True
    for n, limit in quality.DUPLICATE_LIMITS.items():
        seen, inside = set(), set()
        for i in range(len(words) - n + 1):
            g = tuple(words[i:i + n])
            if g in seen:
                inside.update(range(i, i + n))
            seen.add(g)
        if sum(len(words[i]) for i in inside) > limit * chars:
            return True
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        size = sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", line)))
        if size and line in seen:
            repeated += size
        seen.add(line)
    return repeated > quality.LINE_CHARACTER_LIMIT * chars


def test_against_brute_force(spark, docs):
    more = ["", "a\r\na\r\n\n\na", "x " * 50, "é\x0bü a", "a" * 2000 + " " + "a" * 2000, "b\nb", "# * | <", None] + [
        "one two three four five six seven eight nine ten\n" * k for k in (1, 2, 3)]
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(more)], "doc_id long, text string")
    rows = quality.verdicts(docs.select("doc_id", "text").union(extra)).select("text", "repetition", "base_failed", "kept").collect()
    assert len(rows) == 200 + len(more)
    for row in rows:
        n = brute(row.text)
        assert tuple(row.repetition[c] for c in BASE) == n
        assert row.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert row.kept == (not row.base_failed and not brute_rejected(row.text))


def test_awkward(awkward):
    assert quality.verdicts(awkward).count() == 8
    assert quality.keep_good(awkward).columns == awkward.columns
    assert quality.keep_good(awkward.limit(0)).count() == 0
