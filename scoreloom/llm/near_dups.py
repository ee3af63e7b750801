"""Near duplicates by Order MinHash.

Texts are lower-cased words without ASCII punctuation; their k-mers are runs of five words (all words of a shorter text).
Each k-mer is labelled with its occurrence in the text. A sketch (Marcais et al. 2019) is the pair of k-mers whose labelled
hashes are least, kept in the order of the text; sixteen independent sketches make sixteen bucket keys. Texts that agree in
content and order share a sketch with about the square of their similarity: a pair of similarity 0.8 shares none of sixteen
with a chance under one in a million.

Candidates are verified by banded alignment of their word sequences: the similarity is the number of five-word runs that
the alignment matches over those of both texts (as a Jaccard index), and 0.8 or more is a link. The band follows from the
threshold, and pairs whose k-mers can't reach it in any order are dropped before.

A pair is verified only if it shares two sketches or more: texts that share no more than a passage mostly share one. What a bucket's
rows carry of the sketches is a byte each, so this is known where the pair is made, before any text is fetched. A pair of similarity
0.8 shares under two of sixteen with a chance of about two in a million.

Candidates of a bucket: all pairs while it has up to ``SMALL`` texts. Of a larger one, every text is first compared with two
centres, the text that has most company over all its sketches and the least key, so that a group of many thousand copies
makes two rows per text and not all pairs. What is still between classes then is compared in tiles: the texts outside the bucket's largest
class, in blocks, meet all its texts, in blocks. A tile tells from the sketches which pairs to look at, counts the k-mers they have in
common for all of them in one matrix product, and aligns those that have enough while they are in different classes; it gives links, and no
row is made for a pair. A pair is looked at in the tile of the first sketch it shares only, and not if it met in a small bucket. Buckets above
``SPLIT`` texts are split by a second sketch first; a pair to verify shares two, so none is lost.

Pairs that are in one class anyhow are not compared again, so in large buckets ``n_links`` counts the links that were needed
to build the class, not all links there are.

Texts are told apart by a 128-bit digest; equal texts are one text. Classes are the connected components of links and
exact copies. Null and empty texts equal each other; texts without words have no near duplicates. Texts of any length are aligned whole. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import Words, components, fresh, mix, slices, stored, text_bytes, text_key

K = 5
SIMILARITY = 0.8
SKETCHES = 16
MINIMA = 2
SMALL = 32
#: Texts, and their words together, in one block of a large bucket; two blocks meet in a tile.
TILE = 1024
TILE_WORDS = 1 << 19
#: Buckets with more texts are split by a second sketch before.
SPLIT = 4096

_ROLL = np.uint64(0xD6E8FEB86659FD93)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def plain_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of lower-cased texts (A to Z and the Latin-1 letters), ASCII punctuation taken as white space."""
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    if len(data) > 1:
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        data[second] += 32
    mark = ((data > 32) & (data < 48)) | ((data > 57) & (data < 65)) | ((data > 90) & (data < 97)) | ((data > 122) & (data < 128))
    data[mark] = 32
    return Words(data, offsets)


def kmers(word_hash: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of K words of each text (of all words of a shorter one), in text order, and their texts."""
    sizes = np.bincount(text, minlength=n_texts)
    n = len(word_hash)
    roll = word_hash.copy()
    for i in range(1, K):
        roll = roll[: max(0, n - i)] * _ROLL + word_hash[i:]
    if n >= K:
        whole = np.flatnonzero(text[: n - K + 1] == text[K - 1:])
        keys, owner = mix(roll[whole]), text[whole]
    else:
        keys, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    short = np.flatnonzero((sizes > 0) & (sizes < K))
    if len(short):
        extra = []
        for s in short:
            h = np.full(1, sizes[s], np.uint64)
            for i in range(first[s], first[s] + sizes[s]):
                h = mix(h * _ROLL + word_hash[i: i + 1])
            extra.append(h)
        keys, owner = np.concatenate((keys, *extra)), np.append(owner, short)
        order = np.argsort(owner, kind="stable")
        keys, owner = keys[order], owner[order]
    return keys, owner


def occurrences(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How often each key stood before in its text."""
    tagged = mix(keys ^ mix(owner.astype(np.uint64) + np.uint64(7)))
    order = np.argsort(tagged, kind="stable")
    ordered = tagged[order]
    begin = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(ordered)))
    out = np.zeros(len(keys), np.uint64)
    out[order] = (np.arange(len(keys)) - np.repeat(begin, size)).astype(np.uint64)
    return out


def sketches(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have k-mers, their sketches as an array of texts x SKETCHES)."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros((0, SKETCHES), np.uint64)
    begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    size = np.diff(np.append(begin, len(owner)))
    labelled = mix(keys + occurrences(keys, owner) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(begin), SKETCHES), np.uint64)
    group = np.repeat(np.arange(len(begin)), size)
    for j, seed in enumerate(_SEEDS):
        value = mix(labelled ^ seed)
        places = []
        for _ in range(MINIMA):
            least = np.minimum.reduceat(value, begin)
            at = np.flatnonzero(value == least[group])
            at = at[np.append(True, group[at][1:] != group[at][:-1])]  # one place per text
            places.append(at)
            value[at] = _LAST
        order = np.sort(np.stack(places), axis=0)
        code = np.full(len(begin), seed)
        for row in order:
            code = mix(code * _ROLL + keys[row])
        out[:, j] = code
    return owner[begin], out


def _sketch_rows(docs: DataFrame) -> DataFrame:
    """(key, sketch hashes, number of k-mers) of each text with words; docs has (key, text)."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for low, high in slices(offsets):
                part = offsets[low: high + 1] - offsets[low]
                words = plain_words(data[offsets[low]: offsets[high]], part)
                keys, owner = kmers(words.hashes(), words.text, high - low)
                texts, codes = sketches(keys, owner)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * SKETCHES),
                                                 pa.array(codes.reshape(-1).view(np.int64)))
                sizes = np.diff(np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(owner)))[: len(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low).take(pa.array(texts)), lists,
                                                  pa.array(sizes, pa.int64())], names=["key", "sketches", "n"])

    return docs.mapInArrow(over, "key binary, sketches array<bigint>, n bigint")


def _word_rows(docs: DataFrame) -> DataFrame:
    """(key, 32-bit word hashes) of each text; docs has (key, text)."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for low, high in slices(offsets):
                part = offsets[low: high + 1] - offsets[low]
                words = plain_words(data[offsets[low]: offsets[high]], part)
                codes = (words.hashes() >> np.uint64(32)).astype("<u4")
                cut = np.searchsorted(words.text, np.arange(high - low + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low),
                     pa.array([codes[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                    names=["key", "words"])

    return docs.mapInArrow(over, "key binary, words binary")


def _extend(a: np.ndarray, b: np.ndarray, x: int, y: int) -> int:
    """Words in common from a[x] and b[y] on."""
    most = min(len(a) - x, len(b) - y)
    done, block = 0, 16
    while done < most:
        size = min(block, most - done)
        differ = a[x + done: x + done + size] != b[y + done: y + done + size]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, block = done + size, block * 4
    return most


def aligned_runs(a: np.ndarray, b: np.ndarray, most: int) -> list[int] | None:
    """Lengths of the matched runs of a shortest edit script with at most ``most`` insertions and deletions, else None.

    Furthest-reaching points on diagonals (Ukkonen 1985, Myers 1986); only diagonals within the band of ``most`` are entered.
    """
    n, m = len(a), len(b)
    reach: list[dict[int, int]] = []
    front = {0: _extend(a, b, 0, 0)}
    reach.append(front)
    while front.get(n - m, -1) < n:
        d = len(reach)
        if d > most:
            return None
        new = {}
        for k in range(-min(d, m + (d - m) % 2 if d > m else d), min(d, n) + 1, 1):
            if (k + d) % 2 or k > n or -k > m:
                continue
            x = max(front.get(k - 1, -2) + 1, front.get(k + 1, -2))
            if x < 0 or x - k < 0 or x > n or x - k > m:
                continue
            new[k] = x + _extend(a, b, x, x - k)
        front = new
        reach.append(front)
    runs, k = [], n - m
    for d in range(len(reach) - 1, 0, -1):
        before = reach[d - 1]
        down, right = before.get(k + 1, -2), before.get(k - 1, -2) + 1
        runs.append(reach[d][k] - max(down, right))
        k = k - 1 if right >= down else k + 1
    runs.append(reach[0][0])
    return runs


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Share of five-word runs matched in an alignment of two word sequences; 0 where it can't reach the threshold."""
    if len(a) < K or len(b) < K:
        return float(len(a) == len(b) and len(a) > 0 and bool((a == b).all()))
    na, nb = len(a) - K + 1, len(b) - K + 1
    need = threshold * (na + nb) / (1 + threshold)
    if min(na, nb) < need - 1e-9:
        return 0.0
    ka, kb = (kmers(x.astype(np.uint64), np.zeros(len(x), np.int64), 1)[0] for x in (a, b))
    va, ca = np.unique(ka, return_counts=True)
    vb, cb = np.unique(kb, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    if np.minimum(ca[ia], cb[ib]).sum() < need - 1e-9:  # more than any alignment can match
        return 0.0
    runs = aligned_runs(a, b, int(na + nb - 2 * need) + 2 * K)
    if runs is None:
        return 0.0
    matched = sum(max(0, r - K + 1) for r in runs)
    return matched / (na + nb - matched)


def _verify(pairs: DataFrame) -> DataFrame:
    """Links (a, b) among pairs (a, b, wa, wb) by their words."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similarity(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")) >= SIMILARITY
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return pairs.select("a", "b", "wa", "wb").mapInArrow(over, "a binary, b binary")


_CODES = ("c0", "c1")


def _with_codes(sketched: DataFrame) -> DataFrame:
    """The low bytes of the sixteen sketches in two longs; bytes that equal by chance only let a pair more through."""
    def packed(low: int) -> Column:
        out = F.lit(0).cast("bigint")
        for i in range(8):
            out = out.bitwiseOR(F.shiftleft(F.element_at("sketches", low + i + 1).bitwiseAND(F.lit(255).cast("bigint")), 8 * i))
        return out

    return sketched.withColumns({"c0": packed(0), "c1": packed(8)})


def _shared(left: Column, right: Column) -> Column:
    """How many of sixteen sketches are equal, for structs with c0 and c1: the zero bytes of the differences."""
    total = F.lit(16)
    for c in _CODES:
        x = left[c].bitwiseXOR(right[c])
        for step in (4, 2, 1):  # the lowest bit of each byte becomes the union of its bits
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        total = total - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101).cast("bigint")))
    return total


def _pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    """(a, b), a before b, of the structs in two columns (key, n, c0, c1) that share two sketches at least and are long enough for each other."""
    x, y = F.col(left), F.col(right)
    alike = F.least(x["n"], y["n"]) * 5 >= F.greatest(x["n"], y["n"]) * 4  # else no alignment can reach the similarity of 0.8
    return df.where((x["key"] != y["key"]) & alike & (_shared(x, y) >= 2)).select(
        F.least(x["key"], y["key"]).alias("a"), F.greatest(x["key"], y["key"]).alias("b"))


def _members(sketched: DataFrame) -> DataFrame:
    """(bucket, at, size, t: key and codes) of the buckets that several of the texts (key, sketches) are in."""
    rows = _with_codes(sketched).select(F.struct("key", "n", *_CODES).alias("t"), F.posexplode("sketches").alias("at", "bucket"))
    return rows.join(rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "bucket")


def candidates(sketched: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (a, b), a before b, of texts (key, sketches) to verify; ``members`` are their buckets, if at hand."""
    members = stored(_members(sketched), "near-members") if members is None else members
    small = members.where(F.col("size") <= SMALL).groupBy("bucket").agg(F.collect_list("t").alias("ts"))
    first = small.select("ts", F.posexplode("ts").alias("i", "x"))
    listed = _pairs(first.select("x", F.explode(F.slice("ts", F.col("i") + 2, F.size("ts"))).alias("y")), "x", "y")

    large = members.where(F.col("size") > SMALL)
    company = large.groupBy("t.key").agg(F.sum("size").alias("company"))
    known = large.select("bucket", "t", "t.key").join(company, "key")
    centres = known.groupBy("bucket").agg(
        F.max_by("t", F.struct("company", F.xxhash64("key"))).alias("centre"), F.min_by("t", "key").alias("least"))
    starred = large.select("bucket", "t").join(centres, "bucket").select("t", F.explode(F.array("centre", "least")).alias("c"))
    return listed.union(_pairs(starred, "t", "c")).distinct()


def _texts(members: DataFrame, labels: DataFrame, sketched: DataFrame, words: DataFrame) -> DataFrame:
    """A row per text of the large buckets: key, n, sketches, words, its class so far (label), its large buckets (within: bucket and at)
    and the places of their sketches as bits (large)."""
    by_text = members.groupBy("t.key").agg(F.collect_list(F.struct("bucket", "at")).alias("within"),
                                           F.bit_or(F.expr("shiftleft(1, at)")).alias("large"))
    return (by_text.join(labels, "key", "left").join(sketched, "key").join(words, "key")
            .select("key", "n", "sketches", "words", F.coalesce("label", "key").alias("label"), "within", "large"))


def _open(members: DataFrame) -> DataFrame:
    """Members (bucket, at, next, key, n, label) of the buckets that several classes are in, with the bucket's size, whether the text is outside its
    largest class, and in how many blocks the texts outside of it (outer) and all its texts (blocks) are dealt."""
    def dealt(count: Column, size: Column) -> Column:
        return F.greatest(F.ceil(count / TILE), F.ceil(size / TILE_WORDS)).cast("int")

    groups = members.groupBy("bucket", "label").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    buckets = groups.groupBy("bucket").agg(F.max(F.struct("c", "w", "label")).alias("main"), F.sum("c").alias("size"), F.sum("w").alias("w"),
                                           F.count("*").alias("classes")).where("classes > 1")
    return members.join(buckets.select(
        "bucket", "size", F.col("main.label").alias("main"), dealt(F.col("size"), F.col("w")).alias("blocks"),
        dealt(F.col("size") - F.col("main.c"), F.col("w") - F.col("main.w")).alias("outer")), "bucket").select(
        "bucket", "at", "next", "key", "n", "label", "size", (F.col("label") != F.col("main")).alias("outside"), "outer", "blocks")


def _split(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Members of the parts into which each later sketch splits a bucket; a pair to compare shares two sketches, so it is in one of them."""
    return (members.join(texts.select("key", "sketches"), "key")
            .select("bucket", "at", "key", "n", "label", F.posexplode("sketches").alias("next", "code")).where("next > at")
            .select(F.xxhash64("bucket", "next", "code").alias("bucket"), "at", "next", "key", "n", "label"))


def _tiles(opened: DataFrame) -> DataFrame:
    """(bucket, i, j, at, next, key, outside, left): the texts outside a bucket's largest class, block by block (left), meet each block of all its texts."""
    place = F.xxhash64("key", "bucket")
    i, j = (F.pmod(place, F.col(c)).cast("int") for c in ("outer", "blocks"))
    keep = ("bucket", "at", "next", "key", "outside")
    left = opened.where("outside").select(*keep, i.alias("i"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("j"), F.lit(True).alias("left"))
    right = opened.select(*keep, F.explode(F.expr("sequence(0, outer - 1)")).alias("i"), j.alias("j"), F.lit(False).alias("left"))
    return left.unionByName(right)


def shared_kmers(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many k-mers, with repeats, each text on the left has in common with each on the right; texts as word hashes."""
    def labelled(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        keys, owner = kmers(np.concatenate(texts).astype(np.uint64), owner, len(texts))
        return mix(keys + occurrences(keys, owner) * np.uint64(0x9E3779B97F4A7C15)), owner

    (ka, oa), (kb, ob) = labelled(left), labelled(right)
    both = np.intersect1d(ka, kb)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(both):
        return out

    def found(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, keys), len(both) - 1)
        known = both[at] == keys
        return at[known], owner[known]

    (ka, oa), (kb, ob) = found(ka, oa), found(kb, ob)
    for low in range(0, len(both), 4096):  # bounds the matrices, whatever number of k-mers
        width = min(4096, len(both) - low)
        sides = []
        for at, owner, n in ((ka, oa, len(left)), (kb, ob, len(right))):
            here = (at >= low) & (at < low + width)
            side = np.zeros((n, width), np.float32)
            side[owner[here], at[here] - low] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _tile_links(tile: pa.Table) -> pa.Table:
    """Links between the classes of a tile. Of pairs that share two sketches and no small bucket, each is looked at in one tile: that of the
    first sketch they share (and the second, if the bucket was split). Common k-mers are counted for all pairs at once; pairs that have enough
    are aligned while they are in different classes."""
    none = pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
    at, after = tile.column("at")[0].as_py(), tile.column("next")[0].as_py()
    left = tile.column("left").to_numpy(zero_copy_only=False)
    keys = np.array(tile.column("key").to_pylist(), object)
    _, label = np.unique(np.array(tile.column("label").to_pylist(), object), return_inverse=True)
    codes = tile.column("sketches").combine_chunks().flatten().to_numpy().reshape(-1, SKETCHES)
    n, large = tile.column("n").to_numpy(), tile.column("large").to_numpy()
    outside = tile.column("outside").to_numpy(zero_copy_only=False)
    x, y = np.flatnonzero(left), np.flatnonzero(~left)
    order = np.argsort(np.argsort(keys))
    good = (label[x][:, None] != label[y]) & (~outside[y] | (order[x][:, None] < order[y]))  # a pair of texts outside is in both orders
    good &= np.minimum(n[x][:, None], n[y]) * 5 >= np.maximum(n[x][:, None], n[y]) * 4  # else no alignment can reach 0.8
    count, second = np.zeros(good.shape, np.uint8), np.full(good.shape, -1, np.int8)
    for i in range(SKETCHES):
        same = codes[x, i][:, None] == codes[y, i]
        if i < at:
            good &= ~same
        count += same
        second[same & (count == 2)] = i
        good &= ~(same & (large[x] >> i & 1 == 0)[:, None])
    good &= count >= 2
    if after >= 0:
        good &= second == after
    rows, columns = np.flatnonzero(good.any(1)), np.flatnonzero(good.any(0))
    if not len(rows):
        return none
    x, y, good = x[rows], y[columns], good[np.ix_(rows, columns)]
    words = [np.frombuffer(w, "<u4") for w in tile.column("words").to_pylist()]
    common = shared_kmers([words[i] for i in x], [words[i] for i in y])
    size = n[x][:, None] + n[y]
    p, q = np.nonzero(good & (common >= SIMILARITY * size / (1 + SIMILARITY) - 1e-6))
    root = list(range(int(label.max()) + 1))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found = []
    for k in np.argsort(-common[p, q] / size[p, q], kind="stable"):
        i, j = x[p[k]], y[q[k]]
        one, other = top(int(label[i])), top(int(label[j]))
        if one != other and similarity(words[i], words[j]) >= SIMILARITY:
            root[one] = other
            found.append((min(keys[i], keys[j]), max(keys[i], keys[j])))
    return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})


def _between(texts: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of each large bucket, all pairs that share two sketches."""
    members = texts.select("key", "n", "label", F.inline("within")).select("bucket", "at", F.lit(-1).alias("next"), "key", "n", "label")
    opened = stored(_open(members), "near-open")
    tiles = _tiles(opened.where(F.col("size") <= SPLIT))
    wide = opened.where(F.col("size") > SPLIT)
    if not wide.isEmpty():
        parts = stored(_open(_split(wide, texts)), "near-open")
        tiles = tiles.unionByName(_tiles(parts))
    rows = tiles.join(texts.select("key", "n", "label", "large", "sketches", "words"), "key")
    return rows.groupBy("bucket", "i", "j").applyInArrow(_tile_links, "a binary, b binary")


def links(docs: DataFrame, text: str = "text") -> DataFrame:
    """Verified links (a, b) between different texts, by their text_key; their components are the classes."""
    keyed = docs.select(text_key(F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text"))
    sketched = stored(_sketch_rows(keyed).dropDuplicates(["key"]), "near-sketches")
    members = stored(_members(sketched), "near-members")
    pairs = stored(candidates(sketched, members), "near-pairs")
    # Texts with a large bucket may be compared later on; the keys grow with the texts, so the join is shuffled at every size.
    large = members.where(F.col("size") > SMALL)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).union(large.select("t.key"))
    wanted = stored(wanted.distinct(), "near-wanted")
    words = stored(_word_rows(keyed.join(wanted.hint("merge"), "key", "left_semi")).dropDuplicates(["key"]), "near-words")
    joined = (pairs.join(words.select(F.col("key").alias("a"), F.col("words").alias("wa")), "a")
              .join(words.select(F.col("key").alias("b"), F.col("words").alias("wb")), "b"))
    found = stored(_verify(joined), "near-links")
    labels = stored(components(found), "near-labels")
    texts = stored(_texts(large, labels, sketched.select("key", "n", "sketches"), words), "near-texts")
    return stored(found.union(_between(texts)).distinct(), "near-links")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (the least id of its class) and n_links (links of its text
    that were found while the class was built)."""
    found = links(docs, text)
    labels = stored(components(found), "near-labels")
    degree = (found.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n_links")))
    labels = labels.join(degree, "key")
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("key"))
    placed = (keyed.join(labels, "key", "left")
              .select("doc_id", F.coalesce("label", "key").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    placed = stored(placed, "near-classes")
    least = placed.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return placed.join(least, "class").select("doc_id", "class_id", "class_size", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each class, the one with the least id (then the least text digest), with the columns of docs."""
    labels = stored(components(links(docs, text)), "near-labels")
    digest = F.concat_ws("|", F.hex(text_key(F.col(f"`{text}`"))), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")))
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(F.col(f"`{text}`")).alias("key"), F.md5(digest).alias("row"))
    best = (keyed.join(labels, "key", "left").groupBy(F.coalesce("label", "key").alias("class"))
            .agg(F.min_by("row", F.struct("id", "key")).alias("row")))
    best = stored(best.select("row"), "near-kept")
    # The texts are dealt out once, by row; rows that repeat id and text meet there. Shuffled at every size, as both sides grow.
    row = fresh("row", docs.columns)
    chosen = docs.withColumn(row, F.md5(digest)).join(best.withColumnRenamed("row", row).hint("merge"), row, "left_semi")
    return chosen.dropDuplicates([row]).select(*[F.col(f"`{c}`") for c in docs.columns])
