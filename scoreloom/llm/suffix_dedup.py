"""Removal of repeated byte strings with suffix arrays and longest-previous-factor arrays.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts anywhere else, in the same text or another. Strings
never cross texts, and all copies count, judged on the input.

A suffix array of all texts can't be held by one task, so starts are first dealt out by content. Every string has an anchor,
its 64-byte run of least hash (ties go to the first), so equal strings have equal anchors at equal places. Neighbouring
starts of one text that share an anchor are a block: the bytes of all their strings together. Equal blocks are counted by
digest: all starts of a block that stands twice are copies. Blocks whose anchor stands in other blocks are compared: blocks of
an anchor meet in one task, which sorts the suffixes of their bytes to a depth of ``LENGTH`` by prefix doubling. In suffix order
the nearest smaller positions before and after an entry give its longest previous factor, and the nearest larger ones its
longest next factor; a start with a factor of ``LENGTH`` bytes or more is a copy. An anchor with more than ``HOT_BLOCKS``
different blocks is not gathered: its strings are dealt out by digest and counted.

Null texts are empty. Texts shorter than LENGTH lose nothing. Equal texts are worked on once, and lose everything if they
have LENGTH bytes, as each is a copy of the other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import eight, mix, slices, stored, text_bytes, text_key

LENGTH = 400
ANCHOR = 64
#: Blocks of one anchor that are gathered, about what SORT_BYTES hold; the strings of more are dealt out by digest.
HOT_BLOCKS = 4_000
#: Bytes whose suffixes are sorted together; whole groups of an anchor are put together up to this size.
SORT_BYTES = 2 << 20

_STEP = np.uint64(0xD6E8FEB86659FD93)


def blocks(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(first start, number of starts, anchor's hash, text) of each block of the texts in ``data``."""
    n = len(data)
    sizes = np.diff(offsets)
    if not n or sizes.max() < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), empty
    hashes = mix(eight(data)[:n] + np.uint64(1))
    at = 8
    while at < ANCHOR:  # doubling: eight bytes to sixteen to ... to the anchor's size
        hashes[: n - at] = hashes[: n - at] * _STEP + hashes[at:]
        at *= 2
    hashes = mix(hashes)
    place_bits = np.uint64(max(1, n.bit_length()))
    mask = (np.uint64(1) << place_bits) - np.uint64(1)
    width = length - ANCHOR + 1
    packed = np.full(-(-(n + width) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    packed[:n] = (hashes & ~mask) | np.arange(n, dtype=np.uint64)
    square = packed.reshape(-1, width)
    forward = np.minimum.accumulate(square, axis=1).reshape(-1)
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    inside = np.zeros(n + 1, np.int64)
    long = np.flatnonzero(sizes >= length)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long + 1] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[:n] > 0)
    anchor = (np.minimum(backward[starts], forward[starts + width - 1]) & mask).astype(np.int64)
    text = np.searchsorted(offsets, starts, "right") - 1
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    return starts[new], np.diff(np.append(new, len(starts))), hashes[anchor[new]], text[new]


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each entry the index of the nearest smaller value before it, or -1."""
    out = np.arange(len(values), dtype=np.int64) - 1
    open_ = np.flatnonzero(out >= 0)
    while len(open_):
        open_ = open_[(out[open_] >= 0)]
        open_ = open_[values[out[open_]] > values[open_]]
        out[open_] = out[out[open_]]
    return out


def suffix_classes(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Rank of each suffix by its first ``length`` bytes (zeros behind the end); equal strings have equal ranks."""
    rank = np.unique(eight(data)[: len(data)].byteswap(), return_inverse=True)[1].astype(np.uint64)
    depth = 8
    while depth < length:
        shift = min(depth, length - depth)
        behind = np.zeros(len(data), np.uint64)
        behind[: max(0, len(data) - shift)] = rank[shift:] + np.uint64(1)
        rank = np.unique((rank << np.uint64(32)) | behind, return_inverse=True)[1].astype(np.uint64)
        depth += shift
    return rank


def factors(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For each of the ``starts``: does a string of ``length`` bytes from it stand earlier, does one stand later.

    Only starts count as places; strings from them must lie within what they belong to.
    """
    rank = suffix_classes(data, length)[starts]
    order = np.argsort(rank, kind="stable")
    place, ordered = starts[order], rank[order]

    def reached(values: np.ndarray) -> np.ndarray:
        before = nearest_smaller(values)
        after = len(values) - 1 - nearest_smaller(values[::-1])[::-1]
        hit = (before >= 0) & (ordered[np.maximum(before, 0)] == ordered)
        return hit | ((after < len(values)) & (ordered[np.minimum(after, len(values) - 1)] == ordered))

    earlier, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    earlier[order], later[order] = reached(place), reached(-place)
    return earlier, later


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """[low, high) of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


_RANGE = "array<struct<low:int,high:int>>"
_RANGE_ARROW = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))


def _block_rows(keyed: DataFrame, length: int) -> DataFrame:
    """(key, anchor, block, n, starts): the different blocks of each text and where they start."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for low, high in slices(offsets):
                part = data[offsets[low]: offsets[high]]
                first, count, anchor, text = blocks(part, offsets[low: high + 1] - offsets[low], length)
                view, found = memoryview(np.ascontiguousarray(part)), {}
                begin = (first - (offsets[low + text] - offsets[low])).tolist()
                for i, (a, n, t) in enumerate(zip(first.tolist(), count.tolist(), text.tolist(), strict=True)):
                    found.setdefault((t, xxhash.xxh3_128_digest(view[a: a + n - 1 + length])), []).append(i)
                if not found:
                    continue
                heads = np.asarray([places[0] for places in found.values()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text[heads] + low)), pa.array(anchor[heads].view(np.int64)),
                     pa.array([b for _, b in found], pa.binary()), pa.array(count[heads].astype(np.int32)),
                     pa.array([[begin[i] for i in places] for places in found.values()], pa.list_(pa.int32()))],
                    names=["key", "anchor", "block", "n", "starts"])

    return keyed.mapInArrow(over, "key binary, anchor bigint, block binary, n int, starts array<int>")


def _compare(contents: DataFrame, length: int) -> DataFrame:
    """(block, ranges of its starts that are copies) for blocks (anchor, block, n, bytes); an anchor's rows are together."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        ends = np.cumsum([len(r[3]) for r in rows])
        begins = ends - [len(r[3]) for r in rows]
        counts = np.asarray([r[2] for r in rows])
        starts = np.concatenate([np.arange(b, b + n) for b, n in zip(begins, counts, strict=True)])
        earlier, later = factors(data, starts, length)
        flags = np.split(earlier | later, np.cumsum(counts)[:-1])
        ranges = [[{"low": a, "high": b} for a, b in _ranges(f)] for f in flags]
        return pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.binary()), pa.array(ranges, _RANGE_ARROW)],
                                          names=["block", "ranges"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > SORT_BYTES and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solve(rows)

    return (contents.select("anchor", "block", "n", "bytes").repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(over, f"block binary, ranges {_RANGE}"))


def _count_hot(contents: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many blocks: their strings are dealt out by digest to as many parts as the blocks need,
    in packed arrays, and counted there."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("anchor", "block", "n", "blocks", "bytes")), strict=True))
            for anchor in sorted({r[0] for r in rows}):
                mine = [r for r in rows if r[0] == anchor]
                parts = -(-mine[0][3] // HOT_BLOCKS) if HOT_BLOCKS else 3
                digest = b"".join(xxhash.xxh3_128_digest(memoryview(r[4])[i: i + length]) for r in mine for i in range(r[2]))
                digest = np.frombuffer(digest, "<u8").reshape(-1, 2)
                origin = np.repeat(np.arange(len(mine), dtype=np.int32), [r[2] for r in mine])
                at = np.concatenate([np.arange(r[2], dtype=np.int32) for r in mine])
                part = digest[:, 0] % np.uint64(parts)
                for p in np.unique(part):
                    own = np.flatnonzero(part == p)
                    used, origin_here = np.unique(origin[own], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([anchor]), pa.array([int(p)], pa.int32()), pa.array([digest[own].tobytes()], pa.binary()),
                         pa.array([[mine[k][1] for k in used]], pa.list_(pa.binary())),
                         pa.array([origin_here.astype("<i4").tobytes()], pa.binary()), pa.array([at[own].tobytes()], pa.binary())],
                        names=["anchor", "part", "digests", "blocks", "origins", "ats"])

    def solve(rows: list[dict]) -> pa.RecordBatch:
        digest = np.frombuffer(b"".join(r["digests"] for r in rows), "V16")
        _, place, count = np.unique(digest, return_inverse=True, return_counts=True)
        copied, low = count[place] > 1, 0
        blocks_, ranges = [], []
        for r in rows:
            origin, at = np.frombuffer(r["origins"], "<i4"), np.frombuffer(r["ats"], "<i4")
            flag = copied[low: low + len(origin)]
            low += len(origin)
            cuts = np.searchsorted(origin, np.arange(len(r["blocks"]) + 1))
            for block, a, b in zip(r["blocks"], cuts[:-1], cuts[1:], strict=True):
                hit = at[a:b][flag[a:b]]
                if len(hit):
                    full = np.zeros(hit[-1] + 1, bool)
                    full[hit] = True
                    blocks_.append(block)
                    ranges.append([{"low": x, "high": y} for x, y in _ranges(full)])
        return pa.RecordBatch.from_arrays([pa.array(blocks_, pa.binary()), pa.array(ranges, _RANGE_ARROW)], names=["block", "ranges"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict] = []
        for row in (r for b in batches for r in b.to_pylist()):
            if kept and (kept[0]["anchor"], kept[0]["part"]) != (row["anchor"], row["part"]):
                yield solve(kept)
                kept = []
            kept.append(row)
        if kept:
            yield solve(kept)

    dealt = contents.mapInArrow(deal, "anchor bigint, part int, digests binary, blocks array<binary>, origins binary, ats binary")
    return (dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
            .mapInArrow(count, f"block binary, ranges {_RANGE}"))


def repeated(docs: DataFrame, text: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(texts, copies): texts is (key, text) with each different text once; copies is (key, starts and ranges) for texts with
    copied strings: a string from ``start + x`` is a copy for x in [low, high)."""
    keyed = docs.select(text_key(F.col(f"`{text}`")).alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = stored(_block_rows(keyed, length), "suffix-blocks")
    kinds = found.groupBy("anchor", "block").agg(
        F.sum(F.size("starts").cast("long")).alias("times"), F.first("n").alias("n"),
        F.min(F.struct("key", F.element_at("starts", 1).alias("start"))).alias("at"))
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("blocks"), F.max((F.col("times") == 1).cast("int")).alias("open"))
    kinds = stored(kinds.join(anchors, "anchor").where("times > 1 or blocks > 1"), "suffix-kinds")
    texts = keyed.groupBy("key").agg(F.first("text").alias("text"))

    # The bytes of one copy of each block that must be compared. The join is shuffled at every size, as both sides grow.
    wanted = (kinds.where("blocks > 1 and open = 1").groupBy(F.col("at.key").alias("key"))
              .agg(F.collect_list(F.struct("anchor", "block", "n", "blocks", F.col("at.start").alias("start"))).alias("parts")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = value.encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["anchor"] for p in parts]), pa.array([p["block"] for p in parts], pa.binary()),
                     pa.array([p["n"] for p in parts], pa.int32()), pa.array([p["blocks"] for p in parts], pa.int64()),
                     pa.array([data[p["start"]: p["start"] + p["n"] - 1 + length] for p in parts], pa.binary())],
                    names=["anchor", "block", "n", "blocks", "bytes"])

    contents = stored(texts.join(wanted.hint("merge"), "key").select("text", "parts").mapInArrow(
        cut, "anchor bigint, block binary, n int, blocks bigint, bytes binary"), "suffix-contents")
    compared = _compare(contents.where(F.col("blocks") <= HOT_BLOCKS), length)
    counted = _count_hot(contents.where(F.col("blocks") > HOT_BLOCKS), length)
    partial = compared.union(counted).where(F.size("ranges") > 0)
    once = kinds.where("times = 1").select("block")
    whole = kinds.where("times > 1").select("block", F.array(F.struct(F.lit(0).alias("low"), F.col("n").alias("high"))).alias("ranges"))
    flags = stored(whole.union(partial.join(once, "block", "left_semi")), "suffix-flags")
    copies = (found.select("key", "block", "starts").join(flags, "block")
              # Rows of equal texts have the same blocks; a set drops the repeats before the shuffle.
              .groupBy("key").agg(F.collect_set(F.struct("starts", "ranges")).alias("copies")))
    return texts, copies


def spans_of(size: int, copies: list[dict] | None, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal spans of covered bytes of a text."""
    step = np.zeros(size + 1, np.int64)
    for part in copies or ():
        for start in part["starts"]:
            for r in part["ranges"]:
                step[start + r["low"]] += 1
                step[start + r["high"] - 1 + length] -= 1
    return _ranges(np.cumsum(step)[:size] > 0)


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and the sha256 of the bytes that stay."""
    texts, copies = repeated(docs, text, length)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = value.encode()
                spans = spans_of(len(data), parts, length)
                sha, at = hashlib.sha256(), 0
                for low, high in [*spans, (len(data), len(data))]:
                    sha.update(data[at:low])
                    at = high
                out.append((len(data), sum(b - a for a, b in spans), len(spans), sha.hexdigest()))
            columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)] + [pa.array([r[3] for r in out], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                             names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = texts.join(copies.hint("merge"), "key", "left").select("key", "text", "copies").mapInArrow(
        over, "key binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_key(F.col(f"`{text}`")).alias("key"))
    return ids.join(done, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
