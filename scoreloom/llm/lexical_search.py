"""Ranked lexical search of many queries at once, with common subexpressions worked out once.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII; A to Z are lower-cased. N counts the
documents with a term, L all their terms, n a document's terms, df the documents that hold a term, tf its occurrences in a document.
A term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))) and gives a document w * ((10^9 tf) div (1000 tf + 8 m)), with
m = 25 + ((75 n N) div L). A document's score for an item is the sum over the item's terms, repeats included.

Items are worked on in blocks of bounded size, each against all documents. A block's items are sums of terms that share parts:
``share_terms`` mines pairs that stand in at least two items and puts a node in their place, again and again, so that sets of
terms shared by many items become nodes of a DAG. A task reads documents in small groups; per group each term's and each node's
partial score of every document is worked out once, and an item adds up the few nodes that are left of it.

One pass over the texts counts each document's query terms (whole texts, in slices of bounded bytes) into a narrow stored table; df is
counted from that table, and the second pass over it keeps the best documents of each item per task, so between tasks go tasks x items
x k rows at most, whatever the documents. Terms are told apart by 64-bit hashes (a mix-up of a million million words with
ten thousand query terms has a chance of about 5 in 10^4).

A null text or one without terms is no document; items without terms have no rows. Equal scores go by the lesser document
id (null last); documents that repeat an id are documents of their own. Each different (item id, text) is ranked on its own,
repeated ones once. Only scores above 0 are returned. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from scoreloom.llm.common import Words, hash_spans, slices, stored, text_bytes, text_key

TOP = 10
#: Bytes of item texts in a block; a longer item is a block of its own.
BLOCK_BYTES = 1 << 18
#: Values of the partial scores held at once.
HELD = 1 << 22

Node = tuple[int, int]


def terms(data: np.ndarray, offsets: np.ndarray) -> Words:
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    data[~((data >= 128) | ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)))] = 32
    return Words(data, offsets)


def item_terms(texts: list[str]) -> list[Counter]:
    """The terms of each text by their hashes, with their counts."""
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    words = terms(data, offsets)
    hashes, cut = words.hashes(), np.searchsorted(words.text, np.arange(len(texts) + 1))
    return [Counter(hashes[a:b].tolist()) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def share_terms(items: list[dict[int, int]]) -> tuple[list[Node], list[dict[int, int]]]:
    """A DAG for sums of terms: ``items`` hold term numbers with their counts, terms numbered from 0 on.

    Gives the nodes, each the sum of two earlier parts, and per item the parts that are left with their factors. Nodes are
    numbered behind the terms. In each round pairs of parts that stand with one factor in two items or more are counted, and the
    most frequent ones take the place of their parts; rounds end when no pair is shared. Of an item with very many shared
    parts the 64 most common are paired; that bears on how much is shared, not on the sums.
    """
    next_part = 1 + max((t for item in items for t in item), default=-1)
    left, nodes = [dict(item) for item in items], []
    while True:
        pairs: Counter = Counter()
        common = Counter(p for item in left for p in item)
        for item in left:
            parts = sorted((p for p in item if common[p] > 1), key=lambda p: (-common[p], p))[:64]
            pairs.update((min(a, b), max(a, b)) for i, a in enumerate(parts) for b in parts[i + 1:] if item[a] == item[b])
        shared = sorted((p for p in pairs.items() if p[1] > 1), key=lambda p: (-p[1], p[0]))
        if not shared:
            return nodes, left
        where: dict[int, set[int]] = {}
        for i, item in enumerate(left):
            for p in item:
                where.setdefault(p, set()).add(i)
        done = False
        used: set[int] = set()
        for (a, b), _ in shared:
            if a in used or b in used:
                continue
            both = [i for i in where[a] & where[b] if left[i][a] == left[i][b]]
            if len(both) < 2:
                continue
            used.update((a, b))
            for i in both:
                left[i][next_part] = left[i].pop(a)
                del left[i][b]
            nodes.append((a, b))
            next_part, done = next_part + 1, True
        if not done:
            return nodes, left


def node_levels(nodes: list[Node], n_terms: int) -> list[np.ndarray]:
    """Nodes (number, one part, other part) in groups whose parts are all terms or nodes of groups before."""
    level: dict[int, int] = {}
    groups: list[list[tuple[int, int, int]]] = []
    for k, (a, b) in enumerate(nodes):
        at = max(level.get(a, -1), level.get(b, -1)) + 1
        level[n_terms + k] = at
        if at == len(groups):
            groups.append([])
        groups[at].append((n_terms + k, a, b))
    return [np.array(g, np.int64) for g in groups]


def _count_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, times) of every document with a term; only terms of the sorted ``vocabulary`` are listed."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for low, high in slices(offsets):
                part = offsets[low: high + 1] - offsets[low]
                words = terms(data[offsets[low]: offsets[high]], part)
                sizes = np.bincount(words.text, minlength=high - low)
                hashes = hash_spans(words.data, words.start, words.end, words.window)
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                hit = np.flatnonzero(vocabulary[at] == hashes)
                code, times = np.unique(words.text[hit] * len(vocabulary) + at[hit], return_counts=True)
                live = np.flatnonzero(sizes)
                cut = np.searchsorted(code, np.append(live, high - low) * len(vocabulary)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low).take(pa.array(live)), pa.array(sizes[live]),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array((code % len(vocabulary)).astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(times.astype(np.int32)))],
                    names=["doc_id", "n", "terms", "times"])

    return docs.mapInArrow(over, T.StructType([
        T.StructField("doc_id", docs.schema[0].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.IntegerType()))]))


def term_scores(n: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray, weights: np.ndarray,
                total: int, length: int) -> np.ndarray:
    """Score of each (document, term) in 64-bit integers; n holds all documents' sizes, the rest one value per pair."""
    m = 25 + 75 * n * total // length
    return weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))


def _best(counts: DataFrame, weights: np.ndarray, levels: list[np.ndarray], parts: list[dict[int, int]], total: int, length: int,
          top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each item within each task, ids in the order of the result."""
    n_terms = len(weights)
    size = n_terms + sum(map(len, levels))
    live = [i for i, p in enumerate(parts) if p]
    at = np.array([p for i in live for p in parts[i]], np.int64)
    factor = np.array([f for i in live for f in parts[i].values()], np.int64)
    begin = np.cumsum([0] + [len(parts[i]) for i in live])[:-1]
    group = max(1, HELD // max(1, size + len(at)))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per item the best scores so far and where their ids stand in ``pool``.
        best, spot, pool = np.zeros((len(live), top), np.int64), np.zeros((len(live), top), np.int64), None
        for batch in batches:
            n, lists = batch.column(1).to_numpy(), batch.column(2).offsets.to_numpy()
            term, times = batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy().astype(np.int64)
            for low in range(0, len(n), group):
                high = min(len(n), low + group)
                span = slice(lists[low], lists[high])
                doc = np.repeat(np.arange(high - low), np.diff(lists[low: high + 1]))
                partial = np.zeros((size, high - low), np.int64)
                partial[term[span], doc] = term_scores(n[low:high], doc, term[span], times[span], weights, total, length)
                for level in levels:
                    partial[level[:, 0]] = partial[level[:, 1]] + partial[level[:, 2]]
                score = np.add.reduceat(partial[at] * factor[:, None], begin, axis=0)
                better = np.flatnonzero(score.max(axis=1) >= np.maximum(best[:, -1], 1))
                if not len(better):
                    continue
                own = batch.column(0).slice(low, high - low)
                pool = own if pool is None else pa.concat_arrays([pool, own])
                rank = pc.rank(pool, "ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64)
                here = np.arange(len(pool) - len(own), len(pool))
                here = here[np.argsort(rank[here], kind="stable")]
                # The group's best by (score, id), then those among the best before.
                score = score[better][:, here - (len(pool) - len(own))]
                first = np.argsort(-score, axis=1, kind="stable")[:, :top]
                both = np.concatenate((best[better], np.take_along_axis(score, first, axis=1)), axis=1)
                where = np.concatenate((spot[better], here[first]), axis=1)
                order = np.lexsort((rank[where], -both), axis=1)[:, :top]
                best[better], spot[better] = np.take_along_axis(both, order, axis=1), np.take_along_axis(where, order, axis=1)
                used, inverse = np.unique(spot, return_inverse=True)
                spot, pool = inverse.reshape(spot.shape), pool.take(pa.array(used))
        if pool is not None:
            item, column = np.nonzero(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(live, np.int32)[item]), pool.take(pa.array(spot[item, column])), pa.array(best[item, column])],
                names=["item", "doc_id", "score"])

    return counts.mapInArrow(over, T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("doc_id", counts.schema["doc_id"].dataType),
        T.StructField("score", T.LongType())]))


def _ranked_block(docs: DataFrame, ids: DataFrame, texts: list[str], top: int) -> DataFrame | None:
    """The ranks of one block of items, numbered as in ``ids`` (item, item_id)."""
    spark = docs.sparkSession
    found = item_terms(texts)
    vocabulary = np.array(sorted({t for item in found for t in item}), np.uint64)
    if not len(vocabulary):
        return None
    number = {t: i for i, t in enumerate(vocabulary.tolist())}
    counts = stored(_count_terms(docs, vocabulary), "search-counts")
    total, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not total:
        return None
    df = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(total) + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = np.zeros(len(vocabulary), np.int64)
    for term, w in df.select("term", weight).collect():  # one row per term of the block
        weights[term] = w
    nodes, parts = share_terms([{number[t]: c for t, c in item.items()} for item in found])
    best = _best(counts.select("doc_id", "n", "terms", "times"), weights, node_levels(nodes, len(vocabulary)), parts, total, length, top)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return stored(ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score"), "search-ranked")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
           item_text: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the best documents for each item."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")).where("text is not null")
    asked = stored(asked.withColumn("digest", text_key(F.col("text"))).dropDuplicates(["item_id", "digest"]), "search-items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("digest"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    asked = asked.withColumn("block", block)
    out = None
    for b in range(blocks):
        rows = asked.where(F.col("block") == b).orderBy("item_id", "digest").select("item_id", "text").collect()  # a bounded block
        schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema[item_col].dataType)])
        ids = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], schema)
        ranked = _ranked_block(docs, ids, [r[1] for r in rows], top)
        out = ranked if out is None else (out if ranked is None else out.unionByName(ranked))
    if out is None:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).where("false")
    return out
