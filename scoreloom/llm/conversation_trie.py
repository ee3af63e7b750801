"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of (role, text) turns; a trie node at depth d is a distinct sequence of d first turns, its members are
the conversations that start with it. Conversations are first rebuilt as the query asks (``rebuilt``), or taken as they are (``as_given``).

Turns are numbered by ordered sums over range partitions, so a very long conversation is spread. ``BLOCK`` turns in a row are a block
with one digest. A prefix of whole blocks is known by sums of hashes of (block number, block digest), which the same ordered sums give
for every block at once, however many there are. Conversations are grouped by (prefix, next block): one row per distinct block behind a
prefix, combined before the shuffle. Where a prefix goes on with one block only, the turn boundaries inside it have the
members of the block; only where siblings diverge are they refined, from the distinct blocks and not from conversations.

Sums over subtrees need no walk of the trie: a node belongs to its least member, and a conversation owns the nodes
of its path from some depth on. With ``start`` the words before the first node that a conversation owns, the saved words of a node are the
sum of (start - words above the node) over its other members, and its leaves are its members that own a leaf. Both are sums over members.
The ids of conversations that end at a node are put into sorted text pieces per range partition, and one task chains a node's pieces
through SHA-256, which can't be split; it reads the pieces as a stream.

Turns are ordered by turn number (null first); turns of equal number by a digest of role and text, so repeated rows are turns
of their own and reruns agree. Null role or text is empty. Rows without conversation id belong to no conversation and are left out. An
empty table gives an empty result. Texts of any length count whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import stored, word_count
from scoreloom.operators.scan import ordered_sums

BLOCK = 4
#: Ids in one piece of text.
PIECE = 1 << 14
#: Parts of a prefix digest; each is a sum of 28-bit hashes, so it holds for 2^35 blocks.
PARTS = 4

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _digest(*parts: Column) -> Column:
    """128 bits of columns that are joined with separators no hexadecimal text or number holds."""
    return F.unhex(F.md5(F.concat_ws("|", *parts).cast("binary")))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), turn_digest and words of each turn in order, without texts."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    narrow = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn_digest"),
        word_count(text).alias("words"), F.lit(1).cast("long").alias("one"))
    spark = conversations.sparkSession
    return ordered_sums(spark, narrow, ["conv_id"], ["turn", "turn_digest"], ["one"]).select(
        "conv_id", F.col("before_one").alias("pos"), "turn_digest", "words")


def as_given(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with their number of turns, their turns), for conversations taken as they are."""
    return numbered.groupBy("conv_id").agg(F.count("*").alias("n")), numbered


def rebuilt(numbered: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conversations with their number of turns, their turns): the first h turns of conversation c - c % every, then c's own turns
    after its first h, with h = crc32(decimal c) % heads."""
    c = F.col("conv_id")
    head = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(heads)).cast("long")
    sizes = numbered.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("head", head).withColumn("donor", c - c % every)
    sizes = stored(sizes, "trie-sizes")
    donors = sizes.where(F.col("donor") == c).select("donor", F.col("own").alias("given"))
    sizes = sizes.join(donors, "donor", "left").withColumn("shift", F.least("head", F.coalesce("given", F.lit(0)))).select(
        "conv_id", "donor", "head", "shift", (F.col("shift") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("n"))
    sizes = stored(sizes, "trie-conversations")
    # A conversation gives its first turns, fewer than ``heads``, to fewer than ``every`` others.
    lent = numbered.where((F.col("pos") < heads - 1) & (c % every == 0)).withColumnRenamed("conv_id", "donor")
    borrowed = sizes.where("shift > 0").select("conv_id", "donor", "shift").join(lent, "donor").where("pos < shift")
    kept = numbered.where(F.col("pos") >= head).join(sizes.select("conv_id", "shift"), "conv_id")
    own = kept.select("conv_id", (F.col("pos") - head + F.col("shift")).alias("pos"), "turn_digest", "words")
    return sizes.select("conv_id", "n"), own.unionByName(borrowed.select(*own.columns))


def _blocks(sizes: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """One row per conversation and block: conv_id, k, digests and words of its turns, prefix and next (digests of the turns
    before it and up to its end), above (words before it), last (it is the conversation's last)."""
    spark = rows.sparkSession
    grouped = rows.groupBy("conv_id", F.floor(F.col("pos") / length).alias("k")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_digest", "words"))).alias("t"))  # ``length`` turns at most
    grouped = grouped.select("conv_id", "k", F.col("t.turn_digest").alias("digests"), F.col("t.words").alias("words"))
    block = F.md5(F.concat_ws("|", F.col("k").cast("string"), F.concat_ws("|", "digests")).cast("binary"))
    parts = {f"s{i}": F.conv(F.substring(block, 8 * i + 1, 7), 16, 10).cast("long") for i in range(PARTS)}  # 28 bits each
    total = F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + x).alias("block_words")
    summed = ordered_sums(spark, grouped.select("*", total, *[v.alias(k) for k, v in parts.items()]), ["conv_id"], ["k"],
                          ["block_words", *parts])
    before = [F.col(f"before_{s}") for s in parts]
    after = [F.col(f"before_{s}") + F.col(s) for s in parts]
    placed = summed.join(sizes, "conv_id").select(
        "conv_id", "k", "digests", "words", F.col("before_block_words").alias("above"),
        _digest(F.col("k").cast("string"), *[b.cast("string") for b in before]).alias("prefix"),
        _digest((F.col("k") + 1).cast("string"), *[a.cast("string") for a in after]).alias("next"),
        ((F.col("k") + 1) * length >= F.col("n")).alias("last"))
    return stored(placed, "trie-blocks")


def _boundaries(blocks: DataFrame, length: int) -> DataFrame:
    """Distinct blocks (prefix, digests, ...) with a row for each of their turns: node, parent, j (1 up to the block's length)."""
    def node(j: Column) -> Column:
        inside = _digest(F.hex("prefix"), j.cast("string"), F.concat_ws("|", F.slice("digests", 1, j)))
        return F.when(j == length, F.col("next")).otherwise(F.when(j == 0, F.col("prefix")).otherwise(inside))

    j = F.col("j")
    return (blocks.withColumn("j", F.explode(F.sequence(F.lit(1), F.size("digests"))))
            .withColumns({"node": node(j), "parent": node(j - 1),
                          "upto": F.col("above") + F.aggregate(F.slice("words", 1, j - 1), F.lit(0).cast("long"), lambda a, x: a + x)}))


def _merged(blocks: DataFrame, length: int, sums: dict[str, Column]) -> DataFrame:
    """Turn nodes of distinct blocks: as they are where a prefix has one block behind it, grouped where siblings diverge."""
    rows = _boundaries(blocks, length)
    depth = (F.col("k") * length + F.col("j")).alias("depth")
    alone = rows.where("siblings = 1").select("node", "parent", depth, "upto", *sums)
    shared = rows.where("siblings > 1").groupBy("node").agg(
        F.first("parent").alias("parent"), F.first(depth).alias("depth"), F.first("upto").alias("upto"),
        *[v.alias(k) for k, v in sums.items()])
    return alone.unionByName(shared)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) for (node, conv_id): SHA-256 of the ids in ascending order, joined by commas."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "low": pa.array([ids[0]], pa.int64()),
                                               "ids": [",".join(map(str, ids))]})

        for batch in batches:
            for n, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (n != node or len(ids) == PIECE):
                    yield row()
                    ids = []
                node = n
                ids.append(i)
        if ids:
            yield row()

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for n, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if n != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
                                             names=["node", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "ends_sha256": [state.hexdigest()]})

    texts = (ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
             .mapInArrow(pieces, "node binary, low bigint, ids string"))
    return texts.repartition("node").sortWithinPartitions("node", "low").mapInArrow(chained, "node binary, ends_sha256 string")


def trie(sizes: DataFrame, rows: DataFrame, length: int = BLOCK) -> DataFrame:
    """The nodes of the trie of conversations ``sizes`` (conv_id, n) with turns ``rows`` (conv_id, pos, turn_digest, words)."""
    blocks = _blocks(sizes, rows, length)
    group = ["prefix", "digests"]
    distinct = blocks.groupBy(*group).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("owner"),
        *[F.first(c).alias(c) for c in ("k", "words", "above", "next")])
    siblings = distinct.groupBy("prefix").agg(F.count("*").alias("siblings"))
    distinct = stored(distinct.join(siblings, "prefix"), "trie-distinct")

    # Who owns what: a distinct block's least member owns its turns from the first one where it is the node's least member.
    nodes = stored(_merged(distinct, length, {"n": F.sum("n"), "owner": F.min("owner")}), "trie-nodes")
    edges = _boundaries(distinct.select(*group, "k", "words", "above", "next", F.col("owner").alias("mine")), length)
    owned = (edges.join(nodes.select("node", "owner"), "node").where("owner = mine")
             .groupBy(F.col("mine").alias("conv_id")).agg(F.min("upto").alias("start")))
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    leaves = nodes.join(children, "node", "left_anti").select(F.col("owner").alias("conv_id"), F.lit(1).cast("long").alias("leaf"))
    total = blocks.where("last").select("conv_id", (F.col("above") + F.aggregate(
        "words", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total"))
    people = stored(total.join(owned, "conv_id", "left").join(leaves, "conv_id", "left").select(
        "conv_id", F.coalesce("start", "total").alias("start"), F.coalesce("leaf", F.lit(0)).alias("leaf")), "trie-members")

    again = blocks.select("conv_id", *group, "k", "words", "above", "next").join(people, "conv_id")
    sums = again.groupBy(*group).agg(
        F.sum("start").alias("starts"), F.sum("leaf").alias("leaves"), F.min(F.struct("conv_id", "start")).alias("least"),
        *[F.first(c).alias(c) for c in ("k", "words", "above", "next")])
    sums = sums.join(siblings, "prefix")
    sums = _merged(sums, length, {"starts": F.sum("starts"), "leaves": F.sum("leaves"), "least": F.min("least")})

    last = blocks.where("last").select("conv_id", *group, "next")
    j = F.size("digests")
    inside = _digest(F.hex("prefix"), j.cast("string"), F.concat_ws("|", "digests"))
    ends = _end_hashes(last.select(F.when(j == length, F.col("next")).otherwise(inside).alias("node"), "conv_id"))

    # The root: all conversations, those without turns too.
    zero = _digest(F.lit("0"), *[F.lit("0")] * PARTS)
    whole = sizes.join(people, "conv_id", "left").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                                                      F.sum(F.coalesce("start", F.lit(0))).alias("saved_tokens"),
                                                      F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves")).where("n_convs > 0")
    rootless = _end_hashes(sizes.where("n = 0").select(zero.alias("node"), "conv_id"))
    root = whole.withColumn("node", zero).join(children, "node", "left").join(rootless, "node", "left")
    empty_sha = F.lit(EMPTY_SHA)
    root = root.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast(sizes.schema["conv_id"].dataType).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        "saved_tokens", F.coalesce("ends_sha256", empty_sha).alias("ends_sha256"))

    above = nodes.select(F.col("node").alias("parent"), F.col("owner").alias("above_owner"))
    least = sizes.agg(F.min("conv_id")).first()[0]
    full = (nodes.join(sums.select("node", "starts", "leaves", "least"), "node").join(children, "node", "left")
            .join(ends, "node", "left").join(above, "parent", "left"))
    saved = F.col("starts") - F.col("least.start") - (F.col("n") - 1) * F.col("upto")
    full = full.select(
        F.col("owner").alias("conv_id"), "depth",
        F.when(F.col("depth") > 1, F.col("above_owner")).otherwise(F.lit(least)).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"), F.coalesce("ends_sha256", empty_sha).alias("ends_sha256"))
    return full.unionByName(root)
