"""Near duplicates among embeddings by a subspace pigeonhole join.

Vectors of one label are compared by cosine. On unit vectors a cosine of at least ``t`` is a squared distance of at most
2 - 2t. Unit vectors are rotated (fixed random signs, then a Hadamard transform, padded with zeros to a power of two), which spreads
their energy evenly, and cut into blocks of ``BLOCK`` coordinates. Each block gets its proportional share of the squared
distance: a pair within the whole budget is within its share in at least one block.

Each block is a range join of its own on a grid over two of its coordinates. A cell is twice the block's radius wide, so a
vector's box reaches at most two cells along a coordinate: the vector stands in its own cell, and probes the touched cells behind
it in order. Pairs that are within the block's share are then verified by the cosine of the vectors as given, in
doubles. A pair that several blocks find counts in the first of them, so the union needs no shuffle of pairs: a task returns one row
per vector with its number of links and one linked vector that stands for what hangs together in that task.

A cell with more than ``TILE`` rows is dealt into parts, and pairs of parts are groups of their own, so no task holds a
cell; work in a cell of near copies that all link stays quadratic, as each vector's links are counted exactly. Equal vectors
of a label are one vector with a multiplicity from the start.

Vectors without label, null, empty or zero vectors, and those with null or non-finite components link with nothing and stand alone;
vectors of different length link with nothing. Rows with equal vectors link with each other whatever their ids; of rows that repeat an id
each is a row of its own. A row without id counts as a link of others; the least id of its class skips it. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import components, mix, stored

COSINE = 0.98
BLOCK = 8
TILE = 2048
#: Slack of distances before they are compared, far above rounding and far below any share.
SLACK = 1e-9
#: Pairs verified in one numpy pass.
PAIRS = 1 << 15

_CELL = ("label", "dim", "block", "c0", "c1")


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two, which is exact, so that squares neither vanish nor overflow."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def unit(vectors: np.ndarray) -> np.ndarray:
    out = scaled(vectors)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def rotate(units: np.ndarray) -> np.ndarray:
    """Rotated rows, padded to a power of two of at least ``BLOCK`` coordinates. Sums run in a fixed order, so a row's
    result does not depend on the rows beside it."""
    n, dim = units.shape
    size = max(BLOCK, 1 << (dim - 1).bit_length())
    signs = np.where(mix(np.arange(1, dim + 1, dtype=np.uint64)) & np.uint64(1), 1.0, -1.0)
    out = np.zeros((n, size))
    out[:, :dim] = units * signs
    half = 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, size)
        half *= 2
    return out / np.sqrt(size)


def share(dim: int, cosine: float) -> tuple[int, float]:
    """Number of blocks, and the squared distance each of them is allowed."""
    blocks = max(BLOCK, 1 << (dim - 1).bit_length()) // BLOCK
    return blocks, (2 - 2 * cosine) / blocks


def usable(vector: Column, label: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column without nulls."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[at[0]: at[-1]].astype("<f8"), at - at[0]


def _width(distinct: DataFrame) -> str:
    """How the components of a vector travel: as they came, in single or double precision."""
    return "<f4" if distinct.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"


def _places(distinct: DataFrame, cosine: float, vectors: bool) -> DataFrame:
    """The cells of each vector: one row for its own in every block, and one for each cell behind that its box touches."""
    width = _width(distinct)
    schema = "label string, dim int, block int, c0 bigint, c1 bigint, key binary, probe boolean"
    schema += ", copies bigint, vector binary" if vectors else ""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = _lists(batch.column("embedding"))
            dims = np.diff(at)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                given = values[at[rows][:, None] + np.arange(dim)]
                turned = rotate(unit(given))
                blocks, budget = share(dim, cosine)
                radius = np.sqrt(budget) + SLACK
                for b in range(blocks):
                    xy = turned[:, b * BLOCK: b * BLOCK + 2]
                    own = np.floor(xy / (2 * radius)).astype(np.int64)
                    low, high = (np.floor((xy + s * radius) / (2 * radius)).astype(np.int64) for s in (-1, 1))
                    for dx in (0, 1):
                        for dy in (-1, 0, 1):
                            if dx == 0 and dy < 0:
                                continue
                            cell = own + np.array([dx, dy])
                            hit = np.flatnonzero(((cell >= low) & (cell <= high)).all(axis=1))
                            if not len(hit):
                                continue
                            take = pa.array(rows[hit])
                            out = [batch.column("label").take(take), pa.array(np.full(len(hit), dim, np.int32)),
                                   pa.array(np.full(len(hit), b, np.int32)), pa.array(cell[hit, 0]), pa.array(cell[hit, 1]),
                                   batch.column("key").take(take), pa.array(np.full(len(hit), bool(dx or dy)))]
                            if vectors:
                                out += [batch.column("copies").take(take), pa.array([v.tobytes() for v in given[hit].astype(width)], pa.binary())]
                            names = [f.split()[0] for f in schema.split(", ")]
                            yield pa.RecordBatch.from_arrays(out, names=names)

    return distinct.select("label", "key", "copies", "embedding").mapInArrow(over, schema)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of n rows hangs together with through links (a, b)."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def tile_links(given: np.ndarray, probe: np.ndarray, first: np.ndarray, second: np.ndarray, block: int,
               cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows, one of ``first`` and one of ``second`` (or both of one part), that count in this block."""
    plain = scaled(given)
    norm = np.sqrt(np.einsum("ij,ij->i", plain, plain))
    turned = rotate(unit(given))
    blocks, budget = share(given.shape[1], cosine)
    span = slice(block * BLOCK, (block + 1) * BLOCK)
    x, y = turned[first, span], turned[second, span]
    near = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T) <= budget + 10 * SLACK
    near &= ~(probe[first][:, None] & probe[second][None, :])
    if first is second:
        near &= np.tri(len(first), k=-1, dtype=bool).T
    i, j = np.nonzero(near)
    found = []
    for at in range(0, len(i), PAIRS):
        a, b = first[i[at: at + PAIRS]], second[j[at: at + PAIRS]]
        squares = np.square(turned[a] - turned[b]).reshape(len(a), blocks, BLOCK)
        sums = squares[:, :, 0]
        for k in range(1, BLOCK):
            sums = sums + squares[:, :, k]
        inside = sums <= budget + SLACK
        mine = inside[:, block] & ~inside[:, :block].any(axis=1)
        a, b = a[mine], b[mine]
        good = np.einsum("ij,ij->i", plain[a], plain[b]) / (norm[a] * norm[b]) >= cosine
        found.append((a[good], b[good]))
    none = np.zeros(0, np.int64)
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (none, none)


def links(distinct: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(key, root, links) from each cell, for ``distinct`` (label, key, copies, embedding): links counts the vectors a key is linked
    with there, each with its copies, and root is a key that it hangs together with."""
    sizes = (_places(distinct, cosine, vectors=False).groupBy(*_CELL).agg(F.count("*").alias("n")).where(F.col("n") > TILE)
             .select(*_CELL, F.ceil(F.col("n") / TILE).cast("int").alias("parts")))
    sizes = stored(sizes, "embedding-cells")
    placed = _places(distinct, cosine, vectors=True).join(sizes, list(_CELL), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = dealt.select(*_CELL, F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"),
                         "part", "key", "probe", "copies", "vector")

    width = _width(distinct)

    def of_tile(group: tuple, rows: pa.Table) -> pa.Table:
        block, one, two = (x.as_py() for x in (group[2], group[5], group[6]))
        given = np.stack([np.frombuffer(v, width) for v in rows.column("vector").to_pylist()]).astype("<f8")
        part, copies = rows.column("part").to_numpy(), rows.column("copies").to_numpy()
        probe = np.asarray(rows.column("probe").to_pylist(), bool)
        first = np.flatnonzero(part == one)
        a, b = tile_links(given, probe, first, first if one == two else np.flatnonzero(part == two), block, cosine)
        n = np.zeros(len(given), np.int64)
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        with_links = np.flatnonzero(n)
        keys = rows.column("key")
        return pa.table({"key": keys.take(pa.array(with_links)), "root": keys.take(pa.array(_roots(len(given), a, b)[with_links])),
                         "links": pa.array(n[with_links])})

    return tiles.groupBy(*_CELL, "one", "two").applyInArrow(of_tile, "key binary, root binary, links bigint")


def classes(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
            cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id (the least id of all that links reach) and
    kept (it has that id)."""
    v, l = F.col(f"`{vector}`"), F.col(f"`{label}`")
    text = F.concat_ws(",", F.size(v).cast("string"), l.cast("string"), v.cast("array<string>"))
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), l.cast("string").alias("label"), v.alias("embedding"),
                          F.when(usable(v, l), F.unhex(F.md5(text.cast("binary")))).alias("key"))
    distinct = stored(rows.where("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("copies"),
        F.min("vec_id").alias("least")), "embedding-distinct")
    found = stored(links(distinct, cosine), "embedding-links")
    degree = found.groupBy("key").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    known = (distinct.select("key", "copies", "least").join(degree, "key", "left").join(labels, "key", "left")
             .withColumn("class", F.coalesce("label", "key")))
    known = stored(known, "embedding-classes")
    least = known.groupBy("class").agg(F.min("least").alias("component_id"))
    known = known.join(least, "class").select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "component_id")
    out = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
