"""Helpers shared by the text operators: columns, stored tables, and words and lines of an Arrow batch as numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import new_table_path, prepare

#: Words are runs of anything but a space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Text handed to one numpy pass; a longer document is a pass of its own.
SLICE_BYTES = 2 << 20
#: Spans above this many bytes are hashed one by one, shorter ones eight bytes at a time for all spans together.
LONG_SPAN = 512


def ready(spark: SparkSession) -> SparkSession:
    """Session settings the text operators rely on: UTC, and Arrow batches bounded in bytes, as a text may be very long."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not taken (Spark compares names without case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of df other than these; an operator's own columns replace columns of the same name."""
    low = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in low]


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """128 bits that stand for a whole text (null as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def crc_of(id_column: Column) -> Column:
    """crc32 of an id written as text (null as empty)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))


# --- numpy views of Arrow text -------------------------------------------------------------------------------------


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column, nulls as empty texts; text i is bytes[offsets[i]:offsets[i + 1]]."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes together, or one longer text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def eight(data: np.ndarray) -> np.ndarray:
    """View whose element i holds the eight bytes from i on, the first byte lowest; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they stand."""
    window = eight(data) if window is None else window
    size = (ends - starts).astype(np.int64)
    out = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    long = size > LONG_SPAN
    for i in np.flatnonzero(long):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]: ends[i]])
    live, at = np.flatnonzero(~long & (size > 0)), 0
    while len(live):
        left = np.minimum(size[live] - at, 8).astype(np.uint64)
        part = window[starts[live] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))
        out[live] = mix(out[live] * np.uint64(0x9E3779B97F4A7C15) + part)
        at += 8
        live = live[size[live] > at]
    return out


class Words:
    """Words of some texts: byte spans [start, end) in ``data``, and the text each belongs to."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.zeros(len(data) + 1, bool)  # a text begins here
        edge[offsets] = True
        before = np.concatenate(([False], solid[:-1])) if len(data) else solid
        after = np.concatenate((solid[1:], [False])) if len(data) else solid
        self.start = np.flatnonzero(solid & (~before | edge[:-1]))
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.window = eight(data)
        self.solid = solid

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.start, self.end, self.window)


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(over, schema)


# --- classes of linked texts ---------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(key, label) for the end points of ``links`` (a, b): label is the least key that is connected to key.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): each is one grouping with a minimum that combines
    before its shuffle, and rounds grow with the logarithm of a component. A round's table is written, so no lineage grows.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(links.where("a <> b").select(low.alias("a"), high.alias("b")).distinct(), "links")

    def star(edges: DataFrame, small: bool) -> DataFrame:
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        if not small:
            both = both.union(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = both.join(least, "u")
        if small:  # every smaller neighbour, and the node itself, under the least
            out = moved.select("m", F.col("v").alias("x")).union(least.select("m", F.col("u").alias("x")))
        else:  # every larger neighbour under the least
            out = moved.where("v > u").select("m", F.col("v").alias("x"))
        return out.where("m <> x").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()

    state = None
    while True:
        edges = stored(star(star(edges, small=False), small=True), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("b").alias("key"), F.col("a").alias("label")).union(
        edges.select(F.col("a").alias("key"), F.col("a").alias("label")).distinct())
