"""Ordered running clamp per key, at any skew.

One step of a bounded score is ``x -> min(max(x + a, low), high)``. Such steps are closed under
composition: doing ``(a, l, h)`` and then ``(b, m, n)`` is ``(a + b, clamp(l + b, m, n), clamp(h + b, m, n))``.
So a long history need not be walked by one task:

1. rows are range-partitioned by key *and* time, so one hot key spreads over many partitions ("chunks");
2. inside each chunk every row gets the composition of all *earlier* steps of its key in that chunk;
3. each chunk is reduced to at most two small rows (its first and last key), which are combined into the
   composition a chunk's first key brings with it; that table has at most two rows per chunk;
4. a row's full prefix is the carried composition followed by its own, a plain column expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from scoreloom.functions.numeric import clamp
from scoreloom.operators.kernels import IDENTITY as _IDENTITY
from scoreloom.operators.kernels import PREFIX, chunk_kernel, sum_kernel
from scoreloom.session import new_table_path


def compose(first: tuple, second: tuple) -> tuple:
    """Composition of two clamp steps given as column triples."""
    (a, l, h), (b, m, n) = first, second
    return a + b, clamp(l + b, m, n), clamp(h + b, m, n)


def apply_step(x: Column, step: tuple) -> Column:
    add, low, high = step
    return clamp(x + add, low, high)


def _with_kernel(df: DataFrame, keys: Sequence[str], step: Sequence[str]) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField("chunk_pos", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in PREFIX],
                           T.StructField("chunk_end", T.BooleanType())])
    return df.mapInArrow(chunk_kernel(tuple(keys), tuple(step)), schema)


def _cols(names: Sequence[str], prefix: str = "") -> tuple:
    return tuple(F.col(prefix + c) for c in names)


def _same_key(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"head.{k}").eqNullSafe(F.col(f"tail.{k}"))
    return same


def _chunk_parts(chunks: DataFrame, keys: Sequence[str], fields: Sequence[str], tail: list[Column],
                 head: list[Column]) -> DataFrame:
    """At most two rows per chunk: its first key with ``head`` values and its last key with ``tail`` values.

    The filter reaches the files: only row groups with a first or a last row of a chunk are read.
    """
    ends = chunks.filter((F.col("chunk_pos") == 0) | F.col("chunk_end")).groupBy("chunk").agg(
        F.min_by(F.struct(*keys), "chunk_pos").alias("head"),
        F.max_by(F.struct(*keys, *fields), "chunk_pos").alias("tail"))
    last = F.struct(*[F.col(f"tail.{k}").alias(k) for k in keys], *tail)
    first = F.struct(*[F.col(f"head.{k}").alias(k) for k in keys], *head)
    return ends.select("chunk", F.explode(F.when(_same_key(keys), F.array(last)).otherwise(F.array(first, last)))
                       .alias("part")).select("chunk", "part.*")


def _carried(chunks: DataFrame, keys: Sequence[str], step: Sequence[str]) -> DataFrame:
    """The composition each chunk's first key brings from earlier chunks."""
    names = ("t_add", "t_low", "t_high")
    total = compose(_cols(PREFIX, "tail."), _cols(step, "tail."))
    parts = _chunk_parts(chunks, keys, [*step, *PREFIX], [t.alias(n) for t, n in zip(total, names)],
                         [F.lit(v).alias(n) for v, n in zip(_IDENTITY, names)])
    full = _with_kernel(parts.repartition(*keys).sortWithinPartitions(*keys, "chunk"), keys, names)
    earlier = F.lag("chunk").over(W.partitionBy(*keys).orderBy("chunk"))
    return (full.withColumn("earlier", earlier).filter("earlier is not null")
            .select("chunk", *keys, *[F.col(c).alias(f"carried_{c}") for c in PREFIX]))


def _carried_sums(chunks: DataFrame, keys: Sequence[str], sums: Sequence[str],
                  previous: Sequence[str]) -> DataFrame:
    tail = [(F.col(f"tail.before_{c}") + F.col(f"tail.{c}")).alias(f"t_{c}") for c in sums]
    head = [F.lit(0).cast("bigint").alias(f"t_{c}") for c in sums]
    tail += [F.col(f"tail.{c}").alias(f"v_{c}") for c in previous]
    head += [F.lit(None).cast(chunks.schema[c].dataType).alias(f"v_{c}") for c in previous]
    parts = _chunk_parts(chunks, keys, list(dict.fromkeys([*sums, *[f"before_{c}" for c in sums], *previous])), tail,
                         head)
    by_chunk = W.partitionBy(*keys).orderBy("chunk")
    prior = by_chunk.rowsBetween(W.unboundedPreceding, -1)
    return (parts.withColumn("earlier", F.lag("chunk").over(by_chunk))
            .withColumns({**{f"carried_{c}": F.sum(f"t_{c}").over(prior) for c in sums},
                          **{f"last_{c}": F.lag(f"v_{c}").over(by_chunk) for c in previous}})
            .filter("earlier is not null")
            .select("chunk", *keys, *[f"carried_{c}" for c in sums], *[f"last_{c}" for c in previous]))


def _stage(spark: SparkSession, df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int | None,
           kernel, prepare=None, finish=None) -> DataFrame:
    """Range-partition, sort, run the kernel, and write once.

    Choosing range limits reads the input once before the shuffle. Row-wise work that the order does not need
    (``prepare``) is therefore placed behind the shuffle, where it runs once, and columns that only the written table
    needs (``finish``) behind the kernel. The written table fixes the chunk numbers for the second pass, and a lost
    executor does not bring back the work before it.
    """
    by = [*keys, *order]
    spread = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
    rows = spread.sortWithinPartitions(*by).withColumn("chunk", F.spark_partition_id())
    staged = kernel(prepare(rows) if prepare else rows)
    staged = finish(staged) if finish else staged
    path = new_table_path(spark, "scan-rows")
    staged.write.parquet(path)
    return spark.read.schema(staged.schema).parquet(path)


def _with_carried(spark: SparkSession, rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    path = new_table_path(spark, "scan-carried")
    carried.coalesce(1).write.parquet(path)
    # At most two rows per chunk, so its size is bounded by the partition count and not by the data.
    return rows.join(F.broadcast(spark.read.schema(carried.schema).parquet(path)), ["chunk", *keys], "left")


def scan_order() -> Column:
    """One number per row that grows along (keys, order).

    "The last row of a group" is then a maximum over a number, which Spark aggregates by hash; an order by
    several columns would make it sort the input first.
    """
    return (F.shiftleft(F.col("chunk").cast("bigint"), 40) + F.col("chunk_pos")).alias("scan_order")


def clamped_scan(spark: SparkSession, df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 step: Sequence[str], chunks: int | None = None, prepare=None, finish=None) -> DataFrame:
    """Rows of ``df`` plus, per row, the composition of all earlier steps of its key.

    ``order`` must make rows of a key distinct. ``prepare`` is row-wise work that adds the step columns; it runs
    after the shuffle, and ``finish`` adds columns behind the kernel. The result is a scan of the written rows, joined with the small carried table: no further
    shuffle.
    """
    rows = _stage(spark, df, keys, order, chunks, lambda x: _with_kernel(x, keys, step), prepare, finish)
    joined = _with_carried(spark, rows, _carried(rows, keys, step), keys)
    before = tuple(F.coalesce(F.col(f"carried_{c}"), F.lit(v)) for c, v in zip(PREFIX, _IDENTITY))
    prefix = compose(before, _cols(PREFIX))
    inner = {"chunk", "chunk_pos", "chunk_end", *PREFIX}
    return joined.select(*[c for c in rows.columns if c not in inner], scan_order(),
                         *[p.alias(c) for p, c in zip(prefix, PREFIX)])


def ordered_sums(spark: SparkSession, df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 sums: Sequence[str] = (), previous: Sequence[str] = (), chunks: int | None = None) -> DataFrame:
    """Per row: exact sums of BIGINT columns over earlier rows of its key, and values of the row before.

    Does what an ordered window per key does, without putting a whole key into one task.
    """
    extra = [T.StructField("chunk_pos", T.LongType()), *[T.StructField(f"before_{c}", T.LongType()) for c in sums],
             *[T.StructField(f"previous_{c}", df.schema[c].dataType) for c in previous],
             T.StructField("chunk_end", T.BooleanType())]

    def kernel(x: DataFrame) -> DataFrame:
        return x.mapInArrow(sum_kernel(tuple(keys), tuple(sums), tuple(previous)),
                            T.StructType([*x.schema.fields, *extra]))

    rows = _stage(spark, df, keys, order, chunks, kernel)
    joined = _with_carried(spark, rows, _carried_sums(rows, keys, sums, previous), keys)
    return joined.select(
        *df.columns,
        *[(F.col(f"before_{c}") + F.coalesce(f"carried_{c}", F.lit(0))).alias(f"before_{c}") for c in sums],
        *[F.when(F.col("chunk_pos") == 0, F.col(f"last_{c}")).otherwise(F.col(f"previous_{c}"))
          .alias(f"previous_{c}") for c in previous])
