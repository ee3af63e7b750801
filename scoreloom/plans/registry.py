"""Named queries over the test tables, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _portable_column(field: T.StructField) -> Column:
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        col = F.date_format(col, TIME_FORMAT)
    elif isinstance(kind, T.DateType):
        col = F.date_format(col, "yyyy-MM-dd")
    elif isinstance(kind, T.ArrayType):
        col = F.concat_ws(",", col.cast("array<string>"))
    elif isinstance(kind, T.MapType):
        pairs = F.transform(F.array_sort(F.map_entries(col)), lambda e: F.concat(
            e["key"].cast("string"), F.lit("="), e["value"].cast("string")))
        col = F.concat_ws(",", pairs)
    return col.alias(field.name)


def portable(df: DataFrame) -> DataFrame:
    """Times, dates, arrays and maps as text, so any SQL engine can be compared value by value."""
    return df.select(*[_portable_column(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(prepare(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add
