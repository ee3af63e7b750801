"""The engine's base tables over the test data, shared by all queries of a session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.model import ALL_RULES, ScoreConfig
from scoreloom.operators.archive import write_archive
from scoreloom.operators.propagate import neighbour_deltas, score_with_neighbours
from scoreloom.operators.scoring import score_events
from scoreloom.session import new_table_path
from scoreloom.sources import star

CONFIG = ScoreConfig()
_stored: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Scored tables are written tables: built by the first query of a session that needs them, then read."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def events(spark: SparkSession, sf_dir: str, payload: bool = False) -> DataFrame:
    return star.events(spark, sf_dir, payload)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.profiles(spark, sf_dir)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.edges(spark, sf_dir)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed events: one row per event with its change and the running score around it.

    What follows from a row alone is not shuffled for it; the payload is not written either, queries that read it work it out.
    """
    return _once(spark, sf_dir, "processed", lambda: score_events(
        spark, star.source_events(spark, sf_dir), star.profiles(spark, sf_dir), ALL_RULES, CONFIG,
        details=star.with_details, late=star.with_payload).drop("raw_type", "value"))


def processed_with_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary and secondary changes in one running score."""
    def build() -> DataFrame:
        secondary = neighbour_deltas(processed(spark, sf_dir), edges(spark, sf_dir))
        return score_with_neighbours(spark, processed(spark, sf_dir), secondary, profiles(spark, sf_dir), CONFIG)

    return _once(spark, sf_dir, "with_neighbours", build)


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive as written: every processed event first with an older version and a wrong score, then as it is."""
    def build() -> DataFrame:
        path, pe = new_table_path(spark, "archive"), processed(spark, sf_dir)
        older = pe.withColumns({"processed_at": F.col("processed_at") - F.expr("INTERVAL 1 SECOND"), "new_score": F.lit(-1.0)})
        write_archive(spark, older.filter("event_id % 2 = 0"), path)
        write_archive(spark, pe.unionByName(older.filter("event_id % 2 = 1")), path)
        return spark.read.parquet(path)

    return _once(spark, sf_dir, "archive", build)
