"""Configuration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.model import CONFIG_COLUMNS, TIER_COLUMNS, Decay, ScoreConfig, Tier


def config_frames(spark: SparkSession, config: ScoreConfig) -> tuple[DataFrame, DataFrame]:
    """A configuration as its one-row table and its tier table."""
    decay, ids = config.decay, config.rule_ids
    row = (config.config_id, config.baseline, config.low, config.high, decay.enabled, decay.points_per_day, decay.floor,
           None if ids is None else list(ids), list(config.include_tags), list(config.exclude_tags))
    main = spark.createDataFrame([row], CONFIG_COLUMNS)
    tiers = spark.createDataFrame([(config.config_id, t.name, t.low, t.high) for t in config.tiers], TIER_COLUMNS)
    return main, tiers


def load_config(main: DataFrame, tiers: DataFrame, config_id: str = "default") -> ScoreConfig:
    """The configuration with this id; a missing or doubled one is an error. Its tiers are part of it, so all are read."""
    rows = main.filter(F.col("config_id") == config_id).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{len(rows)} configurations with id {config_id!r}")
    row = rows[0]
    bands = tiers.filter(F.col("config_id") == config_id).orderBy("low", "tier").collect()
    return ScoreConfig(config_id, row.baseline, row.low, row.high, tuple(Tier(b.tier, b.low, b.high) for b in bands),
                       Decay(row.decay_enabled, row.decay_points_per_day, row.decay_floor),
                       None if row.rule_ids is None else tuple(row.rule_ids),
                       tuple(row.include_tags or ()), tuple(row.exclude_tags or ()))
