"""Writing and reading of features and flags."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import Settings
from ..operators.guards import require_unique
from ..operators.iforest import isolation_scores
from ..sources.tables import write_text
from .features import FeatureTables
from .scoring import report, score_players


@dataclass(frozen=True)
class Scored:
    flags: DataFrame
    report: str


def write_features(features: FeatureTables, folder: str) -> None:
    features.wide.write.mode("overwrite").parquet(f"{folder}/player_features")
    features.evidence.write.mode("overwrite").parquet(f"{folder}/player_features_evidence")


def load_features(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    wide, evidence = spark.read.parquet(f"{folder}/player_features"), spark.read.parquet(f"{folder}/player_features_evidence")
    require_unique(wide, "player_key", what="features")
    return wide, evidence


def score_and_write(features: FeatureTables, folder: str, settings: Settings | None = None) -> Scored:
    """Scores with the isolation forest if it is on, writes the flags, and writes the report made from them (flags_report).

    The forest's scores are written first, so that a failure inside it shows here: then they are zero, with a warning,
    unless its weight says that somebody relies on them.
    """
    settings = settings or Settings()
    forest, spark = None, features.wide.sparkSession
    if settings.iforest_enabled:
        try:
            isolation_scores(features.wide, settings.iforest_trees, settings.iforest_seed).write.mode("overwrite").parquet(f"{folder}/iforest")
            forest = spark.read.parquet(f"{folder}/iforest")
        except Exception as error:
            if settings.iforest_weight:
                raise RuntimeError("isolation forest failed although its weight is not zero") from error
            logging.getLogger(__name__).warning("isolation forest failed; its scores are zero, and its weight is", exc_info=True)
    score_players(features.structs, settings, forest).write.mode("overwrite").parquet(f"{folder}/flags")
    flags = spark.read.parquet(f"{folder}/flags")
    text = report(flags, settings)
    write_text(spark, text, f"{folder}/flags_report")
    return Scored(flags, text)
