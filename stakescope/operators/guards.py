"""Checks that stop a run early, each one small action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """An input breaks what the operators rely on."""


def require_unique(df: DataFrame, *keys: str, what: str = "table") -> None:
    """Error with up to ten samples if a key (rows with a null in it aside) stands twice."""
    known = df.where(F.concat_ws("", *keys).isNotNull())
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    twice = known.groupBy(*keys).count().where("count > 1").limit(10).collect()
    if twice:
        raise ContractError(f"{what}: duplicate {', '.join(keys)}: {[tuple(r)[:-1] for r in twice]}")


def require_currency(df: DataFrame, rows: Column, currency: str = "UGX", what: str = "table") -> None:
    """Error if one of the rows has another currency; null passes."""
    other = [r[0] for r in df.where(rows & (F.col("currency") != currency)).select("currency").distinct().limit(10).collect()]
    if other:
        raise ContractError(f"{what}: expected {currency}, found {', '.join(sorted(other))}")


def require_none(df: DataFrame, message: str) -> None:
    """Error with samples if df has rows."""
    rows = df.limit(10).collect()
    if rows:
        raise ContractError(f"{message}: {[tuple(r) for r in rows]}")


def population(df: DataFrame, players: DataFrame) -> DataFrame:
    """Rows whose player is one of players."""
    return df.join(players.select("player_key"), "player_key", "left_semi")
