"""Lookups whose left side may have one key on a third of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most keys that are ever treated as hot; also the most right-hand rows that are ever broadcast.
MAX_HOT_KEYS = 256
_SAMPLE = 0.01
_MIN_SAMPLED = 200


def hot_keys(df: DataFrame, key: str, fraction: float = _SAMPLE, min_sampled: int = _MIN_SAMPLED) -> list:
    """Values of ``key`` seen at least ``min_sampled`` times in a sample, most frequent first.

    Which keys are found changes how ``lookup_join`` runs, never what it returns.
    """
    counted = (
        df.select(key).filter(F.col(key).isNotNull()).sample(fraction=fraction, seed=29)
        .groupBy(key).count().filter(F.col("count") >= min_sampled)
    )
    return [row[0] for row in counted.orderBy(F.desc("count"), key).limit(MAX_HOT_KEYS).collect()]


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str, hot: list) -> DataFrame:
    """Join ``left`` with ``right``, which has at most one row per ``key``; ``hot`` comes from ``hot_keys``.

    Rows with a hot key meet at most ``MAX_HOT_KEYS`` rows of ``right``, so that side is broadcast and the hot rows
    stay where they are.  All other rows take the ordinary shuffled join.
    """
    if len(hot) > MAX_HOT_KEYS:
        raise ValueError(f"more than {MAX_HOT_KEYS} hot keys")
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    cold_part = left.filter(~is_hot).join(right.filter(~is_hot), key, how)
    hot_part = left.filter(is_hot).join(F.broadcast(right.filter(is_hot)), key, how)
    return cold_part.unionByName(hot_part)


def lookup(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """``lookup_join`` that finds the hot keys of ``left`` itself (one sampling job)."""
    return lookup_join(left, right, key, how, hot_keys(left, key))


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key`` (the smallest); repeated keys shrink before the shuffle, which a join can use again."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*")
