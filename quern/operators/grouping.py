"""Splitting of large groups, shared by the operators that join or list whole groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import broadcast_if_small, stage


def piece_of(spread_by: str) -> Column:
    """Piece number of a row within its group, from a hash of `spread_by`; needs a `pieces` column."""
    return F.pmod(F.xxhash64(spread_by), F.col("pieces")).cast("int")


def with_pieces(df: DataFrame, key: str, sizes: DataFrame | None) -> DataFrame:
    """Add `pieces`: how many parts the group of `key` is dealt into.

    `sizes` holds `key, pieces` for the split groups only, or is None when no group is split; then
    no join is planned at all.
    """
    if sizes is None:
        return df.withColumn("pieces", F.lit(1))
    return df.join(broadcast_if_small(sizes), key, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))


def large_groups(sizes: DataFrame, key: str, pieces: Column) -> DataFrame | None:
    """The groups that need more than one piece, as a stage table, or None when there are none."""
    found = stage(sizes.select(key, pieces.cast("int").alias("pieces")).where("pieces > 1"), f"large-{key}")
    return None if found.isEmpty() else found


def replicate(df: DataFrame, name: str) -> DataFrame:
    """One copy of each row per piece of its group, numbered in `name`."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
