"""Old against new version of a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def merged_snapshot(old: DataFrame, new: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """``keys…, action, old, new, row`` for every key of either side, in one join.

    ADD and DROP for keys on one side only; KEEP for equal versions; REPLACE for a higher
    and REJECT for a lower incoming version.  ``old`` and ``new`` are the other columns of either
    side, ``row`` is what is in force afterwards, NULL for a dropped key.
    """
    side = lambda rows, name: rows.select(*keys, F.struct(*(F.col(c) for c in rows.columns if c not in keys)).alias(name))
    before, after = F.col("old")[version], F.col("new")[version]
    action = (
        F.when(F.col("old").isNull(), F.lit("ADD"))
        .when(F.col("new").isNull(), F.lit("DROP"))
        .when(before == after, F.lit("KEEP"))
        .when(before > after, F.lit("REJECT"))
        .otherwise(F.lit("REPLACE"))
    )
    met = side(old, "old").join(side(new, "new"), keys, "full_outer").withColumn("action", action)
    return met.withColumn("row", F.when(F.col("action") == "REJECT", F.col("old")).otherwise(F.col("new")))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """``keys…, old_version, new_version, action`` for every key of either side."""
    only = lambda rows: rows.select(*keys, version)
    return merged_snapshot(only(old), only(new), keys, version).select(
        *keys, F.col(f"old.{version}").alias("old_version"), F.col(f"new.{version}").alias("new_version"), "action"
    )


def apply_snapshot(old: DataFrame, new: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """Rows in force after the refresh: the new side, but the old row where it is newer."""
    merged = merged_snapshot(old.select(*new.columns), new, keys, version).where(F.col("row").isNotNull())
    return merged.select(*(F.col(c) if c in keys else F.col(f"row.`{c}`").alias(c) for c in new.columns))
