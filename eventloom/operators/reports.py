"""Operational counts as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.operators.classify import EDGE_TYPES, PANICKED, WRITTEN, outcomes, status_text
from eventloom.operators.dedupe import DEFAULT_TTL_SECONDS, repeat_counts
from eventloom.operators.ranks import exact_percentiles


def status_counts(rows: DataFrame) -> DataFrame:
    """Rows per status text."""
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(
        status_text(F.col("status")).alias("status_text"), "n"
    )


def event_success_fail(rows: DataFrame) -> DataFrame:
    """Successes and failures per filed event; a skipped column still counts as success."""
    good = F.col("status").isin(*WRITTEN)
    return rows.groupBy("category").agg(
        F.count_if(good).alias("success"), F.count_if(~good).alias("fail")
    )


def duration_by_status(rows: DataFrame, started: Column, finished: Column) -> DataFrame:
    """Processing time per status code, in milliseconds; percentiles are exact."""
    timed = rows.select("status", (F.unix_millis(finished) - F.unix_millis(started)).alias("_millis"))
    ranks = exact_percentiles(timed, ["status"], F.col("_millis"), {"p50_ms": 0.5, "p99_ms": 0.99})
    ranks = ranks.withColumnRenamed("status", "_status")
    sums = timed.groupBy("status").agg(F.avg("_millis").alias("avg_ms"), F.max("_millis").alias("max_ms"))
    return sums.join(ranks, F.col("status").eqNullSafe(F.col("_status")), "left").drop("_status")


def event_age(rows: DataFrame, now: Column, received: str = "received_at") -> DataFrame:
    """Age of events when they are processed, in seconds; percentiles are exact."""
    aged = rows.select((F.unix_seconds(now) - F.unix_seconds(F.col(received).cast("timestamp"))).alias("_age"))
    ranks = exact_percentiles(aged, [], F.col("_age"), {"median_age": 0.5, "p99_age": 0.99})
    sums = aged.agg(F.count("_age").alias("n"), F.min("_age").alias("min_age"), F.max("_age").alias("max_age"))
    # One row each, put side by side.
    both = sums.unionByName(ranks, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def column_outcomes(rows: DataFrame) -> DataFrame:
    """Column outcomes per event."""
    return outcomes(rows).groupBy("event", "outcome").agg(F.count(F.lit(1)).alias("n"))


def _parsed(rows: DataFrame) -> DataFrame:
    """Rows of tracked tables: edge types are counted before the properties are read, so null
    properties (a crash row) count too."""
    return rows.where(F.col("cells").isNotNull() | (F.col("status") == PANICKED))


def edge_type_counts(rows: DataFrame) -> DataFrame:
    """Events per event name and valid edge type."""
    return (
        _parsed(rows).where(F.col("edge_type").isin(*EDGE_TYPES))
        .groupBy("event", "edge_type").agg(F.count(F.lit(1)).alias("n"))
    )


def expected_values(metadata: DataFrame, metadata_type: str) -> DataFrame:
    """``event, expected`` of one metadata type (one row per event)."""
    return metadata.where(F.col("metadata_type") == metadata_type).groupBy("event").agg(
        F.max("metadata_value").alias("expected")
    )


def with_expected(rows: DataFrame, metadata: DataFrame, metadata_type: str) -> DataFrame:
    """Left join of the expected metadata value; '' where none is given.

    The metadata is one short row per configured event; its size is left to the
    optimizer's own broadcast threshold.
    """
    return rows.join(expected_values(metadata, metadata_type), "event", "left").withColumn(
        "expected", F.coalesce("expected", F.lit(""))
    )


def edge_type_mismatch(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Events whose edge type differs from the expected one.

    Counted per (event, edge type) before the join, so the join sees a handful of rows.
    """
    counted = _parsed(rows).groupBy("event", "edge_type").agg(F.count(F.lit(1)).alias("n"))
    joined = with_expected(counted, metadata, "edge_type")
    return joined.where((F.col("expected") != "") & (F.col("expected") != F.col("edge_type"))).select(
        "event", "edge_type", "expected", "n"
    )


def glob_totals(inflated: DataFrame, ttl_seconds: int = DEFAULT_TTL_SECONDS) -> DataFrame:
    """Globs read, failed and suppressed as repeats, in one pass over ``n_records, glob_key, arrival``."""
    facts = inflated.where("n_records is null or n_records > 0")
    counts = repeat_counts(facts, F.col("n_records").isNotNull(), ttl_seconds=ttl_seconds)
    return counts.select(
        F.col("seen").alias("read"), F.col("others").alias("failed"), (F.col("seen") - F.col("fresh")).alias("duplicate"))

