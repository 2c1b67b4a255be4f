"""Sliding-window suppression of repeated globs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_TTL_SECONDS = 300


def _micros(arrival: str) -> Column:
    return F.unix_micros(F.col(arrival).cast("timestamp"))


def _settled(rows: DataFrame, key: str, arrival: str, ttl_seconds: int, tie: Column, row: Column) -> DataFrame:
    """``_key, _row, _seen, _fresh`` of each (key, slice of one TTL) with sightings: how many, and whether the
    first, whose ``row`` it is, is not within a TTL of an earlier one.

    Two sightings inside one slice are less than a TTL apart, so only the first of a slice
    can survive, and only the slice before it can suppress it.  Each row therefore goes
    into its own slice and leaves a note of its arrival in the next one; one aggregation
    settles both.  It combines before the shuffle, and a hot key is spread over its slices.
    """
    ttl = ttl_seconds * 1_000_000
    no_time = F.lit(None).cast("bigint")
    at = F.col("_at")
    entry = lambda shift, row, seen, note: F.struct(
        (F.expr(f"_at div {ttl}") + shift).alias("_slice"), row.alias("_row"), seen.alias("_seen"), note.alias("_note")
    )
    both = (
        rows.withColumn("_at", F.coalesce(_micros(arrival), F.lit(0)))
        .withColumn("_tie", tie)
        .select(
            F.col(key).alias("_key"), "_tie",
            F.explode(F.array(entry(0, row, at, no_time), entry(1, F.when(F.lit(False), row), no_time, at))).alias("_e"),
        )
        .select("_key", "_tie", "_e.*")
    )
    settled = both.groupBy("_key", "_slice").agg(
        F.min_by("_row", F.when(F.col("_seen").isNotNull(), F.struct("_seen", "_tie"))).alias("_row"),
        F.min("_seen").alias("_first"), F.max("_note").alias("_before"), F.count("_seen").alias("_n"),
    )
    fresh = F.col("_before").isNull() | (F.col("_first") - F.col("_before") > ttl)
    return settled.where("_n > 0").select("_key", "_row", F.col("_n").alias("_seen"), fresh.alias("_fresh"))


def _survivors(rows: DataFrame, key: str, arrival: str, ttl_seconds: int, tie: Column) -> DataFrame:
    """First row of each slice that is not within a TTL of an earlier sighting."""
    everything = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return _settled(rows, key, arrival, ttl_seconds, tie, everything).where("_fresh").select("_row.*")


def repeat_counts(
    rows: DataFrame, counted: Column, key: str = "glob_key", arrival: str = "arrival", ttl_seconds: int = DEFAULT_TTL_SECONDS
) -> DataFrame:
    """``seen, fresh, others``: sightings among the ``counted`` rows, those ``dedupe_globs`` would keep, and the
    rows that don't count, in one pass without any payload."""
    own, other = F.monotonically_increasing_id(), "\x00other"
    name = F.when(F.col(arrival).isNull(), F.concat(F.lit("\x00\x00"), own.cast("string"))).otherwise(_own_key(key, own))
    mark = F.when(counted, name).otherwise(F.concat(F.lit(other), (own % 1024).cast("string")))
    keyed = rows.select(mark.alias("_dedupe_key"), F.col(arrival).alias("arrival"))
    settled = _settled(keyed, "_dedupe_key", "arrival", ttl_seconds, F.lit(0).cast("bigint"), F.lit(0))
    real = ~F.col("_key").startswith(other)
    return settled.agg(
        F.coalesce(F.sum(F.when(real, F.col("_seen"))), F.lit(0)).alias("seen"), F.count_if(real & F.col("_fresh")).alias("fresh"),
        F.coalesce(F.sum(F.when(~real, F.col("_seen"))), F.lit(0)).alias("others"))


def _own_key(key: str, row: Column) -> Column:
    """Key of a row without one: matches nothing and spreads over all tasks. ``row`` tells rows apart."""
    return F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.concat(F.lit("\x00"), row.cast("string")))


def _row_hash(rows: DataFrame) -> Column:
    """Hash over the plain columns of a row, to order rows of equal arrival."""
    plain = [c for c, t in rows.dtypes if not t.startswith(("map", "variant", "array", "struct"))]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def dedupe_globs(
    rows: DataFrame,
    key: str = "glob_key",
    arrival: str = "arrival",
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    *,
    tie: Column | None = None,
    dedupe_empty_key: bool = False,
) -> DataFrame:
    """Rows not seen with the same key during the TTL before them.

    Every sighting, a suppressed one too, restarts the clock; a gap of exactly the TTL
    still counts as a repeat.  Rows with an empty key are kept unless ``dedupe_empty_key``
    is set, and rows without an arrival are kept.  Equal arrivals are ordered by ``tie``, by default a
    hash of the row.
    """
    columns = rows.columns
    tie = tie if tie is not None else _row_hash(rows)
    own = F.monotonically_increasing_id()
    keyed = F.coalesce(F.col(key).cast("string"), F.lit("")) if dedupe_empty_key else _own_key(key, own)
    keyed = F.when(F.col(arrival).isNull(), F.concat(F.lit("\x00\x00"), own.cast("string"))).otherwise(keyed)
    rows = rows.withColumn("_dedupe_key", keyed)
    return _survivors(rows, "_dedupe_key", arrival, ttl_seconds, tie).select(*columns)


def session_dedupe(
    stream: DataFrame,
    key: str = "glob_key",
    arrival: str = "arrival",
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
) -> DataFrame:
    """The same rule as one streaming aggregation: first row of each session of a key.

    A row comes out once its session closes; use ``streaming.seen`` where rows must leave at
    once.  The input needs a watermark on ``arrival``; a row without an arrival can't be in a session and
    is not in the result.
    """
    columns = stream.columns
    rows = stream.withColumn("_tie", _row_hash(stream)).withColumn("_key", _own_key(key, F.uuid()))
    # Sessions end before their gap does; a gap of exactly the TTL is still a repeat.
    gap = f"{ttl_seconds} seconds 1 microsecond"
    return (
        rows.groupBy(F.session_window(arrival, gap), "_key")
        .agg(F.min_by(F.struct(*columns), F.struct(arrival, "_tie")).alias("_row"))
        .select("_row.*")
    )
