"""Exact percentiles by refining histograms: no sort, no group in one task.

The value at a rank is found like a digit at a time: the range of a key's values is cut into ``BUCKETS``
equal parts, rows are counted by part (combined before the shuffle, so a hot key costs a partial sum per
task), and the part that holds the rank is the next range. Ranges shrink by ``BUCKETS`` a round, so 64-bit
values take seven rounds at most; rounds read a narrow written table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.session import shared_folder

BUCKETS = 1024
#: Keys (with a percentile each) whose ranges are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 100_000


def exact_percentiles(rows: DataFrame, keys: list[str], value: Column, shares: dict[str, float]) -> DataFrame:
    """``keys…`` and a column for each of ``shares`` (name to percentile): the smallest value (whole number)
    that at least that share of a key's values do not exceed. Null values don't count; a null key is a key."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/percentiles-{uuid.uuid4().hex}"
    key = F.to_json(F.struct(*keys)) if keys else F.lit("")
    slim = rows.select(key.alias("_key"), *keys, value.cast("bigint").alias("_value")).where("_value is not null")
    slim.write.parquet(path)
    slim = spark.read.schema(slim.schema).parquet(path)
    bounds = slim.groupBy("_key").agg(F.min("_value").alias("low"), F.max("_value").alias("high"), F.count(F.lit(1)).alias("n"),
                                      *(F.first(k).alias(k) for k in keys))
    wanted = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("share")) for n, p in shares.items())))
    state = bounds.withColumn("_p", wanted).select(
        "_key", *keys, F.col("_p.name").alias("name"), F.greatest(F.ceil(F.col("n") * F.col("_p.share")), F.lit(1)).cast("bigint").alias("rank"),
        "low", "high")
    few = bounds.count() * len(shares) <= BROADCAST_KEYS
    turn = 0
    while True:
        state = _written(state, f"{path}-state-{turn}")
        if not state.where("high > low").limit(1).count():
            break
        state, turn = _refined(slim, state, keys, few), turn + 1
    out = state.groupBy("_key").agg(
        *(F.first(k).alias(k) for k in keys), *(F.max(F.when(F.col("name") == n, F.col("low"))).alias(n) for n in shares))
    return out.drop("_key")


def _written(state: DataFrame, path: str) -> DataFrame:
    state.write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def _refined(slim: DataFrame, state: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Each range narrowed to the part that holds its rank."""
    # The range of 64-bit values is no 64-bit value: places are counted in decimals.
    wide = lambda c: c.cast("decimal(21,0)")
    span = wide(F.col("high")) - wide(F.col("low")) + F.lit(1)
    ranges = state.withColumn("width", F.ceil(span / BUCKETS).cast("decimal(21,0)"))
    met = slim.select("_key", "_value").join(F.broadcast(ranges) if few else ranges, "_key")
    met = met.where(F.col("_value").between(F.col("low"), F.col("high")))
    part = F.floor((wide(F.col("_value")) - wide(F.col("low"))) / F.col("width")).cast("int")
    counts = met.groupBy("_key", "name", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # At most BUCKETS rows a key and percentile.
    through = F.sum("n").over(Window.partitionBy("_key", "name").orderBy("part"))
    held = counts.withColumn("through", through).join(ranges, ["_key", "name"]).where("through >= rank and through - n < rank")
    low = wide(F.col("low")) + F.col("part").cast("decimal(5,0)") * F.col("width")
    high = F.least(wide(F.col("high")).cast("decimal(28,0)"), (low + F.col("width") - F.lit(1)).cast("decimal(28,0)"))
    return held.select(
        "_key", *keys, "name", (F.col("rank") - (F.col("through") - F.col("n"))).alias("rank"),
        low.cast("bigint").alias("low"), high.cast("bigint").alias("high"))
