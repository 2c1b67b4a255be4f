"""Lookup tables: address blocks and login ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventloom.operators.lookups import ip_number


def read_ip_blocks(spark: SparkSession, path: str, fmt: str = "parquet", validate: bool = True) -> DataFrame:
    """Range table ``start_ip, end_ip, …`` from parquet or a headed CSV.

    Addresses may be numbers or dotted text.  Blocks must not overlap (an overlap would
    repeat looked-up rows), which ``validate`` checks.
    """
    blocks = spark.read.option("header", True).format(fmt).load(path)
    for side in ("start_ip", "end_ip"):
        text = F.col(side).cast("string")
        blocks = blocks.withColumn(side, F.coalesce(text.try_cast("bigint"), ip_number(text)))
    if validate and overlapping_blocks(blocks).limit(1).count():
        raise ValueError(f"address blocks of {path} overlap")
    return blocks


def overlapping_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks that begin before an earlier one has ended.

    Compared inside /8 slices and across them through one row per slice, so no task holds
    the whole table.
    """
    sliced = blocks.select("start_ip", "end_ip", F.shiftright("start_ip", 24).alias("_slice"))
    ends = sliced.groupBy("_slice").agg(F.max("end_ip").alias("_end"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_slice", F.max("_end").over(before).alias("_carried"))  # 256 rows at most
    within = Window.partitionBy("_slice").orderBy("start_ip", "end_ip").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("_prev", F.max("end_ip").over(within))
        .join(F.broadcast(carried), "_slice")
        .where(F.col("start_ip") <= F.greatest("_prev", "_carried"))
        .select("start_ip", "end_ip")
    )


def build_login_dim(responses: DataFrame, path: str = "$.results[0].id") -> DataFrame:
    """``login, user_id`` from saved lookup responses ``login, body``.

    A readable body without the id is a negative entry (NULL id); an unreadable body
    gives no entry, so that the login stays unresolved.
    """
    body = F.try_parse_json("body")
    found = F.try_variant_get(body, path, "variant")
    number = F.when(F.schema_of_variant(found).rlike("^(BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get(found, "$", "bigint"))
    return (
        responses.where(body.isNotNull())
        .select("login", number.alias("user_id"))
        .groupBy("login")
        .agg(F.max("user_id").alias("user_id"))
    )
