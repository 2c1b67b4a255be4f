"""Left lookups against dimension and range tables: broadcast when proven small, salted
shuffle join otherwise.  Every left row comes out exactly once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024
ROW_OVERHEAD = 64
SALT_BUCKETS = 16


def measured_bytes(df: DataFrame) -> int:
    """Measured size of a table: text length of every cell plus a per-row overhead.

    One aggregation over the lookup side only; the estimate of the optimizer is not
    trusted, because it is derived from compressed file sizes.
    """
    width = reduce(
        lambda a, b: a + b,
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns),
    )
    total = df.agg(F.sum(width + F.lit(ROW_OVERHEAD)).alias("n")).first()["n"]
    return int(total or 0)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return measured_bytes(df) <= limit


def _filler(spread: Column) -> Column:
    """Key of a row without a lookup: matches nothing and spreads over all partitions."""
    return F.concat(F.lit("\x00"), spread.cast("string"))


@dataclass(frozen=True)
class KeyTable:
    """Dimension table made ready for lookups: measured once, used by many batches."""

    payload: DataFrame
    values: tuple[str, ...]
    small: bool
    salt_buckets: int


def prepare_keys(
    table: DataFrame, key: str, values: list[str], *,
    broadcast_limit: int = BROADCAST_LIMIT, salt_buckets: int = SALT_BUCKETS,
) -> KeyTable:
    """Lookup rows of a dimension table whose ``key`` is unique.

    A table within ``broadcast_limit`` (measured) is broadcast; a bigger one is repeated
    per salt, so that the shuffle join can spread a hot key over ``salt_buckets`` tasks.
    """
    payload = table.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("_tk"), F.struct(*values, F.lit(True).alias("found")).alias("_tv")
    )
    small = fits_broadcast(table.select(key, *values), broadcast_limit)
    if not small:
        payload = payload.withColumn("_ts", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return KeyTable(payload, tuple(values), small, salt_buckets)


def left_lookup(rows: DataFrame, table: KeyTable, keys: dict[str, Column], spread: Column) -> DataFrame:
    """Adds one struct column per entry of ``keys``, NULL when unmatched.

    Every row comes out once.  Beyond the broadcast limit the join shuffles on (key, salt),
    at the price of one copy of the much smaller lookup row per salt.
    """
    for name, key in keys.items():
        if table.small:
            joined = rows.withColumn("_k", key).join(
                F.broadcast(table.payload), F.col("_k") == F.col("_tk"), "left"
            )
        else:
            joined = (
                rows.withColumn("_k", F.coalesce(key, _filler(spread)))
                .withColumn("_s", F.pmod(spread, F.lit(table.salt_buckets)).cast("int"))
                .join(
                    table.payload.hint("merge"),
                    (F.col("_k") == F.col("_tk")) & (F.col("_s") == F.col("_ts")),
                    "left",
                )
            )
        rows = joined.withColumn(name, F.col("_tv")).drop("_k", "_s", "_tk", "_ts", "_tv")
    return rows


def ip_number(address: Column) -> Column:
    """IPv4 text as BIGINT, NULL for anything else."""
    quad = r"^([0-9]{1,3})[.]([0-9]{1,3})[.]([0-9]{1,3})[.]([0-9]{1,3})$"
    parts = [F.regexp_extract(address, quad, i).try_cast("bigint") for i in (1, 2, 3, 4)]
    ok = reduce(lambda a, b: a & b, (p <= 255 for p in parts))
    return F.when(
        ok, parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3]
    )


# Bucket widths tried for a range table, coarse to fine (bits cut off the address).
BUCKET_SHIFTS = (16, 14, 12, 10, 8, 6, 4)


def bucket_shift(blocks: DataFrame) -> int:
    """Finest bucket width whose exploded table stays within 4 rows per block.

    A finer bucket means fewer candidate blocks per looked-up address; the count of
    bucket rows is measured for all widths in one aggregation over the blocks.
    """
    spans = [
        F.sum(F.shiftright("end_ip", s) - F.shiftright("start_ip", s) + 1).alias(f"s{s}")
        for s in BUCKET_SHIFTS
    ]
    sizes = blocks.agg(F.count(F.lit(1)).alias("n"), *spans).first()
    allowed = max(4 * (sizes["n"] or 0), 1 << 18)
    fitting = [s for s in BUCKET_SHIFTS if (sizes[f"s{s}"] or 0) <= allowed]
    return min(fitting, default=BUCKET_SHIFTS[0])


@dataclass(frozen=True)
class RangeTable:
    """Range table cut into buckets and made ready for lookups."""

    cut: DataFrame
    shift: int
    small: bool
    salt_buckets: int


def prepare_ranges(
    blocks: DataFrame, values: list[str], *,
    broadcast_limit: int = BROADCAST_LIMIT, salt_buckets: int = SALT_BUCKETS,
) -> RangeTable:
    """Buckets of disjoint ``[start_ip, end_ip]`` blocks, measured once.

    Each block is cut into buckets of equal width, which gives the join an equality key.
    """
    shift = bucket_shift(blocks)
    cut = blocks.select(
        F.explode(F.sequence(F.shiftright("start_ip", shift), F.shiftright("end_ip", shift))).alias("_tb"),
        F.col("start_ip").alias("_lo"),
        F.col("end_ip").alias("_hi"),
        F.struct(*values).alias("_tv"),
    )
    small = fits_broadcast(cut.select("_tb", "_lo", "_hi", "_tv.*"), broadcast_limit)
    if not small:
        cut = cut.withColumn("_ts", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return RangeTable(cut, shift, small, salt_buckets)


def range_lookup(rows: DataFrame, table: RangeTable, addresses: dict[str, Column], spread: Column) -> DataFrame:
    """Adds one struct column per address with the values of the covering block.

    The range test stays inside the join condition, so uncovered rows survive.  An open
    range join would be a nested loop.
    """
    for name, address in addresses.items():
        rows = rows.withColumn("_ip", ip_number(address))
        inside = F.col("_ip").between(F.col("_lo"), F.col("_hi"))
        bucket = F.shiftright("_ip", table.shift)
        if table.small:
            joined = rows.withColumn("_b", bucket).join(
                F.broadcast(table.cut), (F.col("_b") == F.col("_tb")) & inside, "left"
            )
        else:
            # Rows without an address take scattered negative buckets, which match nothing.
            scattered = -1 - F.pmod(spread, F.lit(1 << 20))
            joined = (
                rows.withColumn("_b", F.coalesce(bucket, scattered))
                .withColumn("_s", F.pmod(spread, F.lit(table.salt_buckets)).cast("int"))
                .join(
                    table.cut.hint("merge"),
                    (F.col("_b") == F.col("_tb")) & (F.col("_s") == F.col("_ts")) & inside,
                    "left",
                )
            )
        rows = joined.withColumn(name, F.col("_tv")).drop(
            "_ip", "_b", "_s", "_tb", "_ts", "_lo", "_hi", "_tv"
        )
    return rows
