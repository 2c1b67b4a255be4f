"""Lookups of 128-bit addresses in blocks that may lie inside each other; the most specific block wins.

An address of either family is a key of 32 hexadecimal digits, an IPv4 address in the range IPv6 sets aside
for it. A block, any range of keys, is cut into the fewest prefixes that make it up. A prefix is filed
under its whole bytes, so that an address finds it by equality at one of 17 levels at most; only
levels the table uses are looked up. What lies under one key is a short list (255 prefixes at most), from
the narrowest prefix on. Of nested blocks the inner one has the narrower prefix, so the first prefix of the
deepest level that holds the address is the most specific block's; equal prefixes go to the narrower block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.variants import let, pinned
from eventloom.operators.lookups import BROADCAST_LIMIT, SALT_BUCKETS, KeyTable, left_lookup, prepare_keys

BITS, DIGITS = 128, 32
#: Fixed value: what stands before an IPv4 address among the IPv6 ones.
IPV4_PREFIX = "0" * 20 + "ffff"


def _quad_hex(quad: Column) -> Column:
    """Eight digits of four decimal bytes; NULL if one is none."""
    parts = F.split(quad, r"\.")
    one = lambda p: F.when(p.rlike("^[0-9]{1,3}$") & (p.cast("int") <= 255), F.lpad(F.lower(F.hex(p.cast("long"))), 2, "0"))
    digits = F.array_join(F.transform(parts, one), "")
    return F.when((F.size(parts) == 4) & (F.length(digits) == 8), digits)


def address_key(text: Column) -> Column:
    """Key of an IPv4 or IPv6 text, NULL for anything else."""
    none = F.array().cast("array<string>")
    groups = lambda side: F.when(side == "", none).otherwise(F.split(side, ":"))

    def of_sides(sides: Column) -> Column:
        left, right = groups(F.get(sides, F.lit(0))), groups(F.coalesce(F.get(sides, F.lit(1)), F.lit("")))
        return let(F.concat(left, right), lambda given: let(
            F.when((F.size(sides) == 2) & (F.size(given) < 8), F.concat(left, F.array_repeat(F.lit("0"), 8 - F.size(given)), right)).when(
                (F.size(sides) == 1) & (F.size(given) == 8), given),
            lambda whole: F.when(
                F.forall(whole, lambda g: g.rlike("^[0-9a-f]{1,4}$")), F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), ""))))

    def of_text(t: Column) -> Column:
        # An address in dots at the end of an IPv6 text is its last two groups.
        return let(F.regexp_extract(t, r"([0-9]+\.[0-9.]+)$", 1), lambda tail: let(_quad_hex(tail), lambda quad: F.when(
            t.contains(":"),
            let(F.split(F.when(tail == "", t).otherwise(F.concat(
                F.substring(t, F.lit(1), F.length(t) - F.length(tail)), F.substring(quad, 1, 4), F.lit(":"), F.substring(quad, 5, 4))), "::"), of_sides),
        ).otherwise(F.when(t == tail, F.concat(F.lit(IPV4_PREFIX), quad)))))

    return let(F.lower(text), of_text)


def address_blocks(raw: DataFrame, first: str = "start_ip", last: str = "end_ip") -> tuple[DataFrame, DataFrame]:
    """(blocks with keys ``lo`` and ``hi``, rows whose bounds can't be read): the second is for counting, no
    block is lost silently. Bounds are texts, IPv4 numbers, or a network like ``2001:db8::/32`` in ``first``."""
    def bound(c: str) -> Column:
        text = F.col(c).cast("string")
        number = F.when(text.rlike("^[0-9]{1,10}$") & (text.try_cast("long") < 1 << 32), F.lpad(F.lower(F.hex(text.try_cast("long"))), 8, "0"))
        return F.coalesce(F.concat(F.lit(IPV4_PREFIX), number), address_key(text))

    # Step by step, so that no step is written out in the next.
    net = F.split(F.col(first).cast("string"), "/")
    read = raw.withColumn("_net", net).withColumn("_base", pinned(address_key(F.get("_net", F.lit(0)))))
    length = F.get("_net", F.lit(1)).try_cast("int")
    shown = F.when(F.get("_net", F.lit(0)).contains(":"), length).otherwise(F.when(length <= 32, length + 96))
    read = read.withColumn("_length", F.when(shown.between(0, BITS), shown))
    # Whole digits of the network stay; of the digit that is cut its leading bits do.
    kept, bits = F.floor(F.col("_length") / 4).cast("int"), F.col("_length") % 4
    read = read.withColumn("_kept", kept).withColumn("_free", F.when(bits > 0, F.pow(F.lit(2), 4 - bits).cast("int")).otherwise(16))
    digit = F.conv(F.substring(F.col("_base"), F.col("_kept") + F.lit(1), F.lit(1)), 16, 10).cast("int")
    read = read.withColumn("_digit", pinned(F.when(bits > 0, digit - digit % F.col("_free"))))
    ends = lambda cut, fill: F.rpad(F.concat(
        F.substring(F.col("_base"), F.lit(1), F.col("_kept")), F.coalesce(F.lower(F.hex(cut.cast("long"))), F.lit(""))), DIGITS, fill)
    is_net = F.size("_net") == 2
    lo = F.when(is_net, ends(F.col("_digit"), "0")).otherwise(bound(first))
    hi = F.when(is_net, ends(F.col("_digit") + F.col("_free") - 1, "f")).otherwise(bound(last))
    read = read.withColumn("lo", pinned(lo)).withColumn("hi", pinned(hi)).drop("_net", "_base", "_length", "_kept", "_free", "_digit")
    sound = F.coalesce(F.col("lo") <= F.col("hi"), F.lit(False))
    return read.where(sound).drop(first, last), read.where(~sound).drop("lo", "hi")


def prefixes(low: int, high: int) -> list[tuple[int, int]]:
    """(first address, length in bits) of the fewest prefixes that make up a range."""
    out = []
    while low <= high:
        size = min((low & -low).bit_length() - 1 if low else BITS, (high - low + 1).bit_length() - 1)
        out.append((low, BITS - size))
        low += 1 << size
    return out


@dataclass(frozen=True)
class AddressTable:
    """Blocks cut into prefixes and made ready for lookups; ``levels`` are bytes of keys, deepest first."""

    keys: KeyTable
    levels: tuple[int, ...]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place, key, bits, lo, hi, size = [], [], [], [], [], []
        for k, (a, b) in enumerate(zip(batch.column("lo").to_pylist(), batch.column("hi").to_pylist())):
            width = int(b, 16) - int(a, 16)
            for first, length in prefixes(int(a, 16), int(b, 16)):
                digits = f"{first:032x}"
                place.append(k)
                key.append(f"{length // 8}:{digits[: length // 8 * 2]}")
                bits.append(length)
                lo.append(digits)
                hi.append(f"{first + (1 << BITS - length) - 1:032x}")
                size.append(f"{width:032x}")
        values = batch.column("value").take(pa.array(place, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.string()), pa.array(bits, pa.int32()), *(pa.array(c, pa.string()) for c in (lo, hi, size)), values],
            ["key", "length", "lo", "hi", "size", "value"])


def prepare_addresses(
    blocks: DataFrame, values: list[str], *, broadcast_limit: int = BROADCAST_LIMIT, salt_buckets: int = SALT_BUCKETS
) -> AddressTable:
    """Blocks ``lo, hi`` with ``values`` (texts), nested or not, ready for :func:`address_lookup`."""
    packed = blocks.select("lo", "hi", F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias("value"))
    cut = packed.mapInArrow(_cut, "key string, length int, lo string, hi string, size string, value string")
    # Of equal prefixes the narrower block's; then the narrowest prefixes first.
    own = cut.groupBy("key", "length", "lo", "hi").agg(F.min(F.struct("size", "value")).alias("best"))
    rows = own.groupBy("key").agg(F.to_json(F.transform(
        F.sort_array(F.collect_list(F.struct(F.col("length"), "lo", "hi", F.col("best.value").alias("value"))), asc=False),
        lambda b: F.struct(b["lo"].alias("lo"), b["hi"].alias("hi"), b["value"].alias("value")))).alias("blocks"))
    levels = [int(r[0]) for r in rows.select(F.split("key", ":")[0]).distinct().collect()]  # 17 at most
    keys = prepare_keys(rows, "key", ["blocks"], broadcast_limit=broadcast_limit, salt_buckets=salt_buckets)
    fields = ", ".join(f"`{v}` string" for v in values)
    return AddressTable(KeyTable(
        keys.payload.withColumn("_tv", F.struct(
            F.transform(F.from_json("_tv.blocks", "array<struct<lo:string,hi:string,value:string>>"), lambda b: F.struct(
                b["lo"].alias("lo"), b["hi"].alias("hi"), F.from_json(b["value"], fields).alias("value"))).alias("blocks"))),
        tuple(values), keys.small, keys.salt_buckets), tuple(sorted(levels, reverse=True)))


def address_lookup(rows: DataFrame, table: AddressTable, addresses: dict[str, Column], spread: Column) -> DataFrame:
    """Adds one struct column per address with the values of the most specific block; every row comes out once."""
    for name, address in addresses.items():
        rows = rows.withColumn("_address", pinned(address_key(address)))
        names = {f"_level{n}": F.concat(F.lit(f"{n}:"), F.substring("_address", 1, 2 * n)) for n in table.levels}
        rows = left_lookup(rows, table.keys, names, spread)
        inside = lambda n: F.get(F.filter(
            F.col(f"{n}.blocks"), lambda b: F.col("_address").between(b["lo"], b["hi"])), F.lit(0))["value"]
        found = [inside(n) for n in names]
        fields = ", ".join(f"{v}:string" for v in table.keys.values)
        rows = rows.withColumn(name, F.coalesce(*found) if found else F.lit(None).cast(f"struct<{fields}>")).drop("_address", *names)
    return rows
