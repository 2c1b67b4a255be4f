"""Batches bounded by bytes and entries, exactly as one pass over a whole stream would cut them.

The rule is sequential: an entry opens a new batch if it would push the open one over its bytes or its
count; one that is larger than a batch goes alone. What a slice of the stream does to an open batch
depends only on where its first cut falls: from there on, the cuts follow. So a slice is summed up as a
*table*: for each place the first cut can fall (no further than a fresh batch reaches), the open batch at
the end of the slice and the number of cuts. Tables of ``FAN`` neighbours are composed into one of the same form,
level by level, until one is left for each stream; then the open batch at the start of every slice follows
on the way down, and each slice is cut on its own. No task sees more than a slice or ``FAN`` tables, and no
batch is cut short by the end of a partition.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.operators.pack import NO_LIMIT
from eventloom.session import shared_folder

#: Tables composed at once.
FAN = 64
_UNBOUNDED = np.iinfo(np.int64).max // 4
_TABLE = "stream string, rank bigint, size bigint, entries bigint, n bigint, total bigint, ends array<bigint>, bytes array<bigint>, count array<bigint>, cuts array<bigint>"
_STATE = "stream string, rank bigint, left bigint, open bigint, batch bigint"


class _Table:
    """A slice of n entries of ``total`` bytes: ``ends[j]`` are the bytes up to and with entry j, for entries
    j a first cut can fall before; then ``bytes``, ``count`` of the open batch at the end and all ``cuts``."""

    def __init__(self, n, total, ends, left, count, cuts):
        self.n, self.total, self.ends, self.bytes, self.count, self.cuts = n, total, ends, left, count, cuts

    def after(self, left: np.ndarray, count: np.ndarray, cuts: np.ndarray, size: int, entries: int):
        """(bytes, count, cuts) at the end for open batches at the start; vectors."""
        first = np.minimum(np.searchsorted(self.ends, size - left, side="right"), entries - count)
        # A batch without entries takes one of any size.
        first = np.where(count == 0, np.maximum(first, 1), first)
        cut = first < len(self.ends)
        at = np.minimum(first, max(len(self.ends) - 1, 0))
        if not len(self.ends):
            return left + self.total, count + self.n, cuts
        return (np.where(cut, self.bytes[at], left + self.total), np.where(cut, self.count[at], count + self.n),
                cuts + np.where(cut, self.cuts[at], 0))


def _of_sizes(sizes: np.ndarray, size: int, entries: int) -> _Table:
    """The table of a slice from the bytes of its entries."""
    n, ends = len(sizes), np.cumsum(sizes)
    begins = ends - sizes
    # Where the batch that starts at entry i ends, from the last entry back.
    following = np.minimum(np.searchsorted(ends, begins + size, side="right"), np.arange(n) + min(entries, n + 1))
    following = np.maximum(following, np.arange(n) + 1)
    left, count, cuts = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    total = int(ends[-1]) if n else 0
    for i in range(n - 1, -1, -1):
        j = following[i]
        if j >= n:
            left[i], count[i], cuts[i] = total - begins[i], n - i, 1
        else:
            left[i], count[i], cuts[i] = left[j], count[j], cuts[j] + 1
    # A fresh batch reaches no further than from entry 0, and an open one not further than that.
    reach = min(n, int(following[0]) + 1) if n else 0
    return _Table(n, total, ends[:reach], left[:reach], count[:reach], cuts[:reach])


def _composed(tables: list[_Table], size: int, entries: int) -> _Table:
    """The table of neighbouring slices as one."""
    whole = tables[0]
    for table in tables[1:]:
        left, count, cuts = table.after(whole.bytes, whole.count, whole.cuts, size, entries)
        ends = whole.ends
        if len(whole.ends) == whole.n:  # a first cut may fall in the next slice as well
            ends = np.append(ends, table.ends + whole.total)
            left, count, cuts = np.append(left, table.bytes), np.append(count, table.count), np.append(cuts, table.cuts)
        whole = _Table(whole.n + table.n, whole.total + table.total, ends, left, count, cuts)
        fresh = np.searchsorted(whole.ends, size, side="right")
        reach = int(min(len(whole.ends), max(min(fresh, entries), 1) + 1))
        whole = _Table(whole.n, whole.total, whole.ends[:reach], whole.bytes[:reach], whole.count[:reach], whole.cuts[:reach])
    return whole


def _most(entries: int) -> int:
    return _UNBOUNDED if entries == NO_LIMIT else entries


def _row(table: _Table, stream: str | None, rank: int, size: int, entries: int) -> pa.Table:
    lists = [pa.array([v.tolist()], pa.list_(pa.int64())) for v in (table.ends, table.bytes, table.count, table.cuts)]
    whole = [pa.array([v], pa.int64()) for v in (rank, size, entries, table.n, table.total)]
    return pa.table([pa.array([stream], pa.string()), *whole, *lists], [f.split()[0] for f in _TABLE.split(", ")])


def _tables(group: pa.Table) -> list[tuple[int, _Table]]:
    rows = group.select([f.split()[0] for f in _TABLE.split(", ")]).sort_by("rank").to_pylist()
    lists = ("ends", "bytes", "count", "cuts")
    return [(r["rank"], _Table(r["n"], r["total"], *(np.array(r[c], np.int64) for c in lists))) for r in rows]


def _summed(group: pa.Table) -> pa.Table:
    """The table of one slice."""
    group = group.sort_by("_place")
    size, entries = group.column("_size")[0].as_py(), group.column("_entries")[0].as_py()
    table = _of_sizes(group.column("_bytes").to_numpy(), size, _most(entries))
    return _row(table, group.column("_stream")[0].as_py(), group.column("_rank")[0].as_py(), size, entries)


def _compose(group: pa.Table) -> pa.Table:
    """Up to ``FAN`` neighbouring tables as one."""
    size, entries, found = group.column("size")[0].as_py(), group.column("entries")[0].as_py(), _tables(group)
    whole = _composed([t for _, t in found], size, _most(entries))
    return _row(whole, group.column("stream")[0].as_py(), group.column("_up")[0].as_py(), size, entries)


def _descend(group: pa.Table) -> pa.Table:
    """The open batch at the start of each table, from the one at the start of them all."""
    size, entries = group.column("size")[0].as_py(), _most(group.column("entries")[0].as_py())
    state = tuple(np.array([group.column(c)[0].as_py()]) for c in ("left", "open", "batch"))
    out = []
    for rank, table in _tables(group):
        out.append((group.column("stream")[0].as_py(), rank, *(int(v[0]) for v in state)))
        state = table.after(*state, size, entries)
    kinds = [pa.string(), *[pa.int64()] * 4]
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)], [f.split()[0] for f in _STATE.split(", ")])


def _cut(group: pa.Table) -> pa.Table:
    """The rule itself, within a slice, from the open batch at its start."""
    group = group.sort_by("_place")
    size, entries = group.column("_size")[0].as_py(), _most(group.column("_entries")[0].as_py())
    left, count, batch = (group.column(c)[0].as_py() for c in ("left", "open", "batch"))
    numbers = np.empty(group.num_rows, np.int64)
    for k, own in enumerate(group.column("_bytes").to_pylist()):
        if count and (count >= entries or left + own > size):
            left, count, batch = 0, 0, batch + 1
        left, count = left + own, count + 1
        numbers[k] = batch
    return pa.table([group.column("_stream"), group.column("_order"), pa.array(numbers)], ["_stream", "_order", "_batch"])


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def exact_batches(
    rows: DataFrame, stream: str, order: list[str], slice_of: Column, bytes_of: Column,
    max_size: Column, max_entries: Column, number: str = "batch_no",
) -> DataFrame:
    """``rows`` with the number (from 0) of the batch each falls in, in ``order`` within its ``stream``.

    ``slice_of`` is a non-decreasing function of the order whose slices fit in a task; ``max_size`` (bytes)
    and ``max_entries`` (-1: no limit) hold one value for a stream. ``order`` must tell rows apart. Null
    sizes count as 0 bytes; an empty table gives no rows.
    """
    keyed = rows.withColumn("_stream", F.col(stream).cast("string")).withColumn("_slice", slice_of)
    slim = keyed.select(
        "_stream", "_slice", F.struct(*order).alias("_order"), F.coalesce(bytes_of, F.lit(0)).cast("bigint").alias("_bytes"),
        max_size.cast("bigint").alias("_size"), max_entries.cast("bigint").alias("_entries"))
    # Slices in order; the window holds a row per slice, not per entry.
    slices = slim.groupBy("_stream", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    ranked = slices.withColumn("_rank", F.row_number().over(Window.partitionBy("_stream").orderBy("_slice")).cast("bigint") - 1)
    ranked = ranked.select(F.col("_stream").alias("_s"), F.col("_slice").alias("_c"), "_rank")
    same = F.col("_stream").eqNullSafe(F.col("_s")) & F.col("_slice").eqNullSafe(F.col("_c"))
    slim = slim.join(ranked, same).select("_stream", "_rank", "_order", "_bytes", "_size", "_entries")
    # Sorted within (stream, slice): an entry's place in its slice.
    place = F.row_number().over(Window.partitionBy("_stream", "_rank").orderBy("_order")).cast("bigint") - 1
    slim = _kept(slim.withColumn("_place", place), "batch-entries")

    levels = [_kept(slim.drop("_order").groupBy("_stream", "_rank").applyInArrow(_summed, _TABLE), "batch-tables")]
    while (levels[-1].agg(F.max("rank")).first()[0] or 0) > 0:
        groups = levels[-1].withColumn("_up", F.expr(f"rank div {FAN}")).groupBy("stream", "_up")
        levels.append(_kept(groups.applyInArrow(_compose, _TABLE), "batch-tables"))
    zero = F.lit(0).cast("bigint")
    states = levels[-1].select("stream", "rank", zero.alias("left"), zero.alias("open"), zero.alias("batch"))
    for tables in reversed(levels[:-1]):
        above = states.select(F.col("stream").alias("_s"), F.col("rank").alias("_r"), "left", "open", "batch")
        below = tables.withColumn("_up", F.expr(f"rank div {FAN}"))
        met = below.join(above, F.col("stream").eqNullSafe(F.col("_s")) & (F.col("_up") == F.col("_r"))).drop("_s", "_r")
        states = _kept(met.groupBy("stream", "_up").applyInArrow(_descend, _STATE), "batch-starts")

    started = slim.join(states, F.col("_stream").eqNullSafe(F.col("stream")) & (F.col("_rank") == F.col("rank"))).drop("stream", "rank")
    shape = f"_stream string, _order {slim.schema['_order'].dataType.simpleString()}, _batch bigint"
    numbers = started.groupBy("_stream", "_rank").applyInArrow(_cut, shape)
    numbers = numbers.select(F.col("_stream").alias("_s"), F.col("_order").alias("_o"), F.col("_batch").alias(number))
    return keyed.withColumn("_order", F.struct(*order)).join(
        numbers, F.col("_stream").eqNullSafe(F.col("_s")) & (F.col("_order") == F.col("_o"))).drop("_stream", "_slice", "_order", "_s", "_o")
