"""Tables of period folders whose content changes in one step.

Data folders are written once and never changed. A version is a small file that lists the folders of the
table and its columns; the current version is the one with the highest number. A change writes new
data folders first, beside the old ones, and then commits by renaming its version file into place, which
either happens or does not. So a reader sees the table before or after a change, never between, and a
change that breaks off leaves nothing but unused folders. Two writers that start from one version can't both
commit: the second is told and starts again from the new version.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventloom.sources.files import drop_folder, folder_names, path_exists, read_file, write_new_file

VERSIONS = "_versions"


class VersionConflict(RuntimeError):
    """Another change was committed meanwhile."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: StructType
    #: Relative folders by period text; a period may have several.
    folders: dict[str, list[str]]


def _folder_text(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


@dataclass
class VersionedTable:
    """A table at ``path`` with a folder per ``period`` (a column like ``day``, text of the date of ``time``).

    ``pattern`` gives the period's text, ``yyyy-MM-dd`` for days, ``yyyy-MM`` for months.
    """

    path: str
    time: str = "time"
    period: str = "day"
    pattern: str = "yyyy-MM-dd"

    def period_of(self, time: Column) -> Column:
        return F.date_format(time, self.pattern)

    def _with_period(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.period, self.period_of(F.col(self.time)))

    # ------------------------------------------------------------ versions

    def current(self, spark: SparkSession) -> Version | None:
        """The last committed version; a plain table with ``period=…`` folders is version 0."""
        folder = f"{self.path}/{VERSIONS}"
        names = folder_names(spark, folder) if path_exists(spark, folder) else []
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if numbers:
            found = json.loads(read_file(spark, f"{folder}/{max(numbers)}.json"))
            return Version(max(numbers), StructType.fromJson(found["schema"]), found["folders"])
        prefix = f"{self.period}="
        plain = [n for n in folder_names(spark, self.path) if n.startswith(prefix)] if path_exists(spark, self.path) else []
        if not plain:
            return None
        read = spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{n}" for n in plain])
        schema = StructType([f for f in read.schema if f.name != self.period])
        return Version(0, schema, {n.removeprefix(prefix): [n] for n in plain})

    def _commit(self, spark: SparkSession, number: int, schema: StructType, folders: dict[str, list[str]]) -> Version:
        text = json.dumps({"schema": json.loads(schema.json()), "folders": folders}, sort_keys=True)
        if not write_new_file(spark, f"{self.path}/{VERSIONS}/{number}.json", text):
            raise VersionConflict(f"version {number} of {self.path} was committed by another change")
        return Version(number, schema, folders)

    # ------------------------------------------------------------ reading

    def read(self, spark: SparkSession, version: Version | None = None, first: str = "", last: str = "￿") -> DataFrame:
        """Rows of the periods ``first`` to ``last`` (texts); only their folders are listed."""
        version = version or self.current(spark)
        if version is None:
            raise ValueError(f"no table at {self.path}")
        chosen = [f"{self.path}/{f}" for p, folders in sorted(version.folders.items()) if first <= p <= last for f in folders]
        if not chosen:
            return spark.createDataFrame([], version.schema)
        return spark.read.schema(version.schema).parquet(*chosen)

    # ------------------------------------------------------------ changing

    def _stage(self, rows: DataFrame, run_tag: str) -> dict[str, list[str]]:
        """Write rows to new folders; the folders by period. A lost executor costs its tasks only."""
        spark, run = rows.sparkSession, f"data/{run_tag}-{uuid.uuid4().hex}"
        staged = self._with_period(rows)
        staged.hint("rebalance", self.period).write.partitionBy(self.period).parquet(f"{self.path}/{run}")
        names = [n for n in folder_names(spark, f"{self.path}/{run}") if n.startswith(f"{self.period}=")]
        return {n.removeprefix(f"{self.period}="): [f"{run}/{n}"] for n in names}

    def append(self, rows: DataFrame, run_tag: str = "append") -> Version:
        """Rows added to what is there; creates the table."""
        spark = rows.sparkSession
        old = self.current(spark)
        added = self._stage(rows.select(*old.schema.names) if old else rows, run_tag)
        folders = {p: [*f] for p, f in old.folders.items()} if old else {}
        for p, new in added.items():
            folders.setdefault(p, []).extend(new)
        return self._commit(spark, old.number + 1 if old else 1, old.schema if old else rows.schema, folders)

    def replace(
        self, spark: SparkSession, inside: Column, start: datetime, end: datetime, replayed: DataFrame | None, run_tag: str
    ) -> tuple[int, int]:
        """Replace the rows ``inside`` holds for, all in the periods of ``start`` to ``end``, by those of
        ``replayed`` it holds for: (rows deleted, rows inserted). One job writes the periods it touches, one
        counts; every other period keeps its folders."""
        old = self.current(spark)
        if old is None:
            raise ValueError(f"no table at {self.path}")
        text = lambda t: spark.range(1).select(self.period_of(F.lit(t))).first()[0]
        first, last = text(start), text(end)
        touched = [p for p in old.folders if first <= p <= last]
        before = self.read(spark, old, first, last)
        after = before.where(~inside)
        if replayed is not None:
            after = after.unionByName(replayed.select(*old.schema.names).where(inside))
        written = self._stage(after, run_tag)
        new = Version(old.number + 1, old.schema, {p: f for p, f in old.folders.items() if p not in touched} | written)
        # Counted from the folders, by the time column alone: metrics of the write get lost where it is empty.
        mark = lambda rows, sign: rows.where(inside).select(F.lit(sign).alias("sign"))
        both = mark(before, "-").unionByName(mark(self.read(spark, new, first, last), "+"))
        counts = {r["sign"]: r["count"] for r in both.groupBy("sign").count().collect()}
        self._commit(spark, new.number, new.schema, new.folders)
        return counts.get("-", 0), counts.get("+", 0)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Drop data runs that none of the last ``keep`` versions lists; not while a change is under way."""
        folder = f"{self.path}/{VERSIONS}"
        numbers = sorted((int(n.removesuffix(".json")) for n in folder_names(spark, folder) if n.endswith(".json")), reverse=True)
        used = set()
        for number in numbers[:keep]:
            for folders in json.loads(read_file(spark, f"{folder}/{number}.json"))["folders"].values():
                used.update(f.split("/")[1] for f in folders if f.startswith("data/"))
        unused = [n for n in folder_names(spark, f"{self.path}/data") if n not in used]
        for name in unused:
            drop_folder(spark, f"{self.path}/data/{name}")
        return unused
