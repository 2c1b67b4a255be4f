"""The set of stream sinks as a versioned table that each micro-batch brings up to date.

Version N of the table is what batch N runs with. It is merged from the version before and from the
configuration as it reads at that moment: a sink that is new is added, one that is gone is dropped, a higher
version replaces the old one, a lower one is rejected, as are settings that can't be used. A batch that runs
again finds its version and keeps to it, so it sends its rows to the same streams.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.operators.fanout import settings_problem
from eventloom.operators.snapshots import merged_snapshot
from eventloom.sources.configs import SINK_KEYS
from eventloom.sources.files import drop_folder, folder_names, path_exists

log = logging.getLogger(__name__)

#: Lower than any version: settings that can't be used never replace a sink.
UNUSABLE = -1


@dataclass
class SinkTable:
    """``load`` reads the configured sinks (``read_sink_configs``); ``keep`` versions stay in the folder."""

    path: str
    load: Callable[[SparkSession], DataFrame]
    keep: int = 20

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _versions(self, spark: SparkSession) -> list[int]:
        """Complete versions, oldest first."""
        names = folder_names(spark, self.path) if path_exists(spark, self.path) else []
        found = sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))
        return [v for v in found if path_exists(spark, f"{self._folder(v)}/_SUCCESS")]

    def changes(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """``account, stream_type, stream_name, action, problem, stream_role, version, settings`` of a batch's
        merge; the settings are those in force after it, NULL for a sink that has none."""
        return spark.read.parquet(self._folder(batch_id))

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """``settings`` of the sinks the batch runs with."""
        versions = self._versions(spark)
        if batch_id not in versions:
            before = max((v for v in versions if v < batch_id), default=None)
            try:
                self._merge(spark, before, batch_id)
            except Exception:
                if before is None:
                    raise
                # The sinks stay as they were until the configuration can be read again.
                log.exception("reading the sinks of batch %s failed", batch_id)
                self.changes(spark, before).where("settings is not null").withColumn("action", F.lit("KEEP")).write.mode(
                    "overwrite").parquet(self._folder(batch_id))
            for old in versions[: -self.keep]:
                drop_folder(spark, self._folder(old))
        return self.changes(spark, batch_id).where("settings is not null")

    def _merge(self, spark: SparkSession, before: int | None, batch_id: int) -> None:
        # Keys that are left out have a default, so that they meet in the join.
        incoming = self.load(spark).fillna({"account": 0, "stream_type": "stream", "stream_name": ""})
        problem = settings_problem(F.col("settings"))
        # Of one sink listed twice the higher version counts.
        usable = F.when(problem.isNull(), F.coalesce("version", F.lit(0))).otherwise(UNUSABLE)
        rows = incoming.select(*SINK_KEYS, "stream_role", usable.alias("version"), problem.alias("problem"), "settings")
        new = rows.groupBy(*SINK_KEYS).agg(F.max_by(F.struct("stream_role", "version", "problem", "settings"), "version").alias("s"))
        new = new.select(*SINK_KEYS, "s.*")
        if before is None:
            old = new.where(F.lit(False))
        else:
            old = self.changes(spark, before).where("settings is not null").select(*new.columns)
        merged = merged_snapshot(old, new, SINK_KEYS)
        told = F.when(F.col("action") == "DROP", F.col("old.problem")).otherwise(F.col("new.problem"))
        unusable = F.col("action").isin("ADD", "KEEP", "REPLACE") & (F.col("row.version") == UNUSABLE)
        in_force = F.when(~unusable & F.col("row").isNotNull(), F.col("row"))
        out = merged.select(
            *SINK_KEYS, F.when(unusable, "REJECT").otherwise(F.col("action")).alias("action"), told.alias("problem"),
            in_force["stream_role"].alias("stream_role"), in_force["version"].alias("version"), in_force["settings"].alias("settings"))
        out.write.mode("overwrite").parquet(self._folder(batch_id))
