"""Deduplication across micro-batches in Spark's state store, bounded by a watermark."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

LOG = "batch bigint, n_input bigint, n_output bigint, n_duplicates bigint, n_late bigint, n_state_rows bigint, watermark string"


@dataclass(frozen=True)
class DedupedIngest:
    """First arrival of every key, written once.

    A key is remembered until the watermark, the newest event time less ``delay``, has passed the event time of its first
    row by ``delay``; so a redelivered row is either recognised or older than the watermark and then late. Late rows aren't
    written, as they can't be told from duplicates any more, but they are counted in the log, and so are duplicates and the
    keys held. A batch has its own folder, which a replay overwrites. Times up to the epoch are late from the
    start, as are rows without a time; null keys are one key.
    """

    path: str
    keys: tuple[str, ...]
    time: str
    delay: str

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Process everything available, then stop; a later run goes on with the checkpoint's keys and watermark."""
        spark = stream.sparkSession
        kept = stream.observe("arrived", F.count(F.lit(1)).alias("n")).withWatermark(self.time, self.delay).dropDuplicatesWithinWatermark(list(self.keys))
        query = kept.writeStream.foreachBatch(self._write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        self._log(spark, [json.loads(p.json) for p in query.recentProgress])

    def _log(self, spark: SparkSession, progress: Sequence[dict]) -> None:
        """A row for each micro-batch, from the figures that the engine reports of it."""
        rows = []
        for p in progress:
            for state in p.get("stateOperators", []):
                n_input = int((p.get("observedMetrics") or {}).get("arrived", {}).get("n") or 0)
                late = int(state.get("numRowsDroppedByWatermark") or 0)
                repeated = int((state.get("customMetrics") or {}).get("numDroppedDuplicateRows") or 0)
                mark = (p.get("eventTime") or {}).get("watermark")
                rows.append((int(p["batchId"]), n_input, n_input - late - repeated, repeated, late, int(state.get("numRowsTotal") or 0), mark))
        if rows:
            out = spark.createDataFrame(rows, LOG).coalesce(1)
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.path}/log")

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LOG).parquet(f"{self.path}/log")
