"""Streaming jobs: ingest with quarantine, and keyed current state.

Both drain what is available and stop. A micro-batch may be replayed after a failure, so every
write lands in a folder named after the batch id and overwrites itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.cdc import decode_events
from tidemark.operators.quality import QualityGateError, require_unique
from tidemark.operators.upsert import latest_per_key, merge_changes
from tidemark.sources.contracts import LANDING, TableConfig
from tidemark.sources.landing import normalise_landing
from tidemark.sources.sinks import balanced, split_marked, with_reason


def drain(stream: DataFrame, on_batch, checkpoint: str) -> None:
    """Process everything available in micro-batches, then stop."""
    (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


@dataclass(frozen=True)
class BronzeIngest:
    """Landed events to one table per source plus a quarantine table."""

    bronze_path: str
    quarantine_path: str

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        held = with_reason(batch).persist()
        try:
            good, bad = split_marked(held, F.current_timestamp())
            balanced(good, ["table_name"]).write.mode("overwrite").partitionBy("table_name").parquet(f"{self.bronze_path}/batch={batch_id}")
            bad.write.mode("overwrite").parquet(f"{self.quarantine_path}/batch={batch_id}")
        finally:
            held.unpersist()

    def run(self, events: DataFrame, checkpoint: str) -> None:
        drain(events, self.write_batch, checkpoint)


@dataclass(frozen=True)
class CurrentStateStream:
    """Keyed upsert of change events into a current-state table.

    A micro-batch only writes its own latest change per key, so its cost follows the batch and
    not the table. Reading merges the pending changes into the last compacted base; ``compact``
    stores that merge as the next base and records it in a manifest, which is the only thing
    readers trust. All order columns are kept in the table, so a late event cannot undo a newer one; a
    deleted key leaves a marker for the same reason.
    """

    config: TableConfig
    path: str
    schema: T.StructType

    def _no_changes(self, spark: SparkSession) -> DataFrame:
        """No rows, in the layout of the changes."""
        return decode_events(normalise_landing(spark.createDataFrame([], LANDING)), self.config)

    def _stored(self, spark: SparkSession) -> T.StructType:
        """Layout of the base: the table, all order columns, and the marker of deleted keys."""
        order = [f for f in self._no_changes(spark).schema.fields if f.name in self._order]
        own = [f for f in self.schema.fields if f.name not in self._order]
        return T.StructType([*own, *order, T.StructField("_deleted", T.BooleanType())])

    @property
    def _order(self) -> list[str]:
        return list(dict.fromkeys(["event_ts_ms", *self.config.dedupe_order_columns]))

    def create(self, spark: SparkSession) -> None:
        """Lay down an empty table; does nothing when it exists."""
        spark.createDataFrame([(-1,)], "version bigint").write.mode("ignore").parquet(f"{self.path}/manifest")
        self._no_changes(spark).write.mode("ignore").parquet(f"{self.path}/changes/batch=-1")

    def _version(self, spark: SparkSession) -> int:
        return spark.read.parquet(f"{self.path}/manifest").agg(F.max("version")).first()[0]

    def _base(self, spark: SparkSession, version: int) -> DataFrame:
        if version < 0:
            return spark.createDataFrame([], self._stored(spark))
        return spark.read.schema(self._stored(spark)).parquet(f"{self.path}/base/version={version}")

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Publish the batch's latest change of each key; a change without a key fails the batch before that."""
        keys = list(self.config.primary_keys)
        changes = decode_events(batch, self.config).persist()
        try:
            if not changes.filter(reduce(or_, [F.col(k).isNull() for k in keys])).isEmpty():
                raise QualityGateError(f"{self.config.name}: changes with null keys on {keys}")
            latest = latest_per_key(changes, keys, self.config.dedupe_order_columns)
            latest.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch_id}")
        finally:
            changes.unpersist()

    def _merged(self, spark: SparkSession, version: int) -> DataFrame:
        keys = list(self.config.primary_keys)
        pending = spark.read.parquet(f"{self.path}/changes").filter(F.col("batch") > version).drop("batch")
        latest = latest_per_key(pending, keys, self.config.dedupe_order_columns).withColumns(
            {"_deleted": F.col("op") == "d", "op": F.lit("u")}
        )
        return merge_changes(self._base(spark, version), latest, keys, order_column=self.config.dedupe_order_columns)

    def compact(self, spark: SparkSession) -> None:
        """Fold all pending changes into a new base."""
        version = self._version(spark)
        newest = spark.read.parquet(f"{self.path}/changes").agg(F.max("batch")).first()[0]
        if newest is None or newest <= version:
            return
        self._merged(spark, version).write.mode("overwrite").parquet(f"{self.path}/base/version={newest}")
        require_unique(self._base(spark, newest), list(self.config.primary_keys), self.config.name)
        spark.createDataFrame([(newest,)], "version bigint").write.mode("append").parquet(f"{self.path}/manifest")

    def read(self, spark: SparkSession) -> DataFrame:
        """Current rows, pending changes included."""
        return self._merged(spark, self._version(spark)).filter("not _deleted").drop(
            "_deleted", *[c for c in self._order if c != "event_ts_ms" and c not in self.schema.names]
        )

    def run(self, events: DataFrame, checkpoint: str) -> None:
        self.create(events.sparkSession)
        drain(events, self.write_batch, checkpoint)
