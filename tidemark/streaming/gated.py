"""Ingest in which a micro-batch becomes visible only when its gates pass.

A batch is written once, good and unusable events side by side in their own partitions, and counted by an observation of
that write. From the stored batch come its schema drift against the contract and its volume against the published batches
before it. All four tables have a folder for each batch, which a replay overwrites. The manifest's row of the batch says
whether it is published; readers take events and quarantine only from published batches, while the drift and volume rows
of blocked ones stay readable, to see why.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from tidemark.operators import drift
from tidemark.operators.quality import QualityGateError
from tidemark.sources.sinks import balanced, with_reason
from tidemark.streaming.pipelines import drain

MANIFEST = "batch bigint, status string, n_events bigint, n_quarantined bigint, reasons string"
VOLUME = "batch bigint, table_name string, n_rows bigint, rolling_average double, status string"
DRIFT = (
    "batch bigint, table_name string, severity string, is_valid boolean, "
    "added_columns array<string>, removed_columns array<string>, type_changes array<string>, has_unparsed boolean"
)
#: Bytes of a row group of stored events, so that several tasks can parse the events of one file.
ROW_GROUP = 8 << 20
#: A batch's folder has the batch as a partition column.
IMAGES = ("$.payload.before", "$.payload.after")


@dataclass(frozen=True)
class GatedIngest:
    """Landed events to one table, partitioned by batch, usability and source table.

    ``contract`` holds (table, field, JSON type); a source without a contract isn't checked for drift. Volume statuses in
    ``volume_blocks`` block a batch: FAIL for a known source without events, WARN for one under ``fraction`` of its average
    over the last ``lookback`` published batches. So does a share of unusable events above ``most_unusable``. With
    ``on_block="stop"`` a blocked batch fails the stream, which replays it when it is started again, then under whatever
    policy and contract hold; with ``"skip"`` the stream goes on and the batch stays unpublished.
    """

    path: str
    contract: tuple[tuple[str, str, str], ...]
    policy: str = "additive_only"
    allow_additive: bool = False
    volume_blocks: tuple[str, ...] = ("FAIL",)
    lookback: int = 7
    fraction: float = 0.5
    most_unusable: float = 1.0
    on_block: str = "stop"

    def __post_init__(self):
        if self.on_block not in ("stop", "skip"):
            raise ValueError(f"on_block must be stop or skip, not {self.on_block!r}")

    @cached_property
    def _layout(self) -> T.StructType:
        """Columns of the event table as they are stored."""
        return T._parse_datatype_string(
            "topic string, partition int, offset bigint, message_key string, value string, kafka_timestamp timestamp, ingested_at timestamp, "
            "source_schema string, quarantine_reason string, batch bigint, usable boolean, table_name string")

    def create(self, spark: SparkSession) -> None:
        """Lay down empty tables; does nothing where they exist."""
        for name, schema in (("manifest", MANIFEST), ("volume", VOLUME), ("drift", DRIFT)):
            self._empty(spark, schema).write.mode("ignore").parquet(f"{self.path}/{name}/batch=-1")
        spark.createDataFrame([], self._layout).drop("batch", "usable", "table_name").write.mode("ignore").parquet(
            f"{self.path}/events/batch=-1/usable=true/table_name=none")

    @staticmethod
    def _empty(spark: SparkSession, schema: str) -> DataFrame:
        return spark.createDataFrame([], schema).drop("batch")

    def _table(self, spark: SparkSession, name: str, schema: str | T.StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def manifest(self, spark: SparkSession) -> DataFrame:
        """A row for each batch, published or blocked."""
        return self._table(spark, "manifest", MANIFEST)

    def published(self, spark: SparkSession) -> DataFrame:
        return self.manifest(spark).filter("status = 'published'").select("batch")

    def _visible(self, spark: SparkSession, usable: bool) -> DataFrame:
        rows = self._table(spark, "events", self._layout).filter(F.col("usable") == usable)
        return rows.join(self.published(spark), "batch", "left_semi").drop("usable")

    def events(self, spark: SparkSession) -> DataFrame:
        """Good events of published batches."""
        return self._visible(spark, True).drop("quarantine_reason")

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """Unusable events of published batches, with the reason."""
        return self._visible(spark, False)

    def drift_log(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, "drift", DRIFT)

    def volume_log(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, "volume", VOLUME)

    def _drift(self, good: DataFrame, batch_id: int) -> DataFrame:
        """Verdict of every source with a contract that has events in the batch.

        Events are parsed once, into a profile of a row a source, field and type that is written before it is read.
        """
        spark = good.sparkSession
        contract = spark.createDataFrame(list(self.contract), "table_name string, field string, json_type string")
        checked = good.filter(F.col("table_name").isin(*{table for table, _, _ in self.contract}))
        found = drift.field_profile(checked, [F.get_json_object("value", p) for p in IMAGES], "table_name")
        found.write.mode("overwrite").parquet(f"{self.path}/profile/batch={batch_id}")
        profile = spark.read.schema(found.schema).parquet(f"{self.path}/profile/batch={batch_id}")
        present = good.select("table_name").distinct()
        due = contract.join(present, "table_name", "left_semi")
        changes = drift.classify_drift(profile, due, "table_name")
        return drift.drift_severity(changes, due, "table_name", self.policy, self.allow_additive)

    def _volume(self, good: DataFrame, batch_id: int) -> DataFrame:
        """Rows of every source of the batch or of published batches before it, against the average of the last of these."""
        spark = good.sparkSession
        before = self.volume_log(spark).filter((F.col("batch") < batch_id) & (F.col("n_rows") > 0)).join(self.published(spark), "batch", "left_semi")
        newest = Window.partitionBy("table_name").orderBy(F.col("batch").desc())
        recent = before.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") <= self.lookback)
        averages = recent.groupBy("table_name").agg(F.avg("n_rows").alias("rolling_average"))
        counts = good.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))
        both = counts.join(averages, "table_name", "full_outer").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("bigint")))
        low = F.col("n_rows") < F.col("rolling_average") * self.fraction
        return both.withColumn("status", F.when(F.col("n_rows") == 0, "FAIL").when(low, "WARN").otherwise("PASS")).select(
            "table_name", "n_rows", "rolling_average", "status")

    def _reasons(self, spark: SparkSession, batch_id: int, n_events: int, n_quarantined: int) -> list[str]:
        """Why the stored batch can't be published. Only counts of sources reach the driver."""
        own = F.col("batch") == batch_id
        drifted = self.drift_log(spark).filter(own & ~F.col("is_valid")).agg(F.count(F.lit(1)), F.min("table_name")).first()
        thin = self.volume_log(spark).filter(own & F.col("status").isin(*self.volume_blocks)).agg(F.count(F.lit(1)), F.min("table_name")).first()
        reasons = []
        if drifted[0]:
            reasons.append(f"schema drift in {drifted[0]} source(s), first {drifted[1]}")
        if thin[0]:
            reasons.append(f"volume of {thin[0]} source(s), first {thin[1]}")
        if n_quarantined > self.most_unusable * n_events:
            reasons.append(f"{n_quarantined} of {n_events} events unusable")
        return reasons

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Store, measure and judge a batch; an empty one leaves nothing."""
        spark, seen = batch.sparkSession, Observation()
        if batch.isEmpty():
            return
        marked = with_reason(batch).withColumn("usable", F.col("quarantine_reason").isNull())
        counted = marked.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(~F.col("usable")).alias("bad"))
        columns = [c for c in self._layout.names if c != "batch"]
        folder = f"{self.path}/events/batch={batch_id}"
        writer = balanced(counted.select(*columns), ["usable", "table_name"]).write.mode("overwrite").option("parquet.block.size", ROW_GROUP)
        writer.partitionBy("usable", "table_name").parquet(folder)
        n_events, n_quarantined = seen.get["n"], seen.get["bad"]
        good = self._table(spark, "events", self._layout).filter((F.col("batch") == batch_id) & F.col("usable"))
        self._drift(good, batch_id).drop("batch").write.mode("overwrite").parquet(f"{self.path}/drift/batch={batch_id}")
        self._volume(good, batch_id).write.mode("overwrite").parquet(f"{self.path}/volume/batch={batch_id}")
        reasons = self._reasons(spark, batch_id, n_events, n_quarantined)
        row = ("blocked" if reasons else "published", n_events, n_quarantined, "; ".join(reasons) or None)
        spark.createDataFrame([row], MANIFEST.split(", ", 1)[1]).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}")
        if reasons and self.on_block == "stop":
            raise QualityGateError(f"batch {batch_id}: {row[3]}")

    def run(self, events: DataFrame, checkpoint: str) -> None:
        self.create(events.sparkSession)
        drain(events, self.write_batch, checkpoint)
