"""Readers for raw change records, as batches or streams over the same plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.contracts import LANDING


def landing_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental stream of landed JSON change records, explicit schema, no inference."""
    reader = spark.readStream.schema(LANDING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def landing_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING).json(path)


def normalise_landing(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Event rows of the landing records whose topic names a server, a schema and a table (a fixed form).

    The millisecond time becomes a timestamp; all other columns stay.
    """
    names = F.split("topic", r"\.")
    complete = (F.size(names) == 3) & ~F.array_contains(names, "")
    return records.where(complete).select(
        *[c for c in records.columns if c != "timestamp"],
        F.timestamp_millis("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.get(names, F.lit(1)).alias("source_schema"),
        F.get(names, F.lit(2)).alias("table_name"),
    )


def bronze_history(spark: SparkSession, path: str) -> DataFrame:
    """All events ever landed, with columns that were added later filled in as null."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def bronze_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Events not yet seen by this query's checkpoint."""
    return spark.readStream.schema(schema).parquet(path)


def typed_values(records: DataFrame, schema: T.StructType, time_column: str = "timestamp") -> DataFrame:
    """Parse a string-value stream into typed columns, keeping bus time and ingest time."""
    return records.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.timestamp_millis(F.col(time_column)).alias("bus_time"),
        F.current_timestamp().alias("ingested_at"),
    ).select("data.*", "bus_time", "ingested_at")


def stamped_json(spark: SparkSession, path: str, schema: T.StructType, source_system: str) -> DataFrame:
    """JSON batch with ingest time, source system and source file on every row."""
    return spark.read.schema(schema).json(path).select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.lit(source_system).alias("_source_system"),
        F.col("_metadata.file_path").alias("_source_file"),
    )
