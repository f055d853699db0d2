"""Session building, table loading and shared scratch folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    Adaptive execution sizes shuffles, splits skewed join partitions and switches to
    broadcast joins from measured sizes, so no job hard-codes a physical strategy.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


class Tables:
    """Attribute access to the parquet tables under one directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def spread(df: DataFrame, limit_bytes: int = 512 * 1024 * 1024) -> DataFrame:
    """Use all cores for a small input that sits in a few files and cannot be split further.

    A scan of one row group is one task however heavy the work after it. Inputs with at least as
    many files as cores, or above the size limit, are returned as they are.
    """
    spark = df.sparkSession
    files, cores = df.inputFiles(), spark.sparkContext.defaultParallelism
    if not files or len(files) >= cores:
        return df
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    return df.repartition(cores) if size <= limit_bytes else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows as a written table in the shared folder, computed once.

    For results that are read several times: lineage ends at the files, so a lost executor costs
    a re-read and not a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder that all executors reach: under ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
