"""Tables kept in hash buckets of their key, so that a merge reads and writes only the buckets that have changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.upsert import merge_changes

BUCKET, EMPTY = "_bucket", "_empty"


@dataclass(frozen=True)
class BucketedTable:
    """A Parquet table partitioned by the hash of its key.

    A merge finds the buckets of the changes (at most ``buckets`` numbers), reads these partitions alone, applies the
    changes, and replaces them by dynamic overwrite; other partitions keep their files. Every written bucket also gets a
    mark row, so that a bucket whose rows were all deleted is replaced, too; readers leave the marks out. A merge that
    failed before its commit left nothing, and one run again with the same changes gives the same table. Null keys are
    a key value of their own in the hash but match nothing, as in ``merge_changes``; changes hold one row a key.
    """

    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    buckets: int = 256

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(EMPTY, T.BooleanType()), T.StructField(BUCKET, T.IntegerType())])

    def bucket(self) -> Column:
        """The bucket of a row: by the key's text, so that both sides may type it differently."""
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, touched: DataFrame) -> None:
        marks = touched.select(BUCKET, F.lit(True).alias(EMPTY))
        marked = rows.withColumns({EMPTY: F.lit(False), BUCKET: self.bucket()}).unionByName(marks, allowMissingColumns=True)
        out = marked.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._stored.fields])
        out.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def load(self, rows: DataFrame) -> None:
        """Replace the whole table."""
        self._write(rows, rows.sparkSession.range(self.buckets).select(F.col("id").cast("int").alias(BUCKET)))

    def _rows(self, spark: SparkSession, touched: Sequence[int] | None = None) -> DataFrame:
        rows = spark.read.schema(self._stored).parquet(self.path)
        if touched is not None:
            rows = rows.filter(F.col(BUCKET).isin(*touched))
        return rows.filter(~F.col(EMPTY))

    def read(self, spark: SparkSession, touched: Sequence[int] | None = None) -> DataFrame:
        """The table's rows, or those of some buckets."""
        return self._rows(spark, touched).drop(BUCKET, EMPTY)

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets with changes, in order."""
        return sorted(r[0] for r in changes.select(self.bucket().alias(BUCKET)).distinct().collect())

    def merge(self, changes: DataFrame, **options) -> list[int]:
        """Apply the changes with ``merge_changes`` and its options; returns the buckets that were replaced."""
        spark = changes.sparkSession
        touched = self.touched(changes)
        if touched:
            merged = merge_changes(self.read(spark, touched), changes, list(self.keys), **options)
            self._write(merged, spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int"))
        return touched
