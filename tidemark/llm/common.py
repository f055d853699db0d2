"""Helpers that the training-data operators share: shared storage, bounded batches, rows as Arrow."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Characters of text that a Python task works on at a time; rows are never cut, a longer text is a slice of its own.
SLICE_CHARS = 400_000
#: Bytes of the Arrow batches that Spark hands to a Python task, unless the application is configured with a bound of its own.
BATCH_BYTES = "8m"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or one beside the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return base.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, lineage cut, safe from lost executors."""
    return stored_at(df, unused_path(df.sparkSession, label))


def unused_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder for a table that a loop replaces by the next."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """The rows as a Parquet table at the path."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of a finished round; what came after it must be written already."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables of a stage or round in the shared folder, deleted together when it is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(unused_path(self.spark, label))
        return stored_at(df, self.paths[-1])

    def clear(self) -> None:
        """Delete the tables; what was made from them must be written already."""
        for path in self.paths:
            removed(self.spark, path)
        self.paths = []


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` characters."""
    return ranges([len(t) for t in texts], limit)


def ranges(sizes: list[int], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` in size; a larger row is a range of its own."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def arrow_type(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def bound_batches(spark: SparkSession) -> None:
    """Bound what a Python task holds at a time by bytes; ten thousand long rows would be one batch otherwise."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, BATCH_BYTES)


def map_slices(df: DataFrame, text: str, keep: list[str], added: str, function: Callable[[list[str]], list]) -> DataFrame:
    """Apply ``function`` to whole texts (null: empty) in slices; return the ``keep`` columns and the added ones.

    ``function`` gets a list of texts and returns one list or array for each added column.
    """
    spark_type = T.StructType([df.schema[c] for c in keep] + T._parse_datatype_string(added).fields)
    out = arrow_type(spark_type)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            texts = ["" if t is None else t for t in table.column("_text").to_pylist()]
            for a, b in slices(texts):
                columns = [table.column(i).slice(a, b - a).combine_chunks() for i in range(len(keep))]
                made = function(texts[a:b])
                fields = [out.field(len(keep) + i) for i in range(len(made))]
                arrays = [pa.array(x, type=f.type) for x, f in zip(made, fields, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(out.field(i).type) for i, c in enumerate(map(flat, columns))] + arrays, schema=out)

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text")).mapInArrow(run, spark_type)


def flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


class Masked:
    """A table under column names that no operator makes, so that further columns of any name pass through.

    ``df`` has the renamed columns, ``masked["text"]`` is a column's new name and ``restore`` gives the old names back.
    """

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        self.names = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
        self.df = docs.toDF(*self.names.values())

    def __getitem__(self, column: str) -> str:
        return self.names[column]

    def restore(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(n).alias(c) for c, n in self.names.items()])
