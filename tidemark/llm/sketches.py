"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the ``k`` least distinct 64-bit hashes of a text's five-word shingles, ascending. The sketch of a
union is the ``k`` least of both sketches, so parts of a corpus merge. Two sketches estimate the resemblance from the
``k`` least of their union, the distinct shingle count from the k-th least hash, and the containment from both.

Defined cases: null is an empty text, with an empty sketch; a text shorter than a shingle is one shingle; two empty
sketches resemble each other fully (1) and no other sketch at all (0); very long texts are hashed whole; equal texts
have equal sketches. Next documents: ids ascend, null ids first, equal ids by text, the last one's next is the first;
a single document is its own next; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from xxhash import xxh64_intdigest

from tidemark.llm.common import arrow_type, map_slices

#: Hashes in a sketch; the resemblance's standard error is at most 0.5 / sqrt(k).
K = 128
SHINGLE = 5
#: Words whose hashes a task remembers between texts.
WORD_MEMORY = 200_000
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Sketcher:
    """Sketches texts; word hashes are remembered between texts."""

    def __init__(self, k: int = K, shingle: int = SHINGLE):
        self.k, self.shingle, self.memory = k, shingle, {}

    def words(self, text: str) -> np.ndarray:
        words, memory = text.encode().split(), self.memory
        if len(memory) > WORD_MEMORY:
            memory.clear()
        try:
            return np.fromiter(map(memory.__getitem__, words), dtype=np.uint64, count=len(words))
        except KeyError:
            memory.update((w, xxh64_intdigest(w)) for w in set(words).difference(memory))
            return np.fromiter(map(memory.__getitem__, words), dtype=np.uint64, count=len(words))

    def hashes(self, text: str) -> np.ndarray:
        """A hash per shingle: its words' hashes, mixed in their order."""
        w = self.words(text)
        size = min(self.shingle, len(w))
        if not size:
            return w
        out = np.full(len(w) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            out = (out ^ w[i : i + len(out)]) * np.uint64(MIX[0])
            out ^= out >> np.uint64(29)
        for m in MIX[1:]:
            out = (out ^ (out >> np.uint64(30))) * np.uint64(m)
        return out ^ (out >> np.uint64(31))

    def sketch(self, text: str) -> np.ndarray:
        return merge(self.k, self.hashes(text))


def merge(k: int, *parts: np.ndarray) -> np.ndarray:
    """The k least distinct hashes of all parts: also the sketch of a union of sketched sets."""
    every = np.concatenate(parts)
    least = every
    while len(least) > 4 * k:  # repeats may hide in the cut, so cut only where enough distinct hashes are left
        cut = np.partition(least, 2 * k)[: 2 * k + 1]
        if len(np.unique(cut)) < k:
            break
        least = cut
    return np.unique(least)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated share of the union's shingles that both have."""
    if not len(a) and not len(b):
        return 1.0
    union = merge(k, a, b)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union)) if len(union) else 0.0


def distinct_count(a: np.ndarray, k: int) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    return min(1.0, r * (distinct_count(a, k) + distinct_count(b, k)) / (1 + r) / distinct_count(a, k))


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u8")


def merged(sketches: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """Sketches (arrays of hashes as signed numbers, ordered as unsigned) of groups, from their parts' sketches.

    The hashes are ranked per group; Spark cuts each task's rows to the k least before the shuffle.
    """
    flip = F.lit(-(1 << 63))
    each = sketches.select(*by, F.explode(column).alias("h")).distinct()
    order = Window.partitionBy(*by).orderBy(F.col("h").bitwiseXOR(flip))
    return each.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).groupBy(*by).agg(
        F.transform(F.array_sort(F.collect_list(F.col("h").bitwiseXOR(flip))), lambda x: x.bitwiseXOR(flip)).alias(column)
    )


def sketched(docs: DataFrame, keep: list[str], text: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns, ``sketch array<long>`` (hashes as signed numbers) and ``n_shingles``, their estimated number."""
    def run(texts: list[str]) -> list:
        sketcher = Sketcher(k, shingle)
        made = [sketcher.sketch(t) for t in texts]
        return [[m.view(np.int64) for m in made], [distinct_count(m, k) for m in made]]

    return map_slices(docs, text, keep, "sketch array<long>, n_shingles double", run)


def dealt_in_order(docs: DataFrame, order: str, text: str = "text") -> DataFrame:
    """Rows (part, extra, o, t) of ids and texts in ranges of ids, sorted, each range followed by the next one's first.

    Ranges start at quantiles of the ids, which are ids themselves, so the first row of each range is known. It is
    also sent, marked ``extra``, to the range before it (the first of all to the last range): each row's next row
    comes after it in the same task, and texts are shuffled once.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [F.lit(i / (4 * tasks)) for i in range(1, 4 * tasks)]
    ids = docs.select(F.col(f"`{order}`").cast("long").alias("o"))
    found = ids.agg(
        F.percentile_approx("o", F.array(*shares), 100 * tasks).alias("bounds"), F.min("o").alias("least"),
        F.count_if(F.col("o").isNull()).alias("nulls"),
    ).first()
    least = None if found["nulls"] else found["least"]
    bounds = np.array(sorted({b for b in found["bounds"] or [] if found["nulls"] or b != least}), dtype=np.int64)
    schema = T._parse_datatype_string("part int, extra boolean, o long, t string")
    out = arrow_type(schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o, valid = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            part = np.where(valid, np.searchsorted(bounds, o, side="right"), 0)
            starts = np.append(0 if least is None else least, bounds)
            first = np.where(valid, (o == starts[part]) & ((part > 0) | (least is not None)), least is None)
            sent = np.flatnonzero(first)
            to = np.where(part[sent] > 0, part[sent] - 1, len(bounds))
            rows = pa.array(np.append(np.arange(len(o)), sent))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(part, to), pa.int32()), pa.array(np.append(np.zeros(len(o), bool), np.ones(len(sent), bool))),
                batch.column(0).take(rows), batch.column(1).take(rows).cast(pa.string()),
            ], schema=out)

    rows = docs.select(F.col(f"`{order}`").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return rows.mapInArrow(deal, schema).repartition(tasks, "part").sortWithinPartitions("part", "extra", "o", "t")


def map_with_next(docs: DataFrame, order: str, added: str, function, text: str = "text") -> DataFrame:
    """Rows of ``order`` and the ``added`` columns: ``function`` is called once a task and returns a function that
    gets a text and the next text and returns the added values; tasks see texts in order."""
    schema = T._parse_datatype_string(f"`{order}` long, {added}")
    out = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, held, made, size = function(), None, [], 0
        for batch in batches:
            for part, extra, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0] == part:
                    made.append((held[1], *call(held[2], t)))
                    size += len(held[2])
                held = None if extra else (part, o, t)
                if size > 4_000_000:
                    yield rows_to_batch(made, out)
                    made, size = [], 0
        if made:
            yield rows_to_batch(made, out)

    return dealt_in_order(docs, order, text).mapInArrow(run, schema)


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
