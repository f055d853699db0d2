"""Centroid clustering of vectors by exact Lloyd rounds, with heaps of bounds that spare most distances.

Vectors are kept in blocks, a row each. For every vector of a block a key holds the gap between its distance to the second
nearest centroid and to its own, as it was at the vector's last scan, plus the drift its cluster had accumulated by then.
Each cluster of a block keeps its keys in a heap. When centroids move, only the clusters' accumulated drifts grow; a round
pops the keys that the drift has reached, scans exactly these vectors against all centroids, and pushes them anew. Blocks
report the change of each cluster's count and component sums, so new centroids come from integers that only moved vectors
touch. Keys are lowered by more than the error of the roots, so a vector whose nearest centroid could be tied is scanned.

Components are integers, and distances, sums and means are exact. The driver holds the centroids and their sums (clusters
x components); a task holds a block at a time. Every round's blocks are a written table, and the round before the last is
deleted, so lost executors cost a re-read and the disk holds two rounds.

Defined cases: vectors that are null, of another length, or with a null or non-finite component are left out; components
beyond 2^27 after scaling count as 2^27, so that a distance fits a long; equal distances go to the smaller number; repeated
rows are vectors of their own; with fewer vectors than clusters every vector starts a cluster; a cluster that loses all its
vectors keeps its centroid; a null id sorts as an empty one; an empty table gives no rows; an inertia beyond a long is
null; further columns of any name are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import arrow_type, bound_batches, removed, stored_at, unused_path

CLUSTERS, ROUNDS, COMPONENTS, SCALE = 40, 5, 64, 256
LIMIT = 1 << 27
#: Vectors of a block.
BLOCK = 4096
#: Share by which keys are lowered and drifts raised against rounding of roots.
SLACK = 1e-12


def whole(vector: str, components: int, scale: int) -> Column:
    """The vector's integers, or null if it isn't one of ``components`` finite numbers."""
    v = F.col(vector)
    good = (F.size(v) == components) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    low, high = F.lit(float(-LIMIT)), F.lit(float(LIMIT))
    return F.when(good, F.transform(v, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, low), high)).cast("int")))


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector (row) to every centroid."""
    top = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * top * top * vectors.shape[1] < 1 << 53:  # then doubles are exact
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        gap = vectors.astype(np.int64) - c
        out[:, j] = (gap * gap).sum(1)
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller of equal ones, and the gap to the second, lowered by the slack."""
    d = squared(vectors, centroids)
    own = d.argmin(1)
    best = np.sqrt(d[np.arange(len(d)), own])
    d[np.arange(len(d)), own] = np.iinfo(np.int64).max
    second = np.sqrt(d.min(1)) if d.shape[1] > 1 else np.full(len(d), np.inf)
    return own, np.where(np.isinf(second), second, second - best - SLACK * (second + best))


@dataclass
class Centroids:
    """What the driver holds and every task gets: centroids, their members' counts and sums, accumulated drifts."""

    at: np.ndarray
    counts: list[int] = field(default_factory=list)
    sums: list[list[int]] = field(default_factory=list)
    drift: np.ndarray | None = None

    def __post_init__(self):
        k, d = self.at.shape
        self.counts, self.sums, self.drift = [0] * k, [[0] * d for _ in range(k)], np.zeros(k)

    def move(self, changes: list) -> None:
        """Take in changes of (cluster, count, sums); set every non-empty centroid to the floor of its mean."""
        for j, count, sums in changes:
            self.counts[j] += count
            self.sums[j] = [a + b for a, b in zip(self.sums[j], sums, strict=True)]
        new = np.array([[s // n for s in sums] if n else at.tolist() for n, sums, at in zip(self.counts, self.sums, self.at, strict=True)], np.int64)
        moved = np.sqrt(((new - self.at).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
        others = np.array([np.delete(moved, j).max(initial=0) for j in range(len(moved))])
        self.drift = (self.drift + moved + others) * (1 + SLACK)
        self.at = new


def block_schema(id_type: T.DataType) -> T.StructType:
    change = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("count", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))])
    return T.StructType([
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("vectors", T.BinaryType()), T.StructField("clusters", T.ArrayType(T.IntegerType())),
        T.StructField("heap_keys", T.BinaryType()), T.StructField("heap_rows", T.BinaryType()), T.StructField("heap_ends", T.BinaryType()),
        T.StructField("changes", T.ArrayType(change)), T.StructField("scanned", T.LongType()), T.StructField("distances", T.ArrayType(T.LongType())),
    ])


class Block:
    """Vectors with their clusters, and a heap of (key, row) for each cluster."""

    def __init__(self, vectors: np.ndarray, clusters: np.ndarray, heaps: list[list[tuple[float, int]]]):
        self.vectors, self.clusters, self.heaps = vectors, clusters, heaps

    @staticmethod
    def new(vectors: np.ndarray, k: int) -> "Block":
        """Nothing is known yet: every key of the one heap has expired."""
        heaps = [[] for _ in range(k)]
        heaps[0] = [(-np.inf, i) for i in range(len(vectors))]
        return Block(vectors, np.full(len(vectors), -1), heaps)

    @staticmethod
    def read(row: dict, components: int) -> "Block":
        vectors = np.frombuffer(row["vectors"], "<i4").reshape(-1, components)
        keys, rows = np.frombuffer(row["heap_keys"], "<f8"), np.frombuffer(row["heap_rows"], "<i4")
        cuts = np.append(0, np.frombuffer(row["heap_ends"], "<i4"))
        heaps = [list(zip(keys[a:b].tolist(), rows[a:b].tolist(), strict=True)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return Block(vectors, np.array(row["clusters"]), heaps)

    def scan(self, centroids: np.ndarray, drift: np.ndarray) -> tuple[list, int]:
        """Pop the expired keys, scan their vectors, push them anew; the changes of clusters and the number of scans."""
        popped = []
        for heap, limit in zip(self.heaps, drift.tolist(), strict=True):
            while heap and heap[0][0] <= limit:
                popped.append(heappop(heap)[1])
        if not popped:
            return [], 0
        rows = np.array(sorted(popped))
        own, gaps = nearest(self.vectors[rows], centroids)
        keys = gaps + drift[own] * (1 - SLACK)
        for i, j, key in zip(rows.tolist(), own.tolist(), keys.tolist(), strict=True):
            heappush(self.heaps[j], (key, i))
        before = self.clusters[rows]
        moved = before != own
        self.clusters[rows] = own
        changes = {}
        for sign, side in ((-1, before), (1, own)):
            for j in np.unique(side[moved]).tolist():
                if j >= 0:
                    members = self.vectors[rows[moved & (side == j)]].astype(np.int64)
                    count, sums = changes.get(j, (0, 0))
                    changes[j] = count + sign * len(members), sums + sign * members.sum(0)
        return [{"cluster": j, "count": c, "sums": s.tolist()} for j, (c, s) in changes.items()], len(rows)

    def row(self, ids: list, changes: list, scanned: int, distances: list | None) -> dict:
        keys = [key for heap in self.heaps for key, _ in heap]
        rows = [i for heap in self.heaps for _, i in heap]
        return {
            "ids": ids, "vectors": self.vectors.astype("<i4").tobytes(), "clusters": self.clusters.tolist(),
            "heap_keys": np.array(keys, "<f8").tobytes(), "heap_rows": np.array(rows, "<i4").tobytes(),
            "heap_ends": np.cumsum([len(h) for h in self.heaps]).astype("<i4").tobytes(),
            "changes": changes, "scanned": scanned, "distances": distances,
        }


def first_blocks(vectors: DataFrame, centroids: np.ndarray, schema: T.StructType, block: int) -> DataFrame:
    """Blocks of (id, vector) rows, every vector scanned against the starting centroids."""
    out, (k, components) = arrow_type(schema), centroids.shape
    bound_batches(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
                made = Block.new(values, k)
                changes, scanned = made.scan(shared.value, np.zeros(k))
                yield pa.RecordBatch.from_pylist([made.row(part.column(0).to_pylist(), changes, scanned, None)], schema=out)

    return vectors.mapInArrow(run, schema)


def next_blocks(blocks: DataFrame, state: Centroids, last: bool) -> DataFrame:
    """The blocks after a round; with the vectors' distances in the last one."""
    schema = blocks.schema
    out, components = arrow_type(schema), state.at.shape[1]
    bound_batches(blocks.sparkSession)
    shared = blocks.sparkSession.sparkContext.broadcast((state.at, state.drift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, drift = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block.read(row, components)
                changes, scanned = block.scan(centroids, drift)
                distances = None
                if last:
                    gap = block.vectors.astype(np.int64) - centroids[block.clusters]
                    distances = (gap * gap).sum(1).tolist()
                yield pa.RecordBatch.from_pylist([block.row(row["ids"], changes, scanned, distances)], schema=out)

    return blocks.mapInArrow(run, schema)


def changes_of(blocks: DataFrame, components: int) -> list:
    """The changes of all blocks, summed by cluster: at most a row for each cluster."""
    each = blocks.select(F.explode("changes").alias("c")).select("c.*")
    summed = each.groupBy("cluster").agg(F.sum("count").alias("count"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(components)])
    return [(r["cluster"], r["count"], list(r[2:])) for r in summed.collect()]


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors with the least hashes of their ids, in order."""
    hashed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in vectors.orderBy(hashed, "v").limit(k).select("v").collect()], np.int64)


def clustered(df: DataFrame, id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
              components: int = COMPONENTS, scale: int = SCALE, salt: str = "2:", block: int = BLOCK) -> DataFrame:
    """``id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every vector."""
    spark = df.sparkSession
    kept = df.select(F.col(f"`{id}`").alias("id"), whole(f"`{vector}`", components, scale).alias("v")).where("v is not null")
    schema = block_schema(df.schema[id].dataType)
    start = seeds(kept, clusters, salt)
    if not len(start):
        empty = spark.createDataFrame([], schema)
        return described(empty, id, Centroids(np.zeros((1, components), np.int64)))
    state, path = Centroids(start), unused_path(spark, "clusters")
    blocks = stored_at(first_blocks(kept, start, schema, block), path)
    for i in range(rounds):
        state.move(changes_of(blocks, components))
        old, path = path, unused_path(spark, "clusters")
        blocks = stored_at(next_blocks(blocks, state, i == rounds - 1), path)
        removed(spark, old)
    return described(blocks, id, state)


def described(blocks: DataFrame, id: str, state: Centroids) -> DataFrame:
    """The rows of the blocks, with what is known of their clusters: a table of a row each, at most ``clusters``."""
    spark = blocks.sparkSession
    rows = blocks.select(F.explode(F.arrays_zip("ids", "clusters", "distances")).alias("x")).select(
        F.col("x.ids").alias(id), F.col("x.clusters").alias("cluster"), F.col("x.distances").alias("distance"))
    sums = blocks.select(F.explode(F.arrays_zip("clusters", "distances")).alias("x")).groupBy(F.col("x.clusters").alias("cluster")).agg(
        F.sum(F.col("x.distances").cast("decimal(20,0)")).alias("sum")).collect()
    total = sum(int(r["sum"]) for r in sums)
    fits = lambda n: n if n < 1 << 63 else None
    digest = lambda j: hashlib.sha256(",".join(map(str, state.at[j].tolist())).encode()).hexdigest()
    known = [(r["cluster"], fits(int(r["sum"])), fits(total), digest(r["cluster"])) for r in sums]
    table = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(F.col(f"`{id}`"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
