"""Centroid clustering against plain rounds and its SQL, and its defined edge cases."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import clustering
from tidemark.llm.common import unused_path, stored_at

SCHEMA = "vec_id long, embedding array<float>, clusters string, ids int"


def plain(vectors, ids, k, rounds):
    """Lloyd's rounds over all distances with integers of any size."""
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest(), vectors[i]))
    centroids = [vectors[i] for i in order[:k]]

    def assigned():
        out = []
        for v in vectors:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assigned()
        for j in range(len(centroids)):
            members = [v for v, (c, _) in zip(vectors, own, strict=True) if c == j]
            if members:
                centroids[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = assigned()
    inertia = [sum(d for c, d in own if c == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, c, d, inertia[c], sum(inertia), digest[c]) for i, (c, d) in zip(ids, own, strict=True))


def whole(v, scale):
    return [min(max(int(np.floor(np.float64(np.float32(x)) * scale)), -clustering.LIMIT), clustering.LIMIT) for x in v]


def run(spark, vectors, ids, k, rounds, scale, block=64):
    rows = [(i, [float(x) for x in v], "x", 1) for i, v in zip(ids, vectors, strict=True)]
    got = clustering.clustered(spark.createDataFrame(rows, SCHEMA), clusters=k, rounds=rounds, components=len(vectors[0]), scale=scale, block=block)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("kind", ["apart", "even", "ties", "huge"])
def test_rounds_equal_plain_ones(spark, kind):
    random = np.random.default_rng(4)
    n, d, scale = 500, 6, 256
    if kind == "apart":
        vectors = random.normal(0, 1, (8, d))[random.integers(0, 8, n)] + random.normal(0, 0.05, (n, d))
    elif kind == "even":
        vectors = random.uniform(-1, 1, (n, d))
    elif kind == "ties":
        vectors = random.integers(-1, 2, (n, d)) / 64  # many equal vectors and distances
    else:
        vectors = random.normal(0, 1, (n, d)) * 10.0 ** random.integers(3, 30, (n, 1))
    ids = list(range(n - 100)) + list(range(100))  # repeated ids
    if kind == "huge":
        vectors[n - 1] = 1e38
    expected = plain([whole(v, scale) for v in vectors], ids, 12, 4)
    got = run(spark, vectors, ids, 12, 4, scale)
    if kind == "huge":  # sums beyond a long are null
        expected = [(*r[:3], *(x if x < 1 << 63 else None for x in r[3:5]), r[5]) for r in expected]
    assert got == expected


def test_few_vectors_and_one_cluster(spark):
    vectors = [[0.0, 1.0], [2.0, -3.0], [2.0, -3.0]]
    assert run(spark, vectors, [1, 2, 3], 40, 5, 256) == plain([whole(v, 256) for v in vectors], [1, 2, 3], 40, 5)
    assert run(spark, vectors, [1, 2, 3], 1, 5, 256) == plain([whole(v, 256) for v in vectors], [1, 2, 3], 1, 5)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "a", 1), (1, [1.0, 2.0], "b", 2), (None, [5.0, 5.0], "c", 3), (3, None, "d", 4), (4, [], "e", 5), (5, [1.0], "f", 6),
            (6, [1.0, None], "g", 7), (7, [nan, 1.0], "h", 8), (8, [inf, 1.0], "i", 9), (9, [-inf, 1.0], "j", 10), (10, [1.0, 2.0, 3.0], "k", 11)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = clustering.clustered(df, clusters=3, components=2).collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["1", "1", "None"] and {r["inertia"] for r in got} == {0}
    assert clustering.clustered(df.where("vec_id = 3"), components=2).collect() == []


def test_few_vectors_are_scanned_again(spark):
    """Well separated clusters: after some rounds hardly a key has expired, and blocks report no change."""
    random = np.random.default_rng(9)
    middles = random.normal(0, 4, (10, 8))
    vectors = middles[np.arange(4000) % 10] + random.normal(0, 0.02, (4000, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, v array<double>").select("id", clustering.whole("v", 8, 256).alias("v"))
    state = clustering.Centroids(np.array([whole(m + 0.1, 256) for m in middles], np.int64))
    blocks = stored_at(clustering.first_blocks(df, state.at, clustering.block_schema(df.schema["id"].dataType), 512), unused_path(spark, "t"))
    scanned = [blocks.agg(F.sum("scanned")).first()[0]]
    for _ in range(3):
        state.move(clustering.changes_of(blocks, 8))
        blocks = stored_at(clustering.next_blocks(blocks, state, False), unused_path(spark, "t"))
        scanned.append(blocks.agg(F.sum("scanned")).first()[0])
    assert scanned[0] == 4000 and scanned[2:] == [0, 0] and clustering.changes_of(blocks, 8) == []
