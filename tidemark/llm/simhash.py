"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked when few bits differ.

A fingerprint's 64 bits are cut into ``2 + distance`` blocks. Two fingerprints within ``distance`` bits agree on two
blocks at least, so each fingerprint is filed under every pair of blocks (pigeonhole), fingerprints that share a file
are joined and their Hamming distance is verified. Only distinct fingerprints are filed: copies of a text count once
however many there are. A file with more than ``FILE_LIMIT`` fingerprints isn't joined with itself; its members are
linked exactly and in linear work through the points of the cube beside them: two fingerprints are within two bits
exactly if some point is within one bit of both, so all members beside a point are linked to the least of them.
Components come from alternating star contractions, written to the shared folder in each round.

Defined cases: a null text is an empty text; a text without words has fingerprint zero, which links like any other;
a text with fewer words than a shingle is one shingle; very long texts are hashed whole; repeated rows link to
themselves and each keeps its row; a null id stays in the result and is never the smallest id unless a component has
no other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import map_slices, written

#: Seed of the shingle hash.
SEED = 42
#: Fingerprints in a file that are compared pair by pair; larger files are linked through neighbouring points.
FILE_LIMIT = 64


def shingle_hashes(text: str, size: int) -> list[int]:
    """Hashes of the word shingles of a text, A-Z lower-cased, repeats included."""
    words = text.encode().lower().split()
    if len(words) < size:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    return [xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(size)), strict=False)]


def fingerprints(texts: list[str], size: int, halves: int = 1) -> np.ndarray:
    """Fingerprints of texts, a row of signed 64-bit numbers each: a bit is set if it is in over half the shingle hashes.

    Further halves take the hashes mixed anew.
    """
    out = np.zeros((len(texts), halves), dtype=np.int64)
    hashes = [shingle_hashes(t, size) for t in texts]
    counts = np.array([len(h) for h in hashes], dtype=np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        flat = np.fromiter((h for hs in hashes for h in hs), dtype=np.uint64, count=int(counts.sum()))
        starts = np.append(0, np.cumsum(counts[full])[:-1])
        for half in range(halves):
            bits = np.unpackbits(flat.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            set_ = 2 * np.add.reduceat(bits, starts, axis=0, dtype=np.int32) > counts[full][:, None]
            out[full, half] = np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64).view(np.int64)
            flat = (flat ^ (flat >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            flat ^= flat >> np.uint64(29)
    return out


def with_fingerprints(docs: DataFrame, shingle: int, keep: list[str], text: str = "text") -> DataFrame:
    return map_slices(docs, text, keep, "fp long", lambda texts: [fingerprints(texts, shingle)[:, 0]])


def block_keys(fp: Column, distance: int) -> Column:
    """The numbers of the files a fingerprint belongs to, one for each pair of blocks."""
    n = distance + 2
    cuts = [64 * i // n for i in range(n + 1)]

    def block(i: int) -> tuple[Column, int]:
        width = cuts[i + 1] - cuts[i]
        return F.shiftrightunsigned(fp, cuts[i]).bitwiseAND(F.lit((1 << width) - 1)), width

    keys = []
    for number, (i, j) in enumerate(combinations(range(n), 2)):
        (a, _), (b, width) = block(i), block(j)
        keys.append(F.struct(F.lit(number).alias("pair"), F.shiftleft(a, width).bitwiseOR(b).alias("bits")))
    return F.array(*keys)


def links(nodes: DataFrame, distance: int, file_limit: int = FILE_LIMIT) -> DataFrame:
    """Links (a, b), a < b, of distinct fingerprints ``fp`` that connect all pairs within ``distance`` bits."""
    if distance > 2:
        raise ValueError("links through neighbouring points are exact up to two bits")
    files = nodes.select("fp", F.explode(block_keys(F.col("fp"), distance)).alias("k")).select("fp", "k.pair", "k.bits")
    sizes = written(files.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1"), "simhash-files")
    key = ["pair", "bits"]
    small = files.join(sizes.where(F.col("n") <= file_limit), key).select(*key, "fp")
    pairs = small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), key).where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    ).select("a", "b")
    crowded = files.join(sizes.where(F.col("n") > file_limit), key).select("fp").distinct()
    beside = written(crowded.select("fp", F.explode(near_points(F.col("fp"), distance)).alias("point")), "simhash-points")
    least = written(beside.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1"), "simhash-least")
    through = beside.join(least, "point").select("a", F.col("fp").alias("b")).where("a < b")
    return pairs.unionByName(through).distinct()


def near_points(fp: Column, distance: int) -> Column:
    """Points that prove a distance of two (one bit from each), one (the lesser of both), or none."""
    ones = [F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)]
    if distance == 2:
        return F.array(fp, *[fp.bitwiseXOR(one) for one in ones])
    if distance == 1:  # both ends of an edge of the cube name it by its end without the bit, and the bit
        edges = [F.xxhash64(fp.bitwiseAND(F.bitwise_not(one)), F.lit(i)) for i, one in enumerate(ones)]
        return F.array(*edges)
    return F.array(fp)


def stars(links: DataFrame) -> bool:
    """Whether distinct links (a, b), a < b, are one star a component, under its least node."""
    ends = links.select(F.col("b").alias("node"), F.lit(1).alias("above")).unionByName(links.select(F.col("a").alias("node"), F.lit(None).cast("int").alias("above")))
    mixed = ends.groupBy("node").agg(F.count("above").alias("above"), F.max(F.col("above").isNull()).alias("below"))
    return mixed.where("above > 1 or (above = 1 and below)").isEmpty()


def components(edges: DataFrame, store: Callable[[DataFrame, str], DataFrame] = written) -> DataFrame:
    """Rows (node, root) for every node of the links (a, b): root is the least node of its component.

    Alternating stars: each node's neighbours above it are hung under the least node it knows, then each node and its
    neighbours below it. The links shrink to one star a component, and rounds end when each node is the lesser end of all its
    links or the greater end of one; links that are such stars from the start need none. Least nodes are combined before the shuffle and
    written before they are joined, so a node with very many links is split by the skew join. ``store`` writes a table; the
    result reads the last one.
    """
    current = store(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    while not stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m")), "star-least")
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b")
        # a node that is its own least hangs its greater neighbours under itself; others pass them on to their least
        large = store(large.where("a < b").distinct(), "star-large")
        least = store(large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")), "star-least")
        small = large.join(least, F.col("b") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), F.col("u").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a < b").distinct()
        current = store(small, "links")
    leaves = current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return leaves.unionByName(current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def named_components(prints: DataFrame, distance: int, doc_id: str) -> DataFrame:
    """(fp, component_id): the smallest id of the documents reachable from each fingerprint."""
    nodes = written(prints.groupBy("fp").agg(F.min(doc_id).alias("least")), "fingerprint-nodes")
    roots = written(components(links(nodes, distance)), "fingerprint-roots")
    rooted = written(
        nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprint-rooted")
    ids = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    return written(rooted.join(ids, "root").select("fp", "component_id"), "fingerprint-components")


def near_duplicates(docs: DataFrame, shingle: int = 5, distance: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``fp`` and ``component_id``, the smallest id of the documents reachable over links."""
    prints = written(with_fingerprints(docs, shingle, [doc_id], text), "fingerprints")
    named = named_components(prints, distance, doc_id)
    return prints.join(named, "fp").select(doc_id, "fp", "component_id")
