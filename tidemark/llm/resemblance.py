"""Near copies: texts whose SimHash fingerprints link, and texts that share 0.8 of their five-word shingles.

First fingerprints are linked as in ``simhash``; texts of one of its components are of one component here from the start. At a
resemblance of 0.8 a pair's fingerprints may differ more, so what fingerprints left apart is then tested by resemblance. At such a resemblance about 15 % of a fingerprint's bits differ, with so wide a spread that no choice of blocks is both sure to
be shared and selective. So texts are filed under ``BANDS`` hashes of ``ROWS`` least shingle hashes each, and every candidate
pair is verified by the exact resemblance of its two sets of shingles. A pair at 0.8 shares no file once in eight million,
above that less often.

Only components are wanted, so pairs inside one aren't tested. Large groups of near copies have very many pairs: in each of
at most ``LEADERS`` rounds one member of each file, the same one in all files of a group as far as it can be, is tested against the
others, and components are joined. Then, once, all pairs of a file that still lie in different components are tested, by
blocks: a file's members are dealt to blocks of about ``BLOCK`` and every two blocks meet under a key of their own, so
neither a key nor a task holds a whole file. That makes ``LEADERS`` + 1 rounds at most, whatever the texts. New links are contracted to the
components they join, so a round's work on components follows its new links.

Defined cases: a null text is an empty text; texts without words are copies of each other; a text with fewer words than a
shingle is one shingle; very long texts are hashed whole; repeated rows are one node; null ids come after all others, by their
text; an empty table gives no rows; further columns are carried along.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import Masked, Scratch, map_slices
from tidemark.llm.simhash import SEED, components, fingerprints, links, shingle_hashes

#: Files of a text, and least hashes that name a file together.
BANDS, ROWS = 40, 5
#: Percent of two texts' shingles that both must have to be near copies.
RESEMBLANCE = 80
#: Rounds of leaders at most, and pairs of a file's members, for each member, at which all pairs are tested at once.
LEADERS, DENSE = 4, 2
#: Members of a block of a file.
BLOCK = 256


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of texts."""
    return [np.unique(np.array(shingle_hashes(t, size), dtype=np.uint64)) for t in texts]


def banded(texts: list[str], size: int) -> list:
    """For each text: a hash of its set of shingles, how many there are, and the files it belongs to (none without shingles)."""
    sets = shingle_sets(texts, size)
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    full = np.flatnonzero(counts)
    keys: list = [[]] * len(texts)
    if len(full):
        flat, starts = np.concatenate([sets[i] for i in full]), np.append(0, np.cumsum(counts[full])[:-1])
        random = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS), dtype=np.uint64)
        made = np.empty((len(full), BANDS), dtype=np.uint64)
        for band in range(BANDS):
            made[:, band] = band
            for mask, odd in random[:, band * ROWS : (band + 1) * ROWS].T:
                made[:, band] = (made[:, band] ^ np.minimum.reduceat((flat ^ mask) * (odd | np.uint64(1)), starts)) * np.uint64(0x9E3779B97F4A7C15)
                made[:, band] ^= made[:, band] >> np.uint64(29)
        for i, row in zip(full, made.view(np.int64), strict=True):
            keys[i] = row
    nodes = np.array([xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
    return [nodes, counts, keys]


def printed(texts: list[str], size: int) -> list:
    """Fingerprint, and what ``banded`` gives, of each text."""
    return [fingerprints(texts, size)[:, 0], *banded(texts, size)]


def fingerprint_labels(prints: DataFrame, distance: int, kept: Scratch) -> DataFrame:
    """Rows (node, label) of all nodes: those whose fingerprints ``fp`` are of one component of links have one label, a node of theirs.

    A node may have several fingerprints, as it stands for texts that repeat its shingles differently; it then ties their components.
    """
    pairs = kept.written(prints.select("node", "fp").distinct(), "near-fingerprints")
    roots = kept.written(components(links(pairs.select("fp").distinct(), distance), kept.written).select(F.col("node").alias("fp"), "root"), "near-roots")
    filed = pairs.join(roots, "fp", "left").select("node", F.coalesce("root", "fp").alias("root"))
    least = kept.written(filed.groupBy("root").agg(F.min("node").alias("label")), "near-least")
    held = kept.written(filed.join(least, "root").select("node", "label").distinct(), "near-held")
    first = kept.written(held.groupBy("node").agg(F.min("label").alias("label")), "near-seeds")
    ties = first.select("node", F.col("label").alias("a")).join(held, "node").where("a <> label").select("a", F.col("label").alias("b")).distinct()
    ties = kept.written(ties, "near-ties")
    if ties.isEmpty():
        return first
    tied = components(ties, kept.written).select(F.col("node").alias("label"), "root")
    return first.join(tied, "label", "left").select("node", F.coalesce("root", "label").alias("label"))


def similar(pairs: DataFrame, sets: DataFrame, resemblance: int = RESEMBLANCE) -> DataFrame:
    """The pairs (a, b) whose ``sets`` (node, hashes) share at least ``resemblance`` percent of all their members."""
    sides = {c: sets.select(F.col("node").alias(c), F.col("hashes").alias(f"h{c}")) for c in ("a", "b")}
    both = F.size(F.array_intersect("ha", "hb"))
    near = 100 * both >= resemblance * (F.size("ha") + F.size("hb") - both)
    return pairs.join(sides["b"], "b").join(sides["a"], "a").where(near).select("a", "b")


def all_pairs(members: DataFrame, sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b), a < b, of members in one file with different labels, from blocks of the files; ``sizes`` has each file's ``t``."""
    n = F.ceil(F.col("t") / block).cast("int")
    dealt = members.join(sizes.select("key", "t"), "key").withColumn("n_blocks", n).withColumn("own", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    each = dealt.select("key", F.explode(meets).alias("m"), "own", "node", "n", "label").select("key", "m.i", "m.j", "own", "node", "n", "label")
    other = each.select("key", "i", "j", F.col("own").alias("own2"), F.col("node").alias("other"), F.col("n").alias("n2"), F.col("label").alias("label2"))
    # two members meet under the key of their blocks, and under no other
    apart = (F.least("own", "own2") == F.col("i")) & (F.greatest("own", "own2") == F.col("j"))
    return each.join(other, ["key", "i", "j"]).where(apart & (F.col("node") < F.col("other")))


def near_components(members: DataFrame, sets: DataFrame, resemblance: int = RESEMBLANCE, dense: float = DENSE, leaders: int = LEADERS, block: int = BLOCK, seeds: DataFrame | None = None) -> DataFrame:
    """Rows (node, label) of all ``members`` (key, node, n): nodes of one component have one label, a node of it.

    ``seeds`` (node, label) has the labels of nodes that are linked already, of members and others; pairs of one label aren't tested.
    """
    spark = members.sparkSession
    fits = 100 * F.least("n", "n2") >= resemblance * F.greatest("n", "n2")
    kept = Scratch(spark)
    labels = kept.written(members.select("node").distinct().withColumn("label", F.col("node")) if seeds is None else seeds, "near-labels")
    final = False
    for number in range(leaders + 1):
        work = Scratch(spark)
        open_ = members.join(labels, "node")
        by_label = open_.groupBy("key", "label").agg(F.count("*").alias("c"))
        sizes = by_label.groupBy("key").agg(F.sum("c").alias("t"), F.sum(F.col("c") * F.col("c")).alias("own"))
        sizes = work.written(sizes.where("t * t > own"), "near-sizes")  # files of one component are done
        t, pairs = sizes.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum((F.col("t") * F.col("t") - F.col("own")) / 2), F.lit(0))).first()
        if not t:
            work.clear()
            break
        final = final or number == leaders or pairs <= dense * t
        open_ = work.written(open_.join(sizes.select("key"), "key").select("key", "node", "n", "label"), "near-open")
        if final:
            met = all_pairs(open_, sizes, block)
        else:
            least = F.min(F.struct(F.xxhash64("node", F.lit(number)).alias("h"), F.col("node").alias("other"), F.col("n").alias("n2"), F.col("label").alias("label2")))
            leader = open_.groupBy("key").agg(least.alias("x")).select("key", "x.other", "x.n2", "x.label2")
            met = open_.join(work.written(leader, "near-leaders"), "key")
        ends = (F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        tested = work.written(met.where((F.col("label") != F.col("label2")) & fits).select(*ends).distinct(), "near-pairs")
        new = work.written(similar(tested, sets, resemblance), "near-links")
        linked = not new.isEmpty()
        if linked:
            side = {c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b")}
            joined = new.join(side["a"], "a").join(side["b"], "b").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
            roots = components(joined.where("a < b").distinct(), work.written).select(F.col("node").alias("label"), "root")
            labels = kept.written(labels.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "near-labels")
        work.clear()
        if final:
            break
        final = not linked  # leaders link nothing more
    return labels


def representatives(docs: DataFrame, shingle: int = 5, resemblance: int = RESEMBLANCE, doc_id: str = "doc_id", text: str = "text", dense: float = DENSE, leaders: int = LEADERS, block: int = BLOCK, distance: int = 2) -> DataFrame:
    """One row of each component of texts linked by fingerprint or resemblance: that of the smallest id, of repeated rows one.

    Null ids come after all others, by their text. Texts of equal shingles are one node, named by a hash of the set.
    """
    masked, kept = Masked(docs), Scratch(docs.sparkSession)
    columns, text = masked.df.columns, masked[text]
    late = F.xxhash64(text).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    numbered = masked.df.withColumn("_id", F.coalesce(F.col(masked[doc_id]).cast("long"), late))
    prints = kept.written(
        map_slices(numbered, text, [*columns, "_id"], "fp long, node long, n long, keys array<long>", lambda texts: printed(texts, shingle)), "set-prints")
    nodes = kept.written(prints.groupBy("node").agg(F.min("_id").alias("_id"), F.first("n").alias("n"), F.first("keys").alias("keys")), "set-nodes")
    files = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = kept.written(files.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "set-files")
    members = kept.written(files.join(shared, "key").select("key", "node", "n"), "set-members")
    texts = prints.join(kept.written(nodes.select("node", "_id").join(members.select("node").distinct(), "node"), "set-filed"), ["node", "_id"])
    texts = texts.groupBy("node").agg(F.first(text).alias("text"))
    sets = kept.written(map_slices(texts, "text", ["node"], "hashes array<long>", lambda ts: [[s.view(np.int64) for s in shingle_sets(ts, shingle)]]), "set-hashes")
    labels = near_components(members, sets, resemblance, dense, leaders, block, fingerprint_labels(prints, distance, kept))
    rooted = nodes.join(labels, "node", "left").select("node", "_id", F.coalesce("label", "node").alias("root"))
    first = kept.written(rooted.groupBy("root").agg(F.min(F.struct("_id", "node")).alias("x")).select("x._id", "x.node"), "set-firsts")
    order = Window.partitionBy("_id", "node").orderBy(F.xxhash64(*columns))
    same = prints.join(first, ["_id", "node"]).withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return masked.restore(same)
