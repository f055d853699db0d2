"""Document scores by masked pseudo-likelihood of a bidirectional window network.

Words are classes: the most frequent words of the corpus have one each, all others share classes by hash. A network sees
the two classes on each side of a word, not the word: their position-specific vectors are added, passed through tanh, and
predict the word's class in two steps (a group of classes, then the class in it); a word that shares its class has its share
of the class's count in the corpus as probability within it. A document's score is the sum of the log-probabilities of all
its words.

Word counts cover the corpus and stay a table. Texts are cut into words once and written as classes, which training and scoring
read. The shares of the ``KNOWN`` most frequent words that share a class go to all tasks; those of all others are joined by word. The
network is trained in numpy by parameter averaging:
every task runs gradient steps on all windows of its own texts from the same start, and the average over tasks, weighted by
windows, starts the next round; so the tasks' texts have an influence, as in any such averaging, and training amplifies the rounding of
its sums. What is gathered grows with the corpus; only the averaged network, the class words and the known shares reach the driver.

Defined cases: null and empty texts have no words and score 0; words beside the ends see a padding class; repeated rows get
equal scores; very long texts are scored whole; an empty table gives no rows; ties of frequent words go by their bytes.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from xxhash import xxh64_intdigest

from tidemark.llm.common import arrow_type, map_slices, ranges, written

#: Classes: of frequent words, and shared by hash; together GROUPS * GROUPS.
FREQUENT, SHARED, GROUPS = 896, 128, 32
CLASSES, PAD = FREQUENT + SHARED, FREQUENT + SHARED
HIDDEN, SIDE = 24, 2
#: Rounds of averaging, windows in a step, learning rates of the rounds.
ROUNDS, STEP, RATES = 2, 2048, (0.25, 0.12)
#: Seed of Spark's own xxhash64, so that words meet their counts by the same hash.
SEED = 42
#: Words counted by a task before it passes its counts on, and words whose class it remembers.
COUNT_MEMORY, WORD_MEMORY = 300_000, 300_000
#: Words with a share that all tasks know, about 2 MB.
KNOWN = 131_072
#: Windows that are scored at a time; the greatest score whose exponential is taken as it is, and how far below the greatest one counts.
POSITIONS, PLAIN, LEAST = 4096, 40, -60


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over the whole corpus, counted in tasks first."""
    schema = "word binary, n long"
    out = arrow_type(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def passed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=out)
            counts.clear()
            return batch

        for batch in batches:
            for t in batch.column(0):
                counts.update(words(t.as_py() or ""))
                if len(counts) > COUNT_MEMORY:
                    yield passed()
        yield passed()

    return docs.select(F.col(f"`{text}`")).mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


class Numbered(dict):
    """Numbers of words, the frequent ones' their ranks, with each number's class, hash and share; a share that isn't known is not a number."""

    def __init__(self, frequent: list[bytes], known: tuple[np.ndarray, np.ndarray]):
        super().__init__((w, i) for i, w in enumerate(frequent))
        self.known, self.new, n = known, [], len(frequent)
        self.classes, self.hashes, self.shares = array("H", range(n)), array("Q", bytes(8 * n)), array("d", bytes(8 * n))

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def of(self, found: list[list[bytes]], n: int) -> np.ndarray:
        """Numbers of the ``n`` words of lists."""
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(found)), dtype=np.int64, count=n)
        hashes = np.fromiter((xxh64_intdigest(w, SEED) for w in self.new), dtype=np.uint64, count=len(self.new))
        shares, (of, known) = np.full(len(hashes), np.nan), self.known
        if len(of):
            at = np.minimum(np.searchsorted(of, hashes), len(of) - 1)
            shares = np.where(of[at] == hashes, known[at], shares)
        for kept, more in ((self.classes, (FREQUENT + hashes % SHARED).astype(np.uint16)), (self.hashes, hashes), (self.shares, shares)):
            kept.frombytes(more.tobytes())
        self.new = []
        return numbers


class Classes:
    """Classes of words: the frequent ones by rank, the others by hash; ``known`` has hashes in order and their shares."""

    def __init__(self, frequent: list[bytes], known: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0))):
        self.frequent, self.known = frequent, known
        self.memory = Numbered(frequent, known)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words in the memory, which holds until the next call, and words by text."""
        if len(self.memory) > WORD_MEMORY:
            self.memory = Numbered(self.frequent, self.known)
        found = [words(t) for t in texts]
        counts = np.array([len(f) for f in found], dtype=np.int64)
        return self.memory.of(found, int(counts.sum())), counts

    def padded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes of texts with padding around each, the places of their words, and words by text."""
        numbers, counts = self.numbers(texts)
        return *with_padding(np.frombuffer(self.memory.classes, np.uint16)[numbers], counts), counts

    def encoded(self, texts: list[str]) -> list:
        """Of each text: its classes as bytes, characters, sum of known shares, and hashes and counts of the words whose share isn't known."""
        numbers, counts = self.numbers(texts)
        codes = np.frombuffer(self.memory.classes, np.uint16)[numbers]
        shares = np.frombuffer(self.memory.shares)[numbers]
        ends, full = np.append(0, np.cumsum(counts)), np.flatnonzero(counts)
        unknown = np.flatnonzero(np.isnan(shares))
        shares[unknown] = 0
        known = np.zeros(len(texts))
        if len(full):
            known[full] = np.add.reduceat(shares, ends[:-1][full])
        own = np.repeat(np.arange(len(texts)), counts)[unknown]
        uses, times = np.unique(own << 32 | numbers[unknown], return_counts=True)
        hashes = np.frombuffer(self.memory.hashes, np.int64)[uses & 0xFFFFFFFF]
        cuts = np.searchsorted(uses >> 32, np.arange(1, len(texts)))
        return [[codes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], [len(t) for t in texts], known, np.split(hashes, cuts), np.split(times, cuts)]


def with_padding(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of texts with padding around each, and the places of their words."""
    flat = np.full(len(codes) + SIDE * (len(counts) + 1), PAD, dtype=np.uint16)
    places = np.arange(len(codes)) + np.repeat((np.arange(len(counts)) + 1) * SIDE, counts)
    flat[places] = codes
    return flat, places


def padded_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """What ``with_padding`` gives, and words by text, of each slice of the texts in batches of (classes, characters, further columns), and its rows."""
    for batch in batches:
        each = batch.column(0).to_pylist()
        counts = np.array([len(c) // 2 for c in each], dtype=np.int64)
        for a, b in ranges(batch.column(1).to_pylist()):
            yield *with_padding(np.frombuffer(b"".join(each[a:b]), np.uint16), counts[a:b]), counts[a:b], batch.slice(a, b - a)


OFFSETS = (-2, -1, 1, 2)


@dataclass
class Network:
    """Vectors of the context classes by position, and the two prediction steps."""

    context: np.ndarray  # position, class, hidden
    bias: np.ndarray
    group: np.ndarray  # hidden, group
    group_bias: np.ndarray
    inner: np.ndarray  # group, hidden, class in it
    inner_bias: np.ndarray

    @classmethod
    def start(cls, seed: int = 1) -> Network:
        r = np.random.default_rng(seed)
        scale = 1 / np.sqrt(HIDDEN)
        return cls(*(x.astype(np.float32) for x in (
            r.normal(0, 0.3, (len(OFFSETS), CLASSES + 1, HIDDEN)), np.zeros(HIDDEN), r.normal(0, scale, (HIDDEN, GROUPS)), np.zeros(GROUPS),
            r.normal(0, scale, (GROUPS, HIDDEN, GROUPS)), np.zeros((GROUPS, GROUPS)))))

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.bias, self.group, self.group_bias, self.inner, self.inner_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @classmethod
    def from_flat(cls, values: np.ndarray) -> Network:
        out, at = [], 0
        for a in cls.start().arrays():
            out.append(values[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return cls(*out)

    def hidden(self, flat: np.ndarray, places: np.ndarray) -> np.ndarray:
        h = self.bias + self.context[0].take(flat[places + OFFSETS[0]], axis=0)
        for table, offset in zip(self.context[1:], OFFSETS[1:], strict=True):
            h += table.take(flat[places + offset], axis=0)
        return np.tanh(h)

    def matrices(self) -> np.ndarray:
        """Each group's matrix: columns of all groups, then of the group's classes; the last row has their biases."""
        out = np.empty((GROUPS, HIDDEN + 1, 2 * GROUPS), dtype=np.float32)
        out[:, :HIDDEN, :GROUPS], out[:, HIDDEN, :GROUPS] = self.group, self.group_bias
        out[:, :HIDDEN, GROUPS:], out[:, HIDDEN, GROUPS:] = self.inner, self.inner_bias
        return out

    def log_probabilities(self, flat: np.ndarray, places: np.ndarray) -> np.ndarray:
        out, matrices = np.empty(len(places), dtype=np.float64), self.matrices()
        for a in range(0, len(places), POSITIONS):
            order, some, target, cuts = by_group(flat, places[a : a + POSITIONS])
            h = np.ones((len(some), HIDDEN + 1), dtype=np.float32)
            h[:, :HIDDEN] = self.hidden(flat, some)
            scores = np.empty((len(some), 2 * GROUPS), dtype=np.float32)
            for g in range(GROUPS):
                np.matmul(h[cuts[g] : cuts[g + 1]], matrices[g], out=scores[cuts[g] : cuts[g + 1]])
            bounded(scores)
            own = sum(scores.ravel()[cells].astype(np.float64) for cells in target_cells(target))
            out[a + order] = own - np.log(row_sums(exponentials(scores))).reshape(-1, 2).sum(1, dtype=np.float64)
        return out

    def train(self, flat: np.ndarray, places: np.ndarray, rate: float) -> None:
        """Gradient steps over the windows, in place.

        A step's windows are in order of their group, so each group's are a slice; one product with its matrix gives both
        predictions of a window, and what is no such product is done for all groups, and for all four positions, at once.
        """
        tables, offsets = self.context.reshape(-1, HIDDEN), np.array(OFFSETS)[:, None]
        shift = (np.arange(len(OFFSETS)) * (CLASSES + 1))[:, None]
        matrices, change = self.matrices(), np.empty((GROUPS, HIDDEN + 1, 2 * GROUPS), dtype=np.float32)
        outer, inner = matrices[0, :, :GROUPS].copy(), matrices[:, :, GROUPS:]
        size = min(STEP, len(places))
        h_, d_ = np.ones((size, HIDDEN + 1), dtype=np.float32), np.empty((size, 2 * GROUPS), dtype=np.float32)
        dh_, other_ = np.empty((2, size, HIDDEN), dtype=np.float32)
        for a in range(0, len(places), STEP):
            _, some, target, cuts = by_group(flat, places[a : a + STEP])
            n = len(some)
            step, slices_ = np.float32(rate / np.sqrt(n)), [slice(*c) for c in zip(cuts[:-1], cuts[1:], strict=True)]
            h, d, dh, other = h_[:n], d_[:n], dh_[:n], other_[:n]
            near = flat[some + offsets] + shift  # places in all tables, of each position
            tables.take(near[0], axis=0, out=dh, mode="clip")  # with a mode that raises, numpy copies its output
            for own in near[1:]:
                dh += tables.take(own, axis=0, out=other, mode="clip")
            dh += self.bias
            np.tanh(dh, out=h[:, :HIDDEN])
            matrices[:, :, :GROUPS] = outer
            for g, own in enumerate(slices_):
                np.matmul(h[own], matrices[g], out=d[own])
            exponentials(bounded(d))
            both = d.reshape(-1, GROUPS)
            both /= row_sums(d)[:, None]
            for cells in target_cells(target):
                d.reshape(-1)[cells] -= 1
            for g, own in enumerate(slices_):
                np.matmul(d[own], matrices[g, :HIDDEN].T, out=dh[own])
                np.matmul(h[own].T, d[own], out=change[g])
            np.multiply(h[:, :HIDDEN], h[:, :HIDDEN], out=other)
            dh *= np.subtract(1, other, out=other)
            change *= step
            outer -= change[:, :, :GROUPS].sum(0)
            inner -= change[:, :, GROUPS:]
            dh *= step
            self.bias -= np.ones(n, dtype=np.float32) @ dh
            own = near.astype(np.uint16).ravel()  # two bytes wide, so sorted by digits
            order = np.argsort(own, kind="stable")
            own = own[order]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            pairs = dh.view(np.complex64)  # two numbers are added at a time
            tables[own[first]] -= np.add.reduceat(pairs.take(np.tile(np.arange(n), len(OFFSETS))[order], axis=0), first, axis=0).view(np.float32)
        self.group[:], self.group_bias[:] = outer[:HIDDEN], outer[HIDDEN]
        self.inner[:], self.inner_bias[:] = inner[:, :HIDDEN], inner[:, HIDDEN]


def by_group(flat: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """An order of places by the group of their class, the places and classes in it, and where each group begins."""
    order = np.argsort((flat[some] % GROUPS).astype(np.uint8), kind="stable")
    some = some[order]
    return order, some, flat[some], np.searchsorted(flat[some] % GROUPS, np.arange(GROUPS + 1)).tolist()


def target_cells(target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of each row's group, and of its class in the group, among rows of both predictions."""
    rows = np.arange(0, len(target) * 2 * GROUPS, 2 * GROUPS)
    return rows + target % GROUPS, rows + GROUPS + target // GROUPS


def bounded(scores: np.ndarray) -> np.ndarray:
    """The scores, in place less the greatest of their prediction if some are far from zero."""
    if not (scores.max() < PLAIN and scores.min() > -PLAIN):
        both = scores.reshape(-1, GROUPS)
        both -= both.max(axis=1, keepdims=True)
    return scores


def exponentials(scores: np.ndarray) -> np.ndarray:
    """In place, of bounded scores; what a sum wouldn't show isn't let down to denormal numbers, with which products take many times as long."""
    return np.exp(np.maximum(scores, np.float32(LEAST), out=scores), out=scores)


def row_sums(scores: np.ndarray) -> np.ndarray:
    return scores.reshape(-1, GROUPS) @ np.ones(GROUPS, dtype=np.float32)


#: What ``encoded`` adds to a text's other columns.
ENCODED = "_codes binary, _chars long, _known double, _rare array<long>, _times array<long>"


def encoded(docs: DataFrame, keep: list[str], text: str, *given: object) -> DataFrame:
    """The ``keep`` columns and ``ENCODED`` of every document, written; ``given`` is what ``Classes`` get."""
    shared = docs.sparkSession.sparkContext.broadcast(given)
    memory: dict[str, Classes] = {}

    def run(texts: list[str]) -> list:
        if "classes" not in memory:
            memory["classes"] = Classes(*shared.value)
        return memory["classes"].encoded(texts)

    return written(map_slices(docs, text, keep, ENCODED, run), "word-classes")


def trained(docs: DataFrame, frequent: list[bytes], text: str = "text", rounds: int = ROUNDS) -> Network:
    """The network after averaging rounds over all tasks."""
    return fitted(encoded(docs, [], text, frequent), rounds)


def fitted(texts: DataFrame, rounds: int = ROUNDS) -> Network:
    """The network after averaging rounds over all tasks, of ``ENCODED`` texts."""
    schema = "i int, weighted double, weight double"
    out = arrow_type(T._parse_datatype_string(schema))
    sc, network = texts.sparkSession.sparkContext, Network.start()
    for number in range(rounds):
        start = sc.broadcast(network)
        rate = RATES[min(number, len(RATES) - 1)]

        def run(batches: Iterator[pa.RecordBatch], start=start, rate=rate) -> Iterator[pa.RecordBatch]:
            own, windows = Network.from_flat(start.value.flat()), 0
            for flat, places, _, _ in padded_slices(batches):
                own.train(flat, np.random.default_rng(len(places)).permutation(places), rate)
                windows += len(places)
            if windows:
                values = own.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(len(values)), pa.int32()), pa.array(values * windows), pa.array(np.full(len(values), float(windows)))], schema=out)

        parts = texts.select("_codes", "_chars").mapInArrow(run, schema)
        mean = parts.groupBy("i").agg((F.sum("weighted") / F.sum("weight")).alias("v")).collect()  # a row a parameter
        if mean:
            values = np.empty(len(mean))
            values[[r["i"] for r in mean]] = [r["v"] for r in mean]
            network = Network.from_flat(values)
    return network


def frequent_words(counts: DataFrame) -> list[bytes]:
    return [bytes(r["word"]) for r in counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT).collect()]


def word_shares(counts: DataFrame, frequent: list[bytes]) -> DataFrame:
    """(hash, n, share): the logarithm of each word's share of the class that it shares with others, and its count."""
    own = counts.sparkSession.createDataFrame([(w,) for w in frequent], "word binary")
    hashed = F.xxhash64("word")
    rest = counts.join(own, "word", "left_anti").select(hashed.alias("hash"), hashed.bitwiseAND(SHARED - 1).alias("class"), "n")
    sums = rest.groupBy("class").agg(F.sum("n").alias("all"))  # a row a class
    return rest.join(F.broadcast(sums), "class").groupBy("hash").agg(F.sum("n").alias("n"), F.ln(F.sum("n") / F.max("all")).alias("share"))


def known_shares(shares: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and shares of the ``KNOWN`` most frequent words that have a share."""
    found = shares.orderBy(F.col("n").desc(), "hash").limit(KNOWN).select("hash", "share").toArrow()
    hashes, known = found["hash"].to_numpy().view(np.uint64), found["share"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], known[order]


def scored(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``n_words``, ``log_likelihood`` and its mean by word, of every document."""
    counts = written(word_counts(docs, text), "word-counts")
    frequent = frequent_words(counts)
    shares = written(word_shares(counts, frequent), "word-shares")
    names = [f"_k{i}" for i in range(len(keep))]
    kept = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("_text"))
    texts = encoded(kept.withColumn("_row", F.monotonically_increasing_id()), [*names, "_row"], "_text", frequent, known_shares(shares))
    shared = docs.sparkSession.sparkContext.broadcast(fitted(texts))
    given = texts.select("_codes", "_chars", *names, "_row", "_known")
    schema = T.StructType([*given.schema.fields[2:], *T._parse_datatype_string("_words long, _classes double").fields])
    out = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, places, counts, rows in padded_slices(batches):
            total, full = np.zeros(len(counts)), np.flatnonzero(counts)
            if len(full):
                starts = np.append(0, np.cumsum(counts)[:-1])[full]
                total[full] = np.add.reduceat(shared.value.log_probabilities(flat, places), starts)
            columns = [c.cast(f.type) for c, f in zip(rows.columns[2:], out, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts), pa.array(total)], schema=out)

    rows = written(given.mapInArrow(run, schema), "word-scores")
    uses = texts.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("u")).select("_row", F.col("u._rare").alias("hash"), F.col("u._times").alias("times"))
    # summed as whole numbers of 1e-12, in two parts that a text can't overflow, so that the order of the words doesn't matter
    units = shares.select("hash", F.round(F.col("share") * 1e12).cast("long").alias("units"))
    high, low = (F.sum(F.col("times") * x) for x in (F.shiftright("units", 20), F.col("units").bitwiseAND((1 << 20) - 1)))
    within = uses.join(units, "hash").groupBy("_row").agg(((high * F.lit(float(1 << 20)) + low) / 1e12).alias("_within"))
    total = F.col("_classes") + F.col("_known") + F.coalesce("_within", F.lit(0.0))
    return rows.join(within, "_row", "left").select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.col("_words").alias("n_words"), total.alias("log_likelihood"),
        (total / F.greatest(F.lit(1), "_words")).alias("mean_log_likelihood"))
