"""Source divergence audit: how each source's use of terms differs from the other sources and from its whole language.

The terms of a language are those in at least ``threshold`` of its documents. They are found by iceberg refinement: byte
prefixes are counted level by level (8, 16, 32, ... bytes), each once a document; prefixes in too few documents are
discarded, and the next level looks only at terms whose prefix was kept, until no prefix is left to extend. A term shorter
than its level's prefixes is complete there. A last reading counts the kept terms by source. Tasks combine their documents
before the shuffle and hold a bounded number of keys. The kept keys reach the tasks as a bit table of fixed size; a
false hit only means that a rare term is counted and then discarded, so the counts are exact at any size of the corpus.

Probabilities and their divergences are integers (see ``probability``). The sum over all kept terms for a pair of sources
is taken over terms that both have, and corrected by the histograms of each source's counts for those that one or none
has, so the work follows the terms that occur together and not sources x sources x terms.

Defined cases: null text, language and source are empty; a document is a row, so repeated rows count each; a source
without terms is a group of its own and has the probabilities of zero counts; a language without kept terms has pairs of
value 0 and no terms; equal values are ranked by the item's bytes; terms of any length are read whole, a level doubles the
prefix, so rounds grow with the logarithm of the longest prefix that enough documents share; an empty table gives no rows;
further columns of any name are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import arrow_type, bound_batches, written

THRESHOLD = 3
#: Bytes of the first level's prefixes.
FIRST = 8
#: Bits of the table of kept prefixes that tasks get; a power of two, 8 MB.
SIEVE_BITS = 1 << 26
#: Keys, and their bytes, that a task combines before it hands them on.
TASK_KEYS, TASK_BYTES = 800_000, 64_000_000
#: Languages for which a task keeps the answers of the bit table at hand.
MOST_LANGS = 64
SCALE = 1_000_000_000
TOP = 200

#: Letters of A-Z as a-z, other letters and bytes of further code points as they are, all else a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTED = "lang string, key binary, open boolean, documents long"
SAID = "lang string, source string, key binary, n long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(TERM_BYTES).split()


class Sieve:
    """Which prefixes may have been kept: a bit for each hash of (language, prefix)."""

    def __init__(self, bits: bytes):
        self.bits = bits
        self.mask = len(bits) * 8 - 1

    def has(self, seed: int, prefix: bytes) -> bool:
        at = zlib.crc32(prefix, seed) & self.mask
        return bool(self.bits[at >> 3] >> (at & 7) & 1)

    def which(self, seed: int, prefixes: list[bytes]) -> np.ndarray:
        """The answer for each of many."""
        at = np.fromiter(map(zlib.crc32, prefixes, repeat(seed)), np.int64, len(prefixes)) & self.mask
        return (np.frombuffer(self.bits, np.uint8)[at >> 3] >> (at & 7) & 1).astype(bool)

    @staticmethod
    def seed(lang: str) -> int:
        return zlib.crc32(lang.encode() + b"\0")

    @staticmethod
    def of(kept: DataFrame, bits: int = SIEVE_BITS) -> "Sieve | None":
        """From ``lang`` and ``key``; None without rows. At most ``bits`` bits reach the driver."""
        hashed = F.crc32(F.concat(F.encode("lang", "UTF-8"), F.lit(b"\0"), F.col("key")))
        at = (hashed.bitwiseAND(F.lit(bits - 1)) + 1).alias("at")
        parts = kept.select(at).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")).collect()
        if not parts:
            return None
        table = bytearray(bits // 8)
        for part in parts:
            start = (part["bucket"] - 1) * len(part["bitmap"])
            room = table[start : start + len(part["bitmap"])]
            table[start : start + len(part["bitmap"])] = bytes(part["bitmap"])[: len(room)]
        return Sieve(bytes(table))


class Tally:
    """Counts by group that a task combines before it hands them on."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.clear()

    def clear(self) -> None:
        self.counts: dict[tuple, Counter] = defaultdict(Counter)
        self.keys = self.bytes = 0

    def add(self, group: tuple, keys, most: int, width: int | None = None) -> None:
        """Count keys, which have at most ``most`` bytes together and ``width`` each."""
        own = self.counts[group]
        known = len(own)
        own.update(keys)
        new = len(own) - known
        self.keys += new
        self.bytes += min(most, new * (width or most))

    def full(self) -> bool:
        return self.keys >= TASK_KEYS or self.bytes >= TASK_BYTES

    def batches(self, columns: Callable, kept: Callable[[str], Kept], step: int = 50_000) -> Iterator[pa.RecordBatch]:
        """The counts as rows: ``columns`` makes the columns of a group, whose first part is its language, from keys and counts; a text stands in all rows."""
        for group, counts in self.counts.items():
            keys, values = list(counts), list(counts.values())
            for at in range(0, len(keys), step):
                made = columns(group, kept(group[0]), keys[at : at + step], values[at : at + step])
                size = max(len(c) for c in made if isinstance(c, list | np.ndarray))
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(c, f.type), size) if isinstance(c, str) else pa.array(c, type=f.type)
                    for c, f in zip(made, self.schema, strict=True)], schema=self.schema)


class Kept:
    """Which keys of a language may have been kept, with the answers for frequent ones at hand."""

    def __init__(self, sieve: Sieve | None, lang: str):
        self.sieve, self.seed, self.known, self.bytes = sieve, Sieve.seed(lang), {}, 0

    def has(self, key: bytes) -> bool:
        good = self.known.get(key)
        if good is None:
            if self.bytes > TASK_BYTES:
                self.known.clear()
                self.bytes = 0
            self.bytes += len(key) + 100
            good = self.known[key] = self.sieve.has(self.seed, key)
        return good

    def beginning(self, terms: Iterable[bytes], before: int) -> list[bytes]:
        """The terms whose prefix of ``before`` bytes may have been kept."""
        known, has = self.known.get, self.has  # most prefixes have been met
        return [t for t in terms if (good := known(t[:before])) or good is None and has(t[:before])]


def counted(docs: DataFrame, schema: str, sieve: Sieve | None, count: Callable[[Tally, Kept, str, str, bytes], None],
            columns: Callable[[tuple, Kept, list, list], list]) -> DataFrame:
    """What ``count`` adds for each (language, source, text), combined by task; one reading of the texts."""
    spark_type = T._parse_datatype_string(schema)
    out = arrow_type(spark_type)
    shared = docs.sparkSession.sparkContext.broadcast(sieve)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, known = Tally(out), {}

        def kept(lang: str) -> Kept:
            if lang not in known:
                if len(known) >= MOST_LANGS:
                    known.clear()
                known[lang] = Kept(shared.value, lang)
            return known[lang]

        for rows in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                count(tally, kept(lang), lang, source, text.encode())
                if tally.full():
                    yield from tally.batches(columns, kept)
                    tally.clear()
        yield from tally.batches(columns, kept)

    return docs.mapInArrow(run, spark_type)


def level(docs: DataFrame, before: int, width: int, sieve: Sieve | None, threshold: int) -> DataFrame:
    """Prefixes of ``width`` bytes (open) and terms of ``before`` to ``width`` - 1 bytes in enough documents."""
    def count(tally: Tally, kept: Kept, lang: str, source: str, text: bytes) -> None:
        terms = terms_of(text)
        if before:
            terms = kept.beginning({t for t in terms if len(t) >= before}, before)
        tally.add((lang,), {t[:width] for t in terms}, len(text), width)

    def columns(group: tuple, kept: Kept, keys: list, values: list) -> list:
        return [group[0], keys, [len(k) == width for k in keys], values]  # what fills the width is open

    dealt = counted(docs, COUNTED, sieve, count, columns).repartition("lang", "key")  # the tasks have combined their rows
    summed = dealt.groupBy("lang", "key", "open").agg(F.sum("documents").alias("documents"))
    return summed.where(F.col("documents") >= threshold).select("lang", "key", "open")


def occurrences(docs: DataFrame, terms: DataFrame, sieve: Sieve | None) -> DataFrame:
    """``lang``, ``source``, ``term`` and ``n`` of the kept terms."""
    def count(tally: Tally, kept: Kept, lang: str, source: str, text: bytes) -> None:
        tally.add((lang, source), terms_of(text), len(text))

    def columns(group: tuple, kept: Kept, keys: list, values: list) -> list:
        good = kept.sieve.which(kept.seed, keys)
        return [group[0], group[1], list(compress(keys, good)), list(compress(values, good))]

    summed = counted(docs, SAID, sieve, count, columns).repartition("lang", "key").groupBy("lang", "key", "source").agg(F.sum("n").alias("n"))
    return summed.join(terms, ["lang", "key"], "left_semi").select("lang", "source", F.col("key").cast("string").alias("term"), "n")


def plain(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    read = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
    return docs.select(read(lang, "lang"), read(source, "source"), read(text, "text"))


def term_counts(docs: DataFrame, threshold: int = THRESHOLD, text: str = "text", lang: str = "lang", source: str = "source", first: int = FIRST,
                sieve_bits: int = SIEVE_BITS) -> DataFrame:
    """``lang``, ``source``, ``term`` and ``n``: occurrences of the terms in at least ``threshold`` documents of the language."""
    rows = plain(docs, text, lang, source)
    before, width, sieve, found = 0, first, None, None
    while before == 0 or sieve is not None:
        kept = written(level(rows, before, width, sieve, threshold), f"terms-{width}")
        complete = kept.where("not open").select("lang", "key")
        found = complete if found is None else found.unionByName(complete)
        sieve = Sieve.of(kept.where("open").select("lang", "key"), sieve_bits)
        before, width = width, width * 2
    sieve = Sieve.of(found, sieve_bits)
    return occurrences(rows if sieve else rows.limit(0), found, sieve)


def probability(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 1) / (total + kept)), exact: in longs, or decimals of 38 digits where the product needs them."""
    wide = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), (total + kept).cast("decimal(20,0)"))
    return 1 + F.when(n < SCALE, F.call_function("div", (n + 1) * F.lit(SCALE).cast("long"), total + kept)).otherwise(wide)


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); both are at most 10^9 + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def audited(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair`` has a row for each other source of the language, part ``term`` the ``top`` terms of a source that it uses
    more than its language does.
    """
    counts = written(term_counts(docs, threshold, text, lang, source), "term-counts")
    groups = plain(docs, text, lang, source).groupBy("lang", "source").count().select("lang", "source")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    sizes = of_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("total_lang"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("used"))
    zero = F.lit(0).cast("long")
    known = groups.join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("kept", "total_lang", "total", "used")])
    known = known.withColumn("p0", F.when(F.col("kept") > 0, probability(zero, F.col("total"), F.col("kept"))))
    known = written(known, "term-groups")

    rated = counts.join(known.select("lang", "source", "kept", "total", "total_lang", "p0"), ["lang", "source"])
    rated = written(rated.withColumn("p", probability(F.col("n"), F.col("total"), F.col("kept"))), "term-rates")
    return pairs(rated, known).unionByName(excesses(rated, of_lang, top))


def excesses(rated: DataFrame, of_lang: DataFrame, top: int) -> DataFrame:
    """Terms above their language's probability, the highest ``top`` of each source."""
    both = rated.join(of_lang, ["lang", "term"]).withColumn("q", probability(F.col("n_lang"), F.col("total_lang"), F.col("kept")))
    above = both.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


SHARED = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("item", T.StringType()),
    T.StructField("high", T.LongType()), T.StructField("low", T.LongType()),
])
#: Sums are taken of value // PART and of value % PART apart, each within a double's whole numbers.
PART = 1 << 20
#: Entries (a term's sources) that a task compares at a time.
ENTRIES = 1_000_000


def shared_terms(rated: DataFrame) -> DataFrame:
    """For each two sources of a language, the sum over terms of both of what the pair has beyond its one-sided parts.

    A term's sources meet in one row. A task takes some rows at a time and compares each source of theirs with all entries
    of the terms that it has, so it holds those entries and a sum for each of the sources, never all pairs.
    """
    entry = F.struct("source", "p", "p0")
    terms = rated.groupBy("lang", "term").agg(F.collect_list(entry).alias("e")).select("lang", "e").where(F.size("e") > 1)
    schema = arrow_type(SHARED)
    bound_batches(rated.sparkSession)

    def summed(lang: str, ends: np.ndarray, names: pa.Array, p: np.ndarray, p0: np.ndarray) -> pa.RecordBatch:
        """One language's terms: ``ends`` of their entries in the arrays."""
        coded = names.dictionary_encode()
        source, words = coded.indices.to_numpy(), coded.dictionary
        term = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        starts, n = np.append(0, ends)[:-1], len(words)
        out = []
        order = np.argsort(source, kind="stable")
        cuts = np.searchsorted(source[order], np.arange(n + 1))
        for s in range(n):
            mine = order[cuts[s] : cuts[s + 1]]  # this source's entries, one a term
            sizes = ends[term[mine]] - starts[term[mine]]
            high, low, seen = np.zeros(n), np.zeros(n), np.zeros(n, bool)
            for part in np.array_split(np.arange(len(mine)), sizes.sum() // ENTRIES + 1):
                k = sizes[part]
                own = np.repeat(mine[part], k)
                other = np.repeat(starts[term[mine[part]]] - np.cumsum(k) + k, k) + np.arange(k.sum())
                a, a0, b, b0, o = p[own], p0[own], p[other], p0[other], source[other]
                value = (a - b) ** 2 // b - (a - b0) ** 2 // b0 - (a0 - b) ** 2 // b + (a0 - b0) ** 2 // b0
                high += np.bincount(o, value // PART, n)
                low += np.bincount(o, value % PART, n)
                seen[o] = True
            seen[s] = False
            at = np.flatnonzero(seen)
            out.append((np.full(len(at), s), at, high[at].astype(np.int64), low[at].astype(np.int64)))
        first, second, high, low = (np.concatenate(x) for x in zip(*out, strict=True))
        columns = [pa.array([lang] * len(first), pa.string()), words.take(pa.array(first)), words.take(pa.array(second)), pa.array(high), pa.array(low)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0)
            for lang in langs.unique().to_pylist():
                lists = batch.column(1).filter(pc.equal(langs, lang))
                entries, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy())
                names, p, p0 = entries.flatten()
                yield summed(lang, ends, names, p.to_numpy(), p0.to_numpy())

    return terms.mapInArrow(run, SHARED)


def pairs(rated: DataFrame, known: DataFrame) -> DataFrame:
    """The sum of excesses over all kept terms for each two sources of a language."""
    wide = "decimal(38,0)"
    p, q, p0, q0 = map(F.col, ("p", "q", "p0", "q0"))
    together = shared_terms(rated).groupBy("lang", "source", "item").agg(
        (F.sum("high").cast(wide) * PART + F.sum("low").cast(wide)).cast(wide).alias("v"))

    # terms of one source alone: each distinct count once for every other source
    alike = rated.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("m"))
    base = known.select("lang", "source", "kept", "used", "p0")
    here = alike.join(base.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")), "lang").where("source <> item").select(
        "lang", "source", "item", (F.col("m").cast("decimal(18,0)") * excess(p, q0).cast("decimal(20,0)")).cast(wide).alias("v"))
    there = alike.select("lang", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"), "m").join(
        base.select("lang", "source", "p0"), "lang").where("source <> item").select(
        "lang", "source", "item", (F.col("m").cast("decimal(18,0)") * excess(p0, q).cast("decimal(20,0)")).cast(wide).alias("v"))
    neither = base.join(base.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("used").alias("used_there")), "lang").where("source <> item").select(
        "lang", "source", "item",
        F.coalesce((F.col("kept") - F.col("used") - F.col("used_there")).cast("decimal(18,0)") * excess(p0, q0).cast("decimal(20,0)"), F.lit(0)).cast(wide).alias("v"))
    halves = [x.groupBy("lang", "source", "item").agg(F.sum("v").alias("v")) for x in (here, there)]
    total = together.unionByName(halves[0]).unionByName(halves[1]).unionByName(neither).groupBy("lang", "source", "item").agg(F.sum("v").cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return total.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
