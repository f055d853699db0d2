"""Language identification by prediction by partial matching.

Each language has a context tree of bytes: for contexts of up to three bytes, how often each byte followed. A byte
seen in its context costs the logarithm of its share, one not seen costs an escape (method C: as many escape counts as
distinct bytes) and is coded in the next shorter context, where bytes already excluded are left out; at the end all
bytes are equally likely. The statistics are frozen after learning, so the code length of every byte in every context
is a table, and a text's exact code length in each language is a sum of table entries. The shortest code wins; the
score is its share of ``2 ** -bits`` over all languages.

Learning uses at most ``SAMPLE`` distinct texts a language, those with the least text hashes; contexts seen fewer than
``MIN_CONTEXT`` times in the sample are left to their shorter ones. Both are parameters.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every text if nothing was
learned; texts are scored whole at any length; equal code lengths go to the first language by name; repeated rows get
equal results; rows without a language aren't learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import arrow_type, bound_batches, map_slices, slices

#: Distinct texts that are learned from, for each language.
SAMPLE = 2000
#: Least number of times a context must have been seen to have statistics of its own.
MIN_CONTEXT = 6
ORDER = 3
PAD = b"\n" * ORDER
UNKNOWN = "und"


def learning_sample(rows: DataFrame, lang: str, text: str, sample: int) -> DataFrame:
    """Distinct (lang, text), for each language those with the ``sample`` least text hashes."""
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    hashes = rows.select("lang", "h").distinct().withColumn("rank", rank).where(F.col("rank") <= sample)
    last = {r["lang"]: r["h"] for r in hashes.groupBy("lang").agg(F.max("h").alias("h")).collect()}  # a row a language
    if not last:
        return rows.select("lang", "text").limit(0)
    bound = F.create_map(*[F.lit(x) for k, v in sorted(last.items()) for x in (k, v)])
    return rows.where(F.col("h") <= bound[F.col("lang")]).groupBy("lang", "h").agg(F.first("text").alias("text")).drop("h")


def gram_counts(sample: DataFrame) -> DataFrame:
    """(lang, gram, n): how often four bytes (three of context, one following) occur in a language's texts."""
    schema = "lang string, gram long, n long"
    from pyspark.sql import types as T

    out = arrow_type(T._parse_datatype_string(schema))
    bound_batches(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                parts: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(langs[a:b], texts[a:b], strict=True):
                    parts.setdefault(lang, []).append(grams_of(text.encode()))
                for lang, found in parts.items():
                    grams, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], schema=out)

    return sample.select("lang", "text").mapInArrow(run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def grams_of(text: bytes) -> np.ndarray:
    b = np.frombuffer(PAD + text, dtype=np.uint8).astype(np.int64)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


@dataclass
class Model:
    """Frozen code lengths: ``bits[state * width + class, language]``."""

    languages: list[str]
    classes: np.ndarray  # class of each byte; 0 for bytes never learned
    width: int
    states: np.ndarray  # state of each three classes of context
    bits: np.ndarray


def build_model(rows: list[tuple[str, int, int]], min_context: int = MIN_CONTEXT) -> Model | None:
    """A model from (language, gram, count) rows."""
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    number = {x: i for i, x in enumerate(languages)}
    lang = np.array([number[r[0]] for r in rows])
    gram, n = np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.float64)
    octets = np.stack([(gram >> s) & 255 for s in (24, 16, 8, 0)])
    classes = np.zeros(256, dtype=np.int64)
    known = np.union1d(np.unique(octets), np.frombuffer(PAD, dtype=np.uint8))
    classes[known] = np.arange(1, len(known) + 1)
    width, many = len(known) + 1, len(languages)
    c = classes[octets]
    states = np.zeros((width, width, width), dtype=np.int32)
    # order 0: escapes share the bytes never seen evenly
    counts = np.zeros((many, width))
    np.add.at(counts, (lang, c[3]), n)
    total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    unseen = kinds / (total + kinds) / np.maximum(1, 256 - kinds)
    layers = [np.where(counts > 0, counts / (total + kinds), unseen)[None]]  # [state, language, class]
    parent = np.zeros(1, dtype=np.int64)
    base = 1
    for order in range(1, ORDER + 1):
        key = np.zeros(len(rows), dtype=np.int64)
        for i in range(order):
            key = key * width + c[3 - order + i]
        contexts, where = np.unique(key, return_inverse=True)
        keep = np.bincount(where, weights=n) >= min_context
        place = np.cumsum(keep) - 1
        contexts = contexts[keep]
        if not len(contexts):
            break
        counts = np.zeros((len(contexts), many, width))
        own = keep[where]
        np.add.at(counts, (place[where[own]], lang[own], c[3][own]), n[own])
        parts = [(contexts // width**i) % width for i in reversed(range(order))]
        # the state of the context without its first byte
        parent = states[(slice(None),) * 0 + tuple([0] * (ORDER - order + 1)) + tuple(parts[1:])] if order > 1 else np.zeros(len(contexts), np.int64)
        lower = np.concatenate(layers)[parent]
        seen = counts > 0
        total, kinds = counts.sum(2, keepdims=True), seen.sum(2, keepdims=True)
        left = np.maximum(1e-12, 1 - np.where(seen, lower, 0).sum(2, keepdims=True))
        with np.errstate(divide="ignore", invalid="ignore"):
            row = np.where(seen, counts / (total + kinds), kinds / (total + kinds) * lower / left)
        layers.append(np.where(total > 0, row, lower))
        number_of = base + np.arange(len(contexts))
        states[(...,) + tuple(parts)] = number_of
        base += len(contexts)
    bits = -np.log2(np.concatenate(layers)).astype(np.float32)
    return Model(languages, classes.astype(np.int32), width, states.ravel(), np.ascontiguousarray(bits.transpose(0, 2, 1)).reshape(-1, many))


def code_lengths(texts: list[str], model: Model) -> np.ndarray:
    """Bits of each text in each language."""
    data = [PAD + t.encode() for t in texts]
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    c = model.classes[np.frombuffer(b"".join(data), dtype=np.uint8)]
    state = model.states[(c[:-3] * model.width + c[1:-2]) * model.width + c[2:-1]]
    bits = model.bits[state * model.width + c[3:]]
    starts = np.append(0, np.cumsum(sizes)[:-1])
    ends = starts + sizes - ORDER
    out = np.zeros((len(texts), len(model.languages)))
    full = np.flatnonzero(ends > starts)
    if len(full):
        cuts = np.stack([starts[full], ends[full]], axis=1).ravel()
        if cuts[-1] == len(bits):
            cuts = cuts[:-1]
        out[full] = np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)[::2]
    return out


LETTER = regex.compile(r"\p{L}")


def predict(texts: list[str], model: Model | None) -> list:
    """Language, score and bits a byte of each text."""
    if model is None:
        return [[UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)]
    bits = code_lengths(texts, model)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(texts)), best]
    score = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1)
    letters = np.array([LETTER.search(t) is not None for t in texts], dtype=bool)
    size = np.array([max(1, len(t.encode())) for t in texts])
    names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters, strict=True)]
    return [names, np.where(letters, score, 0.0), least / size]


def learn(rows: DataFrame, lang: str = "lang", text: str = "text", sample: int = SAMPLE, min_context: int = MIN_CONTEXT) -> Model | None:
    """A model of all languages in ``rows``. The counts that reach the driver are bounded by the sample."""
    counts = gram_counts(learning_sample(rows, lang, text, sample))
    return build_model([tuple(r) for r in counts.collect()], min_context)


def identify(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``lang_pred``, ``score`` and ``bits_per_byte`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_slices(docs, text, keep, "lang_pred string, score double, bits_per_byte double", lambda texts: predict(texts, shared.value))


def held_out(doc_id: Column) -> Column:
    """Documents kept for measuring; a null id isn't."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
