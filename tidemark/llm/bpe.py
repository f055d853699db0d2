"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

A slice of texts is one array of code points. Its words are cut in array operations by the pre-tokenizer's
character classes, and known words are found by a hash of their code points. The new words are merged together:
the symbols of many words lie in one flat array, the rank of adjacent pairs comes from a binary search over the
sorted pair keys, and each round joins, in each word, all leftmost occurrences of its lowest-ranked pair. A pair's
rank is above that of the merges that made its parts, so joining equal pairs at once gives the same ids as joining
one at a time.

Defined cases: null and empty texts have no ids; a special token's string inside a text becomes its id; texts
of any length are encoded whole; repeated rows give repeated results; other columns are passed through by name.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import regex

#: Words whose ids a task remembers; later ones are encoded each time they come, with the same result.
CACHE_WORDS = 400_000
#: Longer words are looked up as text, shorter ones by a 64-bit hash.
HASHED_CHARS = 64

# Code points that the pattern library counts as letters or numbers and the tokenizers library,
# with an older character table, doesn't.
NEWER = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3
16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
_NEWER = "".join("-".join(rf"\U{x:0>8}" for x in r.split("-")) for r in NEWER.split())
# The character classes and contractions of the public byte-level pre-tokenizer.
CLASSES = {1: rf"(?V1)[\p{{L}}--[{_NEWER}]]+", 2: rf"(?V1)[\p{{N}}--[{_NEWER}]]+", 3: r"\p{White_Space}+"}
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
CONTRACTIONS = ("'s", "'t", "'m", "'d", "'re", "'ve", "'ll")


@lru_cache(maxsize=1)
def char_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its class and a fixed random number."""
    kind = np.full(0x110000, OTHER, dtype=np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for k, pattern in CLASSES.items():
            for m in regex.finditer(pattern, every):
                kind[low + m.start() : low + m.end()] = k
    return kind, np.random.default_rng(7).integers(0, 1 << 64, 0x110000, dtype=np.uint64)


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        x = np.full(n, b, dtype=np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def word_starts(cp: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer's words start; ``fresh`` marks the first character of each text or part of it."""
    kind = char_tables()[0][cp]
    space = kind == SPACE
    before = np.append(np.uint8(0), kind[:-1])
    before[fresh] = 0
    last_blank = np.append(False, cp[:-1] == 32) & ~fresh
    start = np.where(space, before != SPACE, (before != kind) & ~last_blank)
    # the last of a run of spaces stands apart when a word follows in the same text
    start[:-1] |= space[:-1] & ~space[1:] & ~fresh[1:]
    quotes = np.flatnonzero((cp == 39) & ((before == 0) | (before == LETTER) | (before == NUMBER) | (before == SPACE)) & ~last_blank)
    for mark in CONTRACTIONS if len(quotes) else ():
        at = quotes[quotes + len(mark) <= len(cp)]
        for i, c in enumerate(mark[1:], 1):
            at = at[(cp[at + i] == ord(c)) & ~fresh[at + i]]
        for i in range(1, len(mark)):
            start[at + i] = False
        start[(at + len(mark))[at + len(mark) < len(cp)]] = True
    return np.flatnonzero(start | fresh)


def byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins of the public byte-level alphabet."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """Merge ranks and byte strings of a tokenizer file, as sorted arrays."""

    keys: np.ndarray  # sorted left * size + right
    ranks: np.ndarray
    joined: np.ndarray  # id of the joined pair, in the order of keys
    first: np.ndarray  # id of each byte
    bytes_: list[bytes]
    special: dict[str, int]
    size: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        ids, symbols = data["model"]["vocab"], byte_of_symbol()
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*ids.values(), *special.values()]) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], dtype=np.int64)
        joined = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        text: list[bytes] = [b""] * size
        for token, i in ids.items():
            text[i] = bytes(symbols[c] for c in token)
        for token, i in special.items():
            text[i] = token.encode()
        first = np.zeros(256, dtype=np.int64)
        for c, b in symbols.items():
            first[b] = ids[c]
        if size <= 1 << 16:
            keys = keys.astype(np.uint32)
        return cls(keys[order], order.astype(np.int64), joined[order], first, text, special, size)


def pair_ranks(left: np.ndarray, right: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each pair (one past the last if it has none) and its place among the keys, by binary search."""
    keys = (left * v.size + right).astype(v.keys.dtype)
    at = np.minimum(np.searchsorted(v.keys, keys), len(v.keys) - 1)
    return np.where(v.keys[at] == keys, v.ranks[at], len(v.ranks)), at


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and how many each word has."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    symbols = v.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    none = len(v.ranks)
    rank, at = np.full(len(symbols), none), np.zeros(len(symbols), dtype=np.int64)
    changed = np.flatnonzero(word[:-1] == word[1:])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        rank[changed], at[changed] = pair_ranks(symbols[changed], symbols[changed + 1], v)
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        count = np.diff(np.append(starts, len(symbols)))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), count)
        active = lowest < none
        if not active.all():
            done.append((symbols[~active], word[~active]))
            symbols, word, rank, at, lowest = (x[active] for x in (symbols, word, rank, at, lowest))
            if not len(symbols):
                break
        hit = rank == lowest
        position = np.arange(len(symbols))
        # in a run of overlapping pairs (a a a), every second one from the left is joined
        first = hit & ~np.append(False, hit[:-1])
        hit &= (position - np.maximum.accumulate(np.where(first, position, 0))) % 2 == 0
        symbols = np.where(hit, v.joined[at], symbols)
        keep = ~np.append(False, hit[:-1])
        symbols, word, rank, at, hit = (x[keep] for x in (symbols, word, rank, at, hit))
        touched = hit | np.append(hit[1:], False)
        inside = np.append(word[:-1] == word[1:], False)
        rank[touched & ~inside] = none
        changed = np.flatnonzero(touched & inside)
    if not done:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    ids, owner = np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=len(words))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one run after another."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.append(0, np.cumsum(counts)[:-1]), counts)
    return shift + np.arange(total)


class WordTable:
    """Open-addressing table from 64-bit hashes to row numbers 0, 1, 2, ..., in arrays."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.row = np.full(1 << bits, -1, dtype=np.int64)
        self.key = np.zeros(1 << bits, dtype=np.uint64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 if it is unknown."""
        mask = len(self.row) - 1
        slot = (hashes >> self.shift).astype(np.int64)
        found = self.row[slot]
        open_ = np.flatnonzero((found >= 0) & (self.key[slot] != hashes))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            found[open_] = self.row[slot[open_]]
            open_ = open_[(found[open_] >= 0) & (self.key[slot[open_]] != hashes[open_])]
        return found

    def add(self, hashes: np.ndarray, first_row: int) -> None:
        """Give distinct unknown hashes the rows from ``first_row`` on."""
        mask = len(self.row) - 1
        slot, left = (hashes >> self.shift).astype(np.int64), np.arange(len(hashes))
        while len(left):
            free = left[self.row[slot[left]] < 0]
            taken, one = np.unique(slot[free], return_index=True)
            self.row[taken] = first_row + free[one]
            self.key[taken] = hashes[free[one]]
            left = left[self.key[slot[left]] != hashes[left]]
            slot[left] = (slot[left] + 1) & mask


@dataclass
class Encoder:
    """Encodes and decodes lists of whole texts; one per Python task."""

    vocabulary: Vocabulary
    cache_words: int = CACHE_WORDS
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __post_init__(self) -> None:
        self.table = WordTable(max(4, (2 * self.cache_words).bit_length() + 1))
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.token_bytes = np.frombuffer(b"".join(self.vocabulary.bytes_), dtype=np.uint8)
        self.token_sizes = np.array([len(b) for b in self.vocabulary.bytes_], dtype=np.int64)
        self.token_starts = np.append(0, np.cumsum(self.token_sizes)[:-1])

    def rows(self, hashes: np.ndarray, text: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Row in ``ids`` of each word; new words are merged, and remembered while there is room."""
        row = self.table.find(hashes)
        unknown = np.flatnonzero(row < 0)
        if len(unknown):
            keys, one, inverse = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            spans = zip(starts[unknown[one]].tolist(), ends[unknown[one]].tolist(), strict=True)
            base = self.extend([text[a:b] for a, b in spans])
            row[unknown] = base + inverse
            room = min(len(keys), max(0, self.cache_words - base))
            self.table.add(keys[:room], base)
        return row

    def extend(self, words: list[str]) -> int:
        ids, counts = merge_words([w.encode() for w in words], self.vocabulary)
        base = len(self.counts)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.append(0, np.cumsum(counts)[:-1])[: len(words)]])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        return base

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        text = "".join(texts)
        if not text:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cp = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        fresh = np.zeros(len(cp), dtype=bool)
        bounds = np.append(0, np.cumsum(sizes))
        fresh[bounds[:-1][sizes > 0]] = True
        marks = self.special_spans(texts, bounds)
        for a, b, _ in marks:
            fresh[a] = True
            fresh[b : b + 1] = True
        starts = word_starts(cp, fresh)
        for a, b, _ in marks:  # what lies inside a special token is one word
            i, j = np.searchsorted(starts, [a + 1, b])
            starts = np.delete(starts, slice(i, j))
        ends = np.append(starts[1:], len(cp))
        power, inverse = powers(1 << max(10, int(len(cp)).bit_length()))
        total = np.append(np.uint64(0), np.cumsum(char_tables()[1][cp] * power[: len(cp)]))
        length = ends - starts
        hashes = (total[ends] - total[starts]) * inverse[starts] + length.astype(np.uint64)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(32)
        long_ = np.flatnonzero(length > HASHED_CHARS)
        place: dict[str, int] = {}
        if len(long_):
            for i in long_.tolist():
                place.setdefault(text[starts[i] : ends[i]], i)
        row = np.zeros(len(starts), dtype=np.int64)
        short = np.flatnonzero(length <= HASHED_CHARS)
        row[short] = self.rows(hashes[short], text, starts[short], ends[short])
        remembered = min(len(self.counts), self.cache_words)
        if len(long_):
            base = self.extend(list(place))
            order = {w: base + i for i, w in enumerate(place)}
            row[long_] = [order[text[starts[i] : ends[i]]] for i in long_.tolist()]
        counts = self.counts[row]
        first = self.starts[row]
        ids = self.ids
        if marks:
            at = np.searchsorted(starts, [a for a, _, _ in marks])
            first[at], counts[at] = len(ids) + np.arange(len(marks)), 1
            ids = np.append(ids, np.array([i for _, _, i in marks], dtype=np.uint32))
        out = ids[ragged(first, counts)]
        before = np.append(0, np.cumsum(counts))
        totals = np.diff(before[np.searchsorted(starts, bounds)])
        self.starts, self.counts = self.starts[:remembered], self.counts[:remembered]
        self.ids = self.ids[: int(self.starts[-1] + self.counts[-1]) if remembered else 0]
        return out, totals

    def special_spans(self, texts: list[str], bounds: np.ndarray) -> list[tuple[int, int, int]]:
        """Start, end and id of the special tokens' strings in the joined texts."""
        if not self.specials:
            return []
        return [
            (int(bounds[i]) + m.start(), int(bounds[i]) + m.end(), self.vocabulary.special[m[0]])
            for i, t in enumerate(texts) for m in self.specials.finditer(t)
        ]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of runs of ids; bytes that are no valid text become replacement characters."""
        sizes = self.token_sizes[ids]
        data = self.token_bytes[ragged(self.token_starts[ids], sizes)].tobytes()
        cuts = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
        return [data[a:b].decode("utf-8", errors="replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_ENCODERS: dict[int, Encoder] = {}


def task_encoder(vocabulary) -> Encoder:
    """The Python worker's encoder of a broadcast vocabulary; its word memory lasts over batches."""
    key = vocabulary.value
    if id(key) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[id(key)] = Encoder(key)
    return _ENCODERS[id(key)]


def encode_texts(df, text: str, keep: list[str], path: str):
    """The ``keep`` columns and ``ids array<int>`` of each whole text."""
    from tidemark.llm.common import map_slices

    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def run(texts: list[str]) -> list:
        ids, counts = task_encoder(vocabulary).encode(texts)
        return [np.split(ids.astype(np.int32), np.cumsum(counts)[:-1])]

    return map_slices(df, text, keep, "ids array<int>", run)


def decode_ids(df, ids: str, keep: list[str], path: str):
    """The ``keep`` columns and the ``text`` of each array of ids (null: empty)."""
    from collections.abc import Iterator

    import pyarrow as pa
    from pyspark.sql import functions as F, types as T

    from tidemark.llm.common import arrow_type

    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("text", T.StringType())])
    out = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1).fill_null([])
            counts = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = column.flatten().to_numpy(zero_copy_only=False)
            texts = task_encoder(vocabulary).decode(values.astype(np.int64), counts)
            columns = [batch.column(i).cast(out.field(i).type) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema=out)

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").cast("array<int>").alias("_ids")).mapInArrow(run, schema)
