"""Packing of token sequences of at most ``capacity`` tokens, by a configuration linear program.

Documents become items: a longer document is cut into full pieces, the first of which may be shorter. Only the
histogram of item lengths (one count for each length up to the capacity) comes to the driver. A configuration is a
multiset of lengths that fits one sequence; the program covers all items with as few configurations as possible.
Multiplicative weights solve it: a token is priced by its length's weight, a knapsack dynamic program finds the
dearest configurations through each length, and the weights of the lengths they cover fall. The covering is rounded
down to whole sequences and the items left are placed best-fit.

Items learn their sequences without passing the driver: tasks number their items by length, counts of tasks are
summed to offsets, and the plan says which of a length's items go to which sequences and where.

Defined cases: a null text is an empty text and still has its end token; equal lengths are packed in task order;
repeated rows are packed each; an empty table gives no rows; very long texts give many pieces; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm import bpe
from tidemark.llm.common import arrow_type, bound_batches, slices, written

CAPACITY = 1024
#: Rounds of multiplicative weights.
ROUNDS = 120
#: How fast the weight of a length that is covered ahead of its share falls.
STEP = 1.0
#: Least part of a sequence that a configuration must fill to be used in rounding.
FULL = 0.95
#: Lengths in a configuration.
CONTENT = np.dtype("<i4")


class Knapsack:
    """Dearest configurations by dynamic programming: ``value[c]`` is the most that c tokens can be worth.

    ``price[l]`` is what an item of length l is worth; lengths without items are left out. Among equally dear
    configurations those of longer items are preferred, so short items, which fit anywhere, are kept for later.
    """

    def __init__(self, price: np.ndarray, here: np.ndarray):
        capacity = len(price) - 1
        self.capacity, self.choice = capacity, np.zeros(capacity + 1, dtype=np.int64)
        value = np.zeros(capacity + 1)
        worth = np.where(here, price, -1.0)[:0:-1]  # longest first
        for c in range(1, capacity + 1):
            options = worth[capacity - c :] + value[:c]  # length c with nothing, c - 1 with 1 token, ...
            best = int(options.argmax())
            if options[best] >= value[c - 1] and options[best] > 0:
                value[c], self.choice[c] = options[best], c - best
            else:
                value[c] = value[c - 1]
        self.value = value

    def through(self, length: int, left: np.ndarray) -> np.ndarray:
        """A dearest configuration with an item of ``length``, as counts by length, within the items left."""
        used = np.zeros(self.capacity + 1, dtype=np.int64)
        used[length] = 1
        c = self.capacity - length
        while c > 0:
            take = self.choice[c]
            if take and used[take] < left[take]:
                used[take] += 1
                c -= take
            else:
                c -= 1
        return used


def cover(counts: np.ndarray, rounds: int) -> list[tuple[bytes, float]]:
    """Configurations, as ``lengths_in`` reads them, and how often each is used: an approximate solution of the covering program.

    There can be one for each round and length, so each is kept as the lengths in it and not as a count for every length.

    Each round prices lengths by token, solves the knapsack once and takes, for every length, longest first, the
    dearest configuration through it, for its share of the round. Weights fall as lengths are covered, so a length
    that is covered late grows dear.
    """
    capacity = len(counts) - 1
    lengths, here = np.arange(capacity + 1), counts > 0
    covered, used = np.zeros(capacity + 1), {}
    for r in range(1, rounds + 1):
        ahead = covered / np.maximum(1, counts) - (r - 1) / rounds
        weight = np.where(here, np.exp(-STEP * np.minimum(ahead, 20 / STEP)), 0.0)
        knapsack = Knapsack(weight * lengths, here)
        goal = counts * (r / rounds)
        for length in np.flatnonzero(here)[::-1].tolist():
            lacking = goal[length] - covered[length]
            if lacking > 0:
                found = knapsack.through(length, counts)
                inside = found > 0
                amount = lacking / found[length]
                covered[inside] += amount * found[inside]
                key = np.repeat(lengths, found).astype(CONTENT).tobytes()
                used[key] = used.get(key, 0.0) + amount
    return list(used.items())


def lengths_in(configuration: bytes) -> np.ndarray:
    """The lengths in a configuration, in ascending order."""
    return np.frombuffer(configuration, CONTENT)


@dataclass
class Plan:
    """Runs of sequences with the same contents."""

    capacity: int
    runs: list[tuple[np.ndarray, int]] = field(default_factory=list)  # lengths in a sequence, number of sequences
    solved: int = 0  # sequences that came from the program, not from the best-fit rest

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.runs)

    def slots(self) -> dict[str, np.ndarray]:
        """Rows (length, first rank, rank after the last, first sequence, offset), by length and rank: item number r
        of a length has the row whose ranks hold it, and the sequence ``first sequence + r - first rank``."""
        rows: dict[int, list[tuple[int, int, int]]] = {}
        sequence = 0
        for contents, n in self.runs:
            offset = 0
            for length in contents.tolist():
                rows.setdefault(length, []).append((n, sequence, offset))
                offset += length
            sequence += n
        flat = []
        for length in sorted(rows):
            rank = 0
            for n, first, offset in rows[length]:
                flat.append((length, rank, rank + n, first, offset))
                rank += n
        return dict(zip(("length", "first", "after", "sequence", "offset"), np.array(flat, dtype=np.int64).reshape(-1, 5).T, strict=True))


def plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """A plan for a histogram: ``counts[l]`` items of length l; every item has one place."""
    left = counts.astype(np.int64).copy()
    out = Plan(capacity)
    lengths = np.arange(capacity + 1)

    def take(found: np.ndarray, times: int) -> bool:
        inside = found > 0
        times = min(times, int((left[inside] // found[inside]).min()))
        if times > 0:
            left[inside] -= times * found[inside]
            out.runs.append((np.repeat(lengths, found)[::-1], times))
        return times > 0

    if left[capacity]:
        take(np.bincount([capacity], minlength=capacity + 1), int(left[capacity]))
    if left.any():
        # rounded down, longest items first; what overshoots the items stays out
        for configuration, amount in sorted(cover(left.copy(), rounds), key=lambda x: -int(lengths_in(x[0])[-1])):
            if int(lengths_in(configuration).sum(dtype=np.int64)) >= FULL * capacity:
                take(np.bincount(lengths_in(configuration), minlength=capacity + 1), int(amount))
    out.solved = out.sequences
    out.runs += fullest(left, capacity)
    return out


def fullest(left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Best fit: each sequence takes the longest item left, then again and again the longest that fits.

    Runs of equal sequences are taken at once, so the work depends on the number of lengths, not of items.
    """
    left, runs = left.copy(), []
    while left.any():
        room, contents = capacity, np.zeros(capacity + 1, dtype=np.int64)
        while room > 0:
            fits = np.flatnonzero((left - contents)[: room + 1] > 0)
            if not len(fits):
                break
            length = int(fits[-1])
            contents[length] += min(int(left[length] - contents[length]), room // length)
            room = capacity - int((contents * np.arange(capacity + 1)).sum())
        inside = contents > 0
        times = int((left[inside] // contents[inside]).min())
        left[inside] -= times * contents[inside]
        runs.append((np.repeat(np.arange(capacity + 1), contents)[::-1], times))
    return runs


PIECES = "piece int, start long, length long, ids_crc32 long, task int, rank long"


def pieces(docs: DataFrame, keep: list[str], path: str, end_id: int, capacity: int = CAPACITY, text: str = "text", with_ids: bool = False) -> DataFrame:
    """The ``keep`` columns and the items of every document, numbered by length within their task."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(bpe.Vocabulary.load(path))
    extra = ", ids array<int>" if with_ids else ""
    schema = T.StructType([docs.schema[c] for c in keep] + T._parse_datatype_string(PIECES + extra).fields)
    out = arrow_type(schema)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        numbered = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            texts = ["" if t is None else t for t in table.column(len(keep)).to_pylist()]
            for a, b in slices(texts):
                ids, counts = bpe.task_encoder(vocabulary).encode(texts[a:b])
                ids = np.insert(ids, np.cumsum(counts), end_id)  # after each document's ids
                counts = counts + 1
                many = -(-counts // capacity)
                owner = np.repeat(np.arange(len(counts)), many)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
                head = counts - (many - 1) * capacity
                length = np.where(piece == 0, head[owner], capacity)
                start = np.where(piece == 0, 0, head[owner] + (piece - 1) * capacity)
                data = ids.astype("<u4").tobytes()
                cuts = np.append(0, np.cumsum(length)) * 4
                sums = [crc32(data[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                order = np.argsort(length, kind="stable")
                sorted_ = length[order]
                rank = np.empty(len(length), dtype=np.int64)
                rank[order] = np.arange(len(length)) - np.searchsorted(sorted_, sorted_) + numbered[sorted_]
                numbered += np.bincount(length, minlength=capacity + 1)
                columns = [table.column(i).take(pa.array(owner + a)).combine_chunks().cast(out.field(i).type) for i in range(len(keep))]
                made = [piece, start, length, sums, np.full(len(length), task), rank]
                made += [np.split(ids.astype(np.int32), np.cumsum(length)[:-1])] * with_ids
                yield pa.RecordBatch.from_arrays(columns + [pa.array(x, f.type) for x, f in zip(made, list(out)[len(keep):], strict=True)], schema=out)

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")).mapInArrow(run, schema)


def pack(docs: DataFrame, keep: list[str], path: str, end_id: int, capacity: int = CAPACITY, text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``."""
    items = written(pieces(docs, keep, path, end_id, capacity, text, with_ids), "pieces")
    counts = written(items.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row a length, at most capacity
        histogram[row["length"]] = row["n"]
    shared = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity).slots())
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = written(counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("before")), "piece-offsets")
    ranked = items.join(offsets, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "task")
    schema = T.StructType([*ranked.schema.fields, *T._parse_datatype_string("sequence_id long, offset long").fields])
    out = arrow_type(schema)
    at, rank_at = ranked.columns.index("length"), ranked.columns.index("rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        begin = np.searchsorted(slots["length"], np.arange(capacity + 2))
        # ranks of all lengths on one axis: searching it finds the row of a length and rank
        span = np.int64(1) << 40
        axis = slots["length"] * span + slots["first"]
        for batch in batches:
            length, rank = batch.column(at).to_numpy(), batch.column(rank_at).to_numpy()
            row = np.searchsorted(axis, length * span + rank, side="right") - 1
            assert (row >= begin[length]).all()
            sequence = slots["sequence"][row] + rank - slots["first"][row]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(slots["offset"][row])], schema=out)

    return ranked.mapInArrow(place, schema).drop("rank")
