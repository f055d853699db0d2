"""Chat formatting as prefix trees: conversations that share their first turns share those tokens.

A turn becomes ``### role``, a new line, the text, ``</turn>`` and a new line. A backslash goes before every control
string (and backslash) inside a text, which undoes exactly. Conversations sorted by their turns are a depth-first walk of
their prefix tree: each adds to its segment's token stream only the turns that the one before it doesn't share. Its row
has those turns as nodes with their tokens, the position ids they start at (their depth in the conversation) and the
stretch under the loss mask, and the intervals of the stream that the conversation consists of: its ancestors' tokens,
which its own may attend to, and its own.

Conversations are dealt in ranges of their sorted turns, so one opening that very many share is split over tasks; a
segment ends with its task or at ``SEGMENT_TOKENS``, and the next one says the shared turns again.

Defined cases: null roles and texts are empty; turns go by number (null first), then role, then text; rows without a
conversation id form one conversation; equal conversations get a row each and share all tokens; very long texts are
formatted whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm import bpe
from tidemark.llm.common import arrow_type

SEGMENT_TOKENS = 200_000
HEAD, END = "### ", "</turn>"
CONTROL = re.compile(r"\\|</turn>|###")
#: An escaped control string, or a bare end of turn.
MARK = re.compile(r"\\(?:\\|</turn>|###|n)|</turn>")
LOSS_ROLE = "assistant"


def escaped(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return MARK.sub(lambda m: "\n" if m[0] == "\\n" else m[0][1:] if m[0][0] == "\\" else m[0], text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the text and what stands after it."""
    head = escaped(role).replace("\n", "\\n")
    return HEAD + head + "\n", escaped(text), END + "\n"


def parsed(formatted: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(HEAD, at):
            raise ValueError(f"no turn at {at}")
        line = formatted.index("\n", at)
        role = unescaped(formatted[at + len(HEAD) : line])
        end = next(m.start() for m in MARK.finditer(formatted, line + 1) if m[0] == END)
        turns.append((role, unescaped(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


NODE = "struct<start:int,position:int,loss_from:int,loss_to:int,ids:array<int>>"
OUTPUT = f"conv_id long, segment string, place int, nodes array<{NODE}>, path array<struct<start:int,end:int>>, tokens int"


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns, key): the turns of each conversation in order, and what it is sorted by."""
    empty = F.lit("")
    turn = F.struct(F.col("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    grouped = rows.select(F.col("conv_id").cast("long"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return grouped.withColumn("key", F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])))


def prefix_trees(rows: DataFrame, path: str, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """A row per conversation, in depth-first order within its segment: see the module."""
    spark = rows.sparkSession
    vocabulary = spark.sparkContext.broadcast(bpe.Vocabulary.load(path))
    schema = T._parse_datatype_string(OUTPUT)
    out = arrow_type(schema)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, place, stream = TaskContext.get().partitionId(), 0, 0, 0
        shared: list[tuple[tuple[str, str], int, int]] = []  # turns of the row before, their start and length
        for batch in batches:
            made, size = [], 0
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                turns = [(t["role"], t["text"]) for t in turns]
                if stream > segment_tokens:
                    shared, number, place, stream = [], number + 1, 0, 0
                common = 0
                while common < min(len(shared), len(turns)) and shared[common][0] == turns[common]:
                    common += 1
                del shared[common:]
                parts = [p for turn in turns[common:] for p in turn_parts(*turn)]
                ids, counts = bpe.task_encoder(vocabulary).encode(parts)
                pieces = np.split(ids.astype(np.int32), np.cumsum(counts)[:-1]) if parts else []
                position = sum(n for _, _, n in shared)
                nodes = []
                for i, turn in enumerate(turns[common:]):
                    head, text, tail = pieces[3 * i : 3 * i + 3]
                    loss = (stream + len(head), stream + len(head) + len(text)) if turn[0] == LOSS_ROLE else (0, 0)
                    n = len(head) + len(text) + len(tail)
                    nodes.append({"start": stream, "position": position, "loss_from": loss[0], "loss_to": loss[1], "ids": np.concatenate([head, text, tail])})
                    shared.append((turn, stream, n))
                    stream, position = stream + n, position + n
                intervals: list[dict] = []
                for _, start, n in shared:
                    if intervals and intervals[-1]["end"] == start:
                        intervals[-1]["end"] += n
                    else:
                        intervals.append({"start": start, "end": start + n})
                made.append((conv, f"{task}-{number}", place, nodes, intervals, position))
                place, size = place + 1, size + len(ids)
                if size > 500_000:
                    yield batch_of(made, out)
                    made, size = [], 0
            if made:
                yield batch_of(made, out)

    dealt = conversations(rows).repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    return dealt.select("conv_id", "turns").mapInArrow(run, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_back(trees: DataFrame, path: str, added: str, function) -> DataFrame:
    """``conv_id`` and the ``added`` columns: ``function(formatted, masked)`` gets each conversation's decoded text and
    the list of its decoded stretches under the loss mask, both taken from the segment's token stream by its intervals."""
    spark = trees.sparkSession
    vocabulary = spark.sparkContext.broadcast(bpe.Vocabulary.load(path))
    schema = T._parse_datatype_string(f"conv_id long, {added}")
    out = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, stream, losses = None, [], []
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                if row["segment"] != segment:
                    segment, stream, losses = row["segment"], [], []
                for node in row["nodes"]:
                    stream.extend(node["ids"])
                    if node["loss_to"] > node["loss_from"]:
                        losses.append((node["loss_from"], node["loss_to"]))
                encoder = bpe.task_encoder(vocabulary)
                pieces = [stream[p["start"] : p["end"]] for p in row["path"]]
                own = [stream[a:b] for a, b in losses_within(losses, row["path"])]
                counts = [sum(map(len, pieces)), *map(len, own)]
                ids = np.array([i for p in [*pieces, *own] for i in p], dtype=np.int64)
                formatted, *masked = encoder.decode(ids, np.array(counts))
                made.append((row["conv_id"], *function(formatted, masked)))
            if made:
                yield batch_of(made, out)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return trees.repartition(tasks, "segment").sortWithinPartitions("segment", "place").mapInArrow(run, schema)


def losses_within(losses: list[tuple[int, int]], path: list[dict]) -> list[tuple[int, int]]:
    """Stretches under the mask, ascending, that lie inside the path's intervals."""
    from bisect import bisect_left

    out = []
    for p in path:
        i = bisect_left(losses, (p["start"], 0))
        while i < len(losses) and losses[i][0] < p["end"]:
            out.append(losses[i])
            i += 1
    return out
