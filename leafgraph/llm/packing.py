"""Texts into containers of fixed capacity, with little room left (problem 6).

Minimum bin slack: a container is opened with the largest text left, then a bitset subset-sum program over the lengths left finds the
fullest combination for the rest of its room. Bit r of the bitset says that r tokens can be filled; taking a length is a shift and an or.
The bitset before each step is kept, so the combination is read off backwards; the program stops as soon as the container is full.

Only texts larger than a container are cut, into pieces of exactly the capacity and a last piece, which is packed like a text.

Rows are spread evenly over groups of about ``group_rows`` texts, and each group is packed by itself: a task holds the lengths of one
group, whatever the corpus, and a group of thousands of texts leaves no room but in its last containers. A row's group comes from a hash
of its place in the scan, not from its id or source, so no key can make a group large.

Tokens are counted with a public byte-level BPE vocabulary of rank lines; its file is a parameter, read on the driver's machine and sent to the tasks.

Defined results for odd input: null and empty texts have 0 tokens and lie in their group's first container; a repeated row is a text of
its own; a null or non-positive capacity is left out, capacities of the same name and size count once; no texts or no capacities give no
rows; ties between equal lengths are broken by position in the group; texts of any length are counted whole.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.batches import map_columns

RANKS = os.environ.get("LEAFGRAPH_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the public pattern that parts text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def _encoding(ranks_path: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks_path: str = RANKS) -> DataFrame:
    """Rows (doc_id, place, tokens); ``place`` is a hash of the row's position in the scan."""

    docs.sparkSession.sparkContext.addFile(ranks_path)  # executors needn't have it
    name = os.path.basename(ranks_path)

    def make():
        encode = _encoding(SparkFiles.get(name)).encode_ordinary
        task = TaskContext.get()
        base, at = task.partitionId() if task else 0, 0

        def run(ids, texts):
            nonlocal at
            places = [xxhash.xxh3_64_intdigest(f"{base}:{at + k}") >> 1 for k in range(len(ids))]
            at += len(ids)
            return {"doc_id": ids, "place": places, "tokens": [len(encode(t)) if t else 0 for t in texts]}

        return run

    return map_columns(docs, {"i": F.col(doc_id).cast("long"), "t": text}, make, "doc_id long, place long, tokens int")


def fullest(lengths: list[int], counts: list[int], room: int) -> list[int]:
    """Positions of lengths (each at most as often as it is there) whose sum is as near to the room as can be, never above it."""
    mask = (1 << (room + 1)) - 1
    full = 1 << room
    reach = 1
    steps: list[tuple[int, int]] = []
    for k, size in enumerate(lengths):
        if size > room:
            continue
        for _ in range(min(counts[k], room // size)):
            wider = (reach | (reach << size)) & mask
            if wider == reach:
                break
            steps.append((k, reach))
            reach = wider
            if reach & full:
                break
        if reach & full:
            break
    left = reach.bit_length() - 1
    taken = []
    for k, before in reversed(steps):
        if not before >> left & 1:
            taken.append(k)
            left -= lengths[k]
    return taken


def minimum_slack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each size (0 < size <= capacity)."""
    order = np.lexsort((np.arange(len(sizes)), sizes))
    distinct, first, number = np.unique(sizes[order], return_index=True, return_counts=True)
    lengths, counts = distinct[::-1].tolist(), number[::-1].tolist()  # largest first
    heads = first[::-1].tolist()
    out = np.empty(len(sizes), np.int64)
    bin_no = top = 0
    while top < len(lengths):
        if not counts[top]:
            top += 1
            continue
        counts[top] -= 1
        inside = [top]
        room = capacity - lengths[top]
        if room:
            inside += fullest(lengths, counts, room)
        for k in inside[1:]:
            counts[k] -= 1
        for k in inside:
            out[order[heads[k]]] = bin_no
            heads[k] += 1
        bin_no += 1
        if not bin_no & 255:  # drop lengths that are used up
            keep = [k for k in range(top, len(lengths)) if counts[k]]
            lengths, counts, heads = ([x[k] for k in keep] for x in (lengths, counts, heads))
            top = 0
    return out


_OUT = "capacity_name string, capacity_tokens int, doc_id long, piece int, from_token int, tokens int, container long"


def pack_group(ids: np.ndarray, tokens: np.ndarray, name: str, capacity: int, group: int) -> list[np.ndarray]:
    """Columns doc_id, piece, from_token, tokens, container of one group at one capacity."""
    whole = np.maximum((tokens - 1) // capacity, 0)  # full pieces that are cut off before the last
    pieces = whole + 1
    row = np.repeat(np.arange(len(ids)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.where(piece < whole[row], capacity, tokens[row] - piece * capacity)
    container = np.zeros(len(row), np.int64)
    packed = np.flatnonzero(size > 0)
    container[packed] = minimum_slack(size[packed], capacity)
    return [ids[row], piece, piece * capacity, size, container + (np.int64(group) << 32)]


def pack(docs: DataFrame, capacities: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "capacity_name", capacity: str = "capacity_tokens", ranks_path: str = RANKS, group_rows: int = 20_000, most_tasks: int = 20_000) -> DataFrame:
    """Rows (capacity_name, capacity_tokens, doc_id, piece, from_token, tokens, container): the container of each text (or piece) of each capacity.

    Container numbers are unique within a capacity. ``piece`` is 0 for texts that fit."""
    sizes = sorted({(r[0], r[1]) for r in capacities.select(F.col(name).cast("string"), F.col(capacity).cast("int")).collect() if r[1] and r[1] > 0}, key=str)
    spark = docs.sparkSession
    if not sizes:
        return spark.createDataFrame([], _OUT)
    groups = max(1, -(-docs.count() // group_rows))
    counted = token_counts(docs, doc_id, text, ranks_path).withColumn("g", (F.col("place") % groups).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("place").to_numpy(), kind="stable")
        # nulls among the ids are carried beside the numbers
        raw = table.column("doc_id").take(pa.array(order))
        tokens = table.column("tokens").to_numpy()[order].astype(np.int64)
        group = table.column("g")[0].as_py()
        parts = []
        for label, room in sizes:
            at, piece, start, size, box = pack_group(np.arange(len(order)), tokens, label, room, group)
            m = len(at)
            parts.append(pa.table({
                "capacity_name": pa.array([label] * m, pa.string()), "capacity_tokens": pa.array(np.full(m, room, np.int32)), "doc_id": raw.take(pa.array(at)),
                "piece": pa.array(piece.astype(np.int32)), "from_token": pa.array(start.astype(np.int32)), "tokens": pa.array(size.astype(np.int32)), "container": pa.array(box),
            }))
        return pa.concat_tables(parts)

    # The rows are tiny, so by their size all groups would go to one task; their number is what takes time.
    return counted.repartition(min(groups, most_tasks), "g").groupBy("g").applyInArrow(run, _OUT)


def fill_report(packed: DataFrame) -> DataFrame:
    """Per capacity: containers, tokens, share of the room that is used, and texts that were cut."""
    boxes = packed.groupBy("capacity_name", "capacity_tokens", "container").agg(F.sum("tokens").alias("tokens"))
    by = boxes.groupBy("capacity_name", "capacity_tokens").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))
    return by.withColumn("fill", F.try_divide("tokens", F.col("containers") * F.col("capacity_tokens")))
