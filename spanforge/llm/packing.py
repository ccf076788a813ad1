"""Documents packed into sequences of fixed length, planned over the histogram of lengths.

Texts longer than a sequence are cut into whole sequences, the first piece being the shorter one.
How many pieces have each length is all that the plan needs: best fit in decreasing order moves
stretches of sequences, not pieces. All pieces of one length go, as many at a time as fit, to the
sequences whose room is smallest and still enough; new sequences are opened where there are none. A
stretch is split once for each length at most, so the plan has a bound that documents don't move:
HISTOGRAM lengths, and twice as many stretches alive. Pieces then take planned slots by their rank
within their length: ranks are counted in each block of the written pieces, blocks are added up for
each length, and the sum is joined to the pieces by block and length, so that no length, however
common, meets in one task.

Cases: a null text is an empty one, which is its end id alone; rows that repeat an id or a text are
pieces of their own, and pieces of one length stand in the order of their blocks; very long texts are
cut whole; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanforge.llm.common import Shared
from spanforge.llm.token_store import encoder

#: Ids of a sequence; the histogram has as many lengths at most.
HISTOGRAM = 2048

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("block", pa.int64()), ("at", pa.int64())])
PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, block long, at long"
PACKED_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(n: int, size: int) -> Iterator[tuple[int, int]]:
    """start and length of the pieces of n ids."""
    first = n % size or size
    at = 0
    while at < n:
        length = first if at == 0 else size
        yield at, length
        at += length


def encode_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = HISTOGRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all texts with their ids' CRC-32 and their rank among those of their length in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, end_id)
        block, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                code = encode(t)
                for k, (start, length) in enumerate(cut(len(code) // 4, size)):
                    rows.append((i, k, start, length, zlib.crc32(memoryview(code)[4 * start : 4 * (start + length)]), block, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECE, strict=True)] if rows else [pa.array([], f.type) for f in PIECE], schema=PIECE)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECE_DDL)


def plan(counts: dict[int, int], size: int = HISTOGRAM) -> tuple[list[tuple[int, int, int, int]], int]:
    """Slots (length, first sequence, how many sequences, offset) in the order of ranks, and the number of sequences.

    Best fit, longest first: a piece goes where the least room is left."""
    room: dict[int, list[tuple[int, int]]] = {}  # by room left: stretches of sequences
    rooms: list[int] = []  # in ascending order
    slots, opened = [], 0

    def put(r: int, first: int, n: int) -> None:
        if r not in room:
            room[r] = []
            insort(rooms, r)
        room[r].append((first, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):  # open as many as will be full, or one
                n = max(1, left // (size // length))
                put(size, opened, n)
                opened += n
            best = rooms[k]
            first, n = room[best].pop()
            if not room[best]:
                del room[best], rooms[k]
            take = min(n, left)
            if take < n:
                put(best, first + take, n - take)
            if best > length:
                put(best - length, first, take)
            slots.append((length, first, take, size - best))
            left -= take
    return slots, opened


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, shared: Shared, size: int = HISTOGRAM, **columns: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = shared.write(encode_pieces(docs, tokenizer_path, end_id, size, **columns))
    per_block = pieces.groupBy("block", "length").count()
    counts = {r["length"]: r["n"] for r in per_block.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # `size` rows at most
    slots, _ = plan(counts, size)
    taken = np.cumsum([0, *(n for _, _, n, _ in slots)])
    begin: dict[int, int] = {}
    for (length, *_), at in zip(slots, taken.tolist(), strict=False):
        begin.setdefault(length, at)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((taken[:-1], np.asarray([s for _, s, _, _ in slots], np.int64), np.asarray([o for *_, o in slots], np.int64)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, seq, off = held.value
        for b in batches:
            rank = b.column(5).to_numpy()
            k = np.searchsorted(lo, rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq[k] + rank - lo[k]), pa.array(off[k])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    begins = spark.createDataFrame(list(begin.items()) or [(0, 0)], "length long, begin long")  # `size` rows at most
    before = F.coalesce(F.sum("count").over(W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    base = per_block.join(F.broadcast(begins), "length").select("block", "length", (F.col("begin") + before).alias("base"))
    ranked = pieces.join(base, ["block", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("at")).alias("rank"))
    return ranked.mapInArrow(place, PACKED_DDL)
