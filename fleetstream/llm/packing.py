"""Best-fit packing: whole documents into sequences of a fixed number of tokens.

Best-fit decreasing takes the longest pieces first and puts each one into the open
sequence whose free space is tightest. All that matters of a piece is its length, so
the packing is planned over the histogram of lengths, which has ``capacity`` entries
however many documents there are: a segment tree over the free spaces finds the tightest
one in logarithmic time, and a run of equal pieces is placed in one step. The plan is a
list of runs whose number also depends on ``capacity`` alone. Spark numbers the pieces
of each length and looks their places up in it; no piece passes through the driver.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fleetstream.llm.storage import release_memory, shuffle_partitions, written
from fleetstream.llm.tokenizing import tokenizer

#: Texts that are tokenized together.
_GROUP = 64


class FreeSpaces:
    """Segment tree over free spaces 0..capacity: which of them an open bin has."""

    def __init__(self, capacity: int):
        self._leaves = 1
        while self._leaves <= capacity:
            self._leaves *= 2
        self._any = [False] * (2 * self._leaves)

    def set(self, space: int, present: bool) -> None:
        node = space + self._leaves
        self._any[node] = present
        while node > 1:
            node //= 2
            self._any[node] = self._any[2 * node] or self._any[2 * node + 1]

    def tightest(self, need: int) -> int | None:
        """The least space of at least ``need`` that is present."""
        node = need + self._leaves
        if self._any[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self._any[node + 1]:
                node += 1
                while node < self._leaves:
                    node = 2 * node if self._any[2 * node] else 2 * node + 1
                return node - self._leaves
            node //= 2
        return None


@dataclass
class _Bins:
    """Runs of bin numbers by free space."""

    capacity: int
    opened: int = 0
    runs: dict[int, deque] = field(default_factory=dict)
    tree: FreeSpaces = None

    def __post_init__(self):
        self.tree = FreeSpaces(self.capacity)

    def put(self, space: int, first: int, count: int) -> None:
        if space > 0:
            self.runs.setdefault(space, deque()).append((first, count))
            self.tree.set(space, True)

    def take(self, space: int, most: int) -> tuple[int, int]:
        queue = self.runs[space]
        first, count = queue.popleft()
        if count > most:
            queue.appendleft((first + most, count - most))
            count = most
        if not queue:
            self.tree.set(space, False)
        return first, count


def plan_best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Best-fit decreasing over counts of lengths 1..capacity.

    Returns runs (length, first rank, pieces, first bin, offset): the pieces of that
    length with these ranks go to consecutive bins, at that offset.
    """
    bins, plan = _Bins(capacity), []
    for size in sorted((s for s, n in histogram.items() if n), reverse=True):
        rank, left = 0, histogram[size]
        while left:
            space = bins.tree.tightest(size)
            each = (capacity if space is None else space) // size
            # Equal pieces fill a bin before the next one is the tightest.
            each, most = (each, left // each) if left >= each else (left, 1)
            if space is None:
                space, first, count = capacity, bins.opened, most
                bins.opened += count
            else:
                first, count = bins.take(space, most)
            for k in range(each):
                plan.append((size, rank, count, first, capacity - space + k * size))
                rank += count
            left -= each * count
            bins.put(space - each * size, first, count)
    return plan


def token_pieces(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's token ids.

    ``path`` is a file of the ``tokenizers`` library. Each document ends with ``end_id``,
    so an empty or null text is one id long. A document of more than ``capacity`` ids is
    cut from its end, so that only its first piece may be shorter. Repeated rows are
    documents of their own; ``doc_id`` may be null.
    """
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).packed
        for batch in batches:
            for at in range(0, batch.num_rows, _GROUP):
                part = batch.slice(at, _GROUP)
                rows = []
                packed = encode(part.column("text").to_pylist())
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), packed):
                    view = memoryview(ids + end)
                    n = len(view) // 4
                    stop = n % capacity or min(n, capacity)
                    start = 0
                    for piece in range(-(-n // capacity)):
                        crc = zlib.crc32(view[4 * start : 4 * stop])
                        rows.append((doc_id, piece, start, stop - start, crc))
                        start, stop = stop, stop + capacity
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _PIECE_ARROW)],
                    names=_PIECE_SCHEMA.names,
                )
        tokenizer(path).rest()
        release_memory(keep=True)

    return docs.select("doc_id", "text").mapInArrow(cut, _PIECE_SCHEMA)


_PIECE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
_PIECE_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def best_fit(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """pieces with sequence_id and offset; ``pieces`` must be a stored table.

    Every row has a ``length`` of 1..capacity (others fail) and is placed once, repeated
    rows too. No rows give no rows. A third of all rows may have one length: pieces are
    numbered within (chunk, length), and a chunk's first number comes from the counts.
    """
    spark = pieces.sparkSession
    chunks = 4 * shuffle_partitions(pieces)
    # Renamed, as a table may have columns with any names.
    names = pieces.columns
    own = {c: "length" if c == "length" else f"c{k}" for k, c in enumerate(names)}
    pieces = pieces.select(*[F.col(f"`{c}`").alias(own[c]) for c in names])
    keyed = pieces.withColumn("_chunk", F.pmod(F.xxhash64(*pieces.columns), F.lit(chunks)))
    counts = keyed.groupBy("_chunk", "length").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(
        F.sum("count").alias("n")).limit(capacity + 1).collect()}
    if any(not 1 <= size <= capacity for size in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = spark.createDataFrame(
        plan_best_fit(histogram, capacity),
        "_size long, _rank long, _count long, _bin long, _offset long",
    )
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counts.select(
        "_chunk", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy("_chunk", "length").orderBy(*pieces.columns)
    numbered = keyed.withColumn("_nr", F.row_number().over(within) - 1)
    ranked = numbered.join(bases, ["_chunk", "length"]).withColumn(
        "_at", F.col("_base") + F.col("_nr")
    )
    # The plan's size depends on the capacity alone, so it may be broadcast.
    placed = ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("_size"))
        & (F.col("_at") >= F.col("_rank"))
        & (F.col("_at") < F.col("_rank") + F.col("_count")),
    )
    return placed.select(
        *[F.col(own[c]).alias(c) for c in names],
        (F.col("_bin") + F.col("_at") - F.col("_rank")).alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2
) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its sequence and place."""
    return best_fit(written(token_pieces(docs, path, capacity, end_id), "pieces"), capacity)
