"""Token ids in compact binary files.

A store is a folder with two Parquet tables, so that any store Spark can write will do:

* ``vocabulary`` (rank, id): the ids by falling frequency in these texts.
* ``blocks`` (part, block, doc_ids, lengths, control, data): consecutive documents in
  ascending doc_id. A rank takes one to four whole bytes in ``data``, least significant
  first; ``control`` has their number less one in two bits per id, four ids a byte, the
  first in the lowest bits. Frequent ids have small ranks and take one byte.

Decoding looks the lengths of four ids up per control byte, gathers the data bytes at the
summed lengths, and looks the ids up by rank, all of it in numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetstream.llm.storage import release_memory, shuffle_partitions, written
from fleetstream.llm.tokenizing import tokenizer
from fleetstream.sources.workdir import shared_dir

#: A block is closed at this many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 16
_GROUP = 64

#: Bytes of each of the four ids that a control byte stands for.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)

_BLOCKS = (
    "part int, block int, doc_ids array<bigint>, lengths array<int>, "
    "control binary, data binary"
)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4", copy=False)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    more = codes[: len(ranks)]
    most = int(ranks.max(initial=0))
    for top in (0xFF, 0xFFFF, 0xFFFFFF):
        if most > top:
            more += ranks > top
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    # No rank takes more bytes than the greatest.
    if most <= 0xFFFF:
        ranks = ranks.astype("<u2")
    width = ranks.itemsize
    taken = np.arange(width, dtype=np.uint8) <= more[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, width)[taken].tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers back, by table lookup."""
    sizes = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    padded = np.concatenate([np.frombuffer(data, dtype=np.uint8), np.zeros(3, np.uint8)])
    value = padded[starts].astype(np.uint32)
    for k in (1, 2, 3):
        if sizes.size and sizes.max() > k:
            value |= padded[starts + k].astype(np.uint32) << np.uint32(8 * k)
    return value & _MASKS[sizes]


def _narrow(packed: bytes) -> bytes:
    """32-bit ids as their width, 2 or 4, and as many bytes per id."""
    ids = np.frombuffer(packed, dtype="<u4")
    if ids.size and ids.max() > 0xFFFF:
        return b"\4" + packed
    return b"\2" + ids.astype("<u2").tobytes()


def unpacked(ids: bytes) -> np.ndarray:
    """The ids of a row of ``token_ids``."""
    return np.frombuffer(ids, dtype=f"<u{ids[0]}", offset=1)


def token_ids(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """doc_id, ids (for ``unpacked``), with ``end_id`` after each.

    A null or empty text has the end id alone. Repeated rows stay repeated.
    """
    end = end_id.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = tokenizer(path).packed
        for batch in batches:
            for at in range(0, batch.num_rows, _GROUP):
                part = batch.slice(at, _GROUP)
                ids = [_narrow(x + end) for x in packed(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "ids"],
                )
        tokenizer(path).rest()
        release_memory(keep=True)

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, ids binary")


def frequencies(ids: DataFrame) -> DataFrame:
    """id, n over all documents; a task sends one row per id at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            packed = batch.column("ids").to_pylist()
            for at in range(0, len(packed), _GROUP):
                n = np.bincount(np.concatenate([unpacked(x) for x in packed[at : at + _GROUP]]))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[: len(n)] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[seen])], names=["id", "n"]
        )
        release_memory()

    counted = ids.select("ids").mapInArrow(count, "id bigint, n bigint")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(ids: DataFrame, path: str) -> None:
    """Write a stored table of doc_id and ids as a store, in ascending doc_id.

    Equal doc_ids are ordered by their ids; rows without a doc_id come first. An empty
    table makes an empty store.
    """
    spark = ids.sparkSession
    order = [r["id"] for r in frequencies(ids).orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame(
        list(enumerate(order)), "rank bigint, id bigint"
    ).coalesce(1).write.parquet(f"{path}/vocabulary")
    rank = np.zeros(max(order, default=0) + 1, dtype="<u4")
    rank[np.array(order, dtype=np.int64)] = np.arange(len(order))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        doc_ids, held, size = [], [], 0

        def closed() -> pa.RecordBatch:
            control, data = encode_ranks(rank[np.concatenate(held)])
            columns = [[part], [block], [doc_ids], [[len(x) for x in held]], [control], [data]]
            kinds = [
                pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                pa.binary(), pa.binary(),
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["part", "block", "doc_ids", "lengths", "control", "data"],
            )

        for batch in batches:
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                doc_ids.append(doc_id)
                held.append(unpacked(packed.as_py()))
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield closed()
                    block, doc_ids, held, size = block + 1, [], [], 0
        if held:
            yield closed()
        release_memory()

    (
        ids.repartitionByRange(shuffle_partitions(ids), "doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(blocks, _BLOCKS)
        .write.option("compression", "zstd")
        .parquet(f"{path}/blocks")
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document of a store."""
    order = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()
    id_of = np.array([r["id"] for r in order], dtype="<u4")
    stored = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                sizes = np.array(row["lengths"], dtype=np.int64)
                ids = id_of[decode_ranks(row["control"], row["data"], int(sizes.sum()))]
                ends = np.cumsum(sizes)
                k = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends - sizes + row["_base"]),
                        pa.array(sizes),
                        pa.array([x.tobytes() for x in np.split(ids, ends[:-1])], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                ) if k else None
        release_memory()

    sizes = stored.select(
        "part", "block", F.expr("aggregate(lengths, 0L, (s, x) -> s + x)").alias("_n")
    )
    # One row per file in the only window that isn't dealt out.
    parts = sizes.groupBy("part").agg(F.sum("_n").alias("_n"))
    first = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(first), F.lit(0)).alias("_part"))
    inner = Window.partitionBy("part").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = sizes.withColumn("_inner", F.coalesce(F.sum("_n").over(inner), F.lit(0))).join(
        parts, "part"
    )
    based = stored.join(
        bases.select("part", "block", (F.col("_part") + F.col("_inner")).alias("_base")),
        ["part", "block"],
    )
    return based.mapInArrow(
        decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def stored_tokens(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Tokenize, write a store in the shared folder and read it back."""
    to = shared_dir(docs.sparkSession, "tokens")
    write_token_files(written(token_ids(docs, path, end_id), "ids", "zstd"), to)
    return read_token_files(docs.sparkSession, to)


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (unsigned) of read documents."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
