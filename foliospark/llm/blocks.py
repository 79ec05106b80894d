"""Blocks of rows of bounded size, and keyed exchanges between blocks and shards.

Some operators need, for every document, facts about its words that only the whole corpus can give.
Shuffling one row per word occurrence would move many times the input, so documents are dealt to
blocks of bounded size by a hash of their content, every block sends its *distinct* words to shards
(a word always goes to the same shard), the shards answer once per block, and the block's documents
are joined with the answers. Rows and words travel as compressed Arrow payloads. Everything is keyed
by content, so a task that runs again yields the same groups.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

BLOCK_BYTES = 32 << 20  # text of one block
PACKED = StructType([StructField("block", IntegerType()), StructField("payload", BinaryType())])
_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def pack(table: pa.Table | pa.RecordBatch) -> bytes:
    """A table as one compressed byte string."""
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema, options=_ZSTD) as writer:
        writer.write(table)
    return sink.getvalue()


def unpack(payload) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(payload)).read_all()


def unpack_all(payloads: pa.ChunkedArray) -> Iterator[pa.Table]:
    for payload in payloads:
        yield unpack(payload.as_buffer())


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def parts_for(total: int, size: int) -> int:
    """How many parts of about ``size`` hold ``total``; follows the input without a ceiling."""
    return max(1, -(-int(total) // size))


class Dealer:
    """Block of each row of a task: by the hash of its content, equal rows one block after another.

    The blocks a task deals out depend on the rows it holds and not on their order, so a task that runs
    again deals the same.
    """

    def __init__(self, n_blocks: int):
        self.n_blocks, self.seen = np.uint64(n_blocks), {}

    def blocks(self, hashes: np.ndarray) -> np.ndarray:
        unique, place, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        before = np.fromiter(map(self.seen.get, unique.tolist(), [0] * len(unique)), np.int64, len(unique))
        self.seen.update(zip(unique.tolist(), (before + counts).tolist(), strict=True))
        order = np.argsort(place, kind="stable")
        nth = np.empty(len(hashes), np.int64)
        nth[order] = np.arange(len(hashes)) - (np.cumsum(counts) - counts)[place[order]]
        return ((hashes.astype(np.uint64) + (before[place] + nth).astype(np.uint64)) % self.n_blocks).astype(np.int32)


def pack_blocks(rows: DataFrame, n_blocks: int, salt: int = 0) -> DataFrame:
    """Deal rows to ``n_blocks``: (block, payload) with many rows a payload.

    Rows go by a hash of all their columns, and equal rows to blocks in turn, however many there are.
    """
    names = rows.columns
    hashed = rows.withColumn("_hash", F.xxhash64(*names, F.lit(salt)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(n_blocks)
        for batch in batches:
            if not batch.num_rows:
                continue
            block = dealer.blocks(np.asarray(batch.column("_hash")))
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            bare = batch.select(names)
            for part in np.split(order, cuts):
                payload = pack(bare.take(pa.array(part)))
                yield pa.RecordBatch.from_arrays([pa.array([block[part[0]]], pa.int32()), pa.array([payload], pa.binary())],
                                                 names=["block", "payload"])

    return hashed.mapInArrow(deal, PACKED)


def shard_of(words: Iterable[str], n_shards: int) -> np.ndarray:
    """Shard of each word, the same in every task."""
    words = list(words)
    return np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) % n_shards


def by_shard(shards: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Row numbers of every shard that occurs."""
    order = np.argsort(shards, kind="stable")
    cuts = np.flatnonzero(np.diff(shards[order])) + 1
    return [(int(shards[p[0]]), p) for p in np.split(order, cuts)] if len(shards) else []
