"""Best-fit-decreasing packing into id matrices, with a segment tree over free capacities.

Tokenizing, packing and writing happen in one pass without a shuffle: every task
packs the documents it reads, a buffer at a time, largest piece first, each into the
fullest sequence that still has room. The leaves of the segment tree are the free
capacities 0 to L; a node holds how many open sequences lie below it, so the smallest
sufficient capacity is one walk of log L steps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from litpulse.llm.tokens import document_ids, encoder, piece_bounds

SEQUENCE = 1024
END_ID = 2
#: Ids a task holds before it packs them: 16 MB of 32-bit ids.
BUFFER_IDS = 4_000_000


class CapacityTree:
    """Counts of open sequences by free capacity; finds the smallest capacity that suffices."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.count = [0] * (2 * self.base)

    def add(self, capacity: int, change: int) -> None:
        k = capacity + self.base
        while k:
            self.count[k] += change
            k >>= 1

    def at_least(self, capacity: int) -> int | None:
        """The smallest free capacity of an open sequence that is at least ``capacity``."""
        count, k = self.count, capacity + self.base
        if count[k]:
            return capacity
        while k > 1:
            if k % 2 == 0 and count[k + 1]:
                k += 1
                break
            k >>= 1
        else:
            return None
        while k < self.base:
            k = 2 * k if count[2 * k] else 2 * k + 1
        return k - self.base


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Sequences as lists of item indices, in the order the items stand in them.

    Items go largest first, ties by index; among equally full sequences the one
    opened first takes the item.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    tree, bins, open_by = CapacityTree(size), [], [[] for _ in range(size + 1)]
    for i in order:
        need = lengths[i]
        free = tree.at_least(need)
        if free is None:
            bins.append([i])
            free, k = size, len(bins) - 1
        else:
            k = open_by[free].pop()
            tree.add(free, -1)
            bins[k].append(i)
        left = free - need
        if left:
            open_by[left].append(k)
            tree.add(left, 1)
    return bins


SCHEMA = (
    "sequence_id long, ids binary, cu_seqlens array<int>, position_ids binary,"
    " doc_ids array<long>, pieces array<int>, starts array<long>, n_ids int"
)
ARROW = pa.schema(
    [
        ("sequence_id", pa.int64()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())), ("starts", pa.list_(pa.int64())), ("n_ids", pa.int32()),
    ]
)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID, pad_id: int = 0, buffer_ids: int = BUFFER_IDS) -> DataFrame:
    """One row per packed sequence from ``doc_id, text``; other columns are left out.

    ``ids``: ``size`` little-endian 32-bit ids, padded with ``pad_id`` behind ``n_ids``;
    ``cu_seqlens``: 0 and the running ends of the segments; ``position_ids``: 32-bit positions
    that restart at 0 with each segment; ``doc_ids, pieces, starts``: what each segment is.
    A document's ids end with ``end_id``; a longer one is cut, its first piece takes the rest.
    Null text: only the end id. Null or repeated ids stay as they are. Empty table: no rows.
    Full pieces are sequences of their own. ``sequence_id`` holds the task's partition and a counter.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kept, number = encoder(tokenizer), TaskContext.get().partitionId() << 36

        def packed(items: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            bins = best_fit_decreasing([len(x[3]) // 4 for x in items], size)
            for at in range(0, len(bins), 256):
                rows = []
                for one in bins[at : at + 256]:
                    segments = [items[i] for i in one]
                    lengths = [len(x[3]) // 4 for x in segments]
                    joined = b"".join(x[3] for x in segments)
                    positions = np.concatenate([np.arange(n, dtype="<u4") for n in lengths]).tobytes()
                    rows.append(
                        {
                            "sequence_id": number,
                            "ids": joined + np.full(size - len(joined) // 4, pad_id, dtype="<u4").tobytes(),
                            "cu_seqlens": [0, *np.cumsum(lengths).tolist()],
                            "position_ids": positions,
                            "doc_ids": [x[0] for x in segments],
                            "pieces": [x[1] for x in segments],
                            "starts": [x[2] for x in segments],
                            "n_ids": len(joined) // 4,
                        }
                    )
                    number += 1
                yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

        held, n = [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), document_ids(kept, batch.column("text").to_pylist(), end_id), strict=True):
                for piece, (start, length) in enumerate(piece_bounds(len(ids) // 4, size)):
                    held.append((doc_id, piece, start, ids[4 * start : 4 * (start + length)]))
                n += len(ids) // 4
            if n >= buffer_ids:
                yield from packed(held)
                held, n = [], 0
        if held:
            yield from packed(held)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(tasks, SCHEMA)


def read_matrix(rows: list[bytes], size: int = SEQUENCE) -> np.ndarray:
    """Packed ids of several sequences as one matrix."""
    return np.frombuffer(b"".join(rows), dtype="<u4").reshape(-1, size)


def segment_crc(ids: bytes) -> int:
    """Checksum of a segment's little-endian 32-bit ids."""
    return zlib.crc32(ids)
