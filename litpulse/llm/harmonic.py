"""Harmonic packing: pieces of length ``size // k`` go ``k`` to a sequence, class by class, in every task alone.

A document gives full sequences first. What is left is cut at reciprocal capacities, the largest that fits
first: the rest of a length just below ``size / k`` is shorter than ``size / k**2``, so two or three cuts
are enough and every piece fills its place exactly. A class needs no search and no other task: its
open sequence is full after ``k`` pieces. What is open at a task's end is cut into powers of two, the classes
whose sequences may end early without padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litpulse.llm.tokens import document_ids, encoder

SEQUENCE = 2048
END_ID = 1
#: Sequences of a record batch on the way out: 2 MB of ids at 2048 a sequence.
BATCH_SEQUENCES = 256

SEGMENT = "doc_id long, start long, length long, doc_tokens long, offset long"
SCHEMA = f"sequence_id long, ids binary, n_ids int, segments array<struct<{SEGMENT.replace(' long', ': long')}>>"
_SEGMENT = pa.struct([(x.split()[0], pa.int64()) for x in SEGMENT.split(", ")])
ARROW = pa.schema([("sequence_id", pa.int64()), ("ids", pa.binary()), ("n_ids", pa.int32()), ("segments", pa.list_(_SEGMENT))])


def reciprocal(length: int, size: int) -> int:
    """The largest ``size // k`` that is at most ``length``."""
    return size // (size // (length + 1) + 1)


def cuts(length: int, size: int) -> list[int]:
    """Lengths of the pieces a document of ``length`` ids is cut into, in order."""
    out = [size] * (length // size)
    left = length % size
    while left:
        out.append(reciprocal(left, size))
        left -= out[-1]
    return out


def powers_of_two(length: int) -> list[int]:
    """The powers of two that add up to ``length``, largest first."""
    return [1 << b for b in reversed(range(length.bit_length())) if length >> b & 1]


class Classes:
    """The open sequence of every class: pieces ``(doc_id, start, doc_tokens, ids)`` of one length."""

    def __init__(self, size: int):
        self.size = size
        self.open: dict[int, list[tuple]] = {}

    def put(self, piece: tuple) -> list[tuple] | None:
        """The class's pieces once they are as many as a sequence takes."""
        length = len(piece[3]) // 4
        held = self.open.setdefault(length, [])
        held.append(piece)
        return self.open.pop(length) if len(held) == self.size // length else None

    def rest(self) -> Iterator[list[tuple]]:
        """The open sequences at the end, without padding if ``size`` is a power of two."""
        left = [p for length in sorted(self.open, reverse=True) for p in self.open[length]]
        self.open = {}
        for doc_id, start, total, ids in left:
            at = 0
            for n in powers_of_two(len(ids) // 4):
                full = self.put((doc_id, start + at, total, ids[4 * at : 4 * (at + n)]))
                at += n
                if full:
                    yield full
        for length in sorted(self.open, reverse=True):
            held, at = self.open[length], 0
            for n in powers_of_two(len(held)):
                yield held[at : at + n]
                at += n
        self.open = {}


def padded_length(n_ids: int, size: int) -> int:
    """What a sequence takes: ``size``, or its own length at a power of two."""
    return n_ids if n_ids & (n_ids - 1) == 0 else size


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID, pad_id: int = 0) -> DataFrame:
    """One row per packed sequence from ``doc_id, text``; other columns are left out, whatever their names.

    ``ids``: little-endian 32-bit ids, padded with ``pad_id`` to ``size`` unless ``n_ids`` is a power of two;
    ``segments``: what stands in the sequence, with the ids of its document before it, its length, its document's
    ids in all and its place. A document's ids end with ``end_id``. All segments of a sequence have one length,
    ``size // k``, and a full sequence has ``k`` of them. ``sequence_id`` holds the task's partition and a counter.

    Null text counts as empty: only the end id. Null ids stay null. Rows that repeat an id or a text are documents
    of their own. An empty table gives no rows. A task holds a record batch of documents and less than one sequence
    of each of the at most ``2 * sqrt(size)`` classes, so very long texts and hot keys are no group anywhere.
    A task that runs again on its split packs alike.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kept, number, classes = encoder(tokenizer), TaskContext.get().partitionId() << 36, Classes(size)
        known: dict[int, list[int]] = {}

        def row(pieces: list[tuple]) -> dict:
            nonlocal number
            segments, at = [], 0
            for doc_id, start, total, ids in pieces:
                segments.append({"doc_id": doc_id, "start": start, "length": len(ids) // 4, "doc_tokens": total, "offset": at})
                at += len(ids) // 4
            pad = padded_length(at, size) - at
            joined = b"".join(p[3] for p in pieces) + np.full(pad, pad_id, dtype="<u4").tobytes()
            number += 1
            return {"sequence_id": number - 1, "ids": joined, "n_ids": at, "segments": segments}

        rows: list[dict] = []
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), document_ids(kept, batch.column("text").to_pylist(), end_id), strict=True):
                total, at = len(ids) // 4, 0
                left = total % size
                if left not in known:
                    known[left] = cuts(left, size)
                for n in [size] * (total // size) + known[left]:
                    full = classes.put((doc_id, at, total, ids[4 * at : 4 * (at + n)]))
                    at += n
                    if full:
                        rows.append(row(full))
                        if len(rows) == BATCH_SEQUENCES:
                            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                            rows = []
        rows += [row(pieces) for pieces in classes.rest()]
        for k in range(0, len(rows), BATCH_SEQUENCES):
            yield pa.RecordBatch.from_pylist(rows[k : k + BATCH_SEQUENCES], schema=ARROW)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(tasks, SCHEMA)


def pieces(packed: DataFrame) -> DataFrame:
    """One row per segment of ``pack_documents``, with the checksum of its ids, taken from the sequence."""
    crc = lambda s: F.crc32(F.substring("ids", 4 * s["offset"] + 1, 4 * s["length"]))
    names = [x.split()[0] for x in SEGMENT.split(", ")]
    each = F.transform("segments", lambda s: F.struct(*(s[n].alias(n) for n in names), crc(s).alias("ids_crc32")))
    rows = packed.select("sequence_id", F.explode(each).alias("s"))
    return rows.select("s.doc_id", "s.start", "s.length", "s.ids_crc32", "s.doc_tokens", "sequence_id", "s.offset")
