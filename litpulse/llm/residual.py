"""Hierarchical residual packing: local best fit, full sequences out, the rest up the tree.

Pieces are hashed to partitions of a bounded number of items and packed there by best
fit, largest first. Sequences that are nearly full leave; underfull ones go up as items
of their whole length and meet those of other partitions in the next, smaller round, until
one partition is left or a round no longer gains. A task never holds more than a bounded
number of items, and every round is written to the shared folder.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litpulse.llm.packing import END_ID, SEQUENCE, best_fit_decreasing
from litpulse.llm.tokens import document_ids, encoder, piece_bounds
from litpulse.session import materialise

#: Items of a task in a round, and partitions of a round that meet in one of the next.
ITEMS_PER_TASK = 20_000
FAN_IN = 8
#: A sequence with at most this part of its places free is nearly full.
NEARLY_FULL = 0.02

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
MEMBER = f"array<struct<{', '.join(x.strip().replace(' ', ': ') for x in PIECE.split(','))}, offset: int>>"
ITEM = f"length int, members {MEMBER}"
BIN = f"closed boolean, sequence_id long, {ITEM}"


def pieces_of(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece, ``doc_id, piece, start, length, ids_crc32``; null text is empty, all rows count."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = encoder(tokenizer)
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), document_ids(kept, batch.column("text").to_pylist(), end_id), strict=True):
                for piece, (start, length) in enumerate(piece_bounds(len(ids) // 4, size)):
                    for column, value in zip(out, (doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(cut, PIECE)


def _fit(round_no: int, size: int, slack: int, last: bool):
    """Best fit within a task; the items' order of arrival does not matter."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = None
        items: list[tuple] = []
        for batch in batches:
            schema = batch.schema
            items += zip(batch.column("length").to_pylist(), batch.column("members").to_pylist(), strict=True)
        if schema is None:
            return
        total = lambda m: [tuple((v is None, v or 0) for v in x.values()) for x in m]
        items.sort(key=lambda x: (-x[0], total(x[1])))
        kind = schema.field("members").type
        out = pa.schema([("closed", pa.bool_()), ("sequence_id", pa.int64()), ("length", pa.int32()), ("members", kind)])
        number = (round_no << 56) + (TaskContext.get().partitionId() << 32)
        rows = []
        for one in best_fit_decreasing([x[0] for x in items], size):
            members, at = [], 0
            for i in one:
                members += [m | {"offset": m["offset"] + at} for m in items[i][1]]
                at += items[i][0]
            rows.append({"closed": last or size - at <= slack, "sequence_id": number, "length": at, "members": members})
            number += 1
            if len(rows) == 1000:
                yield pa.RecordBatch.from_pylist(rows, schema=out)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return task


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE, items_per_task: int = ITEMS_PER_TASK, fan_in: int = FAN_IN, nearly_full: float = NEARLY_FULL) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; full pieces are sequences of their own.

    A round's result does not depend on the order rows arrive in, so a task that runs
    again packs alike. Items of one task are at most about ``items_per_task``: rounds get
    ``ceil(items / items_per_task)`` partitions at least, and the last round is reached when
    a single one suffices or the items no longer become fewer. Items are dealt by a running number that is
    written with them, so rows that repeat an id and a text spread like others.
    """
    columns = [c.split()[0] for c in PIECE.split(", ")]
    pieces = materialise(pieces.select(*columns, F.monotonically_increasing_id().alias("number")), "pieces")
    member = F.struct(*columns, F.lit(0).alias("offset"))
    items = pieces.where(F.col("length") < size).select("length", F.array(member).cast(MEMBER).alias("members"), "number")
    full = pieces.where(F.col("length") == size)
    n, slack, closed, round_no = items.count(), int(size * nearly_full), [], 1
    parts = max(1, -(-n // items_per_task))
    while n:
        last = parts == 1
        dealt = items.repartition(parts, F.xxhash64(F.lit(round_no), "number")).select("length", "members")
        bins = materialise(dealt.mapInArrow(_fit(round_no, size, slack, last), BIN), "bins")
        closed.append(bins.where("closed"))
        items = bins.where("NOT closed").select("length", "members", F.col("sequence_id").alias("number"))
        left = items.count()
        if left == n and not last:
            # Nothing found room: more rounds would not either.
            closed.append(bins.where("NOT closed"))
            break
        n, round_no = left, round_no + 1
        parts = max(1, -(-parts // fan_in), -(-n // items_per_task))
    alone = full.select(*columns, (F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    packed = alone
    for bins in closed:
        each = bins.select("sequence_id", F.explode("members").alias("m"))
        packed = packed.unionByName(each.select(*(F.col(f"m.{c}") for c in columns), "sequence_id", F.col("m.offset").cast("bigint").alias("offset")))
    return packed


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Pieces of the documents with their places; see ``pieces_of`` and ``pack_pieces``."""
    return pack_pieces(pieces_of(docs, tokenizer), **options)
