"""Conversation structure repair over a suffix-shared automaton of role and fault signatures.

A conversation's rows become one letter each: what its role begins with and what is wrong with it. Read
from the end, signatures that end alike share a path, so all signatures sorted from the end are the
automaton in depth-first order: a task keeps the nodes of one path, drops those the next signature does not share
and adds the rest. A node stands for one ending; it gets the cost of the cheapest edits to the end for each state of the
grammar, the edits made at this row, and the state the next node goes on from, which is the best audit suffix
as a shared chain. Equal differences of costs under equal letters are worked out once (``Steps``).

Grammar of role initials: ``(s?(ua)+)?``. Edits: keep K (0), rerole to user or assistant R (1), delete D (2,
the only one for blank and repeated rows), insert an empty user or assistant row I (5); a truncated row that
stays costs 5 more. Of equally cheap audits the least in ASCII order counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litpulse.llm.common import SPACES
from litpulse.session import materialise

#: States of the grammar: nothing yet, after s, after u, after a; the state a user or assistant row leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL_PAIRS = ("su", "ua", "au")
#: Letter of a row that has to go; the others are s, u, a and o (another role), in upper case if truncated.
GONE = "x"
#: Rows of a record batch on the way out.
BATCH_ROWS = 2000

Node = tuple[int, tuple, tuple, tuple]


def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % 20``: 0 dropped, 1 emptied, 2 without ``.!?``, 3 twice, 4 role user.

    Nulls read as one space, in the checksum's key as well; a null ``conv_id`` or ``turn`` stays null.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    row = F.struct(F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"))
    each = turns.select("conv_id", "turn", F.explode(F.array_repeat(row, copies)).alias("row"))
    return each.select("conv_id", "turn", "row.role", "row.text")


def _rows(turns: DataFrame) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    return turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), space("role"), space("text"))


ORDER = ("conv_id", "head", "turn", "role", "text")


def _faults(turns: DataFrame, everyone: DataFrame | None) -> DataFrame:
    """Rows in order within their partition: ``head`` 0 for a conversation itself, 1 for its rows, with letter and fault."""
    rows = _rows(turns)
    body: Column = F.rtrim("text", F.lit(SPACES))
    rows = rows.select(F.lit(1).alias("head"), "*", (F.length(body) == 0).alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    ids = (rows if everyone is None else everyone).select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    heads = ids.select(F.lit(0).alias("head"), "conv_id", none("turn", "bigint"), F.lit("").alias("role"), F.lit("").alias("text"))
    heads = heads.select("*", F.lit(False).alias("blank"), F.lit(False).alias("cut"))
    # Of equal rows of one turn the first is the one not seen before.
    # One exchange: both windows and the pass over the rows keep the partitioning by conversation.
    dealt = rows.unionByName(heads).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "head", "role", "text").orderBy("turn")) > 1
    dealt = dealt.withColumn("seen", seen)
    initial = F.substring("role", 1, 1)
    fault = F.when(F.col("blank"), 1).when(F.col("seen"), 2).when(F.col("cut"), 3).otherwise(0)
    before = F.lag(initial).over(Window.partitionBy("conv_id", "head").orderBy(*ORDER[2:], "seen"))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(F.col("blank") | F.col("seen"), GONE).when(F.col("cut"), F.upper(letter)).otherwise(letter)
    illegal = F.coalesce(~F.concat(before, initial).isin(*LEGAL_PAIRS), F.lit(False)).cast("int")
    rows = dealt.select(*ORDER, "seen", letter.alias("letter"), fault.alias("fault"), illegal.alias("illegal"))
    return rows.sortWithinPartitions(*ORDER, "seen").select("conv_id", "head", "turn", "letter", "fault", "illegal")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
SIGNATURE = "conv_id long, ending string, " + ", ".join(f"{c} long" for c in COUNTS)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation: its letters from the last row to the first, and its counts."""
    schema = pa.schema([("conv_id", pa.int64()), ("ending", pa.string()), *((c, pa.int64()) for c in COUNTS)])
    out: list[tuple] = []
    letters: list[str] = []
    conv, first, last, turns, counts, open_ = None, None, None, 0, [0, 0, 0, 0, 0], False

    def closed() -> tuple:
        gaps = last - first + 1 - turns if turns else 0
        return (conv, "".join(letters)[::-1], gaps, *counts[1:])

    for batch in batches:
        for conv_id, head, turn, letter, fault, illegal in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if head == 0:
                if open_:
                    out.append(closed())
                    if len(out) == BATCH_ROWS:
                        yield _columns(out, schema)
                        out = []
                conv, first, last, turns, counts, open_ = conv_id, None, None, 0, [0, 0, 0, 0, 0], True
                letters = []
                continue
            letters.append(letter)
            if fault:
                counts[fault] += 1
            counts[4] += illegal
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
        if len(letters) > 1000:
            letters = ["".join(letters)]
    if open_:
        out.append(closed())
    if out:
        yield _columns(out, schema)


class Steps:
    """Nodes from the ending after them: costs relative to the cheapest state, each combination worked out once."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}
        #: The end of a conversation: what is still missing is inserted.
        self.end: Node = (0, (0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""), (START,) * 4)

    def before(self, letter: str, node: Node) -> Node:
        base, costs = node[0], node[1]
        step = self.known.get((letter, costs))
        if step is None:
            step = self.known[(letter, costs)] = self.work_out(letter, costs)
        return (base + step[0], *step[1:])

    @staticmethod
    def work_out(letter: str, costs: tuple) -> tuple:
        role, stays = letter.lower(), TRUNCATED if letter.isupper() else 0
        row = []
        for state in range(4):
            ways = [(DELETE + costs[state], "D", state)]
            if letter != GONE:
                to = NEXT[state]
                ways.append((RENAME + stays + costs[to], "R", to))
                if role == ("a" if state == USER else "u"):
                    ways.append((stays + costs[to], "K", to))
                elif role == "s" and state == START:
                    ways.append((stays + costs[SYSTEM], "K", SYSTEM))
            row.append(min(ways))
        # Rows inserted in front: one or two, since a third leads to a state met before.
        best = []
        for state in range(4):
            ways, at, lead = [], state, ""
            for _ in range(3):
                cost, edit, to = row[at]
                ways.append((cost + INSERT * len(lead), lead + edit, to))
                at, lead = NEXT[at], lead + "I"
            best.append(min(ways))
        least = min(b[0] for b in best)
        return least, tuple(b[0] - least for b in best), tuple(b[1] for b in best), tuple(b[2] for b in best)


class Path:
    """The nodes of one ending; the next ending in order shares those of the common part."""

    def __init__(self):
        self.steps = Steps()
        self.nodes = [self.steps.end]
        self.ending, self.answer = "", (0, "")

    def ask(self, ending: str) -> tuple[int, str]:
        """Cost and audit of the cheapest edits for a signature given from its end."""
        if ending == self.ending:
            return self.answer
        shared = common_length(self.ending, ending)
        del self.nodes[shared + 1 :]
        for letter in ending[shared:]:
            self.nodes.append(self.steps.before(letter, self.nodes[-1]))
        state, audit = START, []
        for node in reversed(self.nodes):
            audit.append(node[2][state])
            state = node[3][state]
        whole = self.nodes[-1]
        self.ending, self.answer = ending, (whole[0] + whole[1][START], "".join(audit))
        return self.answer


def common_length(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


AUDITED = f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path = Path()
    for batch in batches:
        found = [path.ask(e) for e in batch.column("ending").to_pylist()]
        costs, audits = pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())
        kept = [batch.column(c) for c in ("conv_id", *COUNTS)]
        yield pa.RecordBatch.from_arrays([*kept, costs, audits], names=["conv_id", *COUNTS, "cost", "audit"])


def audits(turns: DataFrame, everyone: DataFrame | None = None) -> DataFrame:
    """One row per conversation: ``conv_id``, its counts, ``cost`` and ``audit``; see ``repair``."""
    found = materialise(_faults(turns, everyone).mapInArrow(_signatures, SIGNATURE), "signatures")
    # Endings in order; equal ones are spread by conversation, so a common signature is no hot key.
    return found.repartitionByRange("ending", "conv_id").sortWithinPartitions("ending", "conv_id").mapInArrow(_audits, AUDITED)


REPORT = (*COUNTS, "cost", "audit")
REPAIRED = f"conv_id long, place long, edit string, turn long, role string, text string, {', '.join(f'{c} long' for c in REPORT[:-1])}, audit string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply the audit that precedes a conversation's rows to them, one row at a time."""
    kinds = {"edit": pa.string(), "role": pa.string(), "text": pa.string(), "audit": pa.string()}
    names = [x.split()[0] for x in REPAIRED.split(", ")]
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names])
    blank = (None,) * len(REPORT)
    out: list[tuple] = []
    conv, audit, at, place, state = None, "", 0, 0, START

    def add(edit: str, turn, role: str, text: str) -> None:
        nonlocal place, state
        place += 1
        state = SYSTEM if state == START and role[:1] == "s" else NEXT[state]
        out.append((conv, place, edit, turn, role, text, *blank))

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            add("I", None, wanted(), "")
            at += 1

    def wanted() -> str:
        return "assistant" if state == USER else "user"

    for batch in batches:
        column = {n: batch.column(n).to_pylist() for n in ("conv_id", "head", "turn", "role", "text")}
        report = list(zip(*(batch.column(c).to_pylist() for c in REPORT), strict=True))
        for k, head in enumerate(column["head"]):
            if head == 0:
                inserted()
                conv, audit, at, place, state = column["conv_id"][k], report[k][-1], 0, 0, START
                out.append((conv, 0, "", None, None, None, *report[k]))
            else:
                inserted()
                edit = audit[at]
                at += 1
                if edit != "D":
                    add(edit, column["turn"][k], column["role"][k] if edit == "K" else wanted(), column["text"][k])
            if len(out) >= BATCH_ROWS:
                yield _columns(out, schema)
                out.clear()
    inserted()
    if out:
        yield _columns(out, schema)


def repair(turns: DataFrame, everyone: DataFrame | None = None) -> DataFrame:
    """Repaired conversations from ``conv_id, turn, role, text``; other columns are left out, whatever their names.

    For every conversation a row with ``place`` 0 and its report (``gaps, blank, duplicate, truncated, illegal, cost,
    audit``), then its repaired rows from ``place`` 1 with ``edit`` (K, R or I), ``turn``, ``role`` and ``text``, all
    next to each other and in order within a partition. ``everyone`` names conversations that may have no rows
    (zeros, empty audit, no rows); without it they are those of ``turns``.

    Rows stand in the order of ``turn`` (nulls first), then ``role`` and ``text``; a null role or text reads as one
    space; rows of a null ``conv_id`` are one conversation. A row counts by its first fault: blank, equal role and
    text seen earlier, truncated. ``gaps`` leaves null turns out. An empty table gives no rows.

    Rows are streamed in order, never gathered: a task holds a conversation's letters, a byte a row, and its record
    batches. Sorting and the windows spill. A conversation's rows meet in one task, since order and digest need it; its
    faults are found before the exchange.
    """
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    heads = audits(turns, everyone).select("conv_id", F.lit(0).alias("head"), none("turn", "bigint"), F.lit("").alias("role"), F.lit("").alias("text"), *REPORT)
    nothing = [none(c, "string" if c == "audit" else "bigint") for c in REPORT]
    rows = _rows(turns).select("conv_id", F.lit(1).alias("head"), "turn", "role", "text", *nothing)
    dealt = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*ORDER)
    return dealt.mapInArrow(_repaired, REPAIRED)


DIGEST = f"conv_id long, {', '.join(f'{c} long' for c in REPORT[:-1])}, audit string, repaired_sha256 string"


def digests(repaired: DataFrame) -> DataFrame:
    """The report of each conversation with the digest of its ``role:text`` lines, taken as the rows pass by."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in DIGEST.split(", ")])
        kept, digest, out = None, hashlib.sha256(), []
        for batch in batches:
            report = zip(*(batch.column(c).to_pylist() for c in ("conv_id", *REPORT)), strict=True)
            for place, role, text, row in zip(*(batch.column(c).to_pylist() for c in ("place", "role", "text")), report, strict=True):
                if place == 0:
                    if kept:
                        out.append((*kept, digest.hexdigest()))
                    kept, digest = row, hashlib.sha256()
                else:
                    digest.update(f"{'' if place == 1 else chr(10)}{role}:{text}".encode())
            if len(out) >= BATCH_ROWS:
                yield _columns(out, schema)
                out = []
        if kept:
            out.append((*kept, digest.hexdigest()))
        if out:
            yield _columns(out, schema)

    return repaired.select("conv_id", "place", "role", "text", *REPORT).mapInArrow(task, DIGEST)
