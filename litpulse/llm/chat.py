"""Chat formatting of typed content parts, with a loss mask that can be read back.

A visitor walks the parts of a turn in order: text is escaped, any other part
becomes a numbered placeholder, its reference is recorded, and its tokens are
counted at the rate of its kind. Everything is a column expression; turns of a
conversation meet in one shuffle by conversation.

Form of a turn::

    <s>[ROLE]user[/ROLE]first part<part>second part</s>

``<s> </s> <part> [ROLE] [/ROLE] [INST] [/INST]`` and placeholders such as
``<image:0>`` are control strings. Inside a text each gets a backslash after its
first character, one more if it already has some, so a text never holds a control
string and the original comes back by taking one backslash away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litpulse.llm.common import WORD

#: Tokens per unit: an image's unit is a patch, a sound's a second, a document's a page.
TOKENS_PER_UNIT = {"image": 1.0, "audio": 25.0, "document": 600.0}
#: Any other kind, null included, is an attachment and costs nothing.
OTHER_KIND = "attachment"
LOSS_ROLE = "assistant"

OPEN, CLOSE, PART = "<s>", "</s>", "<part>"
ROLE_OPEN, ROLE_CLOSE = "[ROLE]", "[/ROLE]"
TAILS = r"(/?s>|part>|/?(?:ROLE|INST)\]|(?:image|audio|document|attachment):\d+>)"
ESCAPE = (r"([<\[])(\\*)" + TAILS, r"$1\\$2$3")
UNESCAPE = (r"([<\[])\\(\\*)" + TAILS, "$1$2$3")

PARTS = "array<struct<kind: string, text: string, ref: string, units: double>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def text_part(text: Column) -> Column:
    """A turn of plain text as its one part; null text is empty."""
    one = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("double").alias("units"),
    )
    return F.array(one).cast(PARTS)


def _kind(part: Column) -> Column:
    kind = part["kind"]
    return F.when(kind.isin("text", *TOKENS_PER_UNIT), kind).otherwise(OTHER_KIND)


def _placeholder(part: Column, place: Column) -> Column:
    return F.concat(F.lit("<"), _kind(part), F.lit(":"), place.cast("string"), F.lit(">"))


def visit(parts: Column) -> Column:
    """The body of a turn: its parts in order, placeholders numbered by their place in the turn."""

    def render(part: Column, place: Column) -> Column:
        return F.when(_kind(part) == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(_placeholder(part, place))

    return F.array_join(F.transform(parts, render), PART)


def attachments(parts: Column) -> Column:
    """References of the parts that are not text, in order, each with its placeholder and tokens."""

    def record(part: Column, place: Column) -> Column:
        return F.struct(
            _placeholder(part, place).alias("placeholder"), _kind(part).alias("kind"), part["ref"].alias("ref"), _tokens(part).alias("tokens")
        )

    other = F.transform(parts, lambda p, i: F.when(_kind(p) != "text", record(p, i)))
    return F.filter(other, lambda x: x.isNotNull())


def _tokens(part: Column) -> Column:
    cost = F.when(_kind(part) == "text", F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit(WORD)).cast("double"))
    for kind, rate in TOKENS_PER_UNIT.items():
        cost = cost.when(_kind(part) == kind, F.coalesce(part["units"], F.lit(0.0)) * rate)
    return F.ceil(cost.otherwise(0.0)).cast("bigint")


def expanded_tokens(parts: Column) -> Column:
    """Tokens of a turn once placeholders are expanded; a text's tokens are its words."""
    return F.aggregate(F.transform(parts, _tokens), F.lit(0).cast("bigint"), lambda a, x: a + x)


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation from ``conv_id, turn, role, parts``.

    ``formatted``; ``loss``: spans ``(start, length)`` in code points of the
    assistants' bodies; ``attachments`` in order; ``n_turns``; ``n_tokens``. Turns are ordered
    by ``turn``, ties by role and then by body, nulls first. Null role or parts: empty.
    Null ``conv_id``: a conversation of its own. Other columns are left out.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(PARTS))
    role = F.coalesce(F.col("role"), F.lit(""))
    body = visit(parts)
    head = F.concat(F.lit(OPEN + ROLE_OPEN), escape(role), F.lit(ROLE_CLOSE))
    rendered = turns.select(
        "conv_id", "turn", role.alias("role"), head.alias("head"), body.alias("body"), attachments(parts).alias("refs"), expanded_tokens(parts).alias("tokens")
    )
    whole = F.length("head") + F.length("body") + len(CLOSE)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    placed = rendered.withColumn("place", F.row_number().over(order)).withColumn(
        "end", F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    span = F.struct((F.col("end") - len(CLOSE) - F.length("body")).alias("start"), F.length("body").cast("bigint").alias("length"))
    one = F.struct(
        "place",
        F.concat("head", "body", F.lit(CLOSE)).alias("turn"),
        F.when(F.col("role") == LOSS_ROLE, span).alias("span"),
        "refs",
    )
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(one)).alias("turns"), F.count(F.lit(1)).alias("n_turns"), F.sum("tokens").alias("n_tokens")
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        "n_tokens",
        F.array_join(F.col("turns")["turn"], "").alias("formatted"),
        F.filter(F.col("turns")["span"], lambda s: s.isNotNull()).alias("loss"),
        F.flatten(F.col("turns")["refs"]).alias("attachments"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns (role, text)`` and ``loss_texts`` recovered from the formatted string and its spans.

    The text of a turn is its parts' texts joined by ``<part>``, placeholders as they stand.
    """
    pieces = F.split("formatted", CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substring(piece, len(OPEN + ROLE_OPEN) + 1, 2**31 - 1), ROLE_CLOSE, 1)
        body = F.substr(piece, F.length(role) + (len(OPEN + ROLE_OPEN + ROLE_CLOSE) + 1))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    masked = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("*", F.transform(pieces, turn).alias("turns"), masked.alias("loss_texts"))
