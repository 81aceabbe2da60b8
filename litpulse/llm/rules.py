"""Quality rules as a bitmask ledger, versioned policies, and ablations.

Every rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; a policy is a mask over those bits, so a new version needs
no second look at the texts, and an ablation is an aggregate over masks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litpulse.llm.common import SPACES, settle, words_of

SYMBOLS = "#*$%&|<>"

#: Rules in bit order: name, and the SQL condition under which a document fails.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > 2 * n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "n_words > 0 AND word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
)
BASE_MASK = 0b000011

#: Versioned policies: the mask of the rules that reject.
POLICIES = {"base": BASE_MASK, "v1": 0b001111, "v2": 0b111111}
CURRENT = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The measurements of every document, null text as none, next to its own columns."""
    own = docs.columns
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(*(F.col(f"`{c}`") for c in own), value.alias("_text"), words_of(value).alias("_words"))
    blank = "".join(SPACES)
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, blank, "")) > 0)
    df = df.select(
        *(F.col(f"`{c}`") for c in own),
        "_words",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(_without(F.col("_text"), blank)).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
        F.expr(
            """CASE WHEN size(_words) < 3 THEN CAST(array() AS ARRAY<BIGINT>)
            ELSE transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) END"""
        ).alias("_windows"),
    )
    df = settle(df, "_words", "n_words", "word_chars", "n_symbols", "_lines", "_windows")
    # Places whose hash occurs again, sorted by hash: only these are compared as text.
    df = df.withColumn(
        "_sorted",
        F.expr(
            """CASE WHEN size(array_distinct(_windows)) = size(_windows) THEN CAST(array() AS ARRAY<STRUCT<h: BIGINT, i: INT>>)
            ELSE array_sort(transform(_windows, (h, i) -> struct(h, i))) END"""
        ),
    )
    df = settle(df, "_sorted")
    df = df.withColumn(
        "_near",
        F.expr(
            """array_sort(transform(filter(_sorted, (x, j) -> (j > 0 AND _sorted[j - 1].h = x.h)
            OR (j < size(_sorted) - 1 AND _sorted[j + 1].h = x.h)),
            x -> struct(concat_ws(' ', _words[x.i], _words[x.i + 1], _words[x.i + 2]) AS w, x.i AS i)))"""
        ),
    )
    df = settle(df, "_near")
    places = F.expr(
        """transform(filter(_near, (x, j) -> (j > 0 AND _near[j - 1].w = x.w)
        OR (j < size(_near) - 1 AND _near[j + 1].w = x.w)), x -> x.i)"""
    )
    df = settle(df.withColumn("_places", places), "_places")
    covered = F.expr("size(array_distinct(flatten(transform(_places, i -> array(i, i + 1, i + 2)))))")
    return df.select(
        *(F.col(f"`{c}`") for c in own),
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"),
    )


def fail_bits(rules=RULES) -> Column:
    """One bit per failed rule, the first rule lowest."""
    bits = F.lit(0).cast("bigint")
    for k, (_, condition) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def ledger(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Documents with measurements and ``fail_bits``, evaluated once per row.

    Null text counts as empty. Columns of the documents that bear a measurement's
    name are left out; all others pass through. No shuffle, no Python.
    """
    clash = {*MEASURES, "fail_bits", "_text", "_words", "_lines", "_windows", "_sorted", "_near", "_places"}
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in clash or c == text))
    measured = measure(docs, text)
    return settle(measured.withColumn("fail_bits", fail_bits(rules)), *MEASURES, "fail_bits")


def passes(policy: str = CURRENT, policies=POLICIES) -> Column:
    """Whether a ledger row passes a policy version."""
    return F.col("fail_bits").bitwiseAND(F.lit(policies[policy])) == 0


def ablations(rows: DataFrame, rules=RULES, policies=POLICIES) -> DataFrame:
    """Per policy and rule: documents it rejects, those only this rule rejects, and all rejected without it.

    One pass: the ledger is counted per bit pattern, at most 2 to the number of
    rules, and the counts are combined with the masks.
    """
    spark = rows.sparkSession
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    masks = [(p, m, name, 1 << k) for p, m in policies.items() for k, (name, _) in enumerate(rules) if m >> k & 1]
    grid = F.array(*(F.struct(F.lit(p).alias("policy"), F.lit(m).alias("mask"), F.lit(r).alias("rule"), F.lit(b).alias("bit")) for p, m, r, b in masks))
    each = patterns.select("fail_bits", "n", F.explode(grid).alias("g")).select("fail_bits", "n", "g.*")
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    counted = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    return each.groupBy("policy", "rule").agg(
        counted(failed.bitwiseAND(F.col("bit")) != 0)("rejected"),
        counted(failed == F.col("bit"))("rejected_only_by_it"),
        counted(failed.bitwiseAND(F.bitwise_not("bit")) != 0)("rejected_without_it"),
    )


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that pass a policy, with their own columns."""
    shown = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = docs.select(shown, F.col("text").alias("text"))
    return ledger(rows).where(passes(policy)).select("_row.*")
