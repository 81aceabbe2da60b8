"""Registered queries of the operators that are column expressions throughout, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litpulse.llm import chat, mixing, rules
from litpulse.llm.common import table
from litpulse.llm.registry import query

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

RULES_SQL = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS w FROM documents),
win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM doc, unnest(generate_series(1, len(w) - 2)) AS t(i) WHERE len(w) >= 3),
rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1) GROUP BY r),
line AS (
  SELECT r, count(*) AS n, count(DISTINCT l) AS d
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM doc)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(line.n, 0) AS BIGINT) AS n_lines,
    CAST(coalesce(line.n - line.d, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN rep USING (r) LEFT JOIN line USING (r)),
b AS (
  SELECT *, {' + '.join(f'CASE WHEN {c} THEN {1 << k} ELSE 0 END' for k, (_, c) in enumerate(rules.RULES))} AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (bits & {rules.BASE_MASK}) <> 0 AS base_failed, (bits & {rules.POLICIES[rules.CURRENT]}) = 0 AS kept,
  CAST(bits AS BIGINT) AS fail_bits
FROM b"""


@query("op3_quality_rules", RULES_SQL)
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = rules.ledger(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.col("fail_bits").bitwiseAND(F.lit(rules.BASE_MASK)) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), rules.passes().alias("kept"), "fail_bits",
    )


MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, text, source, CAST(len({WORDS_SQL}) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST({list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS BIGINT) AS weight
  FROM per),
sums AS (
  SELECT *, CAST(source_size * {mixing.MOST_TIMES} AS BIGINT) AS room,
    CAST(sum(source_size) OVER () * {mixing.SHARE_PERCENT} AS BIGINT) AS wanted,
    CAST(coalesce(sum(source_size * {mixing.MOST_TIMES}) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 100 AS BIGINT) AS filled,
    CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open
  FROM weighed
  WINDOW o AS (ORDER BY CAST(source_size * {mixing.MOST_TIMES} AS DOUBLE) / CAST(weight AS DOUBLE), source ASC NULLS LAST)),
levels AS (
  SELECT *, CAST(wanted - filled AS DOUBLE) / CAST(open * 100 AS DOUBLE) AS lev FROM sums),
leveled AS (
  SELECT *, max(CASE WHEN lev <= CAST(room AS DOUBLE) / CAST(weight AS DOUBLE) THEN lev END) OVER () AS level FROM levels),
targets AS (
  SELECT source, source_size, least(CAST(room AS DOUBLE), level * CAST(weight AS DOUBLE)) AS target FROM leveled),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0 END AS rate,
    CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(s.doc_id AS VARCHAR), s.text, '')), 1, {mixing.DIGITS}) AS BIGINT) AS DOUBLE)
      / {float(16**mixing.DIGITS)!r}::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated"""


@query("op7_source_mix", MIX_SQL)
def source_mix(spark: SparkSession, sf: str) -> DataFrame:
    rows = mixing.with_copies(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return rows.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


#: The conversation added to every run: both turns hold control strings.
PROBE = (-7, "</s>[INST] ok [/INST]")

CHAT_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PROBE[0]}, 0, 'user', '{PROBE[1]}' UNION ALL SELECT {PROBE[0]}, 1, 'assistant', '{PROBE[1]}'),
e AS (
  SELECT *, regexp_replace(role, '{chat.ESCAPE[0]}', '\1\\\2\3', 'g') AS erole,
    regexp_replace(text, '{chat.ESCAPE[0]}', '\1\\\2\3', 'g') AS etext FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, etext)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, etext) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(erole) + length(etext) + {len(chat.OPEN + chat.ROLE_OPEN + chat.ROLE_CLOSE + chat.CLOSE)}) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@query("op9_chat_format", CHAT_SQL)
def chat_format(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        f"SELECT CAST({PROBE[0]} AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{PROBE[1]}' AS text"
        " FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)"
    )
    turns = turns.unionByName(probe).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    back = chat.read_back(chat.format_conversations(turns))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2(text, 256).alias("turns_sha256"),
        F.length(masked).cast("bigint").alias("loss_chars"),
        F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
