"""Registered queries of harmonic packing, conversation repair and phrase mining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from litpulse.llm import harmonic, phrases, repair
from litpulse.llm.common import table
from litpulse.llm.registry import query
from litpulse.llm.tokens import public_path


@query("op13_harmonic_packing")
def harmonic_packing(spark: SparkSession, sf: str) -> DataFrame:
    return harmonic.pieces(harmonic.pack_documents(table(spark, sf, "documents").select("doc_id", "text"), public_path()))


def _damage_sql() -> str:
    return r"""
tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS (
  SELECT keyed.*, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
    lambda c, b: xor(c // 256, t[CAST(xor(c, b) % 256 AS INTEGER) + 1])), 4294967295) % 20 AS d FROM keyed, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM coded, (SELECT unnest([1, 2]) AS copy) WHERE d <> 0 AND (copy = 1 OR d = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, substr(role, 1, 1) AS r FROM damaged),
marked AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r NOT IN ('su', 'ua', 'au') AS bad,
    row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM ordered),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (bad) AS illegal, max(i) AS n
  FROM marked GROUP BY conv_id)"""


#: A way to the end in the SQL below: nine digits of cost, a colon, the audit, chr(1), the repaired lines with a line break after each.
def _way(rest: str, cost: str, edit: str, line: str = "''") -> str:
    audit = f"substr({rest}, 11, instr({rest}, chr(1)) - 11)"
    lines = f"substr({rest}, instr({rest}, chr(1)) + 1)"
    return f"lpad(CAST(CAST(substr({rest}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || ':{edit}' || {audit} || chr(1) || {line} || {lines}"


def _repair_sql() -> str:
    """Dynamic programming from the last row to the first, four ways (after nothing, s, u, a) a row."""
    user, assistant, cost = "'user:' || {}", "'assistant:' || {}", "{} + CASE WHEN fault = 3 THEN 5 ELSE 0 END"
    text, added = "text || chr(10)", "chr(10)"
    ways = {}
    for state, to, role, line in (("f0", "f2", "u", user), ("f1", "f2", "u", user), ("f2", "f3", "a", assistant), ("f3", "f2", "u", user)):
        options = [_way(state, "2", "D")]
        options.append(f"CASE WHEN fault IN (0, 3) THEN {_way(to, cost.format(1), 'R', line.format(text))} END")
        options.append(f"CASE WHEN fault IN (0, 3) AND r = '{role}' THEN {_way(to, cost.format(0), 'K', f'''role || ':' || {text}''')} END")
        if state == "f0":
            options.append(f"CASE WHEN fault IN (0, 3) AND r = 's' THEN {_way('f1', cost.format(0), 'K', f'''role || ':' || {text}''')} END")
        ways[state.replace("f", "d")] = f"least({', '.join(options)})"
    put_user = lambda d: _way(d, "5", "I", user.format(added))
    put_assistant = lambda d: _way(d, "5", "I", assistant.format(added))
    two = put_user(f"({put_assistant('d3')})")
    best = {"f0": ("d0", put_user("d2"), two), "f1": ("d1", put_user("d2"), two), "f2": ("d2", put_assistant("d3")), "f3": ("d3", put_user("d2"))}
    end = {"f0": ("0", "", "''"), "f1": ("10", "II", "'user:' || chr(10) || 'assistant:' || chr(10)"), "f2": ("5", "I", "'assistant:' || chr(10)"), "f3": ("0", "", "''")}
    start = ", ".join(f"lpad('{c}', 9, '0') || ':{a}' || chr(1) || {lines} AS {f}" for f, (c, a, lines) in end.items())
    return f"""
WITH RECURSIVE {_damage_sql().strip()},
fold(conv_id, back, f0, f1, f2, f3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), {start} FROM counted
  UNION ALL
  SELECT conv_id, back, {', '.join(f'least({", ".join(w)})' for w in best.values())}
  FROM (SELECT m.conv_id, m.back, {', '.join(f'{w} AS {d}' for d, w in ways.items())}
        FROM fold f JOIN marked m ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.back = f.back + 1)),
done AS (
  SELECT c.*, CAST(substr(f0, 1, 9) AS BIGINT) AS cost, substr(f0, 11, instr(f0, chr(1)) - 11) AS audit, substr(f0, instr(f0, chr(1)) + 1) AS lines
  FROM counted c JOIN fold f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.back = c.n)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(CASE WHEN lines = '' THEN '' ELSE substr(lines, 1, length(lines) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM e.conv_id"""


@query("op12_conversation_repair", _repair_sql())
def conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digests(repair.repair(repair.damage(turns), turns.select("conv_id")))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PHRASE_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{phrases.NO_LANG}') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
words AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM worded, (SELECT unnest(range(1, {phrases.LONGEST + 1})) AS m)),
f AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a FROM placed
  GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
longer AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM c)) GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase)
  WHERE around IS NULL OR CAST(around AS HUGEINT) * 100 < CAST(a AS HUGEINT) * {phrases.COVERED}),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, x.a AS l, y.a AS r, k, CAST(CAST({phrases.SCORE_SCALE} AS HUGEINT) * cut.a // (x.a + y.a) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1:k], ' ')
    JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[k + 1:], ' ')),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN words USING (lang) WHERE rank <= {phrases.BEST}"""


@query("op11_phrase_fingerprints", PHRASE_SQL)
def phrase_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents").select("lang", "text"))
