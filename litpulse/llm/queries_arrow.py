"""Registered queries of the operators that use Arrow batches inside tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litpulse.llm import html, linejoin, ordermin, packing, residual, secrets, vectors
from litpulse.llm.common import table
from litpulse.llm.registry import query
from litpulse.llm.tokens import public_path


@query("op1_packed_matrices")
def packed_matrices(spark: SparkSession, sf: str) -> DataFrame:
    """The packed sequences without padding columns: ids as a digest, lengths, resets and what each segment is."""
    packed = packing.pack_documents(table(spark, sf, "documents").select("doc_id", "text"), public_path())
    return packed.select(
        "sequence_id",
        F.col("n_ids").cast("bigint").alias("n_ids"),
        "cu_seqlens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.crc32("position_ids").alias("position_crc32"),
        "doc_ids",
        "pieces",
        "starts",
    )


@query("op2_crf_secrets")
def crf_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    found = secrets.find_secrets(docs, secrets.fit_on_sample(docs))
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.KINDS[:3]))
    return found.select("doc_id", *(of_kind(k) for k in secrets.KINDS[:3]), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


@query("op4_order_minhash")
def order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return ordermin.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@query("op5_line_blocks")
def line_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(table(spark, sf, "pages"))


@query("op8_line_edit_join")
def line_edit_join(spark: SparkSession, sf: str) -> DataFrame:
    return linejoin.line_classes(table(spark, sf, "documents").select("doc_id", "text"))


#: The search's contract: components times 64, every twentieth id asks, 20 answers.
SCALE, EVERY, ANSWERS = 64, 20, 20

VECTOR_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {ANSWERS}"""


@query("op6_segment_top_k", VECTOR_SQL)
def segment_top_k(spark: SparkSession, sf: str) -> DataFrame:
    whole = vectors.quantized(table(spark, sf, "embeddings"), "vec_id", "embedding", SCALE)
    return vectors.top_k(whole, whole.where(F.col("vec_id") % EVERY == 0), ANSWERS)


@query("op10_residual_packing")
def residual_packing(spark: SparkSession, sf: str) -> DataFrame:
    return residual.pack_documents(table(spark, sf, "documents").select("doc_id", "text"), public_path())
