"""What the operators of this package share: sessions, word rules, row barriers and components."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litpulse.session import materialise, use_utc

#: A word is a run of characters other than these.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows handed to Python at once; documents differ in length by a factor of thousands.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; workers import the package from the same root."""
    use_utc(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(x for x in (root, environment.get("PYTHONPATH")) if x)
    return spark


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def word_count(text: str) -> Column:
    """Words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def words_of(text: Column) -> Column:
    """The words as an array, without a regular expression."""
    plain = F.translate(text, SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(plain, " "), "")


def settle(df: DataFrame, *names: str) -> DataFrame:
    """Evaluate the named columns once per row.

    A generator of one element stops the optimizer from copying their
    expressions into every filter and column above.
    """
    packed = F.explode(F.array(F.struct(*(F.col(n) for n in names))))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*rest, packed.alias("_settled")).select(*rest, *(F.col(f"_settled.{n}") for n in names))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name the frame does not use yet, for helper columns."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def components(links: DataFrame) -> DataFrame:
    """Connected components of links ``(a, b)``: rows ``(id, root)``, root the smallest id.

    Every round each node takes the smallest root among its neighbours' and then
    the root of that root, until nothing changes. A hot node only meets partial
    aggregates and joins that can be split. Each round is written to the shared folder.
    """
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(edges.where("a != b").distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root")), "labels")
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("m"))
        step = labels.join(near, "id", "left").select("id", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        step = materialise(step, "labels")
        roots = step.select(F.col("id").alias("root"), F.col("root").alias("up"))
        jumped = step.join(roots, "root", "left").select("id", "old", F.least("root", "up").alias("root"))
        jumped = materialise(jumped, "labels")
        labels = jumped.select("id", "root")
        if jumped.where("root != old").limit(1).count() == 0:
            return labels
