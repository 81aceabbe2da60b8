"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Date arithmetic below relies on UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keeps month=01 a two-character string when the archive is read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(app: str = "litpulse", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library expects; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Set the one setting results depend on in a session built elsewhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a local master may run without the setting; it gets a folder of its
    own. A cluster must name one, since executors do not share local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="litpulse-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/litpulse/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    Cuts the lineage like ``checkpoint()``, survives the loss of executors, and
    gives the later steps real file sizes, column pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
