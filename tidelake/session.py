"""Session settings the lake's semantics rest on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, not only speed. They are runtime settings, so they can be
# applied to a session somebody else created.
SEMANTIC_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value instead of being rejected.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SEMANTIC_CONFS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tidelake", master: str | None = None, **confs: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in confs.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, under ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="tidelake-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return os.path.join(shared, "tidelake", label, uuid.uuid4().hex)


def written_out(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, lineage cut."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
