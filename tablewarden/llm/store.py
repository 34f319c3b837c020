"""Intermediate tables in the folder that the session shares with its executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A local session without the setting (as in tests) gets a temporary folder; on a
    cluster a missing setting is an error, because executors do not share a machine's
    own folders.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError(f"{SETTING} names no folder that driver and executors share")
        app = spark.sparkContext.applicationId
        root = _OWN.get(app) or _OWN.setdefault(app, tempfile.mkdtemp(prefix="llm-"))
    return root.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start from files,
    which outlive lost executors, and not from its lineage."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
