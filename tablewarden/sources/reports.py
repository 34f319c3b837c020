"""Report files: one JSON object per (stage, name, run)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators.reports import STAGES, parse

SAFE_PART = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"


FILED = "name string, run_id string, payload string, filed_at timestamp, stage string, part int"
# Runs are dealt by hash to so many folders of a stage; a folder once filed to keeps its number.
PARTS = 16


def write_reports(reports: DataFrame, folder: str, *, stages: Sequence[str] = tuple(STAGES)) -> None:
    """File report rows as Parquet with the time of filing, PARTS folders per stage.

    A report filed again replaces its earlier filing: the folders of the runs touched are written
    anew, with the other reports they hold, and all others stay as they are (Spark's dynamic
    partition overwrite moves finished folders into place).  One writer at a time.  A stage
    outside the list, or a name or run id that could leave the folder, stops the write.
    """
    safe = F.col("name").rlike(SAFE_PART) & F.col("run_id").rlike(SAFE_PART)
    good = F.col("stage").isin(list(stages)) & safe
    text = F.concat_ws("/", "stage", "name", "run_id")
    stage = F.when(F.coalesce(good, F.lit(False)), F.col("stage")).otherwise(
        F.raise_error(F.concat(F.lit("report may not be filed: "), text)).cast("string")
    )
    rows = reports.select("name", "run_id", "payload", stage.alias("stage"))
    # of one report filed twice in one call the greatest payload stays
    rows = rows.groupBy("stage", "name", "run_id").agg(F.max("payload").alias("payload"))
    part = F.pmod(F.xxhash64("run_id"), F.lit(PARTS)).cast("int")
    rows = rows.select("name", "run_id", "payload", F.current_timestamp().alias("filed_at"), "stage", part.alias("part"))
    try:
        earlier = reports.sparkSession.read.schema(FILED).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        earlier = None
    if earlier is not None:
        touched = earlier.join(rows.select("stage", "part").distinct(), ["stage", "part"], "left_semi")
        kept = touched.join(rows.select("stage", "name", "run_id"), ["stage", "name", "run_id"], "left_anti")
        rows = rows.unionByName(kept)
    # the rows of one folder go to one file
    writer = rows.repartition("stage", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("stage", "part").parquet(folder)


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Report rows written by ``write_reports``, parsed; of one stage, name and run the newest filing."""
    newest = F.max_by("payload", F.struct("filed_at", "payload"))
    df = spark.read.schema(FILED).parquet(folder)
    return parse(df.groupBy("stage", "name", "run_id").agg(newest.alias("payload")))


def file_name() -> Column:
    """Name of a file, or of the ``file=...`` folder that Spark wrote it in."""
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, "/file=([^/]+)/[^/]+$", 1)
    return F.when(folder != "", folder).otherwise(F.element_at(F.split(path, "/"), -1))


def file_glob(suffix: str) -> str:
    """Files with the suffix, and those Spark names itself; ``file_name`` then tells which of these belong."""
    return "{*" + suffix + ",part-*}"


def write_report_files(reports: DataFrame, folder: str) -> None:
    """One file per report, in a folder ``file={stage}_{name}_{run_id}.json``.

    Of a report given twice the greatest payload is written. An existing folder is an error.
    """
    one = reports.groupBy("stage", "name", "run_id").agg(F.max("payload").alias("value"))
    name = F.concat(F.concat_ws("_", "stage", "name", "run_id"), F.lit(".json"))
    one.select("value", name.alias("file")).write.partitionBy("file").text(folder)


def read_report_files(
    spark: SparkSession, folder: str, *, stages: Sequence[str] = tuple(STAGES), suffix: str = ".json"
) -> DataFrame:
    """JSON files named ``{stage}_{name}_{run_id}.json``, one report each, or folders ``file=`` and that name.

    Whole files are read as text, so a broken file or a list stays one row
    whose ``report`` is NULL, and does not become several valid ones.
    """
    name_of = r"^(" + "|".join(stages) + r")_(.+)_([^_]+)" + re.escape(suffix) + "$"
    files = spark.read.option("pathGlobFilter", file_glob(suffix)).text(folder, wholetext=True)
    file = file_name()
    rows = files.select(
        F.regexp_extract(file, name_of, 1).alias("stage"),
        F.regexp_extract(file, name_of, 2).alias("name"),
        F.regexp_extract(file, name_of, 3).alias("run_id"),
        F.col("value").alias("payload"),
        F.col("_metadata.file_path").alias("path"),
    )
    return parse(rows.filter(F.col("stage") != ""))
