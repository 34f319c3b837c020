"""Table sources and the sink for clean data."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str] | None = None,
    *,
    pattern: str = "*.csv",
    encoding: str = "utf-8",
    multi_line: bool = False,
    bad_rows: str | None = None,
) -> DataFrame:
    """CSV files of a folder with every column as text.

    Typing is left to the contract check and the cast step, where bad cells
    are counted instead of lost, so no types are inferred.  Without
    ``columns`` each file's header names its cells, and files are put together
    by name; with them, every file's header must agree.

    A row with more or fewer cells than its header stops the read, or, if
    ``bad_rows`` names a column, that column holds the whole row (NULL
    for the others).  Quotes within quotes are doubled; line breaks within
    quotes need ``multi_line``, which reads a file in one task.
    """

    def read(names: Sequence[str], paths: Sequence[str]) -> DataFrame:
        reader = (
            spark.read.option("header", True)
            .option("encoding", encoding)
            .option("pathGlobFilter", pattern)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("enforceSchema", False)
        )
        kept = list(names)
        if bad_rows is None:
            # without column pruning, so that a row is judged whole whatever is selected
            reader = reader.option("mode", "FAILFAST").option("columnPruning", False)
        else:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_rows)
            kept.append(bad_rows)
        return reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in kept])).csv(list(paths))

    if columns is not None:
        return read(columns, [folder])
    groups = _header_groups(spark, folder, pattern, encoding)
    if not groups:
        raise FileNotFoundError(f"no file with a header line in {folder}")
    parts = []
    for paths in groups:
        header = spark.read.option("header", True).option("encoding", encoding).option("escape", '"')
        names = header.option("multiLine", multi_line).csv(paths[0]).columns
        # one header for all files: the folder itself, no list of paths
        parts.append(read(names, [folder] if len(groups) == 1 else paths))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _header_groups(spark: SparkSession, folder: str, pattern: str, encoding: str) -> list[list[str]]:
    """Paths of the files, grouped by their first line.

    One pass over the lines; rows of a block keep their order, so the least
    row id of a file's first block is its first line.  The driver gets one row
    per header, with the paths that Spark's reader is then given.
    """
    lines = spark.read.option("pathGlobFilter", pattern).option("encoding", encoding).text(folder)
    first = lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value",
    )
    heads = first.where("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    found = heads.groupBy(F.rtrim("header").alias("header")).agg(F.array_sort(F.collect_list("path")).alias("paths"))
    return [r["paths"] for r in found.orderBy(F.col("paths")[0]).collect()]


DRIVERS = {"postgresql": "org.postgresql.Driver"}


def jdbc_options(
    *,
    driver: str,
    env: Mapping[str, str],
    schema: str | None = None,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    environ: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for Spark's JDBC source.  ``env`` names the variables that hold the secrets.

    A query wins over a table.  With a partition column the query is read as a
    derived table, so that Spark splits it like a table.
    """
    values = os.environ if environ is None else environ

    def secret(name: str, needed: bool = True) -> str | None:
        var = env.get(name)
        value = values.get(var, "").strip() if var else ""
        if needed and not value:
            raise KeyError(f"environment variable for {name!r} is not set ({var})")
        return value or None

    url = f"jdbc:{driver}://{secret('host')}:{secret('port')}/{secret('database')}"
    opts = {"url": url, "user": secret("user"), "password": secret("password")}
    if driver in DRIVERS:
        opts["driver"] = DRIVERS[driver]
    for name, option in (("sslmode", "sslmode"), ("connect_timeout", "connectTimeout")):
        if value := secret(name, needed=False):
            opts[option] = value
    if query and not partition_column:
        opts["query"] = query
    elif query:
        opts["dbtable"] = f"({query}) q"
    elif table:
        opts["dbtable"] = f"{schema}.{table}" if schema else table
    else:
        raise ValueError("a table or a query is needed")
    if partition_column:
        if not bounds or not partitions:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        opts |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return opts


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_clean(df: DataFrame, folder: str, *, run_id: str, prefix: str = "cleaned") -> str:
    """Write a clean table as Parquet; an existing run is never overwritten."""
    path = f"{folder.rstrip('/')}/{prefix}_{run_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_clean_of(spark: SparkSession, reports: DataFrame, run_id: str, paths: Sequence[str]) -> DataFrame:
    """The clean table that a run's reports point at; ``paths`` are JSON paths tried in order."""
    where = F.coalesce(*[F.get_json_object("payload", p) for p in paths])
    hit = reports.filter((F.col("run_id") == run_id) & where.isNotNull()).select(where.alias("p")).first()
    if hit is None:
        raise FileNotFoundError(f"no report of run {run_id} names a clean table")
    return read_clean(spark, hit["p"])
