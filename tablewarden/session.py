"""Session helpers: a local session for tests and benches, and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablewarden")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that ``spark.checkpoint.dir`` names.

    A local session that names none (plain tests) gets a temporary folder of this machine;
    on a cluster that is an error, because executors do not share such folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tablewarden-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A handful of configured rows as plan literals, without an RDD behind them."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df``, written once to the shared folder and read back: several later jobs start from the files, also
    after executors were lost."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str, parts: int | None = None) -> DataFrame:
    """Add ``name``: 1, 2, 3... in the given order, without one task that holds all rows.

    Rows are cut into ordered ranges and written once, sorted, to the shared folder; a row's number is its place
    in its range after the sizes of the ranges before, of which the driver gets one number a range.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    path = shared_folder(spark, "numbered")
    cut.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    # the id holds the range in its upper 31 bits and the place in the lower 33
    written = spark.read.parquet(path).withColumn("_range", F.shiftrightunsigned("_at", 33).cast("int"))
    sizes = {r["_range"]: r["n"] for r in written.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    ahead = [str(sum(n for r, n in sizes.items() if r < i)) for i in range(max(sizes, default=0) + 1)]
    before = F.get(F.split(F.lit(",".join(ahead)), ",").cast("array<long>"), F.col("_range"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return written.withColumn(name, (before + place + 1)).drop("_at", "_range")
