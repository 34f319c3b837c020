"""A training corpus from raw documents: five stages over the operators of tablewarden.llm.

Every stage takes (spark, docs, sf_dir) and works on all documents the one before kept;
``run`` writes each stage's result as Parquet and hands the reread table on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import decontam, jaccard, mixing, quality, sharding
from tablewarden.llm.store import materialise

SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _unused(name: str, columns: list[str]) -> str:
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def _beside(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on the key, text and source of ``docs``, whole rows riding along as one column, so that
    no other column can clash with a name that the work uses."""
    rows = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    return work(rows).select("whole.*")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of 0.5 or more).

    A null text is judged like an empty one; repeated rows fare alike; without labels every
    score is 0.5 and all stay; an empty table stays empty; any further columns are kept.
    """
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    out = _unused("score", docs.columns)
    return quality.score(docs, model, out=out).where(F.col(out) >= 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (five-word shingles, similarity 0.8) the least doc_id.

    Documents without words (null, empty, blank) are in no group and stay. Rows that repeat a
    doc_id are told apart by their texts; of rows equal in both one stays; a null doc_id
    comes after all others. An empty table stays empty; any further columns are kept.
    """
    return _beside(docs, lambda rows: jaccard.keep_one(rows, 5, (80, 100)))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item.

    A null text has no words and stays; rows equal in doc_id (null included) and text fare alike;
    an empty table, of documents or items, is left as it is; any further columns are kept.
    """
    return _beside(docs, lambda rows: decontam.clean_documents(rows, _table(spark, sf_dir, "benchmark")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at weights 5, 2, 1: documents not reached go, some come twice.

    A null source is a source of its own; null and wordless texts have no words to take and go;
    rows equal in doc_id and text share what the mix takes of them; an empty table stays
    empty; any further columns are kept.
    """
    return _beside(docs, mixing.mixed_documents)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix: the columns of ``sharding.shard_rows``.

    A null doc_id and a null text are placed like the empty one; every copy of a row gets a slot
    of its own; an empty table gives no rows; other columns are not read.
    """
    return sharding.shard_rows(docs, SHARDS)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# a classifier and word-shingle components have no SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs.select(*[F.col(c) for c in docs.columns])
