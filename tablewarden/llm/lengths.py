"""Exact token totals for every context limit from one histogram of lengths."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .running import running_sum
from .store import materialise

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: how the vocabulary's authors cut text before merging
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SPAN = 256
# what the pattern calls white space, in runs so long that its backtracking may end in an error
BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LONG_BLANKS = re.compile(rf"(?<!{BLANK}){BLANK}{{10000,}}")


def count_tokens(encoding, text: str) -> int:
    """Tokens of a text under PATTERN, whatever the length of its runs of white space.

    The pattern cuts a run of two or more as one piece: all of it at the end of the text,
    else all but the last blank, which stays with what follows. So long runs are cut out
    and merged by themselves, and the pattern sees the texts between them.
    """
    n = at = 0
    for run in LONG_BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        n += len(encoding.encode_ordinary(text[at : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:]))


def _lengths(ranks_path: str, pattern: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # other patterns may cut white space elsewhere
        count = count_tokens if pattern == PATTERN else lambda e, t: len(e.encode_ordinary(t))
        for batch in batches:
            n = [count(encoding, t.as_py()) if t.is_valid else 0 for t in batch[text]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(n, np.int64))], names=[*batch.schema.names, "length"]
            )

    return run


def encoded_lengths(docs: DataFrame, text: str = "text", ranks_path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Add ``length``, the number of tokens of the whole text. Null and empty texts: 0.

    The vocabulary file must be at ``ranks_path`` on every executor.
    """
    docs = docs.drop("length")
    schema = T.StructType([*docs.schema.fields, T.StructField("length", T.LongType())])
    return docs.mapInArrow(_lengths(ranks_path, pattern, text), schema)


def histogram(lengths: DataFrame, length: str = "length") -> DataFrame:
    """(length, n_docs) of a table with a length per document."""
    return lengths.groupBy(F.col(length).alias("length")).agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length L that occurs: what a context limit of L means for the corpus.

    length, n_docs; docs_from and tokens_from (documents of L tokens or more, and their
    tokens); truncated_total (tokens left if all documents are cut to L);
    share_upto (of documents of at most L tokens). Between two lengths the truncated
    total is linear in the limit. Empty table: no rows. Running sums work on spans of
    lengths, so no task needs the whole histogram.
    """
    hist = hist.withColumn("_span", F.floor(F.col("length") / SPAN)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    hist = materialise(hist, "histogram")
    docs, tokens = hist.agg(F.sum("n_docs"), F.sum("tokens")).first()
    docs, tokens = docs or 0, tokens or 0
    below = running_sum(hist, [], "_span", ["length"], "n_docs", "_docs")
    less = running_sum(hist, [], "_span", ["length"], "tokens", "_tokens").select("length", "_tokens")
    out = below.join(less, "length")
    rest = F.lit(docs) - F.col("_docs")
    return out.select(
        "length",
        "n_docs",
        rest.alias("docs_from"),
        (F.lit(tokens) - F.col("_tokens")).alias("tokens_from"),
        (F.col("_tokens") + F.col("length") * rest).alias("truncated_total"),
        ((F.col("_docs") + F.col("n_docs")) / F.lit(float(docs or 1))).alias("share_upto"),
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the least length whose share of documents up to it reaches each share."""
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    rows = sums.withColumn("share", asked).where(F.col("share_upto") >= F.col("share"))
    return rows.groupBy("share").agg(F.min("length").alias("length"))


def at_limits(hist: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(limit, truncated_total, docs_cut) for any context limits, whether they occur as lengths or not."""
    rows = hist.withColumn("limit", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])))
    n, length = F.col("n_docs"), F.col("length")
    return rows.groupBy("limit").agg(
        F.sum(F.least(length, F.col("limit")) * n).alias("truncated_total"),
        F.sum(F.when(length > F.col("limit"), n).otherwise(0)).alias("docs_cut"),
    )
