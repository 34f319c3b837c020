"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import hot_keys, salted_join
from .store import materialise


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every vertex of ``edges`` (a, b: long); label is the component's smallest vertex.

    Each round hooks every vertex to its smallest neighbour, shortens the chains of
    hooks to their ends and moves the edges to those ends; stars vanish in one round
    and paths at least halve. Vertices of very many edges are salted in the joins.
    """
    spark = edges.sparkSession
    edges = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("v")).agg(
            F.least(F.min("b"), F.col("v")).alias("p"), F.count("*").alias("n")
        )
        hooks = materialise(hooks, "hooks")
        hot = hot_keys(hooks, ["v"])
        while True:
            # a vertex's hook is smaller than itself, so the chains end
            up = hooks.select(F.col("v").alias("p"), F.col("p").alias("_up"))
            hot_p = hot_keys(hooks.groupBy("p").agg(F.count("*").alias("n")), ["p"])
            step = materialise(salted_join(hooks, up, ["p"], hot_p, "v"), "hooks")
            moved = not step.where("_up <> p").isEmpty()
            hooks = step.select("v", F.col("_up").alias("p"), "n")
            if not moved:
                break
        ends = hooks.select("v", "p")
        if labels is None:
            labels = ends.select("v", F.col("p").alias("label"))
        else:
            # a label that has no edge left keeps its name
            hot_l = hot_keys(labels.groupBy(F.col("label").alias("v")).agg(F.count("*").alias("n")), ["v"])
            moved = salted_join(labels.select(F.col("v").alias("_v"), F.col("label").alias("v")), ends, ["v"], hot_l, "_v", "left")
            labels = materialise(moved.select(F.col("_v").alias("v"), F.coalesce("p", "v").alias("label")), "labels")
        first = salted_join(edges.withColumnRenamed("a", "v"), ends, ["v"], hot, "b").select(F.col("p").alias("a"), F.col("b").alias("v"))
        second = salted_join(first, ends, ["v"], hot, "a").select("a", F.col("p").alias("b"))
        edges = materialise(
            second.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
        )
    return labels if labels is not None else spark.createDataFrame([], "v long, label long")
