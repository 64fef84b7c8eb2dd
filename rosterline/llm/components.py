"""Connected components of an undirected graph, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from rosterline.workspace import fresh_dir


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    path = fresh_dir(edges.sparkSession, "edges")
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("total")).write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path), (seen.get["n"], seen.get["total"])


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """For edges (``a``, ``b``) the rows (``node``, ``root``): the smallest node reachable.

    Alternates large-star and small-star steps. Each links the neighbours of a node with
    the smallest of them, which is an aggregate with partial results before the shuffle and
    a join that the adaptive planner can split, so a node with very many neighbours is
    never gathered. Every round is written to the shared folder; the number of rounds is
    logarithmic in practice. Self-loops are ignored.
    """
    current, state = _stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        large = _stored(large)[0]
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")),
        )).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        current, after = _stored(small)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
