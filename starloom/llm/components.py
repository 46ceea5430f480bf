"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """(``node``, ``root``) for every node of ``edges``; ``root`` is the smallest node of the component.

    Every step joins the edges with one minimum per node, so no neighbourhood is gathered in
    a task, and the minimum is pre-aggregated; AQE splits the edges of a hot node in the
    join. The edges are staged after each step (lineage stays short, lost executors cost a
    re-read) and the loop ends when a step changes nothing, after about log(n) steps.
    Loops, repeated edges and nulls are allowed; a null end drops the edge. No edges: no rows.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    nodes = None
    current = stage(_downward(pairs), f"{label}-edges")
    before = _state(current)
    while before[0]:
        current = stage(_small_star(_large_star(current)), f"{label}-edges")
        after = _state(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    loops = pairs.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("root")).distinct()
    nodes = stars.unionByName(roots)
    lone = loops.join(nodes.select("node"), "node", "left_anti")
    return nodes.unionByName(lone)


def _downward(pairs: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end, loops left out."""
    return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def apart(least: DataFrame) -> DataFrame:
    """The minima dealt anew, as AQE only splits a hot node's edges where no aggregate shares their stage."""
    return least.hint("rebalance")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = apart(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = _downward(edges)
    least = apart(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u")
    across = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return across.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
