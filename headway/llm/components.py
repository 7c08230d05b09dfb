"""Connected components by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import keep


def _through(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """`column` replaced by its parent where it has one.

    Both sides are read from files, so Spark sees plain shuffles and can split a vertex
    that many rows point to.
    """
    step = parents.select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"))
    found = df.join(step, F.col(column) == F.col("_hi"), "left")
    return found.withColumn(column, F.coalesce("_lo", column)).drop("_hi", "_lo")


def _edges(df: DataFrame) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return (
        df.filter(a != b)
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """`id` and `component`, its smallest reachable id, for every id but the smallest ones.

    `edges` has two columns of ids, `a` and `b`. Every vertex hooks to its smallest
    neighbour below it; the forest is flattened by doubling, edges are moved to the roots,
    and the rest is done again. Vertices halve each round. Each round is written to the
    shared folder, so a lost executor costs one round at most.
    """
    edges = keep(_edges(edges.select("a", "b")), "edges")
    # no table of any round has more rows: each edge makes one vertex hook at most
    most = edges.count()
    labels = None
    while True:
        parents = keep(edges.groupBy("hi").agg(F.min("lo").alias("lo")), "parents", most)
        if parents.isEmpty():
            break
        while True:
            moved = keep(_through(parents.withColumn("was", F.col("lo")), "lo", parents), "parents", most)
            parents = moved.select("hi", "lo")
            if moved.filter("lo <> was").isEmpty():
                break
        old = [] if labels is None else [_through(labels, "component", parents)]
        new = parents.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
        # a vertex hooks once: later it is no root, so the two sides share none
        labels = keep(old[0].unionByName(new) if old else new, "labels", most)
        ends = edges.select(F.col("hi").alias("a"), F.col("lo").alias("b"))
        edges = keep(_edges(_through(_through(ends, "a", parents), "b", parents)), "edges", most)
    if labels is None:
        labels = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels`, as `components` gives them, with the components that the edges `links` join.

    Only components are vertices here, so it is as much work as there are links.
    """
    ends = labelled(labelled(links, "a", labels, "of_a"), "b", labels, "of_b")
    above = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    old = labelled(labels, "component", above, "above").select("id", F.col("above").alias("component"))
    # a component's own id has no row of its own before it is joined to a smaller one
    return keep(old.unionByName(above.select("id", "component")), "labels")


def labelled(df: DataFrame, column: str, labels: DataFrame, name: str) -> DataFrame:
    """`df` with the component of `column` as `name`; an id without one is its own."""
    step = labels.select(F.col("id").alias("_id"), F.col("component").alias("_component"))
    found = df.join(step, F.col(column) == F.col("_id"), "left")
    return found.withColumn(name, F.coalesce("_component", column)).drop("_id", "_component")
