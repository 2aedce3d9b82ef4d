"""Connected components of a link table, with DataFrame joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.shared import forget, written


def connected(links: DataFrame) -> DataFrame:
    """node, root for every end of ``links`` (a long, b long); root is the least node of its
    component.

    Each round hangs every node below its least neighbour, follows those pointers to their
    ends (their chains double in each step) and contracts the links to the roots, so the graph
    shrinks by half at least.  Every step is an aggregate or an equi-join by node; all tables in
    between lie in the shared folder.
    """
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    edges, path = written(both, "links")
    paths = [path]
    labels = None
    while not edges.isEmpty():
        # hang below the least neighbour (or stay, if less than all)
        hung = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node")
        hung, path = written(hung, "roots")
        paths.append(path)
        while True:
            up = hung.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            nxt, path = written(hung.join(up, F.col("root") == F.col("_n")).select("node", F.col("_r").alias("root"),
                                                                                   (F.col("_r") != F.col("root")).alias("moved")), "roots")
            paths.append(path)
            hung = nxt.select("node", "root")
            if nxt.filter("moved").isEmpty():
                break
        if labels is None:
            labels = hung
        else:
            up = hung.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            labels, path = written(labels.join(up, F.col("root") == F.col("_n"), "left")
                                   .select("node", F.coalesce("_r", "root").alias("root")), "labels")
            paths.append(path)
        left = hung.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = hung.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges, path = written(edges.join(left, "a").join(right, "b").filter("ra <> rb")
                              .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
        paths.append(path)
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).filter("false")
    kept, _ = written(labels, "components")
    forget(spark, *paths)
    return kept
