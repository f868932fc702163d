"""Connected components of an edge table by minimum labels with shortcuts. Nothing of the graph reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.shared import Tables, join_counted


def components(edges: DataFrame, tables: Tables, *, broadcast_rows: int = 400_000) -> tuple[DataFrame, int]:
    """(node, label) for every node of ``edges`` (a, b), and how many rows that has; label is the smallest node that can be reached.

    Each step takes the smallest label among a node's neighbours and then the label of that label, so paths shrink
    by more than half and the number of steps grows with the logarithm of the longest path. A step is one job that writes a table and
    also counts the labels that moved. Labels of up to ``broadcast_rows`` nodes, counted, are broadcast, and a
    step then shuffles once; larger ones are joined by shuffle.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both, _ = tables.keep(both)
    labels, seen = tables.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), n=F.count("*"))
    rows = seen["n"]
    with_labels = lambda df, on, name: join_counted(df, labels.select(F.col("node").alias(on), F.col("label").alias(name)), on, "inner", rows, broadcast_rows)
    while True:
        near = with_labels(both, "b", "near").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        low = with_labels(near, "node", "label").select("node", "label", F.least("label", "near").alias("low"))
        stepped = with_labels(low, "low", "jumped").select("node", "label", F.least("low", "jumped").alias("next"))
        stepped, seen = tables.keep(stepped, moved=F.count_if(F.col("next") < F.col("label")))
        labels = stepped.select("node", F.col("next").alias("label"))
        if not seen["moved"]:
            return labels, rows
