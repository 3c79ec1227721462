"""Connected components of a graph of links, by least labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywing.llm.shared import checkpointed, in_few


def components(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """node and component (its least node) of every node of ``links`` (a, b), from earlier labels if there are any.

    Each round takes the least label among neighbours, by a map-side combining aggregation, and then the label of that
    label, so paths halve; rounds are written to the shared folder. Labels never leave the cluster. Tasks are as many as
    the links ask for, or fewer. Without links or earlier labels there are no nodes.
    """
    rows = 2 * links.count() + (2 * start.count() if start is not None else 0)
    few = lambda frame: in_few(frame, rows)
    links = few(links)
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if start is not None:
        own = few(start).select(F.col("node").alias("a"), F.col("component").alias("b"))
        both = both.unionAll(own).unionAll(own.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = checkpointed(few(both.filter("a <> b").distinct()))
    label = checkpointed(few(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node")))
    while True:
        around = both.join(label, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "component")
        least = label.unionAll(few(around)).groupBy("node").agg(F.min("component").alias("component"))
        of = least.select(F.col("node").alias("at"), F.col("component").alias("further"))
        jumped = few(least).join(of, F.col("component") == F.col("at")).select("node", F.least("component", "further").alias("component"))
        before = label.withColumnRenamed("component", "before")
        new = checkpointed(few(few(jumped).join(before, "node")))
        changed = new.filter("component <> before").limit(1).count()
        label = new.select("node", "component")
        if not changed:
            return label
