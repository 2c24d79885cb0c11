"""Connected components of a table of links, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.sources.scratch import remove_path, write_step


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable over the links, for every node that has one.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so the distance to the smallest node shrinks by a
    factor a round.  Labels are combined before the shuffle, so a node with
    very many links is no hot key.  Every round is written to the shared folder.
    """
    spark = links.sparkSession
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(
        links.select(F.col(b).alias("node"), F.col(a).alias("other"))).where("node <> other").distinct()
    edges_at = write_step(both)
    edges = spark.read.schema(both.schema).parquet(edges_at)
    labels = edges.groupBy("node").agg(F.min("other").alias("other")).select(
        "node", F.least("node", "other").alias("component"))
    schema = labels.schema
    at = write_step(labels)
    while True:
        labels = spark.read.schema(schema).parquet(at)
        near = (edges.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("component").alias("near")))
        # a label's own label is the shortcut
        roots = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        stepped = (labels.join(near, "node", "left").join(roots, "component", "left")
                   .select("node", F.col("component").alias("old"),
                           F.least("component", "near", "root").alias("component")))
        then = write_step(stepped)
        moved = spark.read.parquet(then).where("component <> old").limit(1).count()
        remove_path(spark, at)
        at = then
        if not moved:
            remove_path(spark, edges_at)
            return spark.read.schema(schema).parquet(at).select("node", "component")
