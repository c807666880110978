"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import drop_scratch, spark_read, write_scratch


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (a, b: bigint) with its component's smallest node.

    Each round hooks every node to its smallest neighbour, flattens the trees by
    pointer jumping and replaces the links' ends by their roots; links inside a
    tree vanish, so the nodes left at least halve. All joins have a unique key
    on one side, so a hub only makes one side of a join long, which Spark can
    split. Tables between rounds are written to the shared checkpoint folder.
    Null ends are ignored; no links give no rows.
    """
    spark = links.sparkSession

    def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = write_scratch(df, name)
        return spark_read(spark, path, df), path

    edges, edge_path = keep(links.select("a", "b").where("a <> b").distinct(), "cc-links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels, label_path = keep(nodes.select("node", F.col("node").alias("root")), "cc-labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        tree, tree_path = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                               .select("node", F.least("node", "near").alias("up")), "cc-tree")
        while True:
            over = tree.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped, path = keep(tree.join(over, "up").select("node", "up", "top"), "cc-tree")
            flat = jumped.where("up <> top").isEmpty()
            drop_scratch(spark, tree_path)
            tree, tree_path = jumped.select("node", F.col("top").alias("up")), path
            if flat:
                break
        new, path = keep(labels.join(tree.withColumnRenamed("node", "root"), "root", "left")
                         .select("node", F.coalesce("up", "root").alias("root")), "cc-labels")
        drop_scratch(spark, label_path)
        labels, label_path = new, path
        ends = (edges.join(tree.select(F.col("node").alias("a"), F.col("up").alias("ra")), "a")
                .join(tree.select(F.col("node").alias("b"), F.col("up").alias("rb")), "b"))
        new, path = keep(ends.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                         .distinct(), "cc-links")
        drop_scratch(spark, edge_path)
        drop_scratch(spark, tree_path)
        edges, edge_path = new, path
    drop_scratch(spark, edge_path)
    return labels
