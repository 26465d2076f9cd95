"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import fresh_folder


def _written(rows: DataFrame, name: str) -> DataFrame:
    rows.write.parquet(name)
    return rows.sparkSession.read.schema(rows.schema).parquet(name)


def components(nodes: DataFrame, links: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, component) of each of ``nodes`` (one column); the component is the least node within reach over ``links`` (two columns).

    In a round each node takes the least label next to it, then the label of that label; a fixed
    point is reached when no node moves. Each round is written in the shared folder, so a lost
    executor costs one round at most. Links with an end that is no node are left out.
    """
    folder = fresh_folder(nodes.sparkSession, "components")
    a, b = links.columns
    both = links.toDF("a", "b").where("a <> b")
    both = _written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{folder}/links")
    now = _written(nodes.toDF("node").distinct().select("node", F.col("node").alias("component")), f"{folder}/0")
    for n in range(1, rounds + 1):
        near = both.join(now.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("least"))
        moved = now.join(near, "node", "left").select("node", F.col("component").alias("before"), F.least("component", F.coalesce("least", "component")).alias("label"))
        of_label = moved.select(F.col("node").alias("label"), F.col("label").alias("jumped"))
        after = _written(moved.join(of_label, "label").select("node", "before", F.col("jumped").alias("component")), f"{folder}/{n}")
        now = after.select("node", "component")
        if after.where("before <> component").isEmpty():
            return now
    raise RuntimeError("components did not settle")
