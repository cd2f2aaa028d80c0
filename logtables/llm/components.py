"""Connected components of links, without bringing links together anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.shared import kept


def connected(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (id, label) after joining the components of labels that links (a, b) connect.

    Only links between different components matter; they become edges between labels. Each round
    takes the smallest name among an end's neighbours and, after two rounds, the name of that name,
    so paths shrink by half; rounds end when no name falls. A hub's edges are aggregated before the shuffle
    and spread by skew joins. The label of a component is the smallest of its labels.
    """
    one, other = (labels.select(F.col("id").alias(c), F.col("label").alias(f"label_{c}"))
                  for c in ("a", "b"))
    # However many links there are between two components, they are one edge, in both directions.
    apart = links.join(one, "a").join(other, "b").where("label_a != label_b").select(
        F.least("label_a", "label_b").alias("p"), F.greatest("label_a", "label_b").alias("q")).distinct()
    edges = kept(apart.select(F.explode(F.array(
        F.struct(F.col("p").alias("x"), F.col("q").alias("y")),
        F.struct(F.col("q").alias("x"), F.col("p").alias("y")))).alias("e")).select("e.x", "e.y"))
    names = edges.select(F.col("x").alias("at")).distinct().withColumn("name", F.col("at"))
    rounds = 0
    while True:
        near = edges.join(names, F.col("y") == F.col("at")).groupBy("x").agg(
            F.min("name").alias("near"))
        stepped = names.join(near, F.col("at") == F.col("x")).select(
            "at", F.least("name", "near").alias("name"), F.col("name").alias("before"))
        rounds += 1
        if rounds > 2:
            # Hubs are settled by now; what is left are paths.
            lower = stepped.withColumnRenamed("name", "next")
            jump = lower.select(F.col("at").alias("there"), F.col("next").alias("name"))
            stepped = lower.join(jump, F.col("next") == F.col("there")).select(
                "at", "name", "before")
        stepped = kept(stepped)
        names = stepped.select("at", "name")
        if stepped.where("name != before").isEmpty():
            break
    return kept(labels.join(names, F.col("label") == F.col("at"), "left").select(
        "id", F.coalesce("name", "label").alias("label")))
