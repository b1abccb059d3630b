"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disclosa.llm.common import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of links(a, b); rows may repeat or have a = b.

    Each round takes the smallest label among a node's neighbours, then the label of that label (pointer jumping),
    until nothing changes. Labels are written to the shared folder after each round, which ends their lineage; joins
    are between two exchanged tables, so adaptive execution can split a hub's partition. Null ends are ignored.
    """
    ends = links.select("a", "b").where("a is not null and b is not null and a <> b")
    both = materialise(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hop = materialise(
            labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "hop"
        )
        of = hop.select(F.col("node").alias("at"), F.col("label").alias("next"))
        new = materialise(
            hop.join(of, hop.label == of.at, "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label"), "old"), "labels"
        )
        discard(hop, labels)
        labels = new
        if not new.where("label <> old").limit(1).count():
            discard(both)
            return new.select("node", F.col("label").alias("component"))
