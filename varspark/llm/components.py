"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached, for each node of ``links`` (a, b).

    Each round takes the smallest label among the neighbours and then the label of that label, so
    the number of rounds grows with the logarithm of a component's diameter.  Each round is
    written to the shared folder; the driver sees one count.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v")
    both = stage(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = stage(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")), "labels")
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("m"))
        new = labels.join(near, labels["node"] == near["u"]).select("node", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        new = stage(new, "labels")
        top = new.select(F.col("node").alias("at"), F.col("component").alias("next"))
        jumped = new.join(top, new["component"] == top["at"]).select("node", "old", F.least("component", "next").alias("component"))
        jumped = stage(jumped, "labels")
        labels = jumped.drop("old")
        if not jumped.filter("component <> old").limit(1).count():
            return labels
