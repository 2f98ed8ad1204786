"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """v and root for every end of a link: the smallest vertex that can be reached.

    Every round takes the smallest root among the neighbours, then the root's own
    root, so long chains halve. Each round is written to the shared folder; no link
    or label comes to the driver but the number of changes.
    """
    ends = links.select(F.col(a).alias("v"), F.col(b).alias("w")).filter("v <> w")
    ends = materialize(ends.union(ends.select("w", "v")).distinct(), "ends")
    labels = ends.groupBy("v").agg(F.min("w").alias("root"))
    labels = materialize(labels.select("v", F.least("v", "root").alias("root")), "labels")
    while True:
        near = ends.join(labels.withColumnRenamed("v", "w"), "w").groupBy("v").agg(F.min("root").alias("__near"))
        step = materialize(labels.join(near, "v").select("v", F.least("root", "__near").alias("root")), "step")
        above = step.select(F.col("v").alias("root"), F.col("root").alias("__top"))
        jumped = step.join(above, "root").select("v", F.least("root", "__top").alias("root"))
        jumped = materialize(jumped, "labels")
        moved = jumped.join(labels.withColumnRenamed("root", "__old"), "v").filter(F.col("root") != F.col("__old"))
        labels = jumped
        if moved.isEmpty():
            return labels
