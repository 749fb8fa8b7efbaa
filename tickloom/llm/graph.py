"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Tables


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every end of the links ``a``, ``b`` (long).

    Every node takes the smallest label among its neighbours and then the label
    of that label, until nothing changes; the rounds grow with the logarithm of
    the longest path. Labels are written between rounds. No links give no rows.
    """
    tables = Tables(links.sparkSession, "components")
    both = tables.keep(
        links.select(F.col("a").alias("node"), F.col("b").alias("near"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("near"))).distinct(),
        "links",
    )
    labels = tables.keep(both.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("component")), "labels")
    while True:
        near = labels.select(F.col("node").alias("near"), F.col("component").alias("_near"))
        spread = both.join(near, "near").groupBy("node").agg(F.min("_near").alias("_near"))
        lower = labels.join(spread, "node").select("node", F.least("component", "_near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("_jump"))
        found = tables.keep(
            lower.join(jump, "component", "left")
            .select("node", F.least("component", F.coalesce("_jump", "component")).alias("component")),
            "labels",
        )
        changed = (
            found.join(labels.withColumnRenamed("component", "_was"), "node").where("component <> _was").limit(1).count()
        )
        tables.drop(labels)
        labels = found
        if not changed:
            tables.drop(both)
            return labels
