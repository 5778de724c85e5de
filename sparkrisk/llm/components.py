"""Connected components of a membership table, by rounds of least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import stage


def components(members: DataFrame) -> DataFrame:
    """(doc, label): the least ``doc`` reachable from each ``doc`` over shared groups.

    ``members`` has (doc long, grp); a written table, as it is read in every round. A round gives
    each group the least label of its members, each member the least of its groups', and then
    that label's own label, so chains shorten by doubling. Aggregates combine before their
    shuffle; no group is brought together.
    """
    labels = stage(members.groupBy("doc").agg(F.col("doc").alias("label")).select("doc", "label"), "labels")
    while True:
        least = members.join(labels, "doc").groupBy("grp").agg(F.min("label").alias("m"))
        near = members.join(least, "grp").groupBy("doc").agg(F.min("m").alias("m"))
        of_label = labels.select(F.col("doc").alias("d"), F.col("label").alias("l"))
        step = near.join(of_label, F.col("m") == F.col("d")).select("doc", F.least("m", "l").alias("label"))
        step = step.join(labels.select("doc", F.col("label").alias("old")), "doc")
        step = stage(step, "labels")
        labels = step.select("doc", "label")
        if step.filter("label <> old").isEmpty():
            return labels
