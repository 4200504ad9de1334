"""Connected components of a table of links, as joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazarlake.operators.workdir import materialize

LINKS_PER_TASK = 500_000


def components(links: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable. Links are columns ``a`` and ``b``.

    Labels fall to the smallest label of the neighbours and then to the label's own label, which
    halves the remaining distance, until none changes. Each round is checkpointed. A node with very
    many links makes a hot key of a join between two plain exchanges, which AQE splits; groupings
    combine before the shuffle. The rounds run in as many tasks as the links need, one for each
    ``LINKS_PER_TASK``, so that a short table does not write many tiny files in every round. Nulls
    are no nodes; repeated and self links change nothing.
    """
    held = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    edges = materialize(held.unionAll(held.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    tasks = 1 + edges.count() // LINKS_PER_TASK
    edges = edges.coalesce(tasks)
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = materialize(least.select("node", F.least("node", "least").alias("label")).coalesce(tasks))
    while True:
        seen = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(seen, labels.node == seen.a)
        closer = materialize(
            nearer.select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")).coalesce(tasks)
        )
        above = closer.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        further = closer.join(above, closer.label == above.up).select("node", F.col("up_label").alias("label"), "old")
        jumped = materialize(further.coalesce(tasks))
        if jumped.filter("label < old").isEmpty():
            return jumped.select("node", F.col("label").alias("component"))
        labels = jumped.select("node", "label")
