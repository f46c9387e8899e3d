"""Connected components of an edge table, by least labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residuum.llm.common import cut, freed


#: Rows up to which a table is kept in few files, how many, and rows up to which it is broadcast; they are counted.
FEW, TASKS, SENT = 200_000, 8, 20_000


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every end of ``edges`` (a, b): the least id that a path leads to.

    Each round takes the least label among neighbours, summed up before the shuffle, then
    that label's own label; rounds grow with the logarithm of the longest path. Nothing but
    numbers of rows reaches the driver, but labels of few edges: these are broadcast. More are
    not, as the driver would hold those of each round until it collects its garbage. Where
    there are not many edges, tables are kept in few files, for a round would else be mostly empty tasks.
    What a round leaves in the driver goes before the next one.
    """
    both = edges.select(F.col("a").alias("s"), F.col("b").alias("t")).where("s <> t")
    own = both.select(F.explode(F.array("s", "t")).alias("s")).select("s", F.col("s").alias("t"))  # so that its own label reaches each end as well
    both = cut(both.unionByName(both.select(F.col("t").alias("s"), F.col("s").alias("t"))).unionByName(own).distinct())
    rows = both.count()
    small = rows <= FEW
    sent = F.broadcast if rows <= SENT else lambda df: df.hint("merge")
    kept = (lambda df: cut(df.coalesce(TASKS))) if small else cut
    both = kept(both) if small else both
    labels = kept(both.groupBy(F.col("s").alias("id")).agg(F.min("t").alias("label")))
    while True:
        step = both.join(sent(labels), both["t"] == labels["id"]).groupBy(F.col("s").alias("id")).agg(F.min(F.when(F.col("s") == F.col("t"), F.col("label"))).alias("old"), F.min("label").alias("label"))
        target = labels.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
        after = step.join(sent(target), step["label"] == target["_id"], "left").select("id", "old", F.least("label", "_label").alias("label"))
        after = kept(after)
        freed(edges.sparkSession)
        if after.where("label <> old").isEmpty():
            return after.select("id", "label")
        labels = after.select("id", "label")
