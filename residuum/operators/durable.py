"""A durable cut of the lineage for operators that take rounds, and rows dealt out to tasks of bounded size."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame

#: Rows that one task should get.
EACH = 200_000


def cut(df: DataFrame) -> DataFrame:
    """``df`` kept in the session's ``spark.checkpoint.dir``, so that a lost executor costs no recomputation of earlier rounds.

    Only on a local master, where none is set, a temporary folder serves.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="residuum-"))
    return df.checkpoint()


def parts_of(rows: DataFrame, each: int = EACH) -> int:
    """How many tasks of ``each`` rows it takes; ``rows`` should be a table whose rows are cheap to count, as they are in Parquet's footers."""
    return max(1, -(-rows.count() // each))


def dealt(rows: DataFrame, parts: int, *keys: str | Column) -> DataFrame:
    """``rows`` dealt out by keys to so many tasks.

    Spark joins the partitions of a shuffle by their compressed size, and a map task's share of
    a file grows with the table; where rows are few bytes each, a task then sorts or sums up
    more and more of them. A given number is left as it is, and grows with the table.
    """
    return rows.repartition(parts, *keys)
