"""The flagship: evidence of every structure that covers a position, in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.plans.catalog import query, table


@query(
    "annotate_positions",
    """
    WITH mapped AS (
      SELECT l_partkey AS position_id, l_suppkey AS structure_id, l_quantity AS v,
             0.25 / (1 + exp(1.5 * (1 + l_discount * 20) - 4)) + l_tax * 5 AS q
      FROM lineitem)
    SELECT position_id,
           round(sum(v * q) / sum(q), 6) AS wmean,
           round((1 - 1.0 / (count(v) + 1)) * (max(q) + median(q)) / 2, 6) AS confidence,
           count(*) AS n_mapped,
           arg_max(structure_id, {'q': q, 's': structure_id}) AS recommended
    FROM mapped GROUP BY position_id
    """,
)
def annotate_positions(spark, sf_dir):
    mapped = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("position_id"),
        F.col("l_suppkey").alias("structure_id"),
        F.col("l_quantity").alias("v"),
        (0.25 / (1 + F.exp(1.5 * (1 + F.col("l_discount") * 20) - 4)) + F.col("l_tax") * 5).alias("q"),
    )
    return mapped.groupBy("position_id").agg(
        F.round(F.sum(F.col("v") * F.col("q")) / F.sum("q"), 6).alias("wmean"),
        F.round((1 - 1 / (F.count("v") + 1)) * (F.max("q") + F.median("q")) / 2, 6).alias("confidence"),
        F.count("*").alias("n_mapped"),
        F.max_by("structure_id", F.struct("q", "structure_id")).alias("recommended"),
    )
