"""Sinks of sequences, networks and tables as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fasta(sequences: DataFrame, *, width: int | None = None) -> DataFrame:
    """(value): a record for each (id, sequence), in lines of ``width`` letters if given."""
    letters = F.col("sequence") if width is None else F.rtrim(F.regexp_replace("sequence", f"(.{{{width}}})(?=.)", "$1\n"))
    return sequences.select(F.concat(F.lit(">"), F.col("id").cast("string"), F.lit("\n"), letters).alias("value"))


def sif(edges: DataFrame, *, kind: str = "kind") -> DataFrame:
    """(value): a line ``a kind b`` for each edge (a, b, kind), tab-separated, as network tools read it."""
    return edges.select(F.concat_ws("\t", F.col("a").cast("string"), F.col(kind).cast("string"), F.col("b").cast("string")).alias("value"))


def markdown(rows: DataFrame) -> DataFrame:
    """(line, value): a table with a header; ``line`` keeps header and rows apart when sorted. A null cell is empty, a bar is escaped."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    wrap = lambda text: F.concat(F.lit("| "), text, F.lit(" |"))
    spark = rows.sparkSession
    head = spark.createDataFrame([(0, "| " + " | ".join(rows.columns) + " |"), (1, "|" + "---|" * len(rows.columns))], "line long, value string")
    body = rows.select(F.lit(2).cast("long").alias("line"), wrap(F.concat_ws(" | ", *map(cell, rows.columns))).alias("value"))
    return head.unionByName(body)


def write_text(lines: DataFrame, path: str, *, order: list[str] | None = None) -> None:
    """Text files in ``path``; with ``order`` the files, by name, are one sorted text."""
    rows = lines.orderBy(*order) if order else lines
    rows.select("value").write.mode("overwrite").text(path)
