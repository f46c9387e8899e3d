"""Pairs of aligned sequences: global alignment and the changes that it tells of."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Costs of a gap, and letters that stand for rarer ones.
OPEN, EXTEND = -10.0, -0.5
RARE = str.maketrans("UOJ", "CKI")


def aligned(a: str, b: str, score: np.ndarray, letters: str) -> tuple[str, str]:
    """A global alignment of the greatest score, gaps with affine costs, free at either end.

    Rows are filled at once: what a gap along a row brings is a running maximum.
    """
    at = {c: i for i, c in enumerate(letters)}
    x, y = (np.array([at.get(c, len(letters)) for c in s.translate(RARE)], np.int64) for s in (a, b))
    n, m = len(x), len(y)
    best, down = np.zeros(m + 1), np.full(m + 1, -np.inf)
    steps = np.arange(m + 1) * EXTEND
    from_up, from_left = np.zeros((n + 1, m + 1), np.int32), np.zeros((n + 1, m + 1), np.int32)  # length of a gap that ends here, or none
    up_length = np.zeros(m + 1, np.int32)
    for i in range(1, n + 1):
        fresh = best + OPEN
        longer = down + EXTEND >= fresh
        up_length = np.where(longer, up_length + 1, 1).astype(np.int32)
        down = np.maximum(fresh, down + EXTEND)
        diagonal = np.append(0.0, best[:-1] + score[x[i - 1], y])
        top = np.where(down > diagonal, down, diagonal)
        top[0] = 0.0
        if m and i == n:  # the last row is free
            reach = np.maximum.accumulate(top)
            start = np.maximum.accumulate(np.where(top >= reach, np.arange(m + 1), 0))
            left = np.append(-np.inf, reach[:-1])
        else:
            open_at = top - steps + OPEN - EXTEND
            reach = np.maximum.accumulate(open_at)
            start = np.maximum.accumulate(np.where(open_at >= reach, np.arange(m + 1), 0))
            left = np.append(-np.inf, (reach + steps)[:-1] + EXTEND)
        from_up[i] = np.where(down > diagonal, up_length, 0)
        if m:  # the last column is free downwards
            free = best[m]
            if free > top[m]:
                top[m], from_up[i, m] = free, 1
        over = left > top
        from_left[i] = np.where(over, np.arange(m + 1) - np.append(0, start[:-1]), 0)
        from_up[i][over] = 0
        best = np.where(over, left, top)
        best[0], from_up[i, 0] = 0.0, i
    out_a, out_b, i, j = [], [], n, m
    while i or j:
        if not i or (j and from_left[i, j]):
            k = j if not i else int(from_left[i, j])
            out_a.append("-" * k)
            out_b.append(b[j - k : j][::-1])
            j -= k
        elif not j or from_up[i, j]:
            k = i if not j else int(from_up[i, j])
            out_a.append(a[i - k : i][::-1])
            out_b.append("-" * k)
            i -= k
        else:
            i, j = i - 1, j - 1
            out_a.append(a[i])
            out_b.append(b[j])
    return "".join(out_a)[::-1], "".join(out_b)[::-1]


def aligner(matrix: dict[tuple[str, str], float], letters: str, *, other: float = -1.0) -> Callable:
    """A Pandas UDF of two columns that gives (target, template) aligned; ``matrix`` holds each
    pair of letters in either order, and what it lacks scores ``other``."""
    table = np.full((len(letters) + 1, len(letters) + 1), other)
    for i, p in enumerate(letters):
        for j, q in enumerate(letters):
            table[i, j] = matrix.get((p, q), matrix.get((q, p), other))

    @F.pandas_udf("target string, template string")
    def align(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        pairs = [(None, None) if x is None or y is None else aligned(x, y, table, letters) for x, y in zip(a, b, strict=True)]
        return pd.DataFrame(pairs, columns=["target", "template"])

    return align


def align_distinct(rows: DataFrame, align: Callable, a: str = "a", b: str = "b") -> DataFrame:
    """``rows`` with (target, template), the alignment of their columns a and b; equal pairs are aligned once.

    A large table of few different pairs takes as long as these. The pairs are dealt out by
    their letters, so that a small file of many pairs is not one task.
    """
    pairs = rows.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct()
    pairs = pairs.repartition("_a", "_b").select("_a", "_b", align("_a", "_b").alias("_x"))
    met = rows.join(pairs, rows[a].eqNullSafe(pairs["_a"]) & rows[b].eqNullSafe(pairs["_b"]))
    return met.select(*(rows[c] for c in rows.columns), "_x.target", "_x.template")


def variants(alignments: DataFrame, keys: list[str], target: str = "target", template: str = "template") -> DataFrame:
    """(keys, change) for each run of differing columns of aligned pairs, places along the target.

    One column of two letters is a substitution; a run of gaps in the target an insertion, in
    the other a deletion; any other run is told as deletion and insertion.
    """
    columns = F.arrays_zip(F.split(target, "").alias("a"), F.split(template, "").alias("b"))
    rows = alignments.select(*keys, F.posexplode(columns).alias("i", "p")).where("p.a <> ''").select(*keys, "i", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
    own = Window.partitionBy(*keys).orderBy("i")
    rows = rows.withColumn("pos", F.sum((F.col("a") != "-").cast("int")).over(own)).withColumn("last_a", F.lag("a").over(own)).withColumn("next_a", F.lead("a").over(own))
    differ = rows.where("a <> b").withColumn("run", F.col("i") - F.row_number().over(own))
    letters = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", c))), lambda x: x[c]), "")
    runs = differ.groupBy(*keys, "run").agg(
        letters("a").alias("a"), letters("b").alias("b"), F.min("pos").alias("left"), F.max("pos").alias("right"), F.min_by("last_a", "i").alias("before"), F.max_by("next_a", "i").alias("after"), F.min(F.when(F.col("a") != "-", F.col("pos"))).alias("first")
    )
    lost, got = F.replace("a", F.lit("-"), F.lit("")), F.replace("b", F.lit("-"), F.lit(""))
    ends = F.concat(F.substring(lost, 1, 1), F.col("first").cast("string"), F.when(F.length(lost) > 1, F.concat(F.lit("_"), F.substring(lost, -1, 1), F.col("right").cast("string"))).otherwise(""))
    insertion = F.concat(F.coalesce("before", F.lit("")), F.col("left").cast("string"), F.lit("_"), F.coalesce("after", F.lit("")), (F.col("left") + 1).cast("string"), F.lit("ins"), got)
    change = F.when(lost == "", insertion).when(got == "", F.concat(ends, F.lit("del"))).when((F.length("a") == 1), F.concat(lost, F.col("first").cast("string"), got)).otherwise(F.concat(ends, F.lit("delins"), got))
    return runs.select(*keys, change.alias("change"))
