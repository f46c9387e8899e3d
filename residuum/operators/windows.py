"""Islands, neighbours, flanks and top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def islands(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Runs of consecutive numbers: (keys, first, last, n)."""
    each = rows.select(*keys, place).distinct()
    run = F.col(place) - F.row_number().over(Window.partitionBy(*keys).orderBy(place))
    return each.withColumn("_run", run).groupBy(*keys, "_run").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n")).drop("_run")


def dense_ranges(rows: DataFrame, keys: list[str], place: str, *, gap: int = 2) -> DataFrame:
    """Ranges whose members follow each other at no more than ``gap``: (keys, first, last, n)."""
    own = Window.partitionBy(*keys).orderBy(place)
    far = (F.col(place) - F.lag(place).over(own) > gap).cast("int")
    run = F.sum(F.coalesce(far, F.lit(0))).over(own.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(*keys, place).distinct().withColumn("_run", run).groupBy(*keys, "_run").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n")).drop("_run")


def merged_ranges(rows: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """Ranges that overlap or touch, fused."""
    own = Window.partitionBy(*keys).orderBy(first, last)
    reach = F.max(last).over(own.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col(first) > reach + 1).cast("int"), F.lit(1))
    run = F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_new", new).withColumn("_run", run).groupBy(*keys, "_run").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_run")


def top(rows: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "place") -> DataFrame:
    """The first ``k`` rows of each group; ``order`` should be total."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(out) <= k)


def nearest(rows: DataFrame, keys: list[str], place: str, value: str) -> DataFrame:
    """The last value before and the first after each row that are not null."""
    own = Window.partitionBy(*keys).orderBy(place)
    before = F.last(value, ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(value, ignorenulls=True).over(own.rowsBetween(1, Window.unboundedFollowing))
    return rows.withColumn("before", before).withColumn("after", after)


def flank(keys: list[str], place: str, before: int, after: int):
    """Window of so many rows before and after the current one."""
    return Window.partitionBy(*keys).orderBy(place).rowsBetween(-before, after)


def numbered(rows: DataFrame, keys: list[str], item: str, out: str = "number") -> DataFrame:
    """Items of a group numbered from one in their order, equal items alike."""
    return rows.withColumn(out, F.dense_rank().over(Window.partitionBy(*keys).orderBy(item)))


def upper_scale(rows: DataFrame, keys: list[str], value: str, out: str = "scaled") -> DataFrame:
    """Values over the group's 99th percentile from the top if it has over 1000 rows, else over its greatest, at most one."""
    own = Window.partitionBy(*keys)
    n = F.count("*").over(own)
    place = F.row_number().over(own.orderBy(F.col(value).desc()))
    pivot = F.max(F.when(F.col("_p") == F.when(F.col("_n") > 1000, F.floor(F.col("_n") / 100)).otherwise(1), F.col(value))).over(own)
    scaled = rows.withColumn("_n", n).withColumn("_p", place).withColumn("_top", pivot)
    return scaled.withColumn(out, F.when(F.col("_top") > 0, F.least(F.lit(1.0), F.col(value) / F.col("_top")))).drop("_n", "_p", "_top")


def median_bins(rows: DataFrame, keys: list[str], place: str, *, least: int = 10, dense: float = 0.5) -> DataFrame:
    """(keys, place, first, last): the range around the median that a number is in, null for those outside of it.

    A group of fewer than ``least`` different numbers has no range; one that fills more than
    ``dense`` of its span is one. Else the range reaches from the median as far as neighbours
    are nearer than one more than twice the mean distance between the quartiles; the median
    alone is none.
    """
    own = Window.partitionBy(*keys)
    order = own.orderBy(place)
    each = rows.select(*keys, place).distinct().withColumns({"_n": F.count("*").over(own), "_i": F.row_number().over(order) - 1, "_low": F.min(place).over(own), "_high": F.max(place).over(own), "_gap": F.col(place) - F.lag(place).over(order)})
    quarter = F.floor(F.col("_n") / 4)
    at = lambda i: F.max(F.when(F.col("_i") == i, F.col(place))).over(own)
    limit = 1 + F.floor(2 * (1 + F.col("_q3") - F.col("_q1")) / F.col("_n"))
    each = each.withColumns({"_q1": at(quarter), "_q3": at(3 * quarter)}).withColumn("_far", F.coalesce((F.col("_gap") >= limit).cast("int"), F.lit(0)))
    each = each.withColumn("_run", F.sum("_far").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    each = each.withColumn("_middle", F.max(F.when(F.col("_i") == F.floor(F.col("_n") / 2), F.col("_run"))).over(own))
    run = Window.partitionBy(*keys, "_run")
    each = each.withColumns({"_first": F.min(place).over(run), "_last": F.max(place).over(run)})
    whole = F.col("_n") / (1 + F.col("_high") - F.col("_low")) > dense
    inside = (F.col("_run") == F.col("_middle")) & (F.col("_first") < F.col("_last"))
    bound = lambda a, b: F.when(F.col("_n") >= least, F.when(whole, F.col(a)).when(inside, F.col(b)))
    return each.select(*keys, place, bound("_low", "_first").alias("first"), bound("_high", "_last").alias("last"))
