"""Joins that recur: with defaults, against the store, in space, over undirected edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from residuum.operators.durable import cut


def left_with_default(left: DataFrame, right: DataFrame, on: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Left join where missing columns of the right side take a default."""
    joined = left.join(right, on, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), value) for name, value in defaults.items()})


def within(a: DataFrame, b: DataFrame, coordinates: list[str], distance: float, *, keys: list[str] | None = None) -> DataFrame:
    """Pairs of rows no farther apart than ``distance``; columns of b get ``_b`` behind.

    Space is cut into cubes of that side: rows of b go to their cube, rows of a ask theirs
    and the neighbours, so the join is on equal cubes, and exact distances decide.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(float(distance))).cast("long")
    near = a
    for i, c in enumerate(coordinates):
        near = near.withColumn(f"_c{i}", F.explode(F.array(*(cell(c) + d for d in (-1, 0, 1)))))
    other = b.select(*(F.col(c).alias(f"{c}_b") for c in b.columns), *(cell(c).alias(f"_c{i}") for i, c in enumerate(coordinates)))
    on = [F.col(f"x._c{i}") == F.col(f"y._c{i}") for i in range(len(coordinates))] + [F.col(f"x.{k}") == F.col(f"y.{k}_b") for k in keys or []]
    joined = near.alias("x").join(other.alias("y"), on)
    d = F.sqrt(sum(((F.col(f"x.{c}") - F.col(f"y.{c}_b")) ** 2 for c in coordinates), F.lit(0.0)))
    return joined.select(*(F.col(f"x.{c}") for c in a.columns), *(F.col(f"y.{c}_b") for c in b.columns), d.alias("distance")).where(F.col("distance") <= distance)


def nearest_within(rows: DataFrame, key: str, coordinates: list[str], distance: float, k: int, out: str = "place") -> DataFrame:
    """(key, key_b, distance, place): the ``k`` nearest other rows of each row, none farther apart than ``distance``; of ties the lesser key.

    Rounds over cubes of growing sides: the first side is such that a cube has about 2 k rows
    with another one, and each round doubles it. A row with k others within the side has its
    nearest ones for certain; only rows without go on, up to ``distance``. So a row meets
    about as many others however dense space is. Of rows at one place only the k + 1 of the
    least keys can be among the nearest of any row, so that copies are no group of pairs.
    """
    rows = rows.select(key, *coordinates).dropna(subset=coordinates)
    last = Window.partitionBy(*coordinates).orderBy(key)
    other = cut(rows.withColumn("_i", F.row_number().over(last)).where(F.col("_i") <= k + 1).drop("_i"))
    sides = [float(distance) / 2**i for i in range(16)]
    cubes = lambda side: other.groupBy(*(F.floor(F.col(c) / F.lit(side)) for c in coordinates)).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0]
    start = next((i for i, side in enumerate(sides) if (cubes(side) or 0) <= 2 * k), len(sides) - 1)
    left, found = rows, None
    for side in reversed(sides[: start + 1]):
        near = within(left, other, coordinates, side).where(F.col(key) != F.col(f"{key}_b")).select(key, f"{key}_b", "distance")
        ranked = near.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy("distance", f"{key}_b"))).where(F.col(out) <= k)
        if side == sides[0]:
            return ranked if found is None else found.unionByName(ranked)
        ranked = cut(ranked)
        done = ranked.where(F.col(out) == k).select(key)
        own = ranked.join(done, key, "left_semi")
        found = own if found is None else found.unionByName(own)
        left = cut(left.join(done, key, "left_anti"))


def undirected(edges: DataFrame, a: str, b: str, *aggregates: Column) -> DataFrame:
    """One row for an edge and its reverse, with aggregates over both."""
    return edges.groupBy(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).agg(*(aggregates or (F.count("*").alias("n"),)))


def both_ways(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges and their reverses; a loop stays one row."""
    swapped = edges.where(F.col(a) != F.col(b)).select(*(F.col(b).alias(a) if c == a else F.col(a).alias(b) if c == b else F.col(c) for c in edges.columns))
    return edges.unionByName(swapped)


def better_side(left: DataFrame, right: DataFrame, key: list[str], value: str) -> DataFrame:
    """Full outer join that gives each key to the side with the greater value; the left wins ties."""
    x, y = left.select(*key, F.col(value).alias("_l")), right.select(*key, F.col(value).alias("_r"))
    joined = x.join(y, key, "full")
    wins = F.coalesce("_l", F.lit(-1.0)) >= F.coalesce("_r", F.lit(-1.0))
    return joined.select(*key, F.when(wins, "left").otherwise("right").alias("side"), F.when(wins, F.col("_l")).otherwise(F.col("_r")).alias(value))


def differences(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Difference of a value for the keys that both sides have."""
    return a.select(key, F.col(value).alias("_a")).join(b.select(key, F.col(value).alias("_b")), key).select(key, (F.col("_a") - F.col("_b")).alias("difference"))


def pairs_within(rows: DataFrame, group: str, item: str) -> DataFrame:
    """Ordered pairs of different items of a group: (group, item, item_b)."""
    other = rows.select(F.col(group).alias("_g"), F.col(item).alias(f"{item}_b"))
    return rows.select(group, item).join(other, (F.col(group) == F.col("_g")) & (F.col(item) != F.col(f"{item}_b"))).drop("_g")


def first_taken(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key, the first in ``order``."""
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_x")).select(key, "_x.*")
