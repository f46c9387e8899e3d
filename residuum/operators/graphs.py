"""Graphs as edge tables: roll-ups, neighbourhoods, degrees, centrality."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from residuum.operators.durable import dealt


#: Nodes up to which a network is gone through from all of its nodes at once, in tables of all pairs.
DENSE = 256


def contact_rollup(contacts: DataFrame, a: str, b: str, types: list[str], score: str, *, parts: int | None = None) -> DataFrame:
    """Atom contacts as residue contacts: number and score for each pair and type, and, as type
    ``combi``, for each pair; loops left out. ``parts``: tasks to deal the contacts out to."""
    pairs = contacts.where(F.col(a) != F.col(b)).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b), *types, score)
    own = (dealt(pairs, parts, a, b) if parts else pairs).groupBy(a, b, *types).agg(F.count("*").alias("n"), F.sum(score).alias("score"))
    every = own.groupBy(a, b).agg(F.sum("n").alias("n"), F.sum("score").alias("score")).select(a, b, *(F.lit("combi" if i == 0 else "all").alias(t) for i, t in enumerate(types)), "n", "score")
    return own.unionByName(every)


def degrees(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Number of nodes for each degree."""
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("to")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("to"))).distinct()
    return both.groupBy("node").agg(F.count("*").alias("degree")).groupBy("degree").agg(F.count("*").alias("count"))


def ego(edges: DataFrame, start: DataFrame, *, depth: int = 2, a: str = "a", b: str = "b") -> DataFrame:
    """(node, hop) of all nodes no more than ``depth`` edges from the start nodes (column ``node``)."""
    both = edges.select(F.col(a).alias("s"), F.col(b).alias("t")).unionByName(edges.select(F.col(b).alias("s"), F.col(a).alias("t"))).distinct()
    seen = start.select("node").distinct().withColumn("hop", F.lit(0))
    front = seen
    for hop in range(1, depth + 1):
        reached = front.join(both, front["node"] == both["s"]).select(F.col("t").alias("node")).distinct()
        front = reached.join(seen, "node", "left_anti").withColumn("hop", F.lit(hop))
        seen = seen.unionByName(front)
    return seen


def not_connected(nodes: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    ends = edges.select(F.col(a).alias("node")).unionByName(edges.select(F.col(b).alias("node")))
    return nodes.join(ends, "node", "left_anti")


def changed_edges(before: DataFrame, after: DataFrame, a: str, b: str, score: str, *, least: float = 0.2) -> DataFrame:
    """Edges of two networks over the same nodes: lost, new, changed by more than ``least``, or common."""
    x, y = before.select(a, b, F.col(score).alias("before")), after.select(a, b, F.col(score).alias("after"))
    kind = F.when(F.col("after").isNull(), "lost").when(F.col("before").isNull(), "new").when(F.abs(F.col("after") - F.col("before")) > least, "changed").otherwise("common")
    return x.join(y, [a, b], "full").withColumn("kind", kind)


def alignment_places(alignments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, position, letter, position_b, letter_b) of each column of two aligned sequences (keys, target, template), counted from 1; null for a gap."""
    columns = F.posexplode(F.arrays_zip(F.split("target", "").alias("a"), F.split("template", "").alias("b"))).alias("i", "x")
    rows = alignments.select(*keys, columns).where("x.a <> '' OR x.b <> ''")
    order = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    place = lambda c: F.when(F.col(c) != "-", F.sum((F.col(c) != "-").cast("int")).over(order).cast("int"))
    letter = lambda c: F.when(F.col(c) != "-", F.col(c))
    return rows.select(*keys, place("x.a").alias("position"), letter("x.a").alias("letter"), place("x.b").alias("position_b"), letter("x.b").alias("letter_b"))


def superimposed(before: DataFrame, after: DataFrame, places: DataFrame, keys: list[str], *, least: float = 0.2) -> DataFrame:
    """Edges (keys, chain, residue, node, score) between residues of partner chains and positions of two aligned proteins, put over each other.

    ``places`` are the columns of the alignment (``alignment_places``). Returns (keys, chain,
    residue, node, before, after, weight, kind): ``node`` names both positions (12A/13G, 12A
    where they are the same, 12A/- or -/13G beside a gap), and kind is lost, new, changed (by
    more than ``least`` of the greatest score before) or common; weights are in shares of the
    greatest score of the network that the edge is in, the earlier one if in both.
    """
    node = [*keys, "position", "position_b"]
    text = lambda p, a: F.concat(F.col(p).cast("string"), F.col(a))
    same = (F.col("position") == F.col("position_b")) & (F.col("letter") == F.col("letter_b"))
    name = F.when(same, text("position", "letter")).otherwise(F.concat(F.coalesce(text("position", "letter"), F.lit("-")), F.lit("/"), F.coalesce(text("position_b", "letter_b"), F.lit("-"))))
    named = places.select(*node, name.alias("node"))
    top = lambda rows, c: rows.groupBy(*keys).agg(F.max("score").alias(c))
    x = before.join(named.where("position IS NOT NULL"), [*keys, "position"]).select(*keys, "chain", "residue", "node", F.col("score").alias("before"))
    y = after.withColumnRenamed("position", "position_b").join(named.where("position_b IS NOT NULL"), [*keys, "position_b"]).select(*keys, "chain", "residue", "node", F.col("score").alias("after"))
    joined = x.join(y, [*keys, "chain", "residue", "node"], "full").join(top(before, "_x"), keys, "left").join(top(after, "_y"), keys, "left")
    kind = F.when(F.col("after").isNull(), "lost").when(F.col("before").isNull(), "new").when(F.abs(F.col("after") / F.col("_x") - F.col("before") / F.col("_x")) > least, "changed").otherwise("common")
    weight = 5 * (0.1 + F.coalesce(F.col("before") / F.col("_x"), F.col("after") / F.col("_y")))
    return joined.select(*keys, "chain", "residue", "node", "before", "after", weight.alias("weight"), kind.alias("kind"))


def betweenness(edges: DataFrame, group: str, *, a: str = "a", b: str = "b", score: str = "score", with_negative: bool = False) -> DataFrame:
    """(group, node, betweenness): weighted betweenness within each group, a structure or a chain of one.

    Rows of one pair of nodes are one edge, of their greatest score. It is as long as one over
    its score; one of no positive score is no way, unless ``with_negative``, where the amount
    counts. Edges are made distinct before they are grouped, so a task gets one structure's
    contact network, however many rows told of it; that is bounded by the structure's residues.
    """
    value = F.abs(score) if with_negative else F.col(score)
    edges = edges.where(F.col(a) != F.col(b)).groupBy(group, F.least(a, b).alias(a), F.greatest(a, b).alias(b)).agg(F.max(value).alias(score))
    schema = T.StructType([T.StructField(group, edges.schema[group].dataType), T.StructField("node", edges.schema[a].dataType), T.StructField("betweenness", T.DoubleType())])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        near: dict = {}
        for u, v, s in pdf[[a, b, score]].itertuples(index=False):
            one, other = near.setdefault(u, {}), near.setdefault(v, {})
            if s and s > 0:
                one[v] = other[u] = 1.0 / s
        if len(near) <= DENSE:
            found = _all_dependencies(near)
        else:
            found = dict.fromkeys(near, 0.0)
            for source in near:
                for node, share in _dependency(near, source).items():
                    found[node] += share / 2
        return pd.DataFrame({group: [key[0]] * len(found), "node": list(found), "betweenness": list(found.values())})

    return edges.groupBy(group).applyInPandas(run, schema)


def _dependency(near: dict, source) -> dict:
    """How much of the shortest paths from ``source`` passes each other node."""
    far, paths, parents, done, order = {source: 0.0}, {source: 1.0}, {source: []}, set(), []
    heap, tick = [(0.0, 0, source)], 0
    while heap:
        d, _, u = heapq.heappop(heap)
        if u in done:
            continue
        done.add(u)
        order.append(u)
        for v, length in near[u].items():
            new = d + length
            old = far.get(v)
            if old is None or new < old - 1e-12:
                far[v], paths[v], parents[v] = new, paths[u], [u]
                tick += 1
                heapq.heappush(heap, (new, tick, v))
            elif v not in done and abs(new - old) <= 1e-12:
                paths[v] += paths[u]
                parents[v].append(u)
    share = dict.fromkeys(order, 0.0)
    for v in reversed(order):
        for u in parents[v]:
            share[u] += paths[u] / paths[v] * (1 + share[v])
    share.pop(source)
    return share


def _all_dependencies(near: dict) -> dict:
    """Half of the sum of ``_dependency`` over all sources, a step for the next node of every source at once."""
    n, number = len(near), {u: i for i, u in enumerate(near)}
    length = np.full((n, n), np.inf)
    for u, row in near.items():
        for v, x in row.items():
            length[number[u], number[v]] = x
    far = length.copy()
    np.fill_diagonal(far, 0.0)
    for k in range(n):
        np.minimum(far, far[:, k, None] + far[k], out=far)
    order, each = np.argsort(far, axis=1, kind="stable"), np.arange(n)
    rank = np.empty_like(order)
    rank[each[:, None], order] = each
    paths, share = np.eye(n), np.zeros((n, n))
    parents = []
    for i in range(1, n):
        v = order[:, i]
        end = far[each, v, None]
        with np.errstate(invalid="ignore"):  # what is not reached is no end of a path
            before = (np.abs(far + length[v] - end) <= 1e-12) & (rank < i)
        paths[each, v] = (paths * before).sum(axis=1)
        parents.append(before)
    for i in range(n - 1, 0, -1):
        v = order[:, i]
        own = paths[each, v]
        share += paths * parents[i - 1] * np.divide(1 + share[each, v], own, out=np.zeros(n), where=own > 0)[:, None]
    np.fill_diagonal(share, 0.0)
    return dict(zip(near, (share.sum(axis=0) / 2).tolist()))


def normalized(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Centralities by the number of pairs of other nodes and by the range of the group, one where
    it has none; all null where the greatest is zero."""
    from pyspark.sql.window import Window

    own = Window.partitionBy(group)
    n, low, high = F.count("*").over(own), F.min(value).over(own), F.max(value).over(own)
    pairs = (n - 1) * (n - 2) / 2
    return rows.withColumns({
        "by_length": F.when((high > 0) & (pairs > 0), F.col(value) / pairs),
        "by_range": F.when(high > low, (F.col(value) - low) / (high - low)).when(high > 0, F.lit(1.0)),
    })
