"""Store access, joins, windows and set operations on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.operators import aggregates, distances, graphs, joins, store, windows
from residuum.operators.durable import dealt, parts_of
from residuum.plans.catalog import query, table


@query("scan_predicates", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_orderkey BETWEEN 100 AND 9000 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')""")  # fmt: skip
def scan_predicates(spark, sf_dir):
    return store.select(table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"], equal={"o_orderstatus": "F"}, between={"o_orderkey": (100, 9000)}, among={"o_orderpriority": ["1-URGENT", "2-HIGH", "5-LOW"]})


@query("keyset_semi_scan", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def keyset_semi_scan(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return store.by_keys(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), keys, ["c_custkey"])


@query("session_anti_insert", "SELECT DISTINCT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def session_anti_insert(spark, sf_dir):
    stored = table(spark, sf_dir, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return store.new_rows(stored, table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"])


@query("upsert_merge", """
    SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_suppkey % 3 <> 0
    UNION ALL SELECT s_suppkey, 'new ' || s_name, s_acctbal + 1 FROM supplier WHERE s_suppkey % 3 = 0
    UNION ALL SELECT s_suppkey + 1000000, s_name, s_acctbal FROM supplier WHERE s_suppkey % 5 = 0""")  # fmt: skip
def upsert_merge(spark, sf_dir):
    stored = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    changed = stored.where("s_suppkey % 3 = 0").select("s_suppkey", F.concat(F.lit("new "), "s_name").alias("s_name"), (F.col("s_acctbal") + 1).alias("s_acctbal"))
    added = stored.where("s_suppkey % 5 = 0").withColumn("s_suppkey", F.col("s_suppkey") + 1000000)
    return store.upserted(stored, changed.unionByName(added), ["s_suppkey"])


@query("update_columns", "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 4 = 0 THEN 0.0 ELSE s_acctbal END AS s_acctbal FROM supplier")
def update_columns(spark, sf_dir):
    stored = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return store.updated(stored, stored.where("s_suppkey % 4 = 0").select("s_suppkey", F.lit(0.0).alias("s_acctbal")), ["s_suppkey"])


@query("delete_where", "SELECT p_partkey, p_size FROM part WHERE NOT (p_size > 40 OR p_brand = 'Brand#12')")
def delete_where(spark, sf_dir):
    return store.removed(table(spark, sf_dir, "part"), (F.col("p_size") > 40) | (F.col("p_brand") == "Brand#12")).select("p_partkey", "p_size")


@query("default_left_join", """
    SELECT p_partkey, coalesce(n, 0) AS n, coalesce(top, p_brand) AS top FROM part LEFT JOIN
      (SELECT l_partkey, count(*) AS n, max(l_returnflag) AS top FROM lineitem WHERE l_quantity > 48 GROUP BY l_partkey) ON p_partkey = l_partkey""")  # fmt: skip
def default_left_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 48").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"), F.max("l_returnflag").alias("top"))
    found = joins.left_with_default(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), lines, ["p_partkey"], {"n": F.lit(0), "top": F.col("p_brand")})
    return found.select("p_partkey", "n", "top")


@query("self_pairs", "SELECT a.s_nationkey, a.s_suppkey, b.s_suppkey AS s_suppkey_b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey")
def self_pairs(spark, sf_dir):
    return joins.pairs_within(table(spark, sf_dir, "supplier"), "s_nationkey", "s_suppkey")


POINTS = "SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings"


def points(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", *(F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")))


@query("grid_contacts", f"""
    WITH p AS ({POINTS}) SELECT a.vec_id, b.vec_id AS vec_id_b, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2), 6) AS distance
    FROM p a JOIN p b ON a.vec_id < b.vec_id AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) <= 0.05""")  # fmt: skip
def grid_contacts(spark, sf_dir):
    p = points(spark, sf_dir)
    return joins.within(p, p, ["x", "y", "z"], 0.05).where("vec_id < vec_id_b").select("vec_id", "vec_id_b", F.round("distance", 6).alias("distance"))


@query("neighborhood_stats", f"""
    WITH p AS ({POINTS}), n AS (SELECT a.vec_id, b.vec_id AS o, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS d, b.x AS v FROM p a JOIN p b ON a.vec_id <> b.vec_id)
    SELECT vec_id, count(*) AS n, round(median(v), 6) AS median, round(sum(v / d) / sum(1 / d), 6) AS weighted FROM n WHERE d <= 0.08 AND d > 0 GROUP BY vec_id""")  # fmt: skip
def neighborhood_stats(spark, sf_dir):
    found = distances.neighbour_stats(points(spark, sf_dir), "vec_id", ["x", "y", "z"], "x", 0.08)
    return found.select("vec_id", "n", F.round("median", 6).alias("median"), F.round("weighted", 6).alias("weighted"))


@query("topk_nearest", f"""
    WITH p AS ({POINTS}), n AS (SELECT a.vec_id, b.vec_id AS other, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS d FROM p a JOIN p b ON a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, other) AS place FROM n WHERE d <= 0.2)
    SELECT vec_id, other, place FROM r WHERE place <= 21""")  # fmt: skip
def topk_nearest(spark, sf_dir):
    near = joins.nearest_within(points(spark, sf_dir), "vec_id", ["x", "y", "z"], 0.2, 21)
    return near.select("vec_id", F.col("vec_id_b").alias("other"), "place")


@query("full_outer_split", """
    WITH a AS (SELECT l_suppkey AS k, max(l_tax) AS v FROM lineitem WHERE l_partkey % 2 = 0 GROUP BY 1), b AS (SELECT l_suppkey AS k, max(l_tax) AS v FROM lineitem WHERE l_partkey % 2 = 1 GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN coalesce(a.v, -1) >= coalesce(b.v, -1) THEN 'left' ELSE 'right' END AS side, CASE WHEN coalesce(a.v, -1) >= coalesce(b.v, -1) THEN a.v ELSE b.v END AS v
    FROM a FULL JOIN b ON a.k = b.k""")  # fmt: skip
def full_outer_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    side = lambda where: lines.where(where).groupBy(F.col("l_suppkey").alias("k")).agg(F.max("l_tax").alias("v"))
    return joins.better_side(side("l_partkey % 2 = 0"), side("l_partkey % 2 = 1"), ["k"], "v")


@query("islands", """
    WITH d AS (SELECT DISTINCT o_custkey // 100 AS g, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS k FROM orders),
    r AS (SELECT g, k, k - row_number() OVER (PARTITION BY g ORDER BY k) AS run FROM d)
    SELECT g, min(k) AS first, max(k) AS last, count(*) AS n FROM r GROUP BY g, run""")  # fmt: skip
def islands(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.floor(F.col("o_custkey") / 100).alias("g"), F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("long").alias("k"))
    return windows.islands(rows, ["g"], "k")


@query("dense_ranges", """
    WITH d AS (SELECT DISTINCT o_custkey // 100 AS g, o_orderkey AS k FROM orders),
    l AS (SELECT g, k, CASE WHEN k - lag(k) OVER (PARTITION BY g ORDER BY k) > 40 THEN 1 ELSE 0 END AS new FROM d),
    r AS (SELECT g, k, sum(new) OVER (PARTITION BY g ORDER BY k) AS run FROM l)
    SELECT g, min(k) AS first, max(k) AS last, count(*) AS n FROM r GROUP BY g, run""")  # fmt: skip
def dense_ranges(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.floor(F.col("o_custkey") / 100).alias("g"), F.col("o_orderkey").alias("k"))
    return windows.dense_ranges(rows, ["g"], "k", gap=40)


@query("fused_ranges", """
    WITH x AS (SELECT l_suppkey AS g, l_orderkey AS a, l_orderkey + CAST(l_quantity AS BIGINT) AS b FROM lineitem),
    m AS (SELECT *, max(b) OVER (PARTITION BY g ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM x),
    r AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM m)
    SELECT g, min(a) AS a, max(b) AS b FROM r GROUP BY g, run""")  # fmt: skip
def fused_ranges(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("g"), F.col("l_orderkey").alias("a"), (F.col("l_orderkey") + F.col("l_quantity").cast("long")).alias("b"))
    return windows.merged_ranges(dealt(rows, parts_of(rows), "g"), ["g"], "a", "b")


@query("flank_window", """
    SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS left_mean,
      round(max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 6) AS right_max FROM events""")  # fmt: skip
def flank_window(spark, sf_dir):
    left, right = windows.flank(["user_id"], "event_id", 3, 0), windows.flank(["user_id"], "event_id", 0, 3)
    return table(spark, sf_dir, "events").select("event_id", F.round(F.avg("value").over(left), 6).alias("left_mean"), F.round(F.max("value").over(right), 6).alias("right_max"))


@query("nonull_bisect", """
    WITH e AS (SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN event_id END AS v FROM events)
    SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
      first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM e""")  # fmt: skip
def nonull_bisect(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_type") == "click", F.col("event_id")).alias("v"))
    return windows.nearest(rows, ["user_id"], "event_id", "v").select("event_id", "before", "after")


@query("p99_scale", """
    WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey % 50 AS g, l_extendedprice AS v, count(*) OVER (PARTITION BY l_suppkey % 50) AS n, row_number() OVER (PARTITION BY l_suppkey % 50 ORDER BY l_extendedprice DESC) AS p FROM lineitem),
    t AS (SELECT g, max(CASE WHEN p = CASE WHEN n > 1000 THEN n // 100 ELSE 1 END THEN v END) AS top FROM r GROUP BY g)
    SELECT g, count(*) AS n, round(sum(least(1.0, v / top)), 4) AS total FROM r JOIN t USING (g) GROUP BY g""")  # fmt: skip
def p99_scale(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).alias("g"), F.col("l_extendedprice").alias("v"))
    return windows.upper_scale(rows, ["g"], "v").groupBy("g").agg(F.count("*").alias("n"), F.round(F.sum("scaled"), 4).alias("total"))


@query("diff_report", """
    WITH a AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
    SELECT o_custkey, round(a.v - b.v, 2) AS difference FROM a JOIN b USING (o_custkey)""")  # fmt: skip
def diff_report(spark, sf_dir):
    total = lambda s: table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == s).groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    from residuum.plans.reports import sorted_differences

    return sorted_differences(joins.differences(total("F"), total("O"), "o_custkey", "v"), "o_custkey").select("o_custkey", F.round("difference", 2).alias("difference"))


@query("set_ops", """
    SELECT k, 'both' AS part FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 5000)
    UNION ALL SELECT k, 'only' FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)""")  # fmt: skip
def set_ops(spark, sf_dir):
    ordered, customers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer")
    both = ordered.intersect(customers.where("c_acctbal > 5000").select(F.col("c_custkey").alias("k")))
    only = customers.select(F.col("c_custkey").alias("k")).subtract(ordered)
    return both.withColumn("part", F.lit("both")).unionByName(only.withColumn("part", F.lit("only")))


@query("degree_distribution", """
    WITH e AS (SELECT DISTINCT l_partkey AS a, l_suppkey + 10000000 AS b FROM lineitem), n AS (SELECT a AS node, b AS t FROM e UNION SELECT b, a FROM e),
    d AS (SELECT node, count(*) AS degree FROM n GROUP BY node) SELECT degree, count(*) AS count FROM d GROUP BY degree""")  # fmt: skip
def degree_distribution(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), (F.col("l_suppkey") + 10000000).alias("b"))
    return graphs.degrees(edges, "a", "b")


EDGES = "SELECT DISTINCT l_partkey AS a, 1000000000 + l_suppkey AS b FROM lineitem"


@query("ego_subgraph", f"""
    WITH e AS ({EDGES}), n AS (SELECT a AS s, b AS t FROM e UNION SELECT b, a FROM e), h1 AS (SELECT DISTINCT t FROM n WHERE s = 7), h2 AS (SELECT DISTINCT t FROM n WHERE s IN (SELECT t FROM h1))
    SELECT node, min(hop) AS hop FROM (SELECT 7 AS node, 0 AS hop UNION ALL SELECT t, 1 FROM h1 UNION ALL SELECT t, 2 FROM h2) GROUP BY node""")  # fmt: skip
def ego_subgraph(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), (1000000000 + F.col("l_suppkey")).alias("b"))
    return graphs.ego(edges, spark.range(7, 8).select(F.col("id").alias("node")), depth=2)


@query("contact_rollup", """
    WITH o AS (SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, l_returnflag AS bond, l_linestatus AS side, count(*) AS n, sum(l_quantity) AS score FROM lineitem WHERE l_partkey <> l_suppkey GROUP BY ALL)
    SELECT * FROM o UNION ALL SELECT a, b, 'combi', 'all', CAST(sum(n) AS BIGINT), sum(score) FROM o GROUP BY a, b""")  # fmt: skip
def contact_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_returnflag").alias("bond"), F.col("l_linestatus").alias("side"), F.col("l_quantity").alias("s"))
    return graphs.contact_rollup(rows, "a", "b", ["bond", "side"], "s", parts=parts_of(rows))


@query("gene_edges", """
    WITH e AS (SELECT least(l_partkey, l_suppkey) AS gene_a, greatest(l_partkey, l_suppkey) AS gene_b, round(l_tax * 100) - 2 AS score, l_quantity AS w, 51 - l_quantity AS d FROM lineitem WHERE l_partkey <> l_suppkey),
    r AS (SELECT gene_a, gene_b, greatest(0, sum(score * w) / sum(w)) AS wt, greatest(0, sum(score * d) / sum(d)) AS disease FROM e GROUP BY ALL),
    k AS (SELECT *, CASE WHEN greatest(wt, disease) > 0 THEN (disease - wt) / greatest(wt, disease) ELSE 0 END AS change FROM r)
    SELECT gene_a, gene_b, floor(wt * 10000 + 0.5) / 10000 AS wt, floor(disease * 10000 + 0.5) / 10000 AS disease, floor(change * 10000 + 0.5) / 10000 + 0.0 AS change,
      CASE WHEN wt > 0 AND disease = 0 THEN 'lost' WHEN wt = 0 AND disease > 0 THEN 'new' WHEN change < 0 THEN 'worse' ELSE 'kept' END AS kind FROM k""")  # fmt: skip
def gene_edges(spark, sf_dir):
    """Scores in hundredths: sums of whole numbers are exact, so that rounding is the same in any order."""
    from residuum.plans.reports import gene_network

    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("gene_a"), F.col("l_suppkey").alias("gene_b"), (F.round(F.col("l_tax") * 100) - 2).alias("score"), F.col("l_quantity").alias("w"), (51 - F.col("l_quantity")).alias("d"))
    rounded = lambda x: F.floor(F.col(x) * 10000 + 0.5) / 10000
    return gene_network(rows, "w", "d").select("gene_a", "gene_b", rounded("wt").alias("wt"), rounded("disease").alias("disease"), (rounded("change") + F.lit(0.0)).alias("change"), "kind")


@query("expr_weighted_score", """
    WITH p AS (SELECT l_partkey % 100 AS gene, l_suppkey AS isoform_b, l_tax AS score, greatest(l_quantity - 20, 0) * greatest(l_linenumber - 2, 0) AS shift FROM lineitem)
    SELECT gene, round(CASE WHEN sum(shift) > 0 THEN sum(score * shift) / sum(shift) ELSE 0 END, 6) AS score, round(max(score * shift), 6) AS contribution FROM p GROUP BY gene""")  # fmt: skip
def expr_weighted_score(spark, sf_dir):
    from residuum.plans.reports import gene_isoform_scores

    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 100).alias("gene"), F.lit(0).alias("isoform_a"), F.col("l_suppkey").alias("isoform_b"), F.col("l_tax").alias("score"), F.col("l_quantity").alias("wt_a"), F.lit(20.0).alias("dis_a"), F.lit(2.0).alias("wt_b"), F.col("l_linenumber").cast("double").alias("dis_b"))
    return gene_isoform_scores(rows).select("gene", F.round("score", 6).alias("score"), F.round("contribution", 6).alias("contribution"))


@query("large_structures", "SELECT o_custkey AS complex_id, count(*) AS chains FROM orders GROUP BY o_custkey HAVING count(*) > 15")
def large_structures(spark, sf_dir):
    from residuum.plans.reports import large_structures as report

    return report(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("complex_id")), 15)


@query("betweenness")
def betweenness(spark, sf_dir):
    """Line numbers and quantities of each supplier as a graph of two sides; its size is bounded, however many line items there are."""
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("structure"), F.col("l_linenumber").cast("long").alias("a"), (F.col("l_quantity") + 100).cast("long").alias("b"), F.col("l_tax").alias("score"))
    return graphs.betweenness(edges, "structure")


@query("average_rank", """
    SELECT c_nationkey, c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY floor(c_acctbal / 1000) DESC) + (count(*) OVER (PARTITION BY c_nationkey, floor(c_acctbal / 1000)) - 1) / 2.0 AS rank FROM customer""")  # fmt: skip
def average_rank(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.floor(F.col("c_acctbal") / 1000).alias("v"))
    return aggregates.average_rank(rows, ["c_nationkey"], "v").select("c_nationkey", "c_custkey", "rank")
