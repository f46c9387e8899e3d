"""Checksums, chain groups, recommendation texts and bins, on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.functions import sequences
from residuum.operators import windows
from residuum.plans.catalog import query, table

c = F.col


@query("checksums", """
    WITH b AS (SELECT p_partkey, list_transform(string_split(p_name || p_type, ''), lambda x: CAST(ascii(x) AS BIGINT)) AS d FROM part)
    SELECT p_partkey, ((len(d) + list_sum(list_transform(d, lambda x, i: (len(d) - i + 1) * x))) % 65521) * 65536 + (1 + list_sum(d)) % 65521 AS checksum FROM b""")  # fmt: skip
def checksums(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", sequences.adler32(F.concat("p_name", "p_type")).alias("checksum"))


@query("homomers", """
    WITH g AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN ['AB', 'C'] WHEN 1 THEN ['DEF'] ELSE ['G', 'HI'] END AS gs FROM orders), e AS (SELECT o_orderkey, array_to_string(gs, ',') AS text, unnest(gs) AS g FROM g)
    SELECT o_orderkey, text, chain, g AS chains FROM (SELECT *, unnest(string_split(g, '')) AS chain FROM e)""")  # fmt: skip
def homomers(spark, sf_dir):
    k = c("o_orderkey") % 3
    rows = table(spark, sf_dir, "orders").select("o_orderkey", sequences.homomers(F.when(k == 0, "AB,C").when(k == 1, "DEF").otherwise("G,HI")).alias("p"))
    return rows.select("o_orderkey", sequences.homomer_text("p").alias("text"), F.explode("p").alias("x")).select("o_orderkey", "text", "x.chain", F.array_join("x.chains", "").alias("chains"))


@query("recommendation_texts", """
    SELECT l_orderkey, l_linenumber, l_partkey, 's' || l_suppkey || ':A ' || l_partkey || ':' || l_returnflag || ';' || format('{:.2f}', l_quantity / 50 + 0.001) || ';' || CASE WHEN l_linestatus = 'O' THEN '-' ELSE format('{:.2f}', l_quantity / 100 + 0.001) END || ';' || format('{:.1f}', l_tax * 10 + 0.01) AS text FROM lineitem""")  # fmt: skip
def recommendation_texts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    structure, residue = F.concat(F.lit("s"), c("l_suppkey").cast("string"), F.lit(":A")), F.concat(c("l_partkey").cast("string"), F.lit(":"), "l_returnflag")
    coverage = F.when(c("l_linestatus") != "O", c("l_quantity") / 100 + 0.001)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", sequences.recommendation_text(structure, residue, c("l_quantity") / 50 + 0.001, coverage, c("l_tax") * 10 + 0.01).alias("text"))


@query("median_bins", """
    WITH d AS (SELECT DISTINCT l_suppkey AS g, CAST(floor(l_extendedprice / 500) AS BIGINT) AS v FROM lineitem),
    o AS (SELECT *, count(*) OVER (PARTITION BY g) AS n, row_number() OVER (PARTITION BY g ORDER BY v) - 1 AS i, v - lag(v) OVER (PARTITION BY g ORDER BY v) AS gap FROM d),
    q AS (SELECT g, any_value(n) AS n, min(v) AS lo, max(v) AS hi, max(v) FILTER (i = n // 4) AS q1, max(v) FILTER (i = 3 * (n // 4)) AS q3 FROM o GROUP BY g),
    r AS (SELECT o.*, lo, hi, sum(CASE WHEN gap >= 1 + (2 * (1 + q3 - q1)) // q.n THEN 1 ELSE 0 END) OVER (PARTITION BY o.g ORDER BY v ROWS UNBOUNDED PRECEDING) AS run FROM o JOIN q ON q.g = o.g),
    m AS (SELECT g, run FROM r WHERE i = n // 2), b AS (SELECT r.g, min(v) AS first, max(v) AS last FROM r JOIN m ON m.g = r.g AND m.run = r.run GROUP BY r.g)
    SELECT r.g, v, CASE WHEN n >= 10 THEN CASE WHEN n / (1 + hi - lo) > 0.5 THEN lo WHEN v BETWEEN first AND last AND first < last THEN first END END AS first,
      CASE WHEN n >= 10 THEN CASE WHEN n / (1 + hi - lo) > 0.5 THEN hi WHEN v BETWEEN first AND last AND first < last THEN last END END AS last FROM r JOIN b ON b.g = r.g""")  # fmt: skip
def median_bins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("g"), F.floor(c("l_extendedprice") / 500).alias("v"))
    return windows.median_bins(rows, ["g"], "v")
