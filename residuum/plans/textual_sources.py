"""Texts of tools and databases, made from the supplied tables and parsed again."""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.plans.catalog import query, table
from residuum.sources import features

c = F.col
AA = "ACDEFGHIKLMNPQRSTVWYXa"


@query("accessibility_table", f"""
    WITH a(aa, most) AS (VALUES {', '.join(f"('{k}', {v}::DOUBLE)" for k, v in features.MAX_AREA.items())}), o AS (SELECT o_orderkey AS file, '{AA}'[o_custkey % 22 + 1:o_custkey % 22 + 1] AS x, o_custkey % 1000 AS res, CAST(floor(o_totalprice) AS BIGINT) % 200 AS q, o_orderstatus AS ch FROM orders)
    SELECT file, ch AS chain, CAST(res AS VARCHAR) AS residue, aa, CASE WHEN q % 2 = 0 THEN 'H' ELSE 'E' END AS secondary, round(q / most, 6) AS rsa, round((q // 2) / most, 6) AS main_chain, CASE WHEN q % 2 = 0 THEN q - 90.5::DOUBLE END AS phi
    FROM o JOIN a ON aa = CASE x WHEN 'a' THEN 'C' ELSE x END""")  # fmt: skip
def accessibility_table(spark, sf_dir):
    """A file for each order, with a line before the table that looks like a row of it."""
    o = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("file"), F.substring(F.lit(AA), (c("o_custkey") % 22 + 1).cast("int"), F.lit(1)).alias("x"), (c("o_custkey") % 1000).cast("string").alias("res"), (F.floor("o_totalprice") % 200).alias("q"), c("o_orderstatus").alias("ch"))
    area = lambda v: F.lpad(v.cast("string"), 4, " ")
    even = c("q") % 2 == 0
    front = F.rpad(F.concat(F.lit("     "), F.lpad("res", 5, " "), F.lit(" "), "ch", F.lit(" "), "x", F.lit("  "), F.when(even, "H").otherwise("E")), 34, " ")
    row = F.concat(front, area(c("q")), area(F.floor(c("q") / 2)), area(c("q")))
    angles = F.concat(F.rpad(row, 111, " "), F.lpad(F.format_string("%.1f", c("q") - F.lit(90.5)), 6, " "), F.lit("  45.0 "))
    texts = F.array(row, F.lit("  #  RESIDUE AA STRUCTURE"), F.when(even, angles).otherwise(row), F.lit("short"))
    lines = o.select("file", F.posexplode(texts).alias("line", "value"))
    found = features.parse_accessibility(lines, ["file"])
    return found.select("file", "chain", "residue", "aa", "secondary", F.round("rsa", 6).alias("rsa"), F.round("main_chain", 6).alias("main_chain"), "phi")


@query("coordinate_headers", """
    WITH x AS (SELECT s_suppkey AS file, CAST(s_suppkey % 900 AS VARCHAR) AS a, CAST(s_nationkey AS VARCHAR) AS b, s_suppkey % 4 AS k, 2 + (s_suppkey % 50) / 100 AS v FROM supplier),
    f AS (SELECT file, CASE k WHEN 0 THEN 'ssbond' WHEN 1 THEN 'link' WHEN 2 THEN 'cis' ELSE 'mod' END AS kind, a, b, v FROM x)
    SELECT file, kind, 'A' AS chain, a AS residue, 'CYS' AS name, 'B' AS chain_b, b AS residue_b, CASE kind WHEN 'link' THEN 'ZN' ELSE 'ALA' END AS name_b, round(v, 2) AS value FROM f WHERE kind <> 'mod'
    UNION ALL SELECT file, CASE kind WHEN 'cis' THEN 'cis_follower' ELSE kind END, 'B', b, CASE kind WHEN 'link' THEN 'ZN' ELSE 'ALA' END, 'A', a, 'CYS', round(v, 2) FROM f WHERE kind <> 'mod'
    UNION ALL SELECT file, 'modified', 'A', a, 'MET', NULL, NULL, NULL, NULL FROM f WHERE kind = 'mod'""")  # fmt: skip
def coordinate_headers(spark, sf_dir):
    k, pad = c("s_suppkey") % 4, lambda v, n: F.lpad(v.cast("string"), n, " ")
    a, b, v = pad(c("s_suppkey") % 900, 4), pad(c("s_nationkey"), 4), F.format_string("%5.2f", 2 + (c("s_suppkey") % 50) / 100)
    bond = F.concat(F.rpad(F.concat(F.lit("SSBOND   1 CYS A "), a, F.lit("    ALA B "), b), 73, " "), v)
    link = lambda alt: F.concat(F.rpad(F.concat(F.lit("LINK         SG "), F.lit(alt), F.lit("CYS A"), a, F.lit("                ZN   ZN  B"), b), 73, " "), v)
    cis = F.concat(F.rpad(F.concat(F.lit("CISPEP   1 CYS A "), a, F.lit("    ALA B "), b), 53, " "), F.lit(" "), v)
    modified = F.concat(F.lit("MODRES 1ABC MSE A "), a, F.lit("  MET  SELENOMETHIONINE"))
    texts = F.when(k == 0, F.array(bond)).when(k == 1, F.array(link("B"), link("A"))).when(k == 2, F.array(cis)).otherwise(F.array(modified))
    lines = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("file"), F.posexplode(texts).alias("line", "value"))
    bonds = features.parse_bonds(lines, ["file"]).select("file", "kind", "chain", "residue", "name", "chain_b", "residue_b", "name_b", "value")
    return bonds.unionByName(features.parse_modified(lines, ["file"]).withColumn("kind", F.lit("modified")), allowMissingColumns=True)


@query("near_boxes", """
    WITH a AS (SELECT vec_id // 25 AS s, chr(CAST(65 + vec_id % 5 AS INTEGER)) AS ch, embedding[1] * 60::DOUBLE AS x, embedding[2] * 60::DOUBLE AS y, embedding[3] * 60::DOUBLE AS z FROM embeddings),
    b AS (SELECT s, ch, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, min(z) AS lz, max(z) AS hz FROM a GROUP BY ALL)
    SELECT p.s AS structure, p.ch AS chain, q.ch AS chain_b FROM b p JOIN b q ON p.s = q.s AND p.ch < q.ch AND greatest(p.lx, q.lx) <= least(p.hx, q.hx) + 1 AND greatest(p.ly, q.ly) <= least(p.hy, q.hy) + 1 AND greatest(p.lz, q.lz) <= least(p.hz, q.hz) + 1""")  # fmt: skip
def near_boxes(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    atoms = v.select(F.floor(c("vec_id") / 25).alias("structure"), F.char(65 + c("vec_id") % 5).alias("chain"), *((F.get("embedding", F.lit(i)).cast("double") * 60).alias(x) for i, x in enumerate("xyz")))
    return features.near_boxes(features.boxes(atoms, ["structure"]), ["structure"], apart=1.0)


@query("pocket_hits", """
    SELECT 's' || l_suppkey AS query, CAST(l_orderkey AS VARCHAR) AS query_pos, CASE WHEN l_returnflag = 'A' THEN 'gap' ELSE l_linestatus END AS hit_chain, CASE WHEN l_returnflag = 'A' THEN 'gap' ELSE CAST(l_partkey AS VARCHAR) END AS hit_pos, l_tax AS site_identity, l_quantity AS identity FROM lineitem""")  # fmt: skip
def pocket_hits(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    front = F.concat_ws(" ", F.concat(F.lit("s"), c("l_suppkey").cast("string")), F.lit("A"), "l_linestatus", c("l_orderkey").cast("string"), F.lit("1abc\tG"))
    text = F.concat_ws("  ", front, F.when(c("l_returnflag") != "A", F.concat_ws(" ", "l_linestatus", c("l_partkey").cast("string"))), c("l_tax").cast("string"), F.lit("1.5 2.5 7 0.5"), c("l_quantity").cast("string"))
    header = i.select(F.lit("query aa chain pos hit aa chain pos site_id bb all n lddt id").alias("value")).limit(1)
    found = features.parse_pockets(i.select(text.alias("value")).unionByName(header))
    return found.select("query", "query_pos", "hit_chain", "hit_pos", "site_identity", "identity")


@query("disorder_regions", """
    SELECT 'P' || o_orderkey AS accession, CAST(1 + o_custkey % 10 AS INTEGER) AS first, CAST(20 + o_custkey % 10 AS INTEGER) AS last, o_orderstatus AS kind, 2 AS n_scores, (o_custkey % 10) / 10 AS score FROM orders WHERE o_orderkey % 3 > 0""")  # fmt: skip
def disorder_regions(spark, sf_dir):
    k = c("o_custkey") % 10
    entry = F.format_string('{"acc": "P%d", "x": 1, "mobidb_consensus": {"disorder": {"predictors": [{"method": "other", "scores": [1], "regions": []}, {"method": "%s", "scores": [%s, 0.5], "regions": [["%d", "%d", "%s"]]}]}}}', "o_orderkey", F.when(c("o_orderkey") % 3 > 0, "mobidb-lite").otherwise("another"), (k / 10).cast("string"), 1 + k, 20 + k, "o_orderstatus")
    orders = table(spark, sf_dir, "orders")
    lines = orders.select(entry.alias("value")).unionByName(orders.select(F.lit("no json").alias("value")).limit(1))
    found = features.parse_disorder(lines)
    return found.select("accession", F.explode("regions").alias("r"), F.size("scores").alias("n_scores"), F.get("scores", F.lit(0)).alias("score")).select("accession", "r.*", "n_scores", "score")


@query("ligand_dictionary", """
    WITH s AS (SELECT p_type || p_size AS name, max(p_name) AS smiles FROM part WHERE p_partkey % 3 > 0 GROUP BY 1), i AS (SELECT p_type || p_size AS name, max(p_brand) AS inchi FROM part WHERE p_partkey % 3 < 2 GROUP BY 1)
    SELECT name, smiles, inchi FROM s FULL JOIN i USING (name)""")  # fmt: skip
def ligand_dictionary(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    line = lambda x: F.concat(x, F.lit("\t"), F.concat("p_type", c("p_size").cast("string"))).alias("value")
    return features.ligands(part.where("p_partkey % 3 > 0").select(line("p_name")), part.where("p_partkey % 3 < 2").select(line("p_brand")))


@query("sequence_records", """
    SELECT 'P' || p_partkey AS accession, replace(upper(p_name), ' ', '') || 'AAA' AS sequence FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 'Q' || p_partkey, 'GGG' FROM part WHERE p_partkey % 2 = 1""")  # fmt: skip
def sequence_records(spark, sf_dir):
    k = c("p_partkey").cast("string")
    text = F.when(c("p_partkey") % 2 == 0, F.concat(F.lit("sp|P"), k, F.lit("|NAME of\r\n"), F.upper("p_name"), F.lit("\r\nAAA\n"))).otherwise(F.concat(F.lit(">Q"), k, F.lit(" text\nGGG")))
    return features.parse_sequences(table(spark, sf_dir, "part").select(text.alias("value")))


@query("header_changes", """
    SELECT p_partkey, 'A' || p_size || 'G' AS change, CASE WHEN p_size % 2 = 0 THEN 't' || p_size || '|x' ELSE '' END AS tags FROM part UNION ALL SELECT p_partkey, 'C' || (p_size + 1) || 'del', '' FROM part WHERE p_size % 3 = 0""")  # fmt: skip
def header_changes(spark, sf_dir):
    n = c("p_size").cast("string")
    head = F.concat(F.lit("id"), c("p_partkey").cast("string"), F.lit(" A"), n, F.lit("G"), F.when(c("p_size") % 2 == 0, F.concat(F.lit("<t"), n, F.lit(",x"))).otherwise(""), F.when(c("p_size") % 3 == 0, F.concat(F.lit(";C"), (c("p_size") + 1).cast("string"), F.lit("del"))).otherwise(""), F.lit(" words"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.explode(features.header_changes(head)).alias("x"))
    return rows.select("p_partkey", "x.change", F.array_join("x.tags", "|").alias("tags"))
