"""The reports in full, chains of identifiers and predicates of structures, on the supplied tables.

A protein is a customer, a position one of its orders, a structure a supplier.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.functions import scores, sequences
from residuum.operators import identifiers, indels
from residuum.operators.durable import dealt, parts_of
from residuum.plans import regions, reports
from residuum.plans.catalog import query, table
from residuum.sources import writers

c = F.col
AA = "ACDEFGHIKLMNPQRSTVWYX"


def letter(x):
    return F.substring(F.lit(AA), (x % 21 + 1).cast("int"), F.lit(1))


def proteins(spark, sf_dir):
    k = c("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("protein_id"), F.when(k % 3 == 0, c("c_name")).alias("input_id"), F.concat(F.lit("P"), k.cast("string")).alias("primary_id"), F.concat(F.lit("U"), k.cast("string")).alias("uniprot_ac"), c("c_mktsegment").alias("uniprot_id"), F.when(k % 2 == 0, F.lit("NP")).alias("refseq"))


def positions(spark, sf_dir):
    o = c("o_orderkey")
    return table(spark, sf_dir, "orders").select(o.alias("position_id"), c("o_custkey").alias("protein_id"), (o % 500).alias("position_number"), F.when(o % 5 == 0, F.concat(o.cast("string"), F.lit("_A"))).alias("residue_id"), letter(o).alias("wt"), c("o_orderpriority").alias("tags"))


def evidence(spark, sf_dir):
    """Exposure, classes and structures of each position that has line items."""
    rows = table(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("position_id")).agg(F.min("l_discount").alias("d"), F.max("l_returnflag").alias("f"), F.min("l_suppkey").alias("s"), F.max("l_suppkey").alias("t"), F.count("*").alias("n"))
    name = F.concat(F.when(c("s") % 4 == 0, F.lit("AF-")).otherwise(F.lit("")), c("s").cast("string"), F.lit(";0.9;1.0;2.1"))
    return rows.select("position_id", F.when(c("f") != "R", c("d") * 2).alias("rsa"), F.when(c("f") == "A", "Protein interaction").alias("interaction_class"), F.when(c("f") == "A", "Protein").alias("simple_class"), c("f").alias("secondary"), F.when(c("n") > 1, name).alias("recommended"), F.when(c("n") > 2, F.concat(c("t").cast("string"), F.lit(";0.4"))).otherwise(F.concat(c("t").cast("string"), F.lit(";0.5;0.6;-"))).alias("most_similar"), c("n").alias("n_structures"))


def _place(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} > {scores.SURFACE_ABOVE} THEN 'Surface' WHEN {x} > {scores.BURIED_ABOVE} THEN 'Buried' ELSE 'Core' END"


TABLES = f"""
    pr AS (SELECT c_custkey AS protein_id, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS input_id, 'P' || c_custkey AS primary_id, 'U' || c_custkey AS uniprot_ac, c_mktsegment AS uniprot_id, CASE WHEN c_custkey % 2 = 0 THEN 'NP' END AS refseq FROM customer),
    po AS (SELECT o_orderkey AS position_id, o_custkey AS protein_id, o_orderkey % 500 AS position_number, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey || '_A' ELSE '' END AS residue_id, '{AA}'[o_orderkey % 21 + 1:o_orderkey % 21 + 1] AS wt, o_orderpriority AS tags FROM orders),
    li AS (SELECT l_orderkey AS position_id, min(l_discount) AS d, max(l_returnflag) AS f, min(l_suppkey) AS s, max(l_suppkey) AS t, count(*) AS n FROM lineitem GROUP BY 1),
    ev AS (SELECT *, CASE WHEN f <> 'R' THEN d * 2 END AS rsa FROM li)"""


@query("classification_report", f"""
    WITH {TABLES}
    SELECT coalesce(input_id, primary_id) AS input_id, primary_id, uniprot_ac, uniprot_id, refseq, residue_id, wt AS amino_acid, position_number, tags, {_place('rsa')} AS location,
      CASE WHEN f = 'A' THEN 'Protein interaction' ELSE {_place('rsa')} END AS classification, CASE WHEN f = 'A' THEN 'Protein' ELSE {_place('rsa')} END AS simple_class, f AS secondary,
      CASE WHEN n > 1 THEN CASE WHEN s % 4 = 0 THEN 'AF-' ELSE '' END || s ELSE '-' END AS recommended_structure, CASE WHEN n > 1 THEN '0.9' ELSE '-' END AS recommended_identity, CASE WHEN n > 1 THEN '1.0' ELSE '-' END AS recommended_coverage,
      CASE WHEN n > 1 THEN '2.1' ELSE '-' END AS recommended_resolution, coalesce(n > 1 AND s % 4 = 0, false) AS recommended_model,
      CASE WHEN n <= 2 THEN CAST(t AS VARCHAR) ELSE '-' END AS similar_structure, CASE WHEN n <= 2 THEN '0.5' ELSE '-' END AS similar_identity, CASE WHEN n <= 2 THEN '0.6' ELSE '-' END AS similar_coverage, '-' AS similar_resolution, false AS similar_model, coalesce(n, 0) AS n_structures
    FROM po JOIN pr USING (protein_id) LEFT JOIN ev USING (position_id)""")  # fmt: skip
def classification_report(spark, sf_dir):
    return reports.classification_report(positions(spark, sf_dir), proteins(spark, sf_dir), evidence(spark, sf_dir))


@query("interface_report", f"""
    WITH {TABLES}, i AS (SELECT DISTINCT o_custkey AS protein_id, o_custkey * 10 + o_orderkey % 7 AS interface_id FROM orders), nu AS (SELECT *, dense_rank() OVER (PARTITION BY protein_id ORDER BY interface_id) AS interface_number FROM i)
    SELECT coalesce(input_id, primary_id) AS input_id, primary_id, uniprot_ac, wt AS amino_acid, position_number, CAST(interface_number AS INTEGER) AS interface_number, 'S' || nu.interface_id AS interface_recommendation, 'R' || position_id AS position_recommendation
    FROM po JOIN nu ON nu.protein_id = po.protein_id AND nu.interface_id = po.protein_id * 10 + position_id % 7 JOIN pr ON pr.protein_id = nu.protein_id""")  # fmt: skip
def interface_report(spark, sf_dir):
    rows = positions(spark, sf_dir).withColumn("interface_id", c("protein_id") * 10 + c("position_id") % 7)
    members = rows.select("interface_id", "position_id", F.concat(F.lit("R"), c("position_id").cast("string")).alias("residue"))
    interfaces = rows.select("interface_id", "protein_id").distinct().withColumn("recommendation", F.concat(F.lit("S"), c("interface_id").cast("string")))
    return reports.interface_report(members, interfaces, rows, proteins(spark, sf_dir))


def _flag(letters: str, other: str | None = None) -> str:
    return f"CAST((strpos('{letters}', wt) > 0) <> (strpos('{other or letters}', mu) > 0) AS INTEGER)"


FLAGS = {k: _flag(v, sequences.PROPERTIES["negative"] if k == "charged" else None) for k, v in sequences.PROPERTIES.items()}


@query("feature_report", f"""
    WITH {TABLES}, hy(a, h) AS (VALUES {', '.join(f"('{k}', {v})" for k, v in sequences.HYDROPATHY.items())}), vo(a, v) AS (VALUES {', '.join(f"('{k}', {v})" for k, v in sequences.VOLUME.items())}),
    sn AS (SELECT DISTINCT 'P' || o_custkey AS primary_id, o_orderkey % 500 AS position_number, '{AA}'[l_suppkey % 21 + 1:l_suppkey % 21 + 1] AS mu FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 1 AND l_quantity > 10),
    r AS (SELECT coalesce(input_id, primary_id) AS input_id, primary_id, uniprot_ac, wt, po.position_number, tags, coalesce(mu, wt) AS mu, f FROM po JOIN pr USING (protein_id) LEFT JOIN ev USING (position_id) LEFT JOIN sn USING (primary_id, position_number))
    SELECT input_id, primary_id, uniprot_ac, wt AS amino_acid, position_number, mu AS new_aa, wt || mu AS change, tags, f AS secondary, CAST(coalesce(round(abs(x.h - y.h), 6), 0) AS DOUBLE) AS hydropathy_change, CAST(coalesce(round(abs(p.v - q.v), 6), 0) AS DOUBLE) AS volume_change,
      {', '.join(f"{v} AS {k}_change" for k, v in FLAGS.items())}, {' + '.join(v for k, v in FLAGS.items() if k != 'tiny')} AS total_change
    FROM r LEFT JOIN hy x ON x.a = wt LEFT JOIN hy y ON y.a = mu LEFT JOIN vo p ON p.a = wt LEFT JOIN vo q ON q.a = mu""")  # fmt: skip
def feature_report(spark, sf_dir):
    classified = reports.classification_report(positions(spark, sf_dir), proteins(spark, sf_dir), evidence(spark, sf_dir))
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber = 1 AND l_quantity > 10")
    changes = table(spark, sf_dir, "orders").join(lines, c("l_orderkey") == c("o_orderkey")).select(F.concat(F.lit("P"), c("o_custkey").cast("string")).alias("primary_id"), (c("o_orderkey") % 500).alias("position_number"), letter(c("l_suppkey")).alias("new_aa")).distinct()
    found = reports.feature_report(classified, changes, ["secondary"])
    return found.withColumns({x: F.round(x, 6) for x in ("hydropathy_change", "volume_change")})


@query("partner_report", f"""
    WITH {TABLES}, x AS (SELECT o_custkey AS a, c_custkey AS b, l_suppkey AS complex_id, l_returnflag AS ca, l_linestatus AS cb, l_tax AS score FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = l_partkey % 150 + 1),
    s AS (SELECT c_custkey AS p FROM customer WHERE c_nationkey < 15)
    SELECT m.primary_id AS name_a, n.primary_id AS name_b, complex_id, ca AS chain_a, cb AS chain_b, score, b NOT IN (SELECT p FROM s) AS expanded FROM x JOIN pr m ON m.protein_id = a JOIN pr n ON n.protein_id = b WHERE a IN (SELECT p FROM s)""")  # fmt: skip
def partner_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_tax")
    parts = parts_of(lines)
    orders = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), parts, "o_orderkey")
    ppi = dealt(lines, parts, "l_orderkey").join(orders, c("o_orderkey") == c("l_orderkey")).select(c("o_custkey").alias("protein_a"), (c("l_partkey") % 150 + 1).alias("protein_b"), c("l_suppkey").alias("complex_id"), c("l_returnflag").alias("chain_a"), c("l_linestatus").alias("chain_b"), c("l_tax").alias("score"))
    session = table(spark, sf_dir, "customer").where("c_nationkey < 15").select(c("c_custkey").alias("protein_id"))
    return reports.partner_report(dealt(ppi, parts, "protein_a"), session, proteins(spark, sf_dir), lines.select((c("l_partkey") % 150 + 1).alias("protein_b")))


@query("annotation_rates", """
    WITH m AS (SELECT o_custkey AS p, o_orderkey AS k, l_suppkey AS s, l_quantity / 50 AS i, l_returnflag = 'R' AS bad FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber < 3),
    e AS (SELECT p, k, bool_or(s IS NOT NULL AND NOT bad) AS ok, bool_or(bad) AS faulty, max(CASE WHEN NOT bad THEN i END) AS best FROM m GROUP BY ALL),
    q AS (SELECT p, count(*) AS n, sum(CASE WHEN ok THEN 1 ELSE 0 END) AS ok, sum(CASE WHEN NOT coalesce(ok, false) AND faulty THEN 1 ELSE 0 END) AS faulty, max(best) AS best FROM e GROUP BY p)
    SELECT CAST(sum(n) AS BIGINT) AS positions, CAST(sum(ok) AS BIGINT) AS mapped, CAST(sum(faulty) AS BIGINT) AS faulty, count(*) AS proteins, count(*) FILTER (ok > 0) AS proteins_mapped, count(*) FILTER (best >= 0.35) AS proteins_homolog, count(*) FILTER (best >= 0.99) AS proteins_same FROM q""")  # fmt: skip
def annotation_rates(spark, sf_dir):
    own = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("position_id"), c("o_custkey").alias("protein_id"))
    mapped = table(spark, sf_dir, "lineitem").where("l_linenumber < 3").select(c("l_orderkey").alias("position_id"), c("l_suppkey").alias("structure_id"), (c("l_quantity") / 50).alias("identity"), F.when(c("l_returnflag") == "R", "broken").alias("fault"))
    return reports.annotation_rates(own, mapped)


@query("indel_report", f"""
    WITH {regions.CHANGED}, ins AS (SELECT o_orderkey, 'mut' AS side, mut AS protein, CASE kind WHEN 'ins' THEN l + 1 ELSE l END AS a, CASE kind WHEN 'ins' THEN l + 1 ELSE l END + n - 1 AS b FROM y WHERE kind <> 'del' UNION ALL SELECT o_orderkey, 'wt', wt, l, r FROM y WHERE kind <> 'ins'),
    ag AS (SELECT o_orderkey, side, avg(rsa) AS rsa FROM ins JOIN po USING (protein) WHERE position BETWEEN a AND b GROUP BY ALL),
    fl AS (SELECT o_orderkey, avg(rsa) AS rsa FROM y JOIN po ON protein = wt AND position BETWEEN CASE kind WHEN 'ins' THEN l + 1 ELSE l END - f AND CASE kind WHEN 'ins' THEN l ELSE l - 1 END WHERE e <> 'left' GROUP BY 1)
    SELECT y.o_orderkey, kind, CAST(size AS INTEGER) AS size, round(w.rsa, 6) AS wildtype_rsa, round(m.rsa, 6) AS mutant_rsa, round(fl.rsa, 6) AS wt_left_rsa FROM y LEFT JOIN ag w ON w.o_orderkey = y.o_orderkey AND w.side = 'wt' LEFT JOIN ag m ON m.o_orderkey = y.o_orderkey AND m.side = 'mut' LEFT JOIN fl ON fl.o_orderkey = y.o_orderkey""")  # fmt: skip
def indel_report(spark, sf_dir):
    rows = regions.changes(spark, sf_dir)
    long = indels.region_features(rows, regions.positions(spark, sf_dir), ["o_orderkey"], {"rsa": "number", "bound": "flag"})
    found = reports.indel_report(rows, long, ["o_orderkey"], ["rsa", "bound"])
    size = indels.size_of(c("kind"), c("left"), c("right"), c("inserted"))
    return found.select("o_orderkey", "kind", size.alias("size"), *(F.round(x, 6).alias(x) for x in ("wildtype_rsa", "mutant_rsa", "wt_left_rsa")))


@query("indel_class_counts", """
    WITH x AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'ins' WHEN 1 THEN 'del' ELSE 'sub' END AS kind, ['All', o_orderpriority] AS tags, o_orderstatus AS a, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus ELSE 'X' END AS b FROM orders)
    SELECT kind, tag, CASE WHEN kind <> 'ins' THEN a END AS wt_class, CASE WHEN kind <> 'del' THEN b END AS mut_class, count(*) AS n FROM (SELECT kind, a, b, unnest(tags) AS tag FROM x) GROUP BY ALL""")  # fmt: skip
def indel_class_counts(spark, sf_dir):
    k = c("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.when(k % 3 == 0, "ins").when(k % 3 == 1, "del").otherwise("sub").alias("kind"), F.array("o_orderpriority").alias("tags"), c("o_orderstatus").alias("wt_class"), F.when(k % 4 > 0, c("o_orderstatus")).otherwise("X").alias("mut_class"))
    return reports.indel_class_counts(rows)


@query("equal_sequences", """
    WITH i AS (SELECT p_partkey AS isoform, p_size % 5 AS stem, p_name AS s FROM part)
    SELECT a.isoform AS transcript, min(b.isoform) AS isoform FROM i a JOIN i b ON a.stem = b.stem AND a.s = b.s AND b.isoform % 2 = 0 GROUP BY 1""")  # fmt: skip
def equal_sequences(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(c("p_partkey").alias("transcript"), (c("p_size") % 5).alias("stem"), c("p_name").alias("sequence"))
    return identifiers.equal_sequences(rows, rows.where("transcript % 2 = 0").withColumnRenamed("transcript", "isoform"))


@query("requested_chains", """
    WITH r AS (SELECT o_orderkey, lpad(CAST(o_custkey % 100 AS VARCHAR), 4, 'a') AS s, CASE o_orderkey % 3 WHEN 0 THEN '-' WHEN 1 THEN 'A' ELSE 'B' END AS ch FROM orders),
    k AS (SELECT DISTINCT lpad(CAST(l_suppkey % 100 AS VARCHAR), 4, 'a') AS s, l_returnflag AS ch FROM lineitem WHERE l_returnflag <> 'N')
    SELECT upper(r.s) || ':' || k.ch AS request, o_orderkey FROM r JOIN k USING (s) WHERE r.ch = '-' UNION ALL SELECT upper(s) || ':' || ch, o_orderkey FROM r WHERE ch <> '-'""")  # fmt: skip
def requested_chains(spark, sf_dir):
    name = lambda x: F.lpad((c(x) % 100).cast("string"), 4, "a")
    k = c("o_orderkey") % 3
    requests = table(spark, sf_dir, "orders").select(F.concat(F.upper(name("o_custkey")), F.lit(":"), F.when(k == 0, "-").when(k == 1, "A").otherwise("B")).alias("request"), "o_orderkey")
    chains = table(spark, sf_dir, "lineitem").select(name("l_suppkey").alias("structure"), c("l_returnflag").alias("chain"), F.when(c("l_returnflag") == "N", "DNA").otherwise("Protein").alias("kind")).distinct()
    return identifiers.requested_chains(requests, chains)


@query("isoform_names", """
    WITH a AS (SELECT CASE p_partkey % 3 WHEN 0 THEN 'P' || p_size WHEN 1 THEN 'P' || p_size || '-2' ELSE 'P' || p_size || '_A1G' END AS accession FROM part), n AS (SELECT DISTINCT 'P' || s_suppkey AS stem, s_name AS name FROM supplier)
    SELECT DISTINCT accession, CASE WHEN accession NOT LIKE '%\\_%' ESCAPE '\\' THEN name END AS name FROM a LEFT JOIN n ON stem = split_part(accession, '-', 1)""")  # fmt: skip
def isoform_names(spark, sf_dir):
    k, stem = c("p_partkey") % 3, F.concat(F.lit("P"), c("p_size").cast("string"))
    accessions = table(spark, sf_dir, "part").select(F.when(k == 0, stem).when(k == 1, F.concat(stem, F.lit("-2"))).otherwise(F.concat(stem, F.lit("_A1G"))).alias("accession"))
    return identifiers.isoform_names(accessions, table(spark, sf_dir, "supplier").select(F.concat(F.lit("P"), c("s_suppkey").cast("string")).alias("accession"), c("s_name").alias("name")))


@query("keyed_residues", """
    WITH al AS (SELECT l_suppkey AS p, l_orderkey % 50 AS s, max(l_tax) * 10 AS i FROM lineitem GROUP BY ALL), m AS (SELECT DISTINCT l_suppkey AS p, l_orderkey % 50 AS s, l_linenumber AS n, CASE WHEN l_quantity > 5 THEN l_partkey END AS r FROM lineitem)
    SELECT m.s AS structure_id, r AS residue, p * 100 + n AS position_id FROM m JOIN al USING (p, s) WHERE r IS NOT NULL AND i >= 0.75 AND n < 6""")  # fmt: skip
def keyed_residues(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("protein_id"), (c("l_orderkey") % 50).alias("structure_id"), c("l_linenumber").alias("position_number"), F.when(c("l_quantity") > 5, c("l_partkey")).alias("residue"), "l_tax")
    alignments = rows.groupBy("protein_id", "structure_id").agg((F.max("l_tax") * 10).alias("identity"))
    own = rows.where("position_number < 6").select("protein_id", "position_number", (c("protein_id") * 100 + c("position_number")).alias("position_id")).distinct()
    return identifiers.keyed_residues(rows.drop("l_tax").distinct(), alignments, own, least=0.75)


@query("wild_types", """
    WITH t AS (SELECT p_brand AS gene, arg_max(p_partkey, {'k': p_size > 10, 'v': CASE WHEN p_size > 10 THEN p_size ELSE 0 END, 'o': -p_partkey}) AS tagged, arg_max(p_partkey, {'n': length(p_name), 'o': -p_partkey}) AS longest FROM part GROUP BY 1)
    SELECT gene, tagged, longest FROM t""")  # fmt: skip
def wild_types(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(c("p_brand").alias("gene"), c("p_partkey").alias("protein"), c("p_partkey").alias("order"), c("p_name").alias("sequence"), F.when(c("p_size") > 10, c("p_size").cast("double")).alias("expression"))
    tagged = identifiers.wild_types(rows, tag="expression").select("gene", c("protein").alias("tagged"))
    return tagged.join(identifiers.wild_types(rows).select("gene", c("protein").alias("longest")), "gene")


@query("structure_predicates", """
    WITH b AS (SELECT l_suppkey AS p, l_orderkey % 20 AS s, l_partkey % 40 AS n, min(l_partkey % 40 + l_orderkey % 2) AS i, max(l_quantity) > 10 AS has FROM lineitem GROUP BY ALL),
    e AS (SELECT *, min(n) OVER (PARTITION BY p, s) AS lo, max(n) OVER (PARTITION BY p, s) AS hi FROM b WHERE has), f AS (SELECT DISTINCT s_suppkey AS p, s_suppkey % 30 AS l, s_suppkey % 30 + s_suppkey % 3 AS r FROM supplier), st AS (SELECT DISTINCT p, s FROM e)
    SELECT f.p AS protein_id, st.s AS structure_id, f.l AS "left", f.r AS "right", x.i IS NOT NULL AND y.i IS NOT NULL AS covered, coalesce(y.i - x.i = 1, false) AS adjacent, coalesce(x.n = x.lo OR x.n = x.hi, false) OR coalesce(y.n = y.lo OR y.n = y.hi, false) AS terminal
    FROM f JOIN st ON st.p = f.p LEFT JOIN e x ON x.p = f.p AND x.s = st.s AND x.n = f.l LEFT JOIN e y ON y.p = f.p AND y.s = st.s AND y.n = f.r""")  # fmt: skip
def structure_predicates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("protein_id"), (c("l_orderkey") % 20).alias("structure_id"), (c("l_partkey") % 40).alias("position_number")).agg(F.min(c("l_partkey") % 40 + c("l_orderkey") % 2).alias("seq_index"), F.when(F.max("l_quantity") > 10, F.lit("r")).alias("residue"))
    flanks = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("protein_id"), (c("s_suppkey") % 30).alias("left"), (c("s_suppkey") % 30 + c("s_suppkey") % 3).alias("right"))
    return identifiers.adjacency(rows, flanks)


@query("text_sinks", """
    SELECT 'fasta' AS sink, concat('>', p_partkey, chr(10), rtrim(regexp_replace(p_name, '(.{5})(.)', '\\1' || chr(10) || '\\2', 'g'))) AS value FROM part WHERE length(p_name) < 11 AND p_name NOT LIKE '% ' UNION ALL SELECT 'sif', concat(s_suppkey, chr(9), 'near', chr(9), s_nationkey) FROM supplier""")  # fmt: skip
def text_sinks(spark, sf_dir):
    records = writers.fasta(table(spark, sf_dir, "part").where("length(p_name) < 11 AND p_name NOT LIKE '% '").select(c("p_partkey").alias("id"), c("p_name").alias("sequence")), width=5)
    edges = writers.sif(table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("a"), c("s_nationkey").alias("b"), F.lit("near").alias("kind")))
    return records.select(F.lit("fasta").alias("sink"), "value").unionByName(edges.select(F.lit("sif").alias("sink"), "value"))
