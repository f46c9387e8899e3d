"""Notation, sequences, interfaces, networks and reports on the supplied tables.

A protein is a part with its name as its sequence, a structure a supplier, a residue or a
mapping a line item.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.functions import scores, sequences
from residuum.operators import aggregates, alignment, graphs, joins, profiles, store, windows
from residuum.operators.durable import dealt, parts_of
from residuum.plans import reports
from residuum.plans.catalog import query, table
from residuum.sources import inputs, structures

AA = "ACDEFGHIKLMNPQRSTVWY"
NAMES = ("Ala", "Cys", "Asp", "Glu", "Phe", "Gly", "His", "Ile", "Lys", "Leu", "Met", "Asn", "Pro", "Gln", "Arg", "Ser", "Thr", "Val", "Trp", "Tyr")
c = F.col


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part")


def items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query("hgvs_names", f"""
    SELECT p_partkey, substr('{AA}', 1 + CAST(p_partkey % 20 AS INTEGER), 1) AS wt, CAST(p_partkey + 1 AS INTEGER) AS pos, substr('{AA}', 1 + CAST(p_size % 20 AS INTEGER), 1) AS mut FROM part""")  # fmt: skip
def hgvs_names(spark, sf_dir):
    name = lambda k: F.get(F.array(*map(F.lit, NAMES)), (c(k) % 20).cast("int"))
    text = F.concat(F.lit("p."), name("p_partkey"), (c("p_partkey") + 1).cast("string"), name("p_size"))
    return parts(spark, sf_dir).select("p_partkey", sequences.parse_hgvs(text).alias("x")).select("p_partkey", "x.*")


@query("indel_parse", """
    WITH t AS (SELECT p_partkey, p_partkey % 3 AS k, 1 + p_size AS l, CAST(1 + p_size + CASE WHEN p_partkey % 3 = 2 THEN 1 ELSE p_partkey % 4 END AS INTEGER) AS r FROM part)
    SELECT p_partkey, CASE k WHEN 0 THEN 'substitution' WHEN 1 THEN 'deletion' ELSE 'insertion' END AS kind, l AS "left", r AS "right", CASE WHEN k = 1 THEN '' ELSE 'GW' END AS inserted,
           CASE WHEN k = 2 THEN 0 ELSE r - l + 1 END AS n_affected,
           'A' || l || CASE WHEN l = r THEN '' ELSE '_A' || r END || CASE k WHEN 0 THEN 'delinsGW' WHEN 1 THEN 'del' ELSE 'insGW' END AS notation FROM t""")  # fmt: skip
def indel_parse(spark, sf_dir):
    k, left = c("p_partkey") % 3, 1 + c("p_size")
    right = (left + F.when(k == 2, 1).otherwise(c("p_partkey") % 4)).cast("int")
    text = F.concat(F.lit("A"), left.cast("string"), F.when(left == right, "").otherwise(F.concat(F.lit("_A"), right.cast("string"))), F.when(k == 0, "delinsGW").when(k == 1, "del").otherwise("insGW"))
    rows = parts(spark, sf_dir).select("p_partkey", sequences.parse_indel(text).alias("x"))
    return rows.select("p_partkey", "x.*", F.size(sequences.affected_positions("x")).alias("n_affected"), sequences.indel_notation("x", F.lit("A" * 100)).alias("notation"))


@query("multi_change", """
    SELECT p_partkey, 'Q' || substr(p_name, 2, 2) || 'W' || substr(p_name, 5) AS changed FROM part WHERE length(p_name) > 5""")  # fmt: skip
def multi_change(spark, sf_dir):
    changes = F.array(F.struct(F.lit(1).alias("pos"), F.lit("Q").alias("mut")), F.struct(F.lit(4).alias("pos"), F.lit("W").alias("mut")))
    return parts(spark, sf_dir).where(F.length("p_name") > 5).select("p_partkey", sequences.apply_changes("p_name", changes).alias("changed"))


@query("exposure_classes", f"""
    WITH t AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, CASE WHEN l_quantity <> 13 THEN l_discount * 2 END AS a, l_tax * 2 AS b, l_discount + l_tax AS d FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_suppkey, {{a}} AS location, {{b}} AS main_chain, {{d}} AS side_chain, CASE l_returnflag WHEN 'A' THEN 'Protein interaction' ELSE {{a}} END AS class FROM t""".replace("{{", "{").replace("}}", "}").format(**{k: f"CASE WHEN {k} IS NULL THEN NULL WHEN {k} > {scores.SURFACE_ABOVE} THEN 'Surface' WHEN {k} > {scores.BURIED_ABOVE} THEN 'Buried' ELSE 'Core' END" for k in "abd"}))  # fmt: skip
def exposure_classes(spark, sf_dir):
    rows = items(spark, sf_dir).withColumn("x", scores.triple_locate(F.when(c("l_quantity") != 13, c("l_discount") * 2), c("l_tax") * 2, c("l_discount") + c("l_tax")))
    own = F.when(c("l_returnflag") == "A", "Protein interaction").when(c("l_returnflag") == "N", "No interaction")
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", "x.*", scores.classify(own, "x.location").alias("class"))


@query("accession_kinds", """
    SELECT p_partkey, p_partkey % 3 <> p_partkey % 2 AS mutant,
           CASE p_partkey % 4 WHEN 0 THEN '1' || CAST((p_size % 10) // 2 * 2 AS VARCHAR) WHEN 1 THEN '_' || CAST(p_size % 10 AS VARCHAR) WHEN 2 THEN CAST(p_size % 10 AS VARCHAR) || '_' ELSE '__' END AS chunk,
           CASE p_partkey % 5 WHEN 0 THEN 'entry' WHEN 1 THEN 'asymmetric unit' WHEN 2 THEN 'model' WHEN 3 THEN 'custom' ELSE 'other' END AS kind FROM part""")  # fmt: skip
def accession_kinds(spark, sf_dir):
    k, d = c("p_partkey"), (c("p_size") % 10).cast("string")
    name = F.concat(F.lit("P"), F.repeat(F.lit("del"), (k % 3).cast("int")), F.repeat(F.lit("ins"), (k % 2).cast("int")))
    tail = F.when(k % 4 == 0, F.concat(F.lit("Q1"), d)).when(k % 4 == 1, F.concat(F.lit("QX"), d)).when(k % 4 == 2, F.concat(F.lit("Q"), d, F.lit("X"))).otherwise("QXY")
    shape = F.when(k % 5 == 0, "1abc").when(k % 5 == 1, "1abc_AU").when(k % 5 == 2, "AF-P12345").when(k % 5 == 3, "my__file").otherwise("nothing")
    return parts(spark, sf_dir).select("p_partkey", sequences.is_mutant_accession(name).alias("mutant"), sequences.chunk_of(tail).alias("chunk"), scores.structure_kind(shape).alias("kind"))


ALIGNED = """a AS (SELECT p_partkey, replace(p_name, 'a', '-') AS x, replace(p_name, 'e', '-') AS y FROM part),
    z AS (SELECT p_partkey, i, x[i:i] AS a, y[i:i] AS b FROM (SELECT *, unnest(range(1, length(x) + 1)) AS i FROM a)),
    m AS (SELECT *, sum(CASE WHEN a <> '-' THEN 1 ELSE 0 END) OVER (PARTITION BY p_partkey ORDER BY i) AS pa, sum(CASE WHEN b <> '-' THEN 1 ELSE 0 END) OVER (PARTITION BY p_partkey ORDER BY i) AS pb,
          lag(a) OVER (PARTITION BY p_partkey ORDER BY i) AS la, lead(a) OVER (PARTITION BY p_partkey ORDER BY i) AS na FROM z)"""


def aligned(spark, sf_dir):
    return parts(spark, sf_dir).select(c("p_partkey").alias("protein_id"), F.lit("s").alias("structure_id"), F.replace("p_name", F.lit("a"), F.lit("-")).alias("target"), F.replace("p_name", F.lit("e"), F.lit("-")).alias("template"))


@query("alignment_bridge", f"""
    WITH {ALIGNED} SELECT p_partkey AS protein_id, CAST(pa AS BIGINT) AS position_number, CAST(pb AS BIGINT) AS seq_index, a AS letter FROM m WHERE a <> '-' AND b <> '-'""")  # fmt: skip
def alignment_bridge(spark, sf_dir):
    return inputs.bridge(aligned(spark, sf_dir)).select("protein_id", "position_number", "seq_index", "letter")


@query("aligned_places", f"""
    WITH {ALIGNED} SELECT p_partkey, CAST(pa AS INTEGER) AS i, CAST(pb AS INTEGER) AS j FROM m WHERE a <> '-' AND b <> '-'""")  # fmt: skip
def aligned_places(spark, sf_dir):
    return aligned(spark, sf_dir).select(c("protein_id").alias("p_partkey"), F.inline(sequences.aligned_places("target", "template")))


@query("alignment_variants", f"""
    WITH {ALIGNED},
    r AS (SELECT *, i - row_number() OVER (PARTITION BY p_partkey ORDER BY i) AS run FROM m WHERE a <> b),
    g AS (SELECT p_partkey, run, string_agg(replace(a, '-', ''), '' ORDER BY i) AS lost, string_agg(replace(b, '-', ''), '' ORDER BY i) AS got, count(*) AS n, min(pa) AS l, max(pa) AS r, min(CASE WHEN a <> '-' THEN pa END) AS f, arg_min(coalesce(la, ''), i) AS la, arg_max(coalesce(na, ''), i) AS na FROM r GROUP BY ALL),
    e AS (SELECT *, substr(lost, 1, 1) || f || CASE WHEN length(lost) > 1 THEN '_' || right(lost, 1) || r ELSE '' END AS ends FROM g)
    SELECT p_partkey AS protein_id, CASE WHEN lost = '' THEN la || l || '_' || na || (l + 1) || 'ins' || got WHEN got = '' THEN ends || 'del' WHEN n = 1 THEN lost || f || got ELSE ends || 'delins' || got END AS change FROM e""")  # fmt: skip
def alignment_variants(spark, sf_dir):
    return alignment.variants(aligned(spark, sf_dir), ["protein_id"])


@query("global_alignment")
def global_alignment(spark, sf_dir):
    """Each part's type against its name, by a matrix of matches only; ``sources.structures.parse_matrix`` reads a published one."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    align = alignment.aligner({(x, x): 4.0 for x in letters}, letters)
    rows = parts(spark, sf_dir).select("p_partkey", F.upper("p_type").alias("a"), F.upper("p_name").alias("b"))
    found = alignment.align_distinct(rows, align).select("p_partkey", "target", "template")
    return found.withColumn("q", sequences.identity_and_coverage("target", "template", F.length("target"))).select("p_partkey", "target", "template", "q.identity")


@query("whole_proteins", """
    WITH p AS (SELECT p_partkey, p_name, unnest(range(1, length(p_name) + 1)) AS n FROM part)
    SELECT p_partkey AS protein_id, CAST(n AS INTEGER) AS position_number, p_name[n:n] AS wt FROM p WHERE (p_partkey, n) NOT IN (SELECT l_partkey, l_linenumber FROM lineitem)""")  # fmt: skip
def whole_proteins(spark, sf_dir):
    proteins = parts(spark, sf_dir).select(c("p_partkey").alias("protein_id"), c("p_name").alias("sequence"))
    asked = items(spark, sf_dir).select(c("l_partkey").alias("protein_id"), c("l_linenumber").alias("position_number"))
    return inputs.whole_protein_positions(proteins, asked)


@query("sane_positions", """
    SELECT l_returnflag AS flag, coalesce(p_name[l_linenumber:l_linenumber] = CASE l_returnflag WHEN 'A' THEN 's' ELSE 'e' END, false) OR l_returnflag = 'N' AND p_name IS NOT NULL AND length(p_name) >= l_linenumber AS sane, count(*) AS n
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY ALL""")  # fmt: skip
def sane_positions(spark, sf_dir):
    proteins = parts(spark, sf_dir).select(c("p_partkey").alias("protein_id"), c("p_name").alias("sequence"))
    wt = F.when(c("l_returnflag") == "A", "s").when(c("l_returnflag") == "N", "X").otherwise("e")
    positions = items(spark, sf_dir).select(c("l_partkey").alias("protein_id"), c("l_linenumber").alias("position_number"), wt.alias("wt"), c("l_returnflag").alias("flag"))
    return inputs.sane(positions, proteins).groupBy("flag", "sane").agg(F.count("*").alias("n"))


@query("isoform_usage", """
    WITH s AS (SELECT p_brand AS gene, p_name AS seq, min(p_partkey) AS isoform, sum(p_size) AS a, sum(p_retailprice) AS b FROM part GROUP BY ALL),
    u AS (SELECT gene, isoform, a / sum(a) OVER (PARTITION BY gene) AS ua, b / sum(b) OVER (PARTITION BY gene) AS ub FROM s)
    SELECT gene, isoform, round(ua, 6) AS usage_a, round(ub, 6) AS usage_b, round(ub - ua, 6) AS change, round(CASE WHEN ua > 0 AND ub > 0 THEN log2(ub / ua) END, 6) AS log2_fold FROM u WHERE ua + ub >= 0.01""")  # fmt: skip
def isoform_usage(spark, sf_dir):
    rows = parts(spark, sf_dir).select(c("p_brand").alias("gene"), c("p_name").alias("sequence"), c("p_partkey").alias("isoform"), c("p_size").alias("a"), c("p_retailprice").alias("b"))
    found = reports.isoform_usage(rows, "a", "b")
    fold = F.when(F.abs("log2_fold") < float("inf"), F.round("log2_fold", 6))
    return found.select("gene", "isoform", F.round("usage_a", 6).alias("usage_a"), F.round("usage_b", 6).alias("usage_b"), F.round("change", 6).alias("change"), fold.alias("log2_fold"))


@query("top_partners", """
    WITH s AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS score FROM lineitem GROUP BY ALL)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY score DESC, l_suppkey) AS INTEGER) AS place FROM s) WHERE place <= 5""")  # fmt: skip
def top_partners(spark, sf_dir):
    rows = items(spark, sf_dir).groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("score"))
    return reports.top_partners(rows, "l_partkey", "score", "l_suppkey")


@query("multi_savs", """
    SELECT l_orderkey AS mm_id, string_agg(p_brand, ':' ORDER BY l_linenumber, l_partkey, l_suppkey) AS savs FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")  # fmt: skip
def multi_savs(spark, sf_dir):
    lists = items(spark, sf_dir).groupBy(c("l_orderkey").alias("mm_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: x["l_partkey"]).alias("snv_ids"))
    return reports.multi_savs(lists, parts(spark, sf_dir).select(c("p_partkey").alias("snv_id"), c("p_brand").alias("change")))


@query("not_connected", "SELECT c_custkey AS node FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_custkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def not_connected(spark, sf_dir):
    """Customers that no urgent order joins, as its customer or by an order of the same number."""
    edges = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(c("o_custkey").alias("a"), c("o_orderkey").alias("b"))
    return graphs.not_connected(table(spark, sf_dir, "customer").select(c("c_custkey").alias("node")), edges)


@query("network_changes", """
    WITH x AS (SELECT l_partkey, l_suppkey, avg(l_tax) AS t FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), y AS (SELECT l_partkey, l_suppkey, avg(l_tax) AS t FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL)
    SELECT l_partkey, l_suppkey, CASE WHEN y.t IS NULL THEN 'lost' WHEN x.t IS NULL THEN 'new' WHEN abs(y.t - x.t) > 0.0201 THEN 'changed' ELSE 'common' END AS kind FROM x FULL JOIN y USING (l_partkey, l_suppkey)""")  # fmt: skip
def network_changes(spark, sf_dir):
    own = lambda rows: rows.groupBy("l_partkey", "l_suppkey").agg(F.avg("l_tax").alias("t"))
    rows = items(spark, sf_dir)
    return graphs.changed_edges(own(rows.where("l_returnflag = 'A'")), own(rows.where("l_returnflag <> 'A'")), "l_partkey", "l_suppkey", "t", least=0.0201).select("l_partkey", "l_suppkey", "kind")


@query("structures_without_residues", "SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def structures_without_residues(spark, sf_dir):
    return store.without_children(table(spark, sf_dir, "orders").select(c("o_orderkey").alias("l_orderkey")), items(spark, sf_dir), ["l_orderkey"])


@query("idempotent_insert", """
    WITH s AS (SELECT l_partkey AS protein_id, CASE WHEN l_linenumber > 1 THEN l_linenumber END AS change FROM lineitem WHERE l_returnflag = 'A'), n AS (SELECT DISTINCT l_partkey AS protein_id, CASE WHEN l_linenumber > 1 THEN l_linenumber END AS change FROM lineitem)
    SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.protein_id = n.protein_id AND s.change IS NOT DISTINCT FROM n.change)""")  # fmt: skip
def idempotent_insert(spark, sf_dir):
    rows = items(spark, sf_dir).select(c("l_partkey").alias("protein_id"), F.when(c("l_linenumber") > 1, c("l_linenumber")).alias("change"), "l_returnflag")
    return store.new_rows(rows.where("l_returnflag = 'A'"), rows, ["protein_id", "change"]).select("protein_id", "change")


EDGES = """e AS (SELECT l_suppkey AS structure, chr(CAST(65 + l_linenumber % 3 AS INTEGER)) AS chain, chr(CAST(65 + l_quantity % 3 AS INTEGER)) AS chain_b, l_partkey AS residue,
    CASE WHEN l_returnflag = 'A' THEN 'combi' ELSE 'cnt' END AS bond, CASE WHEN l_linestatus = 'F' THEN 'all' ELSE 'sc' END AS side, CASE WHEN l_tax > 0.04 THEN 'Protein' ELSE 'DNA' END AS partner, CASE WHEN l_discount > 0.02 THEN 'Protein' ELSE 'DNA' END AS chain_type, l_extendedprice AS score FROM lineitem)"""


def edges(spark, sf_dir):
    letter = lambda n: F.char((65 + n % 3).cast("int"))
    return items(spark, sf_dir).select(
        c("l_suppkey").alias("structure"), letter(c("l_linenumber")).alias("chain"), letter(c("l_quantity")).alias("chain_b"), c("l_partkey").alias("residue"), F.when(c("l_returnflag") == "A", "combi").otherwise("cnt").alias("bond"),
        F.when(c("l_linestatus") == "F", "all").otherwise("sc").alias("side"), F.when(c("l_tax") > 0.04, "Protein").otherwise("DNA").alias("partner"), F.when(c("l_discount") > 0.02, "Protein").otherwise("DNA").alias("chain_type"), c("l_extendedprice").alias("score"),
    )


@query("molecule_profile", f"WITH {EDGES} SELECT structure, chain, partner, count(*) AS degree, round(sum(score), 2) AS score FROM e WHERE bond = 'combi' AND side = 'all' GROUP BY ALL")
def molecule_profile(spark, sf_dir):
    return profiles.summary_profile(edges(spark, sf_dir), ["structure", "chain"]).withColumn("score", F.round("score", 2))


@query("interface_scores", f"WITH {EDGES} SELECT structure, residue, round(sum(score), 2) AS interface_score FROM e WHERE side = 'sc' GROUP BY ALL")
def interface_scores(spark, sf_dir):
    return profiles.interface_score(edges(spark, sf_dir), ["structure", "residue"]).withColumn("interface_score", F.round("interface_score", 2))


@query("interface_build", f"""
    WITH {EDGES} SELECT structure, chain, chain_b, count(DISTINCT residue) AS residues, count(*) AS edges, round(sum(score), 2) AS score, 1000000000 * min(residue) + 10000 * max(residue) + count(DISTINCT residue) AS key
    FROM e WHERE chain_type = 'Protein' AND partner = 'Protein' AND chain <> chain_b GROUP BY ALL""")  # fmt: skip
def interface_build(spark, sf_dir):
    found = profiles.interfaces(edges(spark, sf_dir), ["structure"], chain_type_b="partner")
    return found.select("structure", "chain", "chain_b", F.size("residues").cast("long").alias("residues"), "edges", F.round("score", 2).alias("score"), sequences.interface_key("residues").alias("key"))


@query("best_interaction_pairs", """
    SELECT l_partkey, l_suppkey, max(l_extendedprice) AS score, arg_min(l_orderkey, {'s': -l_extendedprice, 'o': l_orderkey}) AS l_orderkey FROM lineitem GROUP BY ALL""")  # fmt: skip
def best_interaction_pairs(spark, sf_dir):
    return profiles.best_pairs(items(spark, sf_dir).select("l_partkey", "l_suppkey", c("l_extendedprice").alias("score"), "l_orderkey"), ["l_partkey", "l_suppkey"])


@query("interface_overlap", """
    WITH o AS (SELECT DISTINCT l_returnflag AS protein, l_suppkey AS structure, chr(CAST(65 + l_linenumber AS INTEGER)) AS chain, l_partkey % 50 AS position FROM lineitem),
    k AS (SELECT DISTINCT l_returnflag AS protein, l_linenumber AS number, l_partkey % 50 AS position FROM lineitem WHERE l_quantity > 44),
    n AS (SELECT protein, structure, chain, count(*) AS n FROM o GROUP BY ALL), m AS (SELECT protein, number, count(*) AS m FROM k GROUP BY ALL),
    j AS (SELECT protein, structure, chain, number, count(*) AS overlap FROM o JOIN k USING (protein, position) GROUP BY ALL)
    SELECT protein, structure, chain, number, overlap FROM j JOIN n USING (protein, structure, chain) JOIN m USING (protein, number) WHERE overlap > 0.5 * n OR overlap > 0.5 * m""")  # fmt: skip
def interface_overlap(spark, sf_dir):
    rows = items(spark, sf_dir).select(c("l_returnflag").alias("protein"), c("l_suppkey").alias("structure"), F.char((65 + c("l_linenumber")).cast("int")).alias("chain"), F.lit("x").alias("chain_b"), c("l_linenumber").alias("number"), (c("l_partkey") % 50).alias("position"), "l_quantity")
    return profiles.overlapping(rows, rows.where("l_quantity > 44")).select("protein", "structure", "chain", "number", "overlap")


@query("interface_fusion", """
    WITH u AS (SELECT l_suppkey AS protein, l_linenumber AS position, l_orderkey AS residue, l_extendedprice AS score FROM lineitem)
    SELECT protein, position, arg_min(residue, {'s': score, 'r': residue}) AS residue, max(score) AS score FROM u GROUP BY ALL""")  # fmt: skip
def interface_fusion(spark, sf_dir):
    rows = items(spark, sf_dir).select(c("l_suppkey").alias("protein"), c("l_linenumber").alias("position"), c("l_orderkey").alias("residue"), c("l_extendedprice").alias("score"), "l_returnflag")
    return profiles.fused(rows.where("l_returnflag = 'A'").drop("l_returnflag"), rows.where("l_returnflag <> 'A'").drop("l_returnflag"), ["protein"])


@query("surface_decision", """
    WITH w AS (SELECT l_partkey, l_tax * 4 < 0.16 AS core, l_quantity / 50 * (1 - l_discount) ** 5 AS w FROM lineitem), s AS (SELECT l_partkey, sum(CASE WHEN core THEN w ELSE 0 END) AS c, sum(CASE WHEN core THEN 0 ELSE w END) AS o, count(*) AS n FROM w GROUP BY ALL)
    SELECT l_partkey, CASE WHEN o - 2 * c > 0 THEN 'Surface' ELSE 'Core' END AS decision, round((1 - 1 / (n + 1)) * abs(o - 2 * c) / (o + 2 * c), 6) AS confidence FROM s""")  # fmt: skip
def surface_decision(spark, sf_dir):
    rows = items(spark, sf_dir).select("l_partkey", (c("l_tax") * 4).alias("surface"), (c("l_quantity") / 50).alias("quality"), (1 - c("l_discount")).alias("coverage"))
    return profiles.surface_decision(rows, ["l_partkey"]).withColumn("confidence", F.round("confidence", 6))


@query("atomic_coverage", """
    WITH r AS (SELECT l_suppkey AS chain, l_partkey, count(*) AS n, CASE l_partkey % 3 WHEN 0 THEN 5 WHEN 1 THEN 4 END AS e FROM lineitem GROUP BY ALL)
    SELECT chain, round(sum(CASE WHEN e IS NOT NULL THEN n ELSE 0 END) / sum(coalesce(e, 1)), 9) AS coverage FROM r GROUP BY chain""")  # fmt: skip
def atomic_coverage(spark, sf_dir):
    name = F.when(c("l_partkey") % 3 == 0, "ALA").when(c("l_partkey") % 3 == 1, "GLY").otherwise("UNK")
    atoms = items(spark, sf_dir).select(c("l_suppkey").alias("chain"), c("l_partkey").alias("res_num"), F.lit("").alias("ins_code"), name.alias("res_name"))
    return profiles.atomic_coverage(atoms, ["chain"]).withColumn("coverage", F.round("coverage", 9))


@query("chain_kinds", """
    WITH a AS (SELECT l_suppkey, CASE WHEN l_linestatus = 'F' THEN 'ATOM' ELSE 'HETATM' END AS record, l_orderkey * 10 + l_linenumber AS serial,
      CASE WHEN l_suppkey % 5 = 0 AND l_linenumber = 7 THEN 'U' WHEN l_suppkey % 5 = 1 AND l_linenumber = 7 THEN 'DA' WHEN l_suppkey % 5 = 2 AND l_linestatus <> 'F' THEN 'HOH' ELSE 'ALA' END AS name FROM lineitem WHERE l_suppkey % 7 > 0 OR l_linestatus <> 'F'),
    s AS (SELECT l_suppkey, sum(CASE WHEN record = 'ATOM' OR (length(name) < 3) THEN 1 ELSE 0 END) AS regular, sum(CASE WHEN record = 'HETATM' AND name = 'ALA' THEN 1 ELSE 0 END) AS odd, sum(CASE WHEN record = 'ATOM' THEN 1 ELSE 0 END) AS polymer,
      arg_max(CASE WHEN record = 'ATOM' AND length(name) < 3 THEN length(name) END, CASE WHEN record = 'ATOM' AND length(name) < 3 THEN serial END) AS l FROM a GROUP BY l_suppkey)
    SELECT l_suppkey, CASE WHEN l = 1 THEN 'RNA' WHEN l = 2 THEN 'DNA' WHEN polymer > 0 OR odd > 0 THEN CASE WHEN regular <= 2 * odd OR regular + odd < 150 THEN 'Peptide' ELSE 'Protein' END ELSE 'MISC' END AS kind FROM s""")  # fmt: skip
def chain_kinds(spark, sf_dir):
    s, seventh = c("l_suppkey") % 5, c("l_linenumber") == 7
    name = F.when((s == 0) & seventh, "U").when((s == 1) & seventh, "DA").when((s == 2) & (c("l_linestatus") != "F"), "HOH").otherwise("ALA")
    atoms = items(spark, sf_dir).where("l_suppkey % 7 > 0 OR l_linestatus <> 'F'").select("l_suppkey", F.when(c("l_linestatus") == "F", "ATOM").otherwise("HETATM").alias("record"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("serial"), name.alias("res_name"))
    return profiles.chain_kinds(atoms, ["l_suppkey"])


@query("substitution_scores", """
    WITH m AS (SELECT l_partkey % 5 AS a, l_suppkey % 7 AS b, min(l_tax) AS s FROM lineitem GROUP BY ALL), n AS (SELECT least(a, b) AS a, greatest(a, b) AS b, min(s) AS s FROM m GROUP BY ALL),
    x AS (SELECT p_partkey, p_partkey % 5 AS w, unnest([p_size % 7, p_size % 9]) AS k FROM part)
    SELECT p_partkey, round(avg(coalesce(s, 0)), 9) AS substitution FROM x LEFT JOIN n ON a = least(w, k) AND b = greatest(w, k) GROUP BY p_partkey""")  # fmt: skip
def substitution_scores(spark, sf_dir):
    digit = lambda x: x.cast("string")
    matrix = items(spark, sf_dir).select(digit(c("l_partkey") % 5).alias("a"), digit(c("l_suppkey") % 7).alias("b"), c("l_tax").alias("score"))
    changes = parts(spark, sf_dir).select("p_partkey", digit(c("p_partkey") % 5).alias("wt"), F.array(digit(c("p_size") % 7), digit(c("p_size") % 9)).alias("mutants"))
    return profiles.substitution_scores(changes, matrix).select("p_partkey", F.round("substitution", 9).alias("substitution"))


@query("frequent_value", """
    WITH n AS (SELECT l_partkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_partkey, arg_min(l_quantity, {'n': -n, 'q': l_quantity}) AS mode FROM n GROUP BY l_partkey""")  # fmt: skip
def frequent_value(spark, sf_dir):
    return aggregates.count_mode(items(spark, sf_dir), ["l_partkey"], c("l_quantity"))


@query("interface_numbers", "SELECT DISTINCT l_suppkey, l_partkey, CAST(dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS INTEGER) AS number FROM lineitem")
def interface_numbers(spark, sf_dir):
    return windows.numbered(items(spark, sf_dir).select("l_suppkey", "l_partkey").distinct(), ["l_suppkey"], "l_partkey")


@query("first_taken", "SELECT l_partkey, arg_min(l_suppkey, {'d': l_shipdate, 's': l_suppkey}) AS l_suppkey, min(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_partkey")
def first_taken(spark, sf_dir):
    return joins.first_taken(items(spark, sf_dir).select("l_partkey", "l_suppkey", "l_shipdate"), "l_partkey", ["l_shipdate", "l_suppkey"])


@query("centrality_norms", """
    WITH n AS (SELECT o_orderkey, o_custkey, floor(o_totalprice / 100000) AS v FROM orders), w AS (SELECT *, count(*) OVER g AS n, min(v) OVER g AS lo, max(v) OVER g AS hi FROM n WINDOW g AS (PARTITION BY o_custkey))
    SELECT o_orderkey, round(CASE WHEN hi > 0 AND n > 2 THEN v / ((n - 1) * (n - 2) / 2) END, 9) AS by_length, round(CASE WHEN hi > lo THEN (v - lo) / (hi - lo) WHEN hi > 0 THEN 1.0 END, 9) AS by_range FROM w""")  # fmt: skip
def centrality_norms(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.floor(c("o_totalprice") / 100000).alias("v"))
    return graphs.normalized(rows, "o_custkey", "v").select("o_orderkey", F.round("by_length", 9).alias("by_length"), F.round("by_range", 9).alias("by_range"))


@query("missing_isoforms", """
    WITH s AS (SELECT DISTINCT l_suppkey AS k, CAST(l_quantity AS INTEGER) AS n FROM lineitem WHERE l_quantity <> 3), m AS (SELECT k, max(n) AS m FROM s GROUP BY k), c AS (SELECT k, unnest(range(1, CAST(m + 2 AS BIGINT))) AS n FROM m)
    SELECT 'P' || k AS stem, CAST(min(n) AS INTEGER) AS missing FROM c ANTI JOIN s USING (k, n) GROUP BY k""")  # fmt: skip
def missing_isoforms(spark, sf_dir):
    rows = items(spark, sf_dir).where("l_quantity <> 3").select(F.concat(F.lit("P"), c("l_suppkey").cast("string"), F.lit("-"), c("l_quantity").cast("int").cast("string")).alias("ac"))
    return inputs.first_free_isoform(rows)


@query("identifier_join", """
    WITH t AS (SELECT 'A' || p_partkey AS ac, unnest(['A' || p_partkey, 'N' || p_size, 'R' || p_partkey % 7]) AS name FROM part), b AS (SELECT name, min(ac) AS ac FROM t GROUP BY name)
    SELECT name AS protein_id, ac FROM b JOIN (SELECT 'N' || l_linenumber AS name FROM lineitem UNION SELECT 'R' || l_linenumber FROM lineitem UNION SELECT 'A' || l_partkey FROM lineitem) USING (name)""")  # fmt: skip
def identifier_join(spark, sf_dir):
    ac = F.concat(F.lit("A"), c("p_partkey").cast("string"))
    each = parts(spark, sf_dir).select(ac.alias("ac"), F.explode(F.array(F.struct(F.lit("RefSeq").alias("id_type"), F.concat(F.lit("N"), c("p_size").cast("string")).alias("value")), F.struct(F.lit("Ensembl").alias("id_type"), F.concat(F.lit("R"), (c("p_partkey") % 7).cast("string")).alias("value")))).alias("x")).select("ac", "x.*")
    names = items(spark, sf_dir).select(F.explode(F.array(F.concat(F.lit("N"), c("l_linenumber").cast("string")), F.concat(F.lit("R"), c("l_linenumber").cast("string")), F.concat(F.lit("A"), c("l_partkey").cast("string")))).alias("protein_id")).distinct()
    return inputs.resolve(names, inputs.identifier_table(each))[0].select("protein_id", "ac")


@query("classification", f"""
    WITH s AS (SELECT l_orderkey * 10 + l_linenumber AS position_id, min(CASE WHEN l_returnflag = 'A' THEN 'W' END) AS new_aa, any_value(l_partkey) AS protein_id, max(l_tax * 4) AS rsa, max(l_discount) AS d FROM lineitem GROUP BY l_orderkey, l_linenumber),
    e AS (SELECT *, CASE WHEN d > 0.02 THEN rsa END AS r FROM s)
    SELECT position_id, 'G' || position_id || coalesce(new_aa, 'G') AS change, CASE WHEN r IS NULL THEN NULL WHEN r > {scores.SURFACE_ABOVE} THEN 'Surface' WHEN r > {scores.BURIED_ABOVE} THEN 'Buried' ELSE 'Core' END AS location,
      CASE WHEN d > 0.02 AND d < 0.06 THEN 'Ligand' WHEN r IS NULL THEN NULL WHEN r > {scores.SURFACE_ABOVE} THEN 'Surface' WHEN r > {scores.BURIED_ABOVE} THEN 'Buried' ELSE 'Core' END AS classification
    FROM e JOIN part ON p_partkey = protein_id""")  # fmt: skip
def classification(spark, sf_dir):
    key = (c("l_orderkey") * 10 + c("l_linenumber")).alias("position_id")
    own = items(spark, sf_dir).groupBy(key).agg(F.max(F.when(c("l_returnflag") == "A", "W")).alias("new_aa"), F.any_value("l_partkey").alias("protein_id"), F.max(c("l_tax") * 4).alias("rsa"), F.max("l_discount").alias("d"))
    positions = own.select("position_id", "protein_id", c("position_id").alias("position_number"), F.lit("G").alias("wt"))
    snvs = own.where("new_aa IS NOT NULL").select("position_id", "new_aa")
    kind = F.when(c("d") < 0.06, "Ligand")
    evidence = own.where("d > 0.02").select("position_id", "rsa", kind.alias("interaction_class"), kind.alias("simple_class"), F.lit("s").alias("recommended"), F.lit(1.0).alias("identity"), F.lit(1.0).alias("coverage"), F.lit(2.0).alias("resolution"), F.lit(1).alias("n_mapped"))
    proteins = parts(spark, sf_dir).select(c("p_partkey").alias("protein_id"), c("p_name").alias("primary_id"), c("p_brand").alias("uniprot_ac"))
    return reports.classification(positions, proteins, snvs, evidence).select(c("position_number").alias("position_id"), "change", "location", "classification")


@query("full_annotation", """
    SELECT o_custkey AS structure_id, l_partkey AS position_id, l_linenumber AS residue, count(*) AS n, round(sum(l_tax * c_acctbal), 4) AS weight
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL""")  # fmt: skip
def full_annotation(spark, sf_dir):
    parts = parts_of(items(spark, sf_dir))
    lines = dealt(items(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_tax"), parts, "l_orderkey")
    orders = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), parts, "o_orderkey")
    bridge = lines.join(orders, c("l_orderkey") == c("o_orderkey")).select(c("o_custkey").alias("structure_id"), c("l_linenumber").alias("residue"), c("l_partkey").alias("position_id"), "l_tax")
    bridge = dealt(bridge, parts, "structure_id")
    residues = bridge.select("structure_id", "residue").distinct()
    found = reports.full_annotation(bridge, residues, table(spark, sf_dir, "customer").select(c("c_custkey").alias("structure_id"), "c_acctbal"))
    return found.groupBy("structure_id", "position_id", "residue").agg(F.count("*").alias("n"), F.round(F.sum(c("l_tax") * c("c_acctbal")), 4).alias("weight"))


@query("contact_positions", """
    WITH b AS (SELECT DISTINCT l_orderkey AS s, l_linenumber AS r, l_partkey AS p FROM lineitem), k AS (SELECT s, r AS ra, r + 1 AS rb, CAST(r AS DOUBLE) AS d FROM b WHERE r <= 5)
    SELECT x.p AS position_a, y.p AS position_b, k.s AS structure_id, d AS distance FROM k JOIN b x ON x.s = k.s AND x.r = ra JOIN b y ON y.s = k.s AND y.r = rb""")  # fmt: skip
def contact_positions(spark, sf_dir):
    bridge = items(spark, sf_dir).select(c("l_orderkey").alias("structure_id"), c("l_linenumber").alias("residue"), c("l_partkey").alias("position_id")).distinct()
    contacts = bridge.select("structure_id", c("residue").alias("residue_a"), (c("residue") + 1).alias("residue_b"), c("residue").cast("double").alias("distance"))
    return reports.contact_network(bridge, contacts)


@query("annotated_structures", """
    SELECT o_orderkey AS structure_id, o_orderpriority AS chain FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand = 'Brand#2')""")  # fmt: skip
def annotated_structures(spark, sf_dir):
    session = parts(spark, sf_dir).where("p_brand = 'Brand#2'").select(c("p_partkey").alias("protein_id"))
    chains = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("structure_id"), c("o_orderpriority").alias("chain"), F.when(c("o_orderstatus") == "F", "Protein").otherwise("DNA").alias("kind"))
    return reports.annotated_structures(session, items(spark, sf_dir).select(c("l_partkey").alias("protein_id"), c("l_orderkey").alias("structure_id")), chains).drop("kind")


@query("search_hits", """
    WITH h AS (SELECT l_partkey AS query, l_suppkey % 10 AS s, chr(CAST(65 + l_linenumber AS INTEGER)) AS chain, l_tax * 10 AS f, CAST(l_quantity * 3 AS INTEGER) AS n FROM lineitem),
    u AS (SELECT h.* FROM h JOIN part ON p_partkey = query WHERE f >= 0.35 AND (n >= 50 OR (p_size * 4 < 100 AND f >= 0.7)))
    SELECT query, 'S' || s AS structure, arg_max(chain, {'n': n, 'f': f, 'c': chain}) AS chain, max(n) AS alnlen, string_agg(DISTINCT chain, ',' ORDER BY chain) AS chains FROM u GROUP BY query, s""")  # fmt: skip
def search_hits(spark, sf_dir):
    target = F.concat(F.lit("S"), (c("l_suppkey") % 10).cast("string"), F.lit("-"), F.char((65 + c("l_linenumber")).cast("int")))
    hits = items(spark, sf_dir).select(c("l_partkey").alias("query"), target.alias("targets"), (c("l_tax") * 10).alias("fident"), (c("l_quantity") * 3).cast("int").alias("alnlen"), F.lit(1).alias("tlen"), F.lit(1.0).alias("qcov"))
    found = structures.usable_hits(hits, parts(spark, sf_dir).select(c("p_partkey").alias("query"), (c("p_size") * 4).alias("query_length")))
    return found.select("query", "structure", "chain", "alnlen", F.array_join("chains", ",").alias("chains"))


@query("candidate_scores", """
    SELECT l_orderkey, l_linenumber, l_suppkey, round((1 / (1 + exp(l_quantity - 10)) + CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 / (1 + exp(l_tax * 100 - 10)) END * 2) / 3, 9) AS score, round(4.0 / 3.0 * pi() * l_tax ** 3, 9) AS volume FROM lineitem""")  # fmt: skip
def candidate_scores(spark, sf_dir):
    score = scores.candidate_score("l_quantity", F.when(c("l_returnflag") != "A", c("l_tax") * 100), chain_weight=2.0)
    return items(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_suppkey", F.round(score, 9).alias("score"), F.round(scores.sphere_volume("l_tax"), 9).alias("volume"))


@query("mutation_lines", """
    SELECT p_partkey, 'P' || p_partkey AS protein_id, 'A' || unnest([p_size, p_size + 100]) || 'W' AS change, 'snv' AS kind, 'x' || p_size AS tag FROM part""")  # fmt: skip
def mutation_lines(spark, sf_dir):
    key, size = c("p_partkey").cast("string"), c("p_size")
    line = F.concat(F.lit("P"), key, F.lit("\tA"), size.cast("string"), F.lit("W,A"), (size + 100).cast("string"), F.lit("W  x"), size.cast("string"), F.lit(",gene:g // note"))
    found = inputs.parse_mutation_lines(parts(spark, sf_dir).select(line.alias("value")))
    return found.select(F.substring("protein_id", 2, 20).cast("long").alias("p_partkey"), "protein_id", "change", "kind", F.get("tags", F.lit(0)).alias("tag"))


@query("fasta_records", """
    SELECT 'E' || p_partkey AS entry_id, upper(replace(p_name, ' ', '')) AS sequence, 1 AS n_mutations FROM part""")  # fmt: skip
def fasta_records(spark, sf_dir):
    text = F.concat(F.lit(">E"), c("p_partkey").cast("string"), F.lit(" told\n<A3W t1,t2\n"), F.substring("p_name", 1, 4), F.lit("\n"), F.substring("p_name", 5, 100), F.lit("*\n"))
    found = inputs.parse_fasta_records(parts(spark, sf_dir).select(text.alias("value")))
    return found.select("entry_id", "sequence", F.size("mutations").alias("n_mutations"))


@query("contact_lines", """
    SELECT 'A' AS chain, CAST(l_partkey AS VARCHAR) AS residue, 'B' AS chain_b, CAST(l_suppkey AS VARCHAR) AS residue_b, 'mc' AS side, l_tax AS score FROM lineitem
    UNION ALL SELECT 'B', CAST(l_suppkey AS VARCHAR), 'A', CAST(l_partkey AS VARCHAR), 'sc', l_tax FROM lineitem""")  # fmt: skip
def contact_lines(spark, sf_dir):
    line = F.concat(F.lit("A:"), c("l_partkey").cast("string"), F.lit(":_:ASP (cnt:mc_sc) B:"), c("l_suppkey").cast("string"), F.lit(":_:LEU\t"), c("l_tax").cast("string"))
    return structures.parse_contacts(items(spark, sf_dir).select(line.alias("value"))).select("chain", "residue", "chain_b", "residue_b", "side", "score")


@query("atom_lines", """
    SELECT l_suppkey AS file, CAST(l_partkey % 9999 AS INTEGER) AS res_num, 'CA' AS atom, round(l_tax * 100, 3) AS x, count(*) AS n FROM lineitem GROUP BY ALL""")  # fmt: skip
def atom_lines(spark, sf_dir):
    rows = items(spark, sf_dir).select("l_suppkey", "l_orderkey", "l_partkey", "l_tax", F.monotonically_increasing_id().alias("line"))
    rows = dealt(rows, parts_of(items(spark, sf_dir)), "l_suppkey")
    line = F.format_string("ATOM  %5d  CA  ALA A%4d    %8.3f%8.3f%8.3f  1.00 10.00           C", (c("l_orderkey") % 99999).cast("int"), (c("l_partkey") % 9999).cast("int"), c("l_tax") * 100, c("l_tax"), c("l_tax"))
    found = structures.parse_atoms(rows.select(c("l_suppkey").alias("file"), "line", line.alias("value")), ["file"])
    return found.groupBy("file", "res_num", "atom", "x").agg(F.count("*").alias("n"))


@query("profile_codec", """
    SELECT l_suppkey, string_agg('A_' || l_partkey || ':' || n || '_' || s, ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS profile
    FROM (SELECT l_suppkey, l_partkey, count(*) AS n, CAST(count(*) AS VARCHAR) || '.0' AS s FROM lineitem GROUP BY ALL) GROUP BY l_suppkey""")  # fmt: skip
def profile_codec(spark, sf_dir):
    each = items(spark, sf_dir).groupBy("l_suppkey", "l_partkey").agg(F.count("*").cast("string").alias("n"))
    text = F.concat(F.lit("A_"), c("l_partkey").cast("string"), F.lit(":"), c("n"), F.lit("_"), c("n"), F.lit(".0"))
    whole = each.groupBy("l_suppkey").agg(F.array_join(F.collect_list(text), ",").alias("p"))
    return whole.select("l_suppkey", scores.profile_text(scores.packed_profile("p")).alias("profile"))
