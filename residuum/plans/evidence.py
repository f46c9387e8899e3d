"""Evidence of structures about positions: aggregates, classes, recommendations.

On the supplied tables a position is a part, a structure that covers it a supplier, and a
mapping of both a line item.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.functions import scores
from residuum.operators import aggregates, profiles
from residuum.plans.catalog import query, table

MAPPED = """mapped AS (
  SELECT l_partkey AS position_id, l_suppkey AS structure_id, l_orderkey AS o, l_linenumber AS n,
         CASE WHEN l_quantity <> 13 THEN l_quantity END AS v, l_extendedprice / 100000 AS quality,
         1 - l_discount * 5 AS coverage, l_discount * 2 AS rsa, l_returnflag AS label, l_linestatus AS status,
         l_quantity / 5 AS dist, l_quantity > 25 AS flag
  FROM lineitem)
"""


def mapped(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        c("l_partkey").alias("position_id"), c("l_suppkey").alias("structure_id"), c("l_orderkey").alias("o"), c("l_linenumber").alias("n"),
        F.when(c("l_quantity") != 13, c("l_quantity")).alias("v"), (c("l_extendedprice") / 100000).alias("quality"),
        (1 - c("l_discount") * 5).alias("coverage"), (c("l_discount") * 2).alias("rsa"), c("l_returnflag").alias("label"), c("l_linestatus").alias("status"),
        (c("l_quantity") / 5).alias("dist"), (c("l_quantity") > 25).alias("flag"),
    )


@query("weighted_mean_conf", f"""
    WITH {MAPPED}
    SELECT position_id, round(sum(v * quality) / sum(CASE WHEN v IS NOT NULL THEN quality END), 6) AS mean,
      CASE WHEN count(v) > 0 THEN round((1 - 1.0 / (count(v) + 1)) * (max(CASE WHEN v IS NOT NULL THEN quality END) + median(CASE WHEN v IS NOT NULL THEN quality END)) / 2, 6) ELSE 0 END AS confidence,
      round(sum(CASE WHEN dist <= 8 THEN dist * quality END) / sum(CASE WHEN dist <= 8 THEN quality END), 6) AS distance
    FROM mapped GROUP BY position_id""")  # fmt: skip
def weighted_mean_conf(spark, sf_dir):
    return mapped(spark, sf_dir).groupBy("position_id").agg(
        F.round(aggregates.weighted_mean("v", "quality"), 6).alias("mean"),
        F.round(aggregates.confidence("v", "quality"), 6).alias("confidence"),
        F.round(aggregates.weighted_distance("dist", "quality"), 6).alias("distance"),
    )


@query("propensity", """
    SELECT source, round(count(quality) / count(*), 9) AS labelled, round(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) / count(*), 9) AS good
    FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id) GROUP BY source""")  # fmt: skip
def propensity(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return rows.groupBy("source").agg(F.round(aggregates.propensity("quality"), 9).alias("labelled"), F.round(aggregates.bool_propensity(F.col("quality") == 1), 9).alias("good"))


@query("weighted_majority", f"""
    WITH {MAPPED}, w AS (SELECT position_id, label, sum(quality) AS w FROM mapped GROUP BY position_id, label),
    r AS (SELECT *, row_number() OVER (PARTITION BY position_id ORDER BY w DESC, label) AS k FROM w)
    SELECT position_id, label AS majority FROM r WHERE k = 1""")  # fmt: skip
def weighted_majority(spark, sf_dir):
    return aggregates.weighted_majority(mapped(spark, sf_dir), ["position_id"], "label", "quality")


@query("region_majority", f"""
    WITH {MAPPED}, w AS (SELECT position_id, status, count(*) AS w FROM mapped GROUP BY position_id, status),
    r AS (SELECT *, row_number() OVER (PARTITION BY position_id ORDER BY w DESC, status DESC) AS k FROM w)
    SELECT position_id, status AS majority FROM r WHERE k = 1""")  # fmt: skip
def region_majority(spark, sf_dir):
    rows = mapped(spark, sf_dir).withColumn("one", F.lit(1))
    return aggregates.weighted_majority(rows, ["position_id"], "status", "one", last=True)


@query("exposure_change", f"""
    WITH {MAPPED}, c AS (SELECT *, CASE WHEN rsa > 0.16 THEN 'Surface' WHEN rsa > 0.05 THEN 'Buried' ELSE 'Core' END AS place FROM mapped)
    SELECT position_id, round(sum(CASE WHEN place <> 'Surface' THEN 1 ELSE 0 END) / count(*), 9) AS change,
      CASE WHEN count(rsa) = 1 THEN 0 ELSE round(stddev_samp(rsa), 9) END AS spread, sum(CASE WHEN place = 'Core' THEN 1 ELSE 0 END) AS n_core
    FROM c GROUP BY position_id""")  # fmt: skip
def exposure_change(spark, sf_dir):
    rows = mapped(spark, sf_dir)
    return rows.groupBy("position_id").agg(
        F.round(aggregates.exposure_change("rsa"), 9).alias("change"),
        F.round(aggregates.spread("rsa"), 9).alias("spread"),
        F.sum((scores.locate("rsa") == "Core").cast("long")).alias("n_core"),
    )


@query("locate_class", """
    SELECT place, count(*) AS n, count(DISTINCT l_partkey) AS positions, round(avg(d), 9) AS mean FROM (
      SELECT l_partkey, nullif(l_discount, 0.03) AS d, CASE WHEN nullif(l_discount, 0.03) IS NULL THEN NULL WHEN l_discount > 0.08 THEN 'Surface' WHEN l_discount > 0.05 THEN 'Buried' ELSE 'Core' END AS place FROM lineitem)
    GROUP BY place""")  # fmt: skip
def locate_class(spark, sf_dir):
    d = F.nullif(F.col("l_discount"), F.lit(0.03))
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", d.alias("d"))
    return rows.groupBy(scores.locate("d", surface=0.08, buried=0.05).alias("place")).agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("positions"), F.round(F.avg("d"), 9).alias("mean"))


@query("feature_registry", f"""
    WITH {MAPPED}
    SELECT position_id, round(sum(CASE WHEN dist <= 8 THEN dist * quality END) / sum(CASE WHEN dist <= 8 THEN quality END), 6) AS dist,
      round(sum(v * quality) / sum(CASE WHEN v IS NOT NULL THEN quality END), 6) AS v, round(sum(CASE WHEN flag THEN 1 ELSE 0 END) / count(*), 9) AS flag,
      round(sum(rsa * quality * coverage * coverage) / sum(quality * coverage * coverage), 6) AS rsa
    FROM mapped GROUP BY position_id""")  # fmt: skip
def feature_registry(spark, sf_dir):
    kinds = {"dist": "distance", "v": "number", "flag": "flag", "rsa": "exposure"}
    found = mapped(spark, sf_dir).groupBy("position_id").agg(*aggregates.feature_aggregates(kinds))
    return found.select("position_id", *(F.round(k, 9 if k == "flag" else 6).alias(k) for k in kinds))


@query("profile_average", f"""
    WITH {MAPPED}, t AS (SELECT position_id, sum(w) AS total FROM (SELECT DISTINCT position_id, structure_id, structure_id % 7 + 1 AS w FROM mapped) GROUP BY position_id)
    SELECT position_id, label AS side, status AS bond, round(sum(dist * (structure_id % 7 + 1)) / any_value(total), 9) AS score
    FROM mapped JOIN t USING (position_id) GROUP BY position_id, label, status""")  # fmt: skip
def profile_average(spark, sf_dir):
    rows = mapped(spark, sf_dir).select("position_id", "structure_id", F.col("label").alias("side"), F.col("status").alias("bond"), F.col("dist").alias("score"), (F.col("structure_id") % 7 + 1).alias("w"))
    found = aggregates.profile_mean(rows, ["position_id"], "structure_id", "w", ["side", "bond"], ["score"])
    return found.select("position_id", "side", "bond", F.round("score", 9).alias("score"))


@query("centrality_mean", f"""
    WITH {MAPPED}
    SELECT position_id, round(sum(coalesce(v, 0) * quality) / sum(quality), 6) AS centrality FROM mapped WHERE flag GROUP BY position_id""")  # fmt: skip
def centrality_mean(spark, sf_dir):
    found = mapped(spark, sf_dir).groupBy("position_id").agg(aggregates.centrality_mean("v", "quality", F.col("flag")).alias("c"))
    return found.where("c IS NOT NULL").select("position_id", F.round("c", 6).alias("centrality"))


@query("quality_score", """
    SELECT p_partkey, round((0.25 / (1 + exp(1.5 * coalesce(nullif(p_size, 7) / 10.0, 3.0) - 4)) + 0.5 * (p_retailprice / 10000) + 1 / (1 + exp(10 * (0.4 - p_size / 50.0)))) / 1.75, 9) AS quality,
      p_size * 2 >= 35 AND coalesce(nullif(p_size, 7) / 10.0 <= 4.5, false) AS usable
    FROM part""")  # fmt: skip
def quality_score(spark, sf_dir):
    resolution = F.nullif(F.col("p_size"), F.lit(7)) / 10.0
    own = scores.quality(resolution, F.col("p_retailprice") / 10000, F.col("p_size") / 50.0)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(own, 9).alias("quality"), scores.is_usable_template((F.col("p_size") * 2).cast("double") + 0.0, resolution).alias("usable"))


@query("recommend_tiers", f"""
    WITH {MAPPED}, j AS (SELECT m.*, label = 'N' AS same_letter, p_size % 2 = 0 AS same_class FROM mapped m JOIN part ON position_id = p_partkey),
    r AS (SELECT *, CASE WHEN same_letter AND same_class THEN 1 WHEN same_class THEN 2 WHEN same_letter THEN 3 ELSE 4 END AS tier FROM j),
    k AS (SELECT *, row_number() OVER (PARTITION BY position_id ORDER BY tier, quality DESC, structure_id DESC, o DESC, n DESC, v DESC) AS preference FROM r)
    SELECT position_id, structure_id, tier, round(quality, 7) AS quality FROM k WHERE preference = 1""")  # fmt: skip
def recommend_tiers(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("position_id"), (F.col("p_size") % 2 == 0).alias("same_class"))
    rows = mapped(spark, sf_dir).join(part, "position_id").withColumn("same_letter", F.col("label") == "N")
    found = aggregates.recommend(rows, ["position_id"], same_letter="same_letter", same_class="same_class", quality="quality", order=["structure_id", "o", "n", "v"])
    return found.where("preference = 1").select("position_id", "structure_id", "tier", F.round("quality", 7).alias("quality"))


@query("consensus_rank", f"""
    WITH {MAPPED}, c AS (SELECT position_id % 50 AS g, position_id, label, count(*) AS n FROM mapped GROUP BY ALL),
    t AS (SELECT g, position_id, sum(n) AS a, count(*) AS kinds, max(n) AS top FROM c GROUP BY g, position_id),
    b AS (SELECT g, position_id, label, row_number() OVER (PARTITION BY position_id ORDER BY n DESC, label) AS k FROM c),
    ok AS (SELECT b.g, b.position_id, b.label FROM b JOIN t ON b.position_id = t.position_id WHERE k = 1 AND top / a > 1.0 / kinds),
    s AS (SELECT ok.g, structure_id, CAST(sum(CASE WHEN m.label = ok.label THEN 1 ELSE 0 END) AS BIGINT) AS score FROM mapped m JOIN ok ON m.position_id = ok.position_id GROUP BY ok.g, structure_id)
    SELECT g AS protein, structure_id, score, rank() OVER (PARTITION BY g ORDER BY score DESC) + (count(*) OVER (PARTITION BY g, score) - 1) / 2.0 AS rank FROM s""")  # fmt: skip
def consensus_rank(spark, sf_dir):
    rows = mapped(spark, sf_dir).withColumn("protein", F.col("position_id") % 50)
    return aggregates.consensus_rank(rows, "protein", "position_id", "structure_id", "label")


@query("edge_profile", """
    WITH e AS (
      SELECT l_orderkey AS residue, l_returnflag AS side, l_linestatus AS bond, l_quantity AS score,
        CASE WHEN l_suppkey % 11 = 0 THEN 'ligand' WHEN l_suppkey % 13 = 0 THEN 'metal' WHEN l_partkey % 2 = 1 THEN 'Protein'
             WHEN abs(l_linenumber - 3) < 2 THEN 'neighbor' WHEN abs(l_linenumber - 3) < 6 THEN 'short' ELSE 'long' END AS partner
      FROM lineitem)
    SELECT residue, side, bond, partner, count(*) AS degree, sum(score) AS score FROM e GROUP BY ALL""")  # fmt: skip
def edge_profile(spark, sf_dir):
    c = F.col
    kind = profiles.partner_type(ligand=c("l_suppkey") % 11 == 0, metal=c("l_suppkey") % 13 == 0, ion=F.lit(False), same_chain=c("l_partkey") % 2 == 0, chain_type=F.lit("Protein"), gap=c("l_linenumber") - 3)
    edges = table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("residue"), c("l_returnflag").alias("side"), c("l_linestatus").alias("bond"), c("l_quantity").alias("score"), kind.alias("partner"))
    return profiles.edge_profile(edges, ["residue"])


@query("interaction_class", """
    WITH e AS (
      SELECT user_id, CASE event_id % 2 WHEN 0 THEN 'mc' ELSE 'sc' END AS side, CASE event_id % 3 WHEN 0 THEN 'cnt' WHEN 1 THEN 'hbond' ELSE 'ovl' END AS bond,
        CASE event_type WHEN 'click' THEN 'ligand' WHEN 'view' THEN 'Protein' WHEN 'purchase' THEN 'DNA' ELSE 'RNA' END AS partner, value FROM events),
    p AS (SELECT user_id, side, bond, partner, sum(value) AS score FROM e GROUP BY ALL),
    b AS (SELECT *, row_number() OVER (PARTITION BY user_id, partner ORDER BY score DESC, side, bond) AS k FROM p WHERE bond <> 'ovl' AND score > 0),
    n AS (SELECT user_id, score, partner, CASE partner WHEN 'ligand' THEN 1 WHEN 'Protein' THEN 4 WHEN 'DNA' THEN 5 ELSE 6 END AS place, side || ' ' || bond || ' ' || partner AS name FROM b WHERE k = 1)
    SELECT user_id, CASE WHEN count(*) > 1 THEN 'Multi interaction: ' ELSE '' END || string_agg(name, ' and ' ORDER BY place) AS interaction_class,
      arg_max(partner, {'s': score, 'p': -place}) || ' interaction' AS simple_class
    FROM n GROUP BY user_id""")  # fmt: skip
def interaction_class(spark, sf_dir):
    e = F.col("event_id")
    kind = F.when(F.col("event_type") == "click", "ligand").when(F.col("event_type") == "view", "Protein").when(F.col("event_type") == "purchase", "DNA").otherwise("RNA")
    edges = table(spark, sf_dir, "events").select("user_id", F.when(e % 2 == 0, "mc").otherwise("sc").alias("side"), F.when(e % 3 == 0, "cnt").when(e % 3 == 1, "hbond").otherwise("ovl").alias("bond"), kind.alias("partner"), F.col("value").alias("score"))
    return profiles.interaction_class(profiles.edge_profile(edges, ["user_id"]), ["user_id"])


@query("shortest_partner", """
    WITH d AS (SELECT l_partkey AS position_id, l_returnflag AS kind, l_suppkey AS partner, nullif(l_quantity, 1) AS distance FROM lineitem)
    SELECT position_id, kind, min(distance) AS distance, arg_min(partner, {'d': distance, 'p': partner}) AS partner, coalesce(min(distance), 2.0) >= 1.2 AS fits
    FROM d WHERE distance IS NOT NULL GROUP BY position_id, kind""")  # fmt: skip
def shortest_partner(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("position_id"), F.col("l_returnflag").alias("kind"), F.col("l_suppkey").alias("partner"), F.nullif(F.col("l_quantity"), F.lit(1.0)).alias("distance"))
    return profiles.shortest_partners(rows, ["position_id"]).withColumn("fits", scores.does_not_clash("distance"))


@query("ppi_rollup", """
    WITH c AS (SELECT l_partkey % 97 AS a, l_suppkey % 89 AS b, l_returnflag AS complex, l_linestatus AS chain, count(*) AS n, sum(l_quantity) AS s FROM lineitem GROUP BY ALL),
    r AS (SELECT a, b, complex, chain, sum(s) OVER (PARTITION BY a, b) AS score, row_number() OVER (PARTITION BY a, b ORDER BY n DESC, complex, chain) AS k FROM c),
    t AS (SELECT a, b, score, complex, chain FROM r WHERE k = 1)
    SELECT a, b, score, complex, chain FROM t UNION ALL SELECT b, a, score, complex, chain FROM t WHERE a <> b""")  # fmt: skip
def ppi_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 97).alias("a"), (F.col("l_suppkey") % 89).alias("b"), F.col("l_quantity").alias("s"), F.col("l_returnflag").alias("complex"), F.col("l_linestatus").alias("chain"))
    return profiles.interaction_rollup(rows, "a", "b", "s", ["complex", "chain"])


@query("pair_mutation_score", """
    WITH x AS (SELECT l_orderkey, CASE l_linestatus WHEN 'O' THEN 0.5 ELSE 1.0 END * CASE l_returnflag WHEN 'A' THEN 0.8 WHEN 'N' THEN 1.0 ELSE 0.0 END AS s, l_tax AS ins FROM lineitem)
    SELECT l_orderkey, round(sqrt(sum(s * s)) + sum(ins), 6) AS score FROM x GROUP BY l_orderkey""")  # fmt: skip
def pair_mutation_score(spark, sf_dir):
    kind = F.when(F.col("l_linestatus") == "O", "substitution").otherwise("deletion")
    function = F.when(F.col("l_returnflag") == "A", "Core").when(F.col("l_returnflag") == "N", "Protein interaction").otherwise("Surface")
    s = scores.position_score(kind, function)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.round(F.sqrt(F.sum(s * s)) + F.sum("l_tax"), 6).alias("score"))


@query("major_structure", """
    WITH c AS (SELECT l_partkey % 200 AS protein, l_suppkey, sum(l_tax * 10 + 1) AS w FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY protein ORDER BY round(w, 6) DESC, l_suppkey DESC) AS k FROM c)
    SELECT protein, l_suppkey AS structure_id, round(w, 6) AS votes FROM r WHERE k = 1""")  # fmt: skip
def major_structure(spark, sf_dir):
    votes = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 200).alias("protein"), "l_suppkey").agg(F.round(F.sum(F.col("l_tax") * 10 + 1), 6).alias("w"))
    return votes.groupBy("protein").agg(F.max_by("l_suppkey", F.struct("w", "l_suppkey")).alias("structure_id"), F.max("w").alias("votes"))


@query("class_distribution", """
    WITH e AS (SELECT unnest(['total', o_orderpriority]) AS tag, o_orderstatus AS s FROM orders)
    SELECT tag, count(*) AS n, round(sum(CASE WHEN s = 'F' THEN 1 ELSE 0 END) / count(*), 9) AS "F", round(sum(CASE WHEN s = 'O' THEN 1 ELSE 0 END) / count(*), 9) AS "O", round(sum(CASE WHEN s = 'P' THEN 1 ELSE 0 END) / count(*), 9) AS "P"
    FROM e GROUP BY tag""")  # fmt: skip
def class_distribution(spark, sf_dir):
    found = aggregates.shares(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])
    return found.select("tag", "n", *(F.round(x, 9).alias(x) for x in "FOP"))


@query("hist50", """
    WITH r AS (SELECT min(value) AS low, (max(value) - min(value)) / 50 AS w FROM events)
    SELECT event_type, CAST(floor((value - low) / w) AS INTEGER) AS bin, count(*) AS n FROM events, r WHERE floor((value - low) / w) < 50 GROUP BY event_type, bin""")  # fmt: skip
def hist50(spark, sf_dir):
    return aggregates.histogram(table(spark, sf_dir, "events"), ["event_type"], "value")


@query("tag_statistics", """
    WITH e AS (SELECT event_id, user_id, value, unnest(['All', event_type]) AS tag FROM events),
    b AS (SELECT tag, user_id, max(CASE WHEN value >= 90 THEN 3 WHEN value >= 50 THEN 2 WHEN value >= 10 THEN 1 ELSE 0 END) AS best FROM e GROUP BY tag, user_id)
    SELECT p.tag, p.positions, p.mapped, b.proteins, b.same, b.homolog, b.model, b.unmapped FROM
      (SELECT tag, count(*) AS positions, CAST(sum(CASE WHEN value >= 10 THEN 1 ELSE 0 END) AS BIGINT) AS mapped FROM e GROUP BY tag) p JOIN
      (SELECT tag, count(*) AS proteins, CAST(sum(CASE best WHEN 3 THEN 1 ELSE 0 END) AS BIGINT) AS same, CAST(sum(CASE best WHEN 2 THEN 1 ELSE 0 END) AS BIGINT) AS homolog, CAST(sum(CASE best WHEN 1 THEN 1 ELSE 0 END) AS BIGINT) AS model, CAST(sum(CASE best WHEN 0 THEN 1 ELSE 0 END) AS BIGINT) AS unmapped FROM b GROUP BY tag) b USING (tag)""")  # fmt: skip
def tag_statistics(spark, sf_dir):
    from residuum.plans.reports import statistics

    v = F.col("value")
    level = F.when(v >= 90, "same").when(v >= 50, "homolog").when(v >= 10, "model").otherwise("unmapped")
    rows = table(spark, sf_dir, "events").select(F.array("event_type").alias("tags"), F.col("user_id").alias("protein"), level.alias("level"))
    return statistics(rows)


@query("strata_cube", """
    WITH b AS (SELECT CASE WHEN l_discount > 0.07 THEN 'high' ELSE 'low' END AS site, CASE WHEN l_quantity > 45 THEN 'q90' WHEN l_quantity > 25 THEN 'q50' ELSE 'rest' END AS seq, l_tax AS t, l_quantity AS w FROM lineitem)
    SELECT site, seq, grouping(site) * 2 + grouping(seq) AS level, round(sum(t * w) / sum(w), 9) AS mean, count(*) AS n FROM b GROUP BY CUBE (site, seq)""")  # fmt: skip
def strata_cube(spark, sf_dir):
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_discount") > 0.07, "high").otherwise("low").alias("site"), F.when(q > 45, "q90").when(q > 25, "q50").otherwise("rest").alias("seq"), F.col("l_tax").alias("t"), q.alias("w"))
    return rows.cube("site", "seq").agg(F.grouping_id().alias("level"), F.round(F.sum(F.col("t") * F.col("w")) / F.sum("w"), 9).alias("mean"), F.count("*").alias("n"))


@query("term_summary", """
    SELECT n_name AS term, n_nationkey AS ext_id, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 6) AS mean, count(DISTINCT c_custkey) AS genes, round(sum(o_totalprice) / (SELECT count(*) FROM customer), 6) AS normalized
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey""")  # fmt: skip
def term_summary(spark, sf_dir):
    from residuum.plans.reports import sorted_terms, terms

    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("gene"), "c_nationkey")
    own = customers.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("gene", F.col("n_name").alias("term"), F.col("n_nationkey").alias("ext_id"))
    scored = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("gene"), F.col("o_totalprice").alias("score"))
    found = sorted_terms(terms(scored, own, customers.select(F.count("*").alias("size"))))
    return found.select("term", "ext_id", F.round("total", 2).alias("total"), F.round("mean", 6).alias("mean"), "genes", F.round("normalized", 6).alias("normalized"))
