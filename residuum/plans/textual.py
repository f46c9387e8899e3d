"""Parsing of changes, tags, sequences and addresses on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.functions import sequences
from residuum.plans.catalog import query, table

AA = "ACDEFGHIKLMNPQRSTVWY"


@query("hgvs_parse", """
    WITH c AS (SELECT p_partkey, substr('ACDEFGHIKLMNPQRSTVWY', 1 + CAST(p_partkey % 20 AS INTEGER), 1) AS a, substr('ACDEFGHIKLMNPQRSTVWY', 1 + CAST(p_size % 20 AS INTEGER), 1) AS b FROM part)
    SELECT p_partkey, a AS wt, CAST(p_partkey AS INTEGER) AS pos, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE b END AS mut FROM c""")  # fmt: skip
def hgvs_parse(spark, sf_dir):
    letter = lambda c: F.substring(F.lit(AA), 1 + (F.col(c) % 20).cast("int"), F.lit(1))
    text = F.concat(letter("p_partkey"), F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 5 == 0, "").otherwise(letter("p_size")))
    return table(spark, sf_dir, "part").select("p_partkey", sequences.parse_change(text).alias("x")).select("p_partkey", "x.*")


@query("tag_map", r"""
    SELECT event_id, TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k, event_type AS kind FROM events""")  # fmt: skip
def tag_map(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    tags = F.array(F.concat(F.lit("function:"), "event_type"), F.concat(F.lit("#k="), F.get_json_object("props", "$.k")))
    return rows.select("event_id", sequences.tag_value(tags, "k").alias("k"), sequences.function_type(tags).alias("kind"))


@query("sequence_apply", """
    SELECT p_partkey, substr(p_name, 1, 2) || 'Q' || substr(p_name, 4) AS changed, substr(p_name, 1, 2) || substr(p_name, 6) AS deleted, substr(p_name, 1, 3) || 'WW' || substr(p_name, 4) AS inserted, len(list_distinct(string_split(p_name, ''))) >= 5 AS valid
    FROM part WHERE length(p_name) > 6""")  # fmt: skip
def sequence_apply(spark, sf_dir):
    indel = lambda kind, l, r, x: F.struct(F.lit(kind).alias("kind"), F.lit(l).alias("left"), F.lit(r).alias("right"), F.lit(x).alias("inserted"))
    rows = table(spark, sf_dir, "part").where(F.length("p_name") > 6)
    return rows.select("p_partkey", sequences.apply_change("p_name", F.lit(3), F.lit("Q")).alias("changed"), sequences.apply_indel("p_name", indel("deletion", 3, 5, "")).alias("deleted"), sequences.apply_indel("p_name", indel("insertion", 3, 4, "WW")).alias("inserted"), sequences.is_valid_sequence("p_name").alias("valid"))


@query("aligned_identity", """
    WITH p AS (SELECT p_partkey, replace(p_name, 'a', '-') AS x, replace(p_type, 'E', '-') AS y FROM part),
    z AS (SELECT p_partkey, x, unnest(list_zip(string_split(x, ''), string_split(y, ''))) AS t FROM p),
    n AS (SELECT p_partkey, sum(CASE WHEN t[1] IS NOT NULL AND t[2] IS NOT NULL AND t[1] <> '-' AND t[2] <> '-' THEN 1 ELSE 0 END) AS n, sum(CASE WHEN t[1] <> '-' AND t[1] = t[2] THEN 1 ELSE 0 END) AS same, any_value(length(x)) AS len FROM z GROUP BY p_partkey)
    SELECT p_partkey, CASE WHEN n > 0 THEN round(same / n, 9) END AS identity, round(n / len, 9) AS coverage FROM n""")  # fmt: skip
def aligned_identity(spark, sf_dir):
    x, y = F.replace("p_name", F.lit("a"), F.lit("-")), F.replace("p_type", F.lit("E"), F.lit("-"))
    found = table(spark, sf_dir, "part").select("p_partkey", sequences.identity_and_coverage(x, y, F.length(x)).alias("r"))
    return found.select("p_partkey", F.round("r.identity", 9).alias("identity"), F.round("r.coverage", 9).alias("coverage"))


@query("property_change", """
    WITH c AS (SELECT p_partkey, substr('ACDEFGHIKLMNPQRSTVWY', 1 + CAST(p_partkey % 20 AS INTEGER), 1) AS a, substr('ACDEFGHIKLMNPQRSTVWY', 1 + CAST(p_size % 20 AS INTEGER), 1) AS b FROM part)
    SELECT p_partkey, contains('ILV', a) <> contains('ILV', b) AS aliphatic, contains('FYWH', a) <> contains('FYWH', b) AS aromatic, contains('HKRDE', a) <> contains('DE', b) AS charged, contains('GCUAS', a) <> contains('GCUAS', b) AS tiny FROM c""")  # fmt: skip
def property_change(spark, sf_dir):
    letter = lambda c: F.substring(F.lit(AA), 1 + (F.col(c) % 20).cast("int"), F.lit(1))
    rows = table(spark, sf_dir, "part").select("p_partkey", sequences.property_changes(letter("p_partkey"), letter("p_size")).alias("x"))
    return rows.select("p_partkey", "x.aliphatic", "x.aromatic", "x.charged", "x.tiny")


@query("url_hosts", r"""
    SELECT regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, count(*) AS n, CAST(sum(CASE WHEN url LIKE 'https:%' THEN 1 ELSE 0 END) AS BIGINT) AS secure FROM pages GROUP BY host""")  # fmt: skip
def url_hosts(spark, sf_dir):
    host = F.regexp_extract("url", r"^https?://([^/:?#]+)", 1)
    return table(spark, sf_dir, "pages").groupBy(host.alias("host")).agg(F.count("*").alias("n"), F.sum(F.col("url").startswith("https:").cast("long")).alias("secure"))
