"""Coordinate text, contact edges, centralities and search hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residuum.functions.scores import col, is_usable_hit


def parse_atoms(lines: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """Atoms of fixed-width coordinate lines: the first model, the first alternate place.

    ``keys`` name the file, and ``line`` the order within it.
    """
    text = col(column)
    part = lambda a, b: F.trim(F.substring(text, a, b - a + 1))
    first_end = lines.where(text.startswith("ENDMDL")).groupBy(*keys).agg(F.min("line").alias("_end"))
    rows = lines.join(first_end, keys, "left")
    rows = rows.where(F.col("_end").isNull() | (F.col("line") < F.col("_end"))).where(text.rlike("^(ATOM|HETATM)") & F.substring(text, 17, 1).isin(" ", "A", "1"))
    return rows.select(
        *keys, F.when(text.startswith("HETATM"), "HETATM").otherwise("ATOM").alias("record"), part(7, 11).try_cast("int").alias("serial"), part(13, 16).alias("atom"), part(18, 20).alias("res_name"),
        part(22, 22).alias("chain"), part(23, 26).try_cast("int").alias("res_num"), part(27, 27).alias("ins_code"),
        *(part(a, a + 7).try_cast("double").alias(c) for c, a in (("x", 31), ("y", 39), ("z", 47))), part(61, 66).try_cast("double").alias("b_factor"), part(77, 78).alias("element"),
    )


def parse_header(lines: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """Resolution of each file, from its remark; null if it has none."""
    text = col(column)
    value = F.regexp_extract(text, r"^REMARK   2 RESOLUTION\.\s+([0-9.]+) ANGSTROMS", 1).try_cast("double")
    return lines.groupBy(*keys).agg(F.min(value).alias("resolution"))


def residue_sequence(atoms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chain, sequence) of the residues in the order of their first atoms."""
    from residuum.functions.sequences import three_to_one

    own = atoms.where(F.col("record") == "ATOM").groupBy(*keys, "chain", "res_num", "ins_code").agg(F.min("serial").alias("s"), F.min_by("res_name", "serial").alias("name"))
    letters = F.array_sort(F.collect_list(F.struct("s", three_to_one("name").alias("l"))))
    return own.groupBy(*keys, "chain").agg(F.array_join(F.transform(letters, lambda x: x["l"]), "").alias("sequence"))


def mean_b_factor(atoms: DataFrame, keys: list[str]) -> DataFrame:
    return atoms.groupBy(*keys, "chain", "res_num", "ins_code").agg(F.avg("b_factor").alias("b_factor"))


def parse_contacts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Directed edges of lines ``A:39:_:ASP (cnt:mc_sc) A:41:_:LEU<tab>2.22``: both directions, each with its own side."""
    text = col(column)
    pattern = r"^(\S+):(\S+):(\S+):(\S+) \((\w+):(\w+)_(\w+)\) (\S+):(\S+):(\S+):(\S+)\t(\S+)"
    names = ["chain", "residue", "ins", "name", "bond", "side", "side_b", "chain_b", "residue_b", "ins_b", "name_b", "score"]
    part = lambda i: F.regexp_extract(text, pattern, i + 1)
    rows = lines.where(text.rlike(pattern)).select(*(part(i).alias(n) for i, n in enumerate(names))).withColumn("score", F.col("score").try_cast("double"))
    forth = rows.select("chain", "residue", "chain_b", "residue_b", "bond", "side", "score", "name", "name_b")
    back = rows.select(F.col("chain_b").alias("chain"), F.col("residue_b").alias("residue"), F.col("chain").alias("chain_b"), F.col("residue").alias("residue_b"), "bond", F.col("side_b").alias("side"), "score", F.col("name_b").alias("name"), F.col("name").alias("name_b"))
    return forth.unionByName(back)


def read_contacts(spark: SparkSession, path: str) -> DataFrame:
    return parse_contacts(spark.read.text(path))


def read_centralities(spark: SparkSession, path: str) -> DataFrame:
    """Residue and twelve centralities, ``None`` as null."""
    schema = "residue string, " + ", ".join(f"c{i} double" for i in range(12))
    return spark.read.schema(schema).option("sep", "\t").option("comment", "#").option("nullValue", "None").csv(path)


def usable_hits(hits: DataFrame, lengths: DataFrame, *, threshold: float = 0.35) -> DataFrame:
    """(query, structure, chain, identity, ...) of search hits (query, targets, fident, alnlen, tlen, qcov).

    A target names several chains; for each structure and query the chain of the longest
    alignment stays, with all chains that were hit.
    """
    rows = hits.join(lengths, "query").where(is_usable_hit("alnlen", "query_length", "fident", threshold=threshold))
    each = rows.withColumn("target", F.explode(F.split("targets", ","))).withColumn("structure", F.substring_index("target", "-", 1)).withColumn("chain", F.substring_index("target", "-", -1))
    return each.groupBy("query", "structure").agg(F.max_by(F.struct("chain", "fident", "alnlen", "tlen", "qcov"), F.struct("alnlen", "fident", "chain")).alias("x"), F.array_sort(F.collect_set("chain")).alias("chains")).select("query", "structure", "x.*", "chains")


def parse_matrix(lines: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """(keys, a, b, score) of substitution matrices as they are published: ``#`` comments, a line of symbols, a line of scores for each symbol.

    ``lines`` has (keys, line, text); ``keys`` name the file, and ``line`` is the order within it.
    """
    text = F.trim(col(column))
    rows = lines.where((text != "") & ~text.startswith("#")).select(*keys, "line", F.split(text, r"\s+").alias("w"))
    head = rows.groupBy(*keys).agg(F.min_by("w", "line").alias("symbols"), F.min("line").alias("_first"))
    body = rows.join(head, keys).where(F.col("line") > F.col("_first"))
    each = body.select(*keys, F.get("w", F.lit(0)).alias("a"), F.posexplode("symbols").alias("i", "b"), "w")
    return each.select(*keys, "a", "b", F.get("w", F.col("i") + 1).try_cast("double").alias("score")).where("score IS NOT NULL")


def matrix_rows(scores: DataFrame, keys: list[str], symbols: str) -> DataFrame:
    """(keys, symbol, row): the scores of each of ``symbols`` with all of them in this order, the matrix's least where one is missing."""
    order = F.array(*map(F.lit, symbols))
    least = scores.groupBy(*keys).agg(F.min("score").alias("_least"))
    own = scores.where(F.col("a").isin(*symbols) & F.col("b").isin(*symbols)).groupBy(*keys, F.col("a").alias("symbol"), F.col("b")).agg(F.max("score").alias("score"))
    found = own.groupBy(*keys, "symbol").agg(F.map_from_entries(F.collect_list(F.struct("b", "score"))).alias("_m")).join(least, keys)
    return found.select(*keys, "symbol", F.transform(order, lambda s: F.coalesce(F.try_element_at("_m", s), F.col("_least"))).alias("row"))
