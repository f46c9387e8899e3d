"""Text of tools and databases about residues: accessibility, bonds, pockets, disorder, ligands, sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from residuum.functions.scores import col
from residuum.functions.sequences import as_map

# Greatest accessible area of each letter in square Å (Sander, Rost 1994), and of an unknown one.
MAX_AREA = {
    "A": 106.0, "R": 248.0, "N": 157.0, "D": 163.0, "C": 135.0, "Q": 198.0, "E": 194.0, "G": 84.0, "H": 184.0, "I": 169.0,
    "L": 164.0, "K": 205.0, "M": 188.0, "F": 197.0, "P": 136.0, "S": 130.0, "T": 142.0, "W": 227.0, "Y": 222.0, "V": 142.0, "X": 220.0,
}


def _part(text: Column, first: int, last: int) -> Column:
    """Characters ``first`` to ``last``, counted from 1, without white space around them."""
    return F.trim(F.substring(text, first, last - first + 1))


def parse_accessibility(lines: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """(keys, chain, residue, aa, secondary, rsa, main_chain, side_chain, phi, psi) of accessibility tables in fixed columns.

    ``lines`` has (keys, line, text). Rows follow the line that begins with ``#``; without
    one, or in a short line or one without a residue number, there is none. Areas are shares
    of the letter's greatest one; a lower-case letter is a bridged cysteine. What is no number
    is null, and so are the angles of a line that ends before them.
    """
    text = col(column)
    head = lines.where(F.ltrim(text).startswith("#")).groupBy(*keys).agg(F.min("line").alias("_head"))
    rows = lines.join(head, keys).where((F.col("line") > F.col("_head")) & (F.length(text) >= 46) & (F.substring(text, 10, 1) != " "))
    letter = F.substring(text, 14, 1)
    aa = F.when(letter.rlike("^[a-z]$"), "C").otherwise(letter)
    most = as_map(MAX_AREA)[aa]
    share = lambda a, b: (_part(text, a, b).try_cast("double") / most)
    angle = lambda a, b: F.when(F.length(text) > 123, _part(text, a, b).try_cast("double"))
    return rows.select(*keys, F.substring(text, 12, 1).alias("chain"), F.replace(F.substring(text, 6, 6), F.lit(" "), F.lit("")).alias("residue"), aa.alias("aa"), F.substring(text, 17, 1).alias("secondary"), share(35, 38).alias("rsa"), share(39, 42).alias("main_chain"), share(43, 46).alias("side_chain"), angle(112, 117).alias("phi"), angle(118, 123).alias("psi"))


def parse_bonds(lines: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """(keys, kind, chain, residue, name, atom, chain_b, residue_b, name_b, atom_b, value) of coordinate headers, in both directions.

    Kinds: ``ssbond`` and ``link`` with their length, ``cis`` with the angle (``cis_follower``
    in the other direction). Of links with alternate places only those of the file's first one count.
    """
    text = col(column)
    value = lambda a, b: _part(text, a, b).try_cast("double")
    rows = lines.where(text.rlike("^(SSBOND|LINK  |CISPEP)"))
    is_bond, is_link = text.startswith("SSBOND"), text.startswith("LINK")
    pick = lambda bond, link, cis: F.when(is_bond, bond).when(is_link, link).otherwise(cis)
    none = F.lit(None).cast("string")
    alternates = F.array_remove(F.array(F.substring(text, 17, 1), F.substring(text, 47, 1)), " ")
    first = rows.where(is_link & (F.size(alternates) > 0)).groupBy(*keys).agg(F.min_by(F.get(alternates, F.lit(0)), "line").alias("_alt"))
    rows = rows.join(first, keys, "left").where(~is_link | (F.size(F.array_remove(alternates, F.coalesce("_alt", F.lit("")))) == 0))
    forth = rows.select(
        *keys, pick(F.lit("ssbond"), F.lit("link"), F.lit("cis")).alias("kind"),
        pick(_part(text, 16, 16), _part(text, 22, 22), _part(text, 16, 16)).alias("chain"), pick(_part(text, 18, 22), _part(text, 23, 27), _part(text, 18, 22)).alias("residue"), pick(_part(text, 12, 14), _part(text, 18, 20), _part(text, 12, 14)).alias("name"), pick(none, _part(text, 13, 16), none).alias("atom"),
        pick(_part(text, 30, 30), _part(text, 52, 52), _part(text, 30, 30)).alias("chain_b"), pick(_part(text, 32, 36), _part(text, 53, 57), _part(text, 32, 36)).alias("residue_b"), pick(_part(text, 26, 28), _part(text, 48, 50), _part(text, 26, 28)).alias("name_b"), pick(none, _part(text, 43, 46), none).alias("atom_b"),
        pick(value(74, 78), value(74, 78), value(54, 59)).alias("value"),
    )
    back = forth.select(*keys, F.when(F.col("kind") == "cis", "cis_follower").otherwise(F.col("kind")).alias("kind"), *(F.col(f"{c}_b").alias(c) for c in ("chain", "residue", "name", "atom")), *(F.col(c).alias(f"{c}_b") for c in ("chain", "residue", "name", "atom")), "value")
    return forth.unionByName(back)


def parse_modified(lines: DataFrame, keys: list[str], column: str = "value") -> DataFrame:
    """(keys, chain, residue, name): modified residues and the one that each is made from; of several lines for a residue the first."""
    text = col(column)
    rows = lines.where(text.startswith("MODRES")).select(*keys, "line", _part(text, 17, 17).alias("chain"), _part(text, 19, 23).alias("residue"), _part(text, 25, 27).alias("name"))
    return rows.groupBy(*keys, "chain", "residue").agg(F.min_by("name", "line").alias("name"))


def boxes(atoms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chain, low and high of each coordinate): the box around the atoms of each chain."""
    edges = [f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("low", F.min), ("high", F.max))]
    return atoms.groupBy(*keys, "chain").agg(*edges)


def near_boxes(found: DataFrame, keys: list[str], *, apart: float = 5.0) -> DataFrame:
    """(keys, chain, chain_b): chains of a structure whose boxes overlap or are no farther apart than this on any axis."""
    other = found.select(*keys, *(F.col(c).alias(f"{c}_b") for c in found.columns if c not in keys))
    touch = [(F.greatest(f"low_{c}", f"low_{c}_b") <= F.least(f"high_{c}", f"high_{c}_b") + apart) for c in "xyz"]
    return found.join(other, keys).where((F.col("chain") < F.col("chain_b")) & touch[0] & touch[1] & touch[2]).select(*keys, "chain", "chain_b")


POCKET = ("query", "query_aa", "query_chain", "query_pos", "hit", "hit_aa", "hit_chain", "hit_pos", "site_identity", "bb_rmsd", "all_rmsd", "n_site", "site_lddt", "identity")


def parse_pockets(lines: DataFrame, column: str = "value") -> DataFrame:
    """Rows of pocket comparisons, white space between the fields: 14 of them, or 12 where the hit is a gap; others, such as the header, are left out."""
    words = F.split(F.trim(col(column)), r"\s+")
    whole = F.size(words) == 14
    at = lambda i: F.when(whole, F.get(words, F.lit(i))).otherwise("gap" if i in (6, 7) else F.get(words, F.lit(i if i < 6 else i - 2)))
    number = {"site_identity", "bb_rmsd", "all_rmsd", "n_site", "site_lddt", "identity"}
    cells = [(at(i).try_cast("double") if name in number else at(i)).alias(name) for i, name in enumerate(POCKET)]
    return lines.where((whole | (F.size(words) == 12))).select(*cells).where("site_identity IS NOT NULL")


DISORDER = "acc string, mobidb_consensus struct<disorder: struct<predictors: array<struct<method: string, scores: array<double>, regions: array<array<string>>>>>>"


def parse_disorder(lines: DataFrame, column: str = "value", *, method: str = "mobidb-lite") -> DataFrame:
    """(accession, scores, regions) of JSON lines of a disorder database, for one method; regions are (first, last, kind). Lines that are no JSON, or lack the method, give nothing."""
    entry = F.from_json(col(column), DISORDER)
    predictors = lines.select(entry.alias("e")).where("e.acc IS NOT NULL").select("e.acc", F.explode("e.mobidb_consensus.disorder.predictors").alias("p")).where(F.col("p.method") == method)
    region = lambda r: F.struct(F.get(r, F.lit(0)).try_cast("int").alias("first"), F.get(r, F.lit(1)).try_cast("int").alias("last"), F.get(r, F.lit(2)).alias("kind"))
    return predictors.select(F.col("acc").alias("accession"), "p.scores", F.transform("p.regions", region).alias("regions"))


def ligands(smiles: DataFrame, inchi: DataFrame, column: str = "value") -> DataFrame:
    """(name, smiles, inchi) of two dictionaries of lines ``notation<tab>name``; of repeated names the greatest notation. A name with one notation only has the other null."""
    def read(lines: DataFrame, kind: str) -> DataFrame:
        words = F.split(col(column), "\t")
        return lines.where(F.size(words) >= 2).select(F.get(words, F.lit(1)).alias("name"), F.get(words, F.lit(0)).alias(kind)).groupBy("name").agg(F.max(kind).alias(kind))

    return read(smiles, "smiles").join(read(inchi, "inchi"), "name", "full")


def parse_sequences(records: DataFrame, column: str = "value") -> DataFrame:
    """(accession, sequence) of records ``sp|ACCESSION|name`` and lines of letters, split at their ``>``; a record without bars has its first word as accession."""
    text = F.regexp_replace(F.regexp_replace(col(column), "^>", ""), "\r", "")
    head = F.substring_index(text, "\n", 1)
    bars = F.split(head, r"\|")
    accession = F.when(F.size(bars) > 1, F.get(bars, F.lit(1))).otherwise(F.substring_index(F.trim(head), " ", 1))
    sequence = F.regexp_replace(F.when(F.instr(text, "\n") > 0, F.substring(text, F.length(head) + 2, F.length(text))).otherwise(""), r"\s", "")
    return records.where(F.trim(text) != "").select(accession.alias("accession"), sequence.alias("sequence"))


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Records are split by the reader, also of compressed files."""
    return parse_sequences(spark.read.option("lineSep", "\n>").text(path))


def header_changes(head: Column | str) -> Column:
    """Changes of a FASTA header ``id A2G<tag,tag;B3del``: an array of (change, tags); what has no number is none."""
    words = F.split(F.trim(col(head)), r"[ \t]+")
    each = F.filter(F.split(F.coalesce(F.get(words, F.lit(1)), F.lit("")), ";"), lambda x: x.rlike("[0-9]"))
    tags = lambda x: F.array_remove(F.split(F.when(F.instr(x, "<") > 0, F.substring_index(x, "<", -1)).otherwise(""), ","), "")
    return F.transform(each, lambda x: F.struct(F.substring_index(x, "<", 1).alias("change"), tags(x).alias("tags")))
