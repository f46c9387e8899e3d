"""Residue interaction profiles and interfaces from contact edges.

An edge is a row (chain, residue, chain_b, residue_b, bond, side, score); both directions
are rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residuum.operators.aggregates import exact_sum

# Partner types in the order of precedence, bonds that make a class, sequence gaps.
CLASS_PARTNERS = ("ligand", "ion", "metal", "Protein", "DNA", "RNA", "Peptide")
CLASS_BONDS = ("cnt", "hbond")
NEIGHBOR_GAP, SHORT_GAP = 2, 6


def partner_type(*, ligand: Column, metal: Column, ion: Column, same_chain: Column, chain_type: Column, gap: Column) -> Column:
    """Type of an edge's partner: a small molecule, another chain, or near in sequence."""
    apart = F.abs(gap)
    own = F.when(apart < NEIGHBOR_GAP, "neighbor").when(apart < SHORT_GAP, "short").otherwise("long")
    return F.when(ligand, "ligand").when(metal, "metal").when(ion, "ion").when(~same_chain, chain_type).when(gap.isNotNull(), own)


def edge_profile(edges: DataFrame, keys: list[str], side: str = "side", bond: str = "bond", partner: str = "partner", score: str = "score") -> DataFrame:
    """Degree and score of every cell (side, bond, partner) of a residue; summary edges left out."""
    return edges.where((F.col(bond) != "combi") & F.col(partner).isNotNull()).groupBy(*keys, side, bond, partner).agg(F.count("*").alias("degree"), exact_sum(score).alias("score"))


def summary_profile(edges: DataFrame, keys: list[str], partner: str = "partner", score: str = "score") -> DataFrame:
    """Degree and score toward each partner, from the summary edges of all bonds and sides only."""
    return edges.where((F.col("bond") == "combi") & (F.col("side") == "all")).groupBy(*keys, partner).agg(F.count("*").alias("degree"), F.sum(score).alias("score"))


def interaction_class(profile: DataFrame, keys: list[str]) -> DataFrame:
    """(class, simple class) of each residue with a scoring cell, from (side, bond, partner, score).

    Each partner has its best cell; one partner gives its name, several give all of them in
    the order of precedence, the best of which gives the simple class. Of ties the side
    chain comes last, the contact first, the partner of precedence first.
    """
    rank = lambda c, values: F.array_position(F.array(*map(F.lit, values)), c)
    ok = profile.where(F.col("bond").isin(*CLASS_BONDS) & F.col("partner").isin(*CLASS_PARTNERS) & (F.col("score") > 0))
    best = ok.groupBy(*keys, "partner").agg(F.max_by(F.struct("side", "bond", "score"), F.struct("score", -F.when(F.col("side") == "mc", 0).otherwise(1), -rank(F.col("bond"), CLASS_BONDS))).alias("x"))
    place = rank(F.col("partner"), CLASS_PARTNERS)
    named = F.struct(place.alias("place"), F.concat_ws(" ", "x.side", "x.bond", "partner").alias("name"))
    every = best.groupBy(*keys).agg(F.array_sort(F.collect_list(named)).alias("names"), F.max_by("partner", F.struct("x.score", -place)).alias("top"))
    joined = F.array_join(F.transform("names", lambda n: n["name"]), " and ")
    whole = F.when(F.size("names") == 1, joined).otherwise(F.concat(F.lit("Multi interaction: "), joined))
    return every.select(*keys, whole.alias("interaction_class"), F.concat("top", F.lit(" interaction")).alias("simple_class"))


def without_far(text: Column) -> Column:
    """A class of several partners joined by `` and ``, without the far ones."""
    parts = F.filter(F.split(text, " and "), lambda p: ~p.contains("Far"))
    return F.when(F.size(parts) > 0, F.array_join(parts, " and "))


def interface_score(profile: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of scores toward other chains and molecules over both sides."""
    return profile.where(F.col("partner").isin(*CLASS_PARTNERS) & F.col("side").isin("mc", "sc")).groupBy(*keys).agg(F.sum("score").alias("interface_score"))


def shortest_partners(distances: DataFrame, keys: list[str], kind: str = "kind", partner: str = "partner", distance: str = "distance") -> DataFrame:
    """Least distance toward each kind of partner and who that is; the lesser name of ties."""
    return distances.where(F.col(distance).isNotNull()).groupBy(*keys, kind).agg(F.min(distance).alias("distance"), F.min_by(partner, F.struct(distance, partner)).alias("partner"))


def interfaces(edges: DataFrame, keys: list[str], chain_type: str = "chain_type", chain_type_b: str = "chain_type_b") -> DataFrame:
    """Protein-protein interfaces: residues, edges and score for each pair of chains."""
    own = edges.where((F.col(chain_type) == "Protein") & (F.col(chain_type_b) == "Protein") & (F.col("chain") != F.col("chain_b")))
    return own.groupBy(*keys, "chain", "chain_b").agg(F.array_sort(F.collect_set("residue")).alias("residues"), F.count("*").alias("edges"), F.sum("score").alias("score"))


def annotation_score(score: Column, identity: Column, coverage: Column) -> Column:
    return score * identity * coverage


def interaction_rollup(pairs: DataFrame, a: str, b: str, score: str, mode: list[str]) -> DataFrame:
    """Sum of pair scores for each two proteins, with the most frequent combination of ``mode``
    (the least of ties), in both directions; a protein with itself once."""
    counts = pairs.groupBy(a, b, *mode).agg(F.count("*").alias("_n"), F.sum(score).alias("_s"))
    rolled = counts.groupBy(a, b).agg(F.sum("_s").alias("score"), F.min_by(F.struct(*mode), F.struct(-F.col("_n"), F.struct(*mode))).alias("_m")).select(a, b, "score", "_m.*")
    swapped = rolled.where(F.col(a) != F.col(b)).select(F.col(b).alias(a), F.col(a).alias(b), "score", *mode)
    return rolled.unionByName(swapped)


def chain_kinds(atoms: DataFrame, keys: list[str], *, irregular: Column | None = None, peptide_below: int = 150) -> DataFrame:
    """Kind of each chain, from atoms (record, serial, res_name).

    The last polymer atom whose residue name has one letter makes it RNA, one of two DNA, else
    polymer atoms or irregular residues a protein; other hetero atoms alone are MISC. A protein
    is a peptide if its irregular atoms are half of the regular ones or more, or if it has
    fewer than ``peptide_below`` of both. ``irregular`` tells hetero atoms of unusual amino
    acids; by default those with a known three-letter name.
    """
    from residuum.functions.sequences import THREE_TO_ONE

    size, polymer = F.length(F.trim("res_name")), F.col("record").isin("ATOM", "MODRES")
    odd = (F.col("record") == "HETATM") & (F.col("res_name").isin(*THREE_TO_ONE) if irregular is None else irregular)
    n = lambda c: F.sum(F.coalesce(c.cast("int"), F.lit(0)))
    last = F.max_by(size, F.when(polymer & (size < 3), F.col("serial")))
    kinds = atoms.groupBy(*keys).agg(n(polymer | ((F.col("record") == "HETATM") & (size < 3) & ~odd)).alias("regular"), n(odd).alias("irregular"), n(polymer).alias("polymer"), F.when(n(polymer & (size < 3)) > 0, last).alias("last"))
    small = (F.col("regular") <= 2 * F.col("irregular")) | (F.col("regular") + F.col("irregular") < peptide_below)
    protein = (F.col("polymer") > 0) | (F.col("irregular") > 0)
    kind = F.when(F.col("last") == 1, "RNA").when(F.col("last") == 2, "DNA").when(protein & small, "Peptide").when(protein, "Protein").otherwise("MISC")
    return kinds.select(*keys, kind.alias("kind"))


def best_pairs(pairs: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """Of the rows of each pair of positions the one of the greatest score; of ties, the least row."""
    rest = [c for c in pairs.columns if c not in keys and c != score]
    return pairs.groupBy(*keys).agg(F.min(F.struct((-F.col(score)).alias("_s"), *rest)).alias("_x")).select(*keys, (-F.col("_x._s")).alias(score), *(f"_x.{c}" for c in rest))


#: Parts into which a position's structures are dealt out.
PARTS = 16


def overlapping(covered: DataFrame, known: DataFrame, *, least: float = 0.5) -> DataFrame:
    """(protein, number, structure, chain, chain_b, overlap): known interfaces with which a structure's
    interface is fused, given positions of both as rows: over half of either's are common.

    Positions that many structures cover are dealt out by structure in ``PARTS``, and known
    ones, which are far fewer, are there in each part, so that no task gets all of a position.
    """
    own = covered.select("protein", "structure", "chain", "chain_b", "position").distinct()
    other = known.select("protein", "number", "position").distinct()
    size = own.groupBy("protein", "structure", "chain", "chain_b").agg(F.count("*").alias("_n"))
    sizes = other.groupBy("protein", "number").agg(F.count("*").alias("_m"))
    part = F.pmod(F.xxhash64("structure", "chain", "chain_b"), F.lit(PARTS))
    every = other.withColumn("_part", F.explode(F.array(*(F.lit(i).cast("long") for i in range(PARTS)))))
    met = own.withColumn("_part", part).join(every, ["protein", "position", "_part"]).groupBy("protein", "structure", "chain", "chain_b", "number").agg(F.count("*").alias("overlap"))
    both = met.join(size, ["protein", "structure", "chain", "chain_b"]).join(sizes, ["protein", "number"])
    return both.where((F.col("overlap") > least * F.col("_n")) | (F.col("overlap") > least * F.col("_m"))).drop("_n", "_m")


def fused(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Positions of two interfaces (keys, position, residue, score) as one: of a position that both
    have, the residue of the lesser interface stays, as the published fusion writes it last."""
    least = F.min_by("residue", F.struct("score", "residue"))
    return a.unionByName(b).groupBy(*keys, "position").agg(least.alias("residue"), F.max("score").alias("score"))


def surface_decision(rows: DataFrame, keys: list[str], *, surface: str = "surface", quality: str = "quality", coverage: str = "coverage", threshold: float = 0.16) -> DataFrame:
    """Surface or Core by the sums of quality times coverage to the fifth on either side of the
    threshold, core counted twice, with a confidence that grows with their number."""
    weight = F.col(quality) * F.col(coverage) ** 5
    core = F.sum(F.when(F.col(surface) < threshold, weight).otherwise(0.0))
    outer = F.sum(F.when(F.col(surface) < threshold, 0.0).otherwise(weight))
    sums = rows.groupBy(*keys).agg(core.alias("core"), outer.alias("outer"), F.count("*").alias("n"))
    apart, whole = F.col("outer") - 2 * F.col("core"), F.col("outer") + 2 * F.col("core")
    return sums.select(*keys, F.when(apart > 0, "Surface").otherwise("Core").alias("decision"), F.when(whole > 0, (1 - 1 / (F.col("n") + 1)) * F.abs(apart) / whole).alias("confidence"))


# Atoms without hydrogen of a residue, by its letter, with the terminal oxygen.
ATOMS_OF = {
    "A": 5, "C": 6, "D": 8, "E": 9, "F": 11, "G": 4, "H": 10, "I": 8, "K": 9, "L": 8,
    "M": 8, "N": 8, "P": 7, "Q": 9, "R": 11, "S": 6, "T": 7, "V": 7, "W": 14, "Y": 12,
}


def atomic_coverage(atoms: DataFrame, keys: list[str]) -> DataFrame:
    """Share of the expected atoms of each chain that are resolved; an unknown residue expects one."""
    from residuum.functions.sequences import as_map, three_to_one

    residues = atoms.groupBy(*keys, "res_num", "ins_code").agg(F.min("res_name").alias("name"), F.count("*").alias("n"))
    expected = as_map(ATOMS_OF)[three_to_one("name")]
    found = residues.groupBy(*keys).agg(F.sum(F.when(expected.isNotNull(), F.col("n")).otherwise(0)).alias("resolved"), F.sum(F.coalesce(expected, F.lit(1))).alias("expected"))
    return found.select(*keys, (F.col("resolved") / F.col("expected")).alias("coverage"))


def substitution_scores(changes: DataFrame, matrix: DataFrame, *, wt: str = "wt", mutants: str = "mutants", default: float | None = 0.0, out: str = "substitution") -> DataFrame:
    """``changes`` with the mean score of a letter to each of its ``mutants`` (an array), by a matrix
    (a, b, score) of letters in either order; what it lacks counts ``default``, or makes null."""
    scores = matrix.groupBy(F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b")).agg(F.min("score").alias("_score"))
    table = scores.agg(F.map_from_entries(F.collect_list(F.struct(F.concat("_a", "_b"), "_score"))).alias("_table"))  # a row of some hundreds of pairs
    each = F.transform(mutants, lambda m: F.coalesce(F.col("_table")[F.concat(F.least(F.col(wt), m), F.greatest(F.col(wt), m))], F.lit(default).cast("double")))
    mean = F.when(F.size(mutants) > 0, F.aggregate(each, F.lit(0.0), lambda s, x: s + x) / F.size(mutants))
    return changes.join(F.broadcast(table)).withColumn(out, mean).drop("_table")
