"""The reports: plain DataFrames over the annotation schema, ready for a tab-separated sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from residuum.functions import scores, sequences
from residuum.operators import aggregates, joins, windows

#: Rows up to which a table is small enough to broadcast; they are counted.
FEW = 200_000


def statistics(rows: DataFrame) -> DataFrame:
    """Counts for each tag and for all rows, from (tags, protein, level).

    A position is mapped unless its level is ``unmapped``; a protein counts with the best
    level among its positions: same, homolog, model, unmapped.
    """
    each = rows.withColumn("tag", F.explode(F.array_union(F.array(F.lit("All")), F.col("tags"))))
    rank = F.when(F.col("level") == "same", 3).when(F.col("level") == "homolog", 2).when(F.col("level") == "model", 1).otherwise(0)
    own = each.groupBy("tag", "protein").agg(F.count("*").alias("positions"), F.sum((rank > 0).cast("long")).alias("mapped"), F.max(rank).alias("best"))
    n = lambda k: F.sum((F.col("best") == k).cast("long"))
    return own.groupBy("tag").agg(F.sum("positions").alias("positions"), F.sum("mapped").alias("mapped"), F.count("*").alias("proteins"), n(3).alias("same"), n(2).alias("homolog"), n(1).alias("model"), n(0).alias("unmapped"))


def terms(scored: DataFrame, own: DataFrame, size: DataFrame) -> DataFrame:
    """Total, mean and normalised score of each ontology term or pathway.

    ``scored`` has (gene, score), ``own`` (gene, term, ext_id), ``size`` one row, the size
    of the data set.
    """
    one = size.select(F.col(size.columns[0]).alias("_n")).agg(F.first("_n").alias("_n"))
    found = scored.join(own, "gene").groupBy("term", "ext_id").agg(F.sum("score").alias("total"), F.avg("score").alias("mean"), F.countDistinct("gene").alias("genes"))
    return found.join(F.broadcast(one)).withColumn("normalized", F.col("total") / F.col("_n")).drop("_n")


def classification(positions: DataFrame, proteins: DataFrame, snvs: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row for each position and change: identities, classes, recommended structure.

    A position without a change keeps its own letter. ``evidence`` has (position_id, rsa,
    interaction_class, simple_class, recommended, identity, coverage, resolution, n_mapped).
    """
    changed = joins.left_with_default(positions, snvs, ["position_id"], {"new_aa": F.col("wt")})
    rows = changed.join(proteins, "protein_id").join(evidence, "position_id", "left")
    location = scores.locate("rsa")
    return rows.select("primary_id", "uniprot_ac", "position_number", F.concat("wt", F.col("position_number").cast("string"), "new_aa").alias("change"), location.alias("location"), scores.classify("interaction_class", location).alias("classification"), scores.classify("simple_class", location).alias("simple_class"), "recommended", "identity", "coverage", "resolution", F.coalesce("n_mapped", F.lit(0)).alias("n_mapped"))


def features(classified: DataFrame, wt: str = "wt", mut: str = "mut") -> DataFrame:
    """The classification with differences of the letters' properties."""
    flags = sequences.property_changes(wt, mut)
    return classified.withColumn("hydropathy_change", sequences.hydropathy_change(wt, mut)).withColumn("changes", flags).select("*", "changes.*").drop("changes")


def full_annotation(bridge: DataFrame, residues: DataFrame, structures: DataFrame) -> DataFrame:
    """Every position with every residue that covers it, without aggregation."""
    return bridge.join(residues, ["structure_id", "residue"]).join(structures, "structure_id")


def suggest(annotation: DataFrame, method: str = "consensus") -> DataFrame:
    """Templates for each protein, ranked by a named method."""
    if method != "consensus":
        raise ValueError(f"no ranking method {method!r}")
    ranked = aggregates.consensus_rank(annotation, "protein_id", "position_id", "structure_id", "simple_class")
    return ranked.withColumn("method", F.lit(method))


def contact_network(bridge: DataFrame, contacts: DataFrame, *, most: float = 5.0) -> DataFrame:
    """Positions whose residues are in contact within a structure."""
    near = contacts.where(F.col("distance") <= most)
    a = bridge.select("structure_id", F.col("residue").alias("residue_a"), F.col("position_id").alias("position_a"))
    b = bridge.select("structure_id", F.col("residue").alias("residue_b"), F.col("position_id").alias("position_b"))
    return near.join(a, ["structure_id", "residue_a"]).join(b, ["structure_id", "residue_b"]).select("position_a", "position_b", "structure_id", "distance")


def annotated_structures(session: DataFrame, alignments: DataFrame, chains: DataFrame) -> DataFrame:
    """Protein chains of all structures aligned to a protein of the session."""
    own = alignments.join(session.select("protein_id"), "protein_id", "left_semi").select("structure_id").distinct()
    return chains.where(F.col("kind") == "Protein").join(own, "structure_id", "left_semi")


def large_structures(chains: DataFrame, limit: int) -> DataFrame:
    return chains.groupBy("complex_id").agg(F.count("*").alias("chains")).where(F.col("chains") > limit)


def gene_isoform_scores(pairs: DataFrame) -> DataFrame:
    """Isoform score of each gene from (gene, isoform_a, isoform_b, score, wt_a, wt_b, dis_a, dis_b).

    A pair counts by its score, by how much the expression of a falls and that of b rises;
    the sum is over the total change. The pair that adds most is named.
    """
    shift = F.greatest(F.col("wt_a") - F.col("dis_a"), F.lit(0.0)) * F.greatest(F.col("dis_b") - F.col("wt_b"), F.lit(0.0))
    rows = pairs.withColumn("part", F.col("score") * shift).withColumn("shift", shift)
    total = F.sum("shift")
    return rows.groupBy("gene").agg(F.when(total > 0, F.sum("part") / total).otherwise(0.0).alias("score"), F.max_by("isoform_b", F.struct("part", "isoform_b")).alias("top_isoform"), F.max("part").alias("contribution"))


def gene_network(edges: DataFrame, wt_weight: str, disease_weight: str) -> DataFrame:
    """Edges between genes under two conditions, from (gene_a, gene_b, score, weights): lost, new, worse, kept."""
    mean = lambda w: F.sum(F.col("score") * F.col(w)) / F.sum(w)
    rolled = edges.where(F.col("gene_a") != F.col("gene_b")).groupBy(F.least("gene_a", "gene_b").alias("gene_a"), F.greatest("gene_a", "gene_b").alias("gene_b")).agg(F.greatest(F.lit(0.0), F.coalesce(mean(wt_weight), F.lit(0.0))).alias("wt"), F.greatest(F.lit(0.0), F.coalesce(mean(disease_weight), F.lit(0.0))).alias("disease"))
    change = F.when(F.greatest("wt", "disease") > 0, (F.col("disease") - F.col("wt")) / F.greatest("wt", "disease")).otherwise(0.0)
    kind = F.when((F.col("wt") > 0) & (F.col("disease") == 0), "lost").when((F.col("wt") == 0) & (F.col("disease") > 0), "new").when(change < 0, "worse").otherwise("kept")
    return rolled.withColumn("change", change).withColumn("kind", kind)


def isoform_usage(rows: DataFrame, a: str, b: str, *, least: float = 0.01) -> DataFrame:
    """Share of each isoform in its gene under two conditions, log fold change; rare isoforms left out.

    Isoforms of one sequence are one. The fold change is infinite where either share is zero.
    """
    same = rows.groupBy("gene", "sequence").agg(F.min("isoform").alias("isoform"), F.sum(a).alias("a"), F.sum(b).alias("b"))
    own = Window.partitionBy("gene")
    share = lambda c: F.when(F.sum(c).over(own) > 0, F.col(c) / F.sum(c).over(own)).otherwise(0.0)
    used = same.withColumn("usage_a", share("a")).withColumn("usage_b", share("b")).where(F.col("usage_a") + F.col("usage_b") >= least)
    fold = F.when((F.col("usage_a") > 0) & (F.col("usage_b") > 0), F.log2(F.col("usage_b") / F.col("usage_a"))).otherwise(F.lit(float("inf")))
    return used.select("gene", "isoform", "usage_a", "usage_b", (F.col("usage_b") - F.col("usage_a")).alias("change"), fold.alias("log2_fold"))


def top_partners(rows: DataFrame, protein: str, score: str, partner: str, k: int = 5) -> DataFrame:
    """The partners of best score of each protein."""
    return windows.top(rows, [protein], [F.col(score).desc(), F.col(partner)], k)


def multi_savs(mutations: DataFrame, snvs: DataFrame) -> DataFrame:
    """(mm_id, savs): changes of each multi-mutation in order, joined by colons."""
    each = mutations.select("mm_id", F.posexplode("snv_ids").alias("i", "snv_id")).join(snvs, "snv_id")
    return each.groupBy("mm_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "change"))), lambda x: x["change"]), ":").alias("savs"))


# the reports in full


def recommended_parts(text: str) -> list:
    """Structure, identity, coverage and resolution of a recommendation ``1abc:A;0.9;1.0;2.1``; a dash for each if it has fewer parts or is none, and whether it is a model."""
    parts = F.split(F.col(text), ";")
    whole = F.col(text).isNotNull() & (F.size(parts) == 4)
    part = lambda i, name: F.when(whole, F.get(parts, F.lit(i))).otherwise("-").alias(name)
    return [part(0, "structure"), part(1, "identity"), part(2, "coverage"), part(3, "resolution"), F.coalesce(whole & F.get(parts, F.lit(0)).startswith("AF-"), F.lit(False)).alias("model")]


def classification_report(positions: DataFrame, proteins: DataFrame, evidence: DataFrame) -> DataFrame:
    """A row for each position with its identities, classes and structures.

    ``positions``: (position_id, protein_id, position_number, residue_id, wt, tags);
    ``proteins``: (protein_id, input_id, primary_id, uniprot_ac, uniprot_id, refseq);
    ``evidence``: (position_id, rsa, interaction_class, simple_class, secondary, recommended,
    most_similar, n_structures), the structures as ``id;identity;coverage;resolution``.
    """
    rows = positions.join(proteins, "protein_id").join(evidence, "position_id", "left")
    location = scores.locate("rsa")
    best, similar = recommended_parts("recommended"), recommended_parts("most_similar")
    named = lambda parts, prefix: [p.alias(f"{prefix}_{n}") for p, n in zip(parts, ("structure", "identity", "coverage", "resolution", "model"), strict=True)]
    return rows.select(
        F.coalesce("input_id", "primary_id").alias("input_id"), "primary_id", "uniprot_ac", "uniprot_id", "refseq", F.coalesce("residue_id", F.lit("")).alias("residue_id"), F.col("wt").alias("amino_acid"), "position_number", "tags",
        location.alias("location"), scores.classify("interaction_class", location).alias("classification"), scores.classify("simple_class", location).alias("simple_class"), "secondary",
        *named(best, "recommended"), *named(similar, "similar"), F.coalesce("n_structures", F.lit(0)).alias("n_structures"))


def interface_report(members: DataFrame, interfaces: DataFrame, positions: DataFrame, proteins: DataFrame) -> DataFrame:
    """A row for each position of an interface, interfaces being numbered within their protein.

    ``members``: (interface_id, position_id, residue); ``interfaces``: (interface_id,
    protein_id, recommendation). A position of several interfaces has a row for each.
    """
    numbered = windows.numbered(interfaces, ["protein_id"], "interface_id", "interface_number")
    rows = members.join(numbered, "interface_id").join(positions.select("position_id", "position_number", "wt"), "position_id").join(proteins, "protein_id")
    return rows.select(F.coalesce("input_id", "primary_id").alias("input_id"), "primary_id", "uniprot_ac", F.col("wt").alias("amino_acid"), "position_number", "interface_number", F.col("recommendation").alias("interface_recommendation"), F.col("residue").alias("position_recommendation"))


def feature_report(classified: DataFrame, changes: DataFrame, features: list[str]) -> DataFrame:
    """A row for each position and change with the differences of the letters and the position's features; a position without a change keeps its letter."""
    rows = joins.left_with_default(classified, changes, ["primary_id", "position_number"], {"new_aa": F.col("amino_acid")})
    flags = sequences.property_changes("amino_acid", "new_aa")
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    rows = rows.withColumns({"hydropathy_change": zero(sequences.hydropathy_change("amino_acid", "new_aa")), "volume_change": zero(sequences.volume_change("amino_acid", "new_aa")), "_f": flags})
    number = [F.col(f"_f.{f}").cast("int").alias(f"{f}_change") for f in (*sequences.PROPERTIES, "total")]
    return rows.select("input_id", "primary_id", "uniprot_ac", "amino_acid", "position_number", "new_aa", F.concat("amino_acid", "new_aa").alias("change"), "tags", *features, "hydropathy_change", "volume_change", *number)


def partner_report(ppi: DataFrame, session: DataFrame, proteins: DataFrame, partners: DataFrame | None = None) -> DataFrame:
    """Interactions (protein_a, protein_b, complex_id, chain_a, chain_b, score) of the proteins of a session, with the names of both; ``expanded`` if the partner is not in the session.

    Few partners that have very many interactions each would be sorted in few tasks: only the
    proteins among ``partners`` (protein_b, any that can occur, those of ``ppi`` by default) are
    joined, and if these are few, which is counted, they are broadcast.
    """
    names = lambda side: proteins.select(F.col("protein_id").alias(f"protein_{side}"), F.col("primary_id").alias(f"name_{side}"))
    own = session.select(F.col("protein_id").alias("protein_a")).distinct()
    other = session.select(F.col("protein_id").alias("protein_b"), F.lit(False).alias("_outside")).distinct()
    asked = (ppi if partners is None else partners).select("protein_b").distinct()
    partner = names("b").join(asked, "protein_b", "left_semi").join(other, "protein_b", "left")
    partner = F.broadcast(partner) if asked.count() <= FEW else partner
    rows = ppi.join(own, "protein_a").join(names("a"), "protein_a").join(partner, "protein_b")
    return rows.select("name_a", "name_b", "complex_id", "chain_a", "chain_b", "score", F.coalesce("_outside", F.lit(True)).alias("expanded"))


def annotation_rates(positions: DataFrame, mapped: DataFrame, *, homolog: float = 0.35, same: float = 0.99) -> DataFrame:
    """One row of counters: positions, mapped ones, those with faults only, proteins, those with a structure, and with one of at least these identities.

    ``positions``: (position_id, protein_id); ``mapped``: (position_id, structure_id,
    identity, fault), ``fault`` being null where the mapping stands.
    """
    good = F.col("fault").isNull()
    each = positions.join(mapped, "position_id", "left").groupBy("protein_id", "position_id").agg(F.max(good & F.col("structure_id").isNotNull()).alias("ok"), F.max(F.col("fault").isNotNull()).alias("faulty"), F.max(F.when(good, F.col("identity"))).alias("best"))
    of_protein = each.groupBy("protein_id").agg(F.count("*").alias("n"), F.sum(F.col("ok").cast("long")).alias("ok"), F.sum((~F.coalesce("ok", F.lit(False)) & F.coalesce("faulty", F.lit(False))).cast("long")).alias("faulty"), F.max("best").alias("best"))
    n = lambda x: F.sum(F.coalesce(x, F.lit(False)).cast("long"))
    return of_protein.agg(F.sum("n").alias("positions"), F.sum("ok").alias("mapped"), F.sum("faulty").alias("faulty"), F.count("*").alias("proteins"), n(F.col("ok") > 0).alias("proteins_mapped"), n(F.col("best") >= homolog).alias("proteins_homolog"), n(F.col("best") >= same).alias("proteins_same"))


def indel_report(indels: DataFrame, aggregates_: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """A row for each change with the features of its six regions as columns, from the long form (keys, region, side, features)."""
    regions = [("inside", "wt", "wildtype"), ("inside", "mut", "mutant"), ("left flank", "wt", "wt_left"), ("left flank", "mut", "mut_left"), ("right flank", "wt", "wt_right"), ("right flank", "mut", "mut_right")]
    here = lambda region, side: (F.col("region") == region) & (F.col("side") == side)
    wide = aggregates_.groupBy(*keys).agg(*(F.max(F.when(here(r, s), F.col(f))).alias(f"{name}_{f}") for r, s, name in regions for f in features))
    return indels.join(wide, keys, "left")


def indel_class_counts(indels: DataFrame) -> DataFrame:
    """(kind, tag, wt_class, mut_class, n): how many changes (kind, tags, wt_class, mut_class) lead from a class to another, for each tag and for all; an insertion has no class before, a deletion none after."""
    tagged = indels.withColumn("tag", F.explode(F.array_union(F.array(F.lit("All")), F.coalesce("tags", F.array().cast("array<string>")))))
    before, after = F.when(F.col("kind") != "ins", F.col("wt_class")), F.when(F.col("kind") != "del", F.col("mut_class"))
    return tagged.groupBy("kind", "tag", before.alias("wt_class"), after.alias("mut_class")).agg(F.count("*").alias("n"))


def sorted_terms(found: DataFrame) -> DataFrame:
    """Terms by their normalised score, greatest first; of ties by name."""
    return found.orderBy(F.col("normalized").desc(), "term")


def sorted_differences(found: DataFrame, key: str) -> DataFrame:
    """Differences from the greatest absolute one on; of ties by key."""
    return found.orderBy(F.abs("difference").desc(), key)
