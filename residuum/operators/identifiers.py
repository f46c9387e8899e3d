"""Chains of identifiers: sequences, isoform names, chains of structures, places of residues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def equal_sequences(transcripts: DataFrame, isoforms: DataFrame) -> DataFrame:
    """(transcript, isoform): for each transcript (transcript, stem, sequence) the first isoform (isoform, stem, sequence) of its stem with the same letters.

    The least isoform of each stem and sequence is the first; it is found before the join, so
    a transcript meets one row, however many isoforms are equal. Sequences meet by their
    digest and are compared then.
    """
    digest = F.sha2("sequence", 256)
    left = transcripts.select("transcript", "stem", F.col("sequence").alias("_s"), digest.alias("_d"))
    first = isoforms.groupBy("stem", "sequence").agg(F.min("isoform").alias("isoform"))
    right = first.select("isoform", "stem", F.col("sequence").alias("_t"), digest.alias("_d"))
    met = left.join(right, ["stem", "_d"]).where(F.col("_s") == F.col("_t"))
    return met.groupBy("transcript").agg(F.min("isoform").alias("isoform"))


def requested_chains(requests: DataFrame, chains: DataFrame) -> DataFrame:
    """Requests (request, ...) of structure chains ``1abc:A``; one of a whole structure, ``1abc:-``, becomes one for each of its protein chains.

    ``chains`` has (structure, chain, kind), structures in lower case. A structure without a
    protein chain gives no row.
    """
    columns = [c for c in requests.columns if c != "request"]
    is_whole = F.col("request").endswith(":-") | F.col("request").endswith("-") & ~F.col("request").contains(":")
    structure = F.lower(F.substring("request", 1, 4))
    proteins = chains.where("kind = 'Protein'").select(F.col("structure").alias("_structure"), "chain")
    whole = requests.where(is_whole).join(proteins, structure == F.col("_structure")).select(F.concat(F.substring("request", 1, 4), F.lit(":"), "chain").alias("request"), *columns)
    return requests.where(~is_whole).select("request", *columns).unionByName(whole)


def isoform_names(accessions: DataFrame, names: DataFrame) -> DataFrame:
    """(accession, name): entry names (accession, name) for accessions, an isoform ``AC-2`` having that of its stem; mutants ``..._...`` have none."""
    stem = F.regexp_replace("accession", r"-[^-]*$", "")
    own = names.select(F.col("accession").alias("_stem"), "name")
    wanted = accessions.select("accession").distinct().withColumn("_stem", F.when(F.size(F.split("accession", "-")) == 2, stem).otherwise(F.col("accession")))
    return wanted.join(own, (F.col("accession").contains("_") == F.lit(False)) & (wanted["_stem"] == own["_stem"]), "left").select("accession", "name")


def keyed_residues(mapped: DataFrame, alignments: DataFrame, positions: DataFrame, *, least: float = 0.35) -> DataFrame:
    """(structure_id, residue, position_id): mapped residues (protein_id, structure_id, position_number, residue) under the ids of their positions.

    Only pairs of a protein and a structure whose alignment (protein_id, structure_id,
    identity) has this identity at least; a place that is no position is left out.
    """
    good = alignments.where(F.col("identity") >= least).select("protein_id", "structure_id")
    own = positions.select("protein_id", "position_number", "position_id")
    return mapped.where("residue IS NOT NULL").join(good, ["protein_id", "structure_id"]).join(own, ["protein_id", "position_number"]).select("structure_id", "residue", "position_id")


def wild_types(proteins: DataFrame, group: str = "gene", *, tag: str | None = None) -> DataFrame:
    """The wild type of each group of isoforms (group, protein, order, sequence[, tag]): that of the greatest tag value, without any the first; if no tag is named the longest, of ties the first."""
    columns = [c for c in proteins.columns if c != group]
    first = F.struct((-F.col("order")).alias("_o"))
    if tag is None:
        best = F.max_by(F.struct(*columns), F.struct(F.length("sequence"), first))
    else:
        best = F.max_by(F.struct(*columns), F.struct(F.col(tag).isNotNull(), F.coalesce(F.col(tag), F.lit(0.0)), first))
    return proteins.groupBy(group).agg(best.alias("_x")).select(group, "_x.*")


def on_structure(bridge: DataFrame) -> DataFrame:
    """The bridge (protein_id, structure_id, position_number, residue, seq_index) with a place ``first`` and ``last`` for the ends of what a structure covers."""
    own = Window.partitionBy("protein_id", "structure_id")
    covered = F.when(F.col("residue").isNotNull(), F.col("position_number"))
    return bridge.withColumn("first", F.min(covered).over(own)).withColumn("last", F.max(covered).over(own))


def is_terminal(position: Column | str, first: Column | str, last: Column | str) -> Column:
    """Is a place the first or last that the structure covers?"""
    position, first, last = (F.col(x) if isinstance(x, str) else x for x in (position, first, last))
    return (position == first) | (position == last)


def adjacency(bridge: DataFrame, flanks: DataFrame) -> DataFrame:
    """(protein_id, structure_id, left, right, covered, adjacent, terminal): do structures cover both flanks (protein_id, left, right), are their residues next to each other, and does the left or right end there?

    A structure that does not cover a flank has ``covered`` false, and so are the others.
    """
    rows = on_structure(bridge).where("residue IS NOT NULL").select("protein_id", "structure_id", "position_number", "seq_index", is_terminal("position_number", "first", "last").alias("end"))
    structures = rows.select("protein_id", "structure_id").distinct()
    each = flanks.join(structures, "protein_id")
    side = lambda name: rows.select("protein_id", "structure_id", F.col("position_number").alias(name), F.col("seq_index").alias(f"_{name}"), F.col("end").alias(f"_{name}_end"))
    found = each.join(side("left"), ["protein_id", "structure_id", "left"], "left").join(side("right"), ["protein_id", "structure_id", "right"], "left")
    covered = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    return found.select("protein_id", "structure_id", "left", "right", covered.alias("covered"), (covered & F.coalesce(F.col("_right") - F.col("_left") == 1, F.lit(False))).alias("adjacent"), (F.coalesce("_left_end", F.lit(False)) | F.coalesce("_right_end", F.lit(False))).alias("terminal"))
