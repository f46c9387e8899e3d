"""Mutation lists, FASTA with mutation lines, variant calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from residuum.functions import sequences
from residuum.functions.scores import col
from residuum.sources.features import header_changes


def identifier_kind(name: Column | str) -> Column:
    """Which id space a protein name belongs to, by its shape."""
    s = col(name)
    return (
        F.when(s.startswith("NP_"), "refseq").when(s.startswith("NM_"), "refseq_nt").when(s.startswith("HGNC:"), "hgnc")
        .when(s.startswith("ENS") & (F.length(s) > 14), "ensembl").when((F.length(s) == 6) & (F.substring(s, 5, 1) == ":"), "structure_chain")
        .when(F.length(s) == 4, "structure").when(s.contains("_"), "entry_name").otherwise("accession")
    )


def change_kind(change: Column | str) -> Column:
    c = col(change)
    return F.when(c.isNull() | (c == ""), "protein").when(c.contains(","), "multi").when(c.contains("delins"), "substitution").when(c.contains("del"), "deletion").when(c.contains("ins"), "insertion").when(c.startswith("p."), "hgvs").otherwise("snv")


def parse_mutation_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(protein_id, id_kind, change, kind, snv, indel, tags, gene): one row for each change of a line.

    Fields are parted by tabs or spaces; ``//`` starts a comment; lines of fewer than three
    characters do not count. Members of a multi-mutation share ``group``.
    """
    text = F.trim(F.regexp_replace(col(column), "//.*$", ""))
    fields = F.split(text, r"[ \t]+", 3)
    rows = lines.where(F.length(text) >= 3).select(fields[0].alias("protein_id"), F.get(fields, F.lit(1)).alias("changes"), F.split(F.coalesce(F.get(fields, F.lit(2)), F.lit("")), ",").alias("tags"))
    each = rows.withColumn("group", F.when(F.col("changes").contains(","), F.col("changes"))).withColumn("change", F.explode_outer(F.split("changes", ",")))
    snv = F.coalesce(sequences.parse_hgvs("change"), sequences.parse_change("change"))
    return each.select("protein_id", identifier_kind("protein_id").alias("id_kind"), "change", change_kind("change").alias("kind"), "group", snv.alias("snv"), sequences.parse_indel("change").alias("indel"), F.array_remove("tags", "").alias("tags"), sequences.tag_text("tags", "gene").alias("gene"))


def read_mutation_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_mutation_lines(spark.read.text(path))


def parse_fasta_records(records: DataFrame, column: str = "value") -> DataFrame:
    """(entry_id, mutations, sequence) of records that begin after their ``>``.

    Changes may stand in the header after the id (``A2G<tag;B3C``); lines with ``<`` are changes with tags; ``/`` and ``*`` are left out of the sequence; a
    sequence with another character than A-Z, or fewer than five letters, is not valid.
    """
    lines = F.filter(F.split(F.regexp_replace(col(column), "\r", ""), "\n"), lambda x: F.trim(x) != "")
    rows = records.where(F.trim(col(column)) != "").select(lines.alias("l"))
    head = F.regexp_replace(F.get("l", F.lit(0)), "^>", "")
    changes = F.transform(F.filter(F.slice("l", 2, F.size("l")), lambda x: x.startswith("<")), lambda x: F.split(F.trim(F.regexp_replace(x, "^<", "")), r"[ \t]+", 2))
    mutations = F.transform(changes, lambda p: F.struct(p[0].alias("change"), F.array_remove(F.split(F.coalesce(F.get(p, F.lit(1)), F.lit("")), ","), "").alias("tags")))
    sequence = F.upper(F.regexp_replace(F.array_join(F.filter(F.slice("l", 2, F.size("l")), lambda x: ~x.startswith("<")), ""), r"[/*\s]", ""))
    found = rows.select(F.get(F.split(F.trim(head), r"[ \t]+"), F.lit(0)).alias("entry_id"), F.concat(header_changes(head), mutations).alias("mutations"), sequence.alias("sequence"))
    return found.withColumn("valid", F.col("sequence").rlike("^[A-Z]+$") & sequences.is_valid_sequence("sequence"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Records are split by the reader, so a large file is read by many tasks."""
    return parse_fasta_records(spark.read.option("lineSep", "\n>").text(path))


COMPLEMENT = {"A": "T", "C": "G", "G": "C", "T": "A"}


def variant_changes(variants: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene_id, pos, change) of variant calls (gene_id, pos, ref, alt) on gene sequences (gene_id, sequence, reverse).

    Places count from one along the gene; on the reverse strand the letters are complemented.
    Calls with ``-`` or more than one base, and those that change nothing or to a stop, go.
    """
    swap = sequences.as_map(COMPLEMENT)
    one = variants.where(F.col("ref").rlike("^[ACGT]$") & F.col("alt").rlike("^[ACGT]$")).join(genes, "gene_id")
    alt = F.when(F.col("reverse"), swap[F.col("alt")]).otherwise(F.col("alt"))
    start = ((F.col("pos") - 1) / 3).cast("int") * 3 + 1
    codon = F.substring("sequence", start, F.lit(3))
    mutated = F.overlay(codon, alt, F.col("pos") - start + 1, F.lit(1))
    rows = one.select("gene_id", "pos", sequences.translate(codon).alias("wt"), sequences.translate(mutated).alias("mut"), ((start - 1) / 3 + 1).cast("int").alias("place"))
    return rows.where((F.col("mut") != "") & (F.col("wt") != F.col("mut"))).select("gene_id", "pos", F.concat("wt", F.col("place").cast("string"), "mut").alias("change"))


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    schema = "gene_id string, pos int, id string, ref string, alt string, qual string, filter string, info string"
    return spark.read.schema(schema).option("sep", "\t").option("comment", "#").csv(path)


def identifier_table(rows: DataFrame) -> DataFrame:
    """(ac, UniProtKB-ID, RefSeq, RefSeq_NT, ensembl) from rows (ac, id_type, value)."""
    kinds = ["UniProtKB-ID", "RefSeq", "RefSeq_NT"]
    single = rows.groupBy("ac").pivot("id_type", kinds).agg(F.min("value"))
    ensembl = rows.where(F.col("id_type").startswith("Ensembl")).groupBy("ac").agg(F.array_sort(F.collect_set("value")).alias("ensembl"))
    return single.join(ensembl, "ac", "left")


def resolve(names: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing): names with their accession by any id space; of several the one with an isoform number, then the least."""
    ids = table.select("ac", F.explode(F.array_compact(F.array_distinct(F.concat(F.array("ac", "UniProtKB-ID", "RefSeq", "RefSeq_NT"), F.coalesce("ensembl", F.array().cast("array<string>")))))).alias("protein_id"))
    best = ids.groupBy("protein_id").agg(F.min_by("ac", F.struct(~F.col("ac").contains("-"), "ac")).alias("ac"))
    return names.join(best, "protein_id"), names.join(best, "protein_id", "left_anti")


def first_free_isoform(rows: DataFrame) -> DataFrame:
    """(stem, missing): the least isoform number that no accession ``stem-n`` has."""
    own = rows.where(F.col("ac").contains("-")).groupBy(F.substring_index("ac", "-", 1).alias("stem")).agg(F.collect_set(F.substring_index("ac", "-", -1).cast("int")).alias("n"))
    return own.select("stem", F.array_min(F.array_except(F.sequence(F.lit(1), F.array_max("n") + 1), "n")).alias("missing"))


def whole_protein_positions(proteins: DataFrame, requested: DataFrame) -> DataFrame:
    """Every place of a sequence that was not asked for by itself."""
    every = proteins.select("protein_id", F.posexplode(F.split("sequence", "")).alias("i", "wt")).where("wt <> ''").select("protein_id", (F.col("i") + 1).alias("position_number"), "wt")
    return every.join(requested, ["protein_id", "position_number"], "left_anti")


def sane(positions: DataFrame, proteins: DataFrame) -> DataFrame:
    """Positions with a flag whether the sequence has their letter at their place."""
    letter = F.substring("sequence", F.col("position_number"), F.lit(1))
    return positions.join(proteins.select("protein_id", "sequence"), "protein_id", "left").withColumn("sane", F.coalesce((letter == F.col("wt")) | (F.col("wt") == "X"), F.lit(False))).drop("sequence")


def bridge(alignments: DataFrame) -> DataFrame:
    """(protein_id, structure_id, position_number, seq_index) of aligned pairs (target, template)."""
    pairs = alignments.select("protein_id", "structure_id", F.posexplode(F.arrays_zip(F.split("target", "").alias("a"), F.split("template", "").alias("b"))).alias("i", "p")).where("p.a <> ''")
    own = Window.partitionBy("protein_id", "structure_id").orderBy("i")
    n = lambda c: F.sum((F.col(f"p.{c}") != "-").cast("int")).over(own)
    rows = pairs.withColumn("position_number", n("a")).withColumn("seq_index", n("b"))
    return rows.where("p.a <> '-' AND p.b <> '-'").select("protein_id", "structure_id", "position_number", "seq_index", F.col("p.a").alias("letter"), F.col("p.b").alias("residue_letter"))
