"""Cases that can be worked out by hand."""

import pytest
from pyspark.sql import functions as F

from residuum.functions import scores, sequences
from residuum.operators import aggregates, store, windows
from residuum.sources import inputs, structures


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("rsa", "place"), [(0.17, "Surface"), (0.16, "Buried"), (0.06, "Buried"), (0.05, "Core"), (None, None)])
def test_exposure(spark, rsa, place):
    assert one(spark, scores.locate(F.lit(rsa).cast("double"))) == place


def test_quality(spark):
    assert one(spark, scores.quality(F.lit(2.0), F.lit(1.0), F.lit(1.0))) == pytest.approx(0.960167, abs=1e-6)


def test_weighted_mean_and_confidence(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0), (None, 9.0)], "v double, q double")
    found = rows.agg(aggregates.weighted_mean("v", "q").alias("m"), aggregates.confidence("v", "q").alias("c"), aggregates.propensity("v").alias("p")).first()
    assert found["m"] == pytest.approx(2.5) and found["c"] == pytest.approx(1.666667, abs=1e-6) and found["p"] == pytest.approx(2 / 3)


def test_far_values_do_not_count(spark):
    rows = spark.createDataFrame([(2.0, 1.0), (9.0, 1.0)], "v double, q double")
    assert rows.agg(aggregates.weighted_distance("v", "q").alias("m")).first()["m"] == 2.0


def test_islands(spark):
    rows = spark.createDataFrame([(n,) for n in (1, 2, 3, 7, 9, 10)], "p int").withColumn("k", F.lit("a"))
    assert sorted((r["first"], r["last"]) for r in windows.islands(rows, ["k"], "p").collect()) == [(1, 3), (7, 7), (9, 10)]


def test_average_rank(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in (5, 3, 3, 1)], "k string, v double")
    assert sorted(r["rank"] for r in aggregates.average_rank(rows, ["k"], "v").collect()) == [1.0, 2.5, 2.5, 4.0]


def test_interface_key(spark):
    assert one(spark, sequences.interface_key(F.array(*map(F.lit, (3, 10, 7))))) == 3000100003


def test_changes(spark):
    assert tuple(one(spark, sequences.parse_change(F.lit("R29L")))) == ("R", 29, "L")
    assert tuple(one(spark, sequences.parse_hgvs(F.lit("p.Arg29Leu")))) == ("R", 29, "L")
    assert one(spark, sequences.parse_change(F.lit("?"))) is None
    assert one(spark, sequences.translate(F.lit("ATGGCTTAAGGG"))) == "MA"


LINES = ["NP_000007.1\tR29L\tlabel:Pathogenic", "P12345", "P12345\tA10_G12del\tgene:G1", "P12345\tA10G,R29L", "1abc:A\tR29_L", "// comment", ""]


def test_mutation_lines(spark):
    rows = inputs.parse_mutation_lines(spark.createDataFrame([(x,) for x in LINES], "value string")).collect()
    assert len(rows) == 6
    by = {(r["protein_id"], r["change"]): r for r in rows}
    assert by["NP_000007.1", "R29L"]["id_kind"] == "refseq" and tuple(by["NP_000007.1", "R29L"]["snv"]) == ("R", 29, "L")
    assert by["P12345", None]["kind"] == "protein"
    assert by["P12345", "A10_G12del"]["gene"] == "G1" and by["P12345", "A10_G12del"]["kind"] == "deletion"
    assert by["P12345", "A10G"]["group"] == by["P12345", "R29L"]["group"] == "A10G,R29L"
    assert by["1abc:A", "R29_L"]["id_kind"] == "structure_chain"


def test_fasta_file(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">P1 some\n<A2G #effect:0.5\nMAGGHKLM\nRAARAFTP\n>TooSimple\nAAAAAAGG\n>BadChar\nMAG-HKL\n")
    rows = {r["entry_id"]: r for r in inputs.read_fasta(spark, str(tmp_path)).collect()}
    assert rows["P1"]["sequence"] == "MAGGHKLMRAARAFTP" and rows["P1"]["valid"]
    assert rows["P1"]["mutations"][0]["change"] == "A2G" and rows["P1"]["mutations"][0]["tags"] == ["#effect:0.5"]
    assert not rows["TooSimple"]["valid"] and not rows["BadChar"]["valid"]


def test_variants(spark):
    genes = spark.createDataFrame([("g", "ATGGCTAAA", False), ("r", "ATGGCTAAA", True)], "gene_id string, sequence string, reverse boolean")
    calls = spark.createDataFrame([("g", 4, "G", "A"), ("g", 6, "T", "C"), ("g", 7, "A", "T"), ("g", 5, "-", "A"), ("r", 4, "C", "T")], "gene_id string, pos int, ref string, alt string")
    assert sorted(tuple(r) for r in inputs.variant_changes(calls, genes).collect()) == [("g", 4, "A2T"), ("r", 4, "A2T")]


def test_contacts(spark):
    rows = structures.parse_contacts(spark.createDataFrame([("A:39:_:ASP (cnt:mc_sc) A:41:_:LEU\t2.220600",), ("no edge",)], "value string")).collect()
    assert sorted((r["residue"], r["residue_b"], r["bond"], r["side"], r["score"]) for r in rows) == [("39", "41", "cnt", "mc", 2.2206), ("41", "39", "cnt", "sc", 2.2206)]


def test_atoms(spark):
    atom = "ATOM  {:>5}  CA {}{} {}{:>4}    {:>8}{:>8}{:>8}  1.00 {:>5}           C"
    text = [atom.format(1, " ", "ALA", "A", 1, "1.000", "2.000", "3.000", "10.0"), atom.format(2, "B", "ALA", "A", 1, "9.000", "2.000", "3.000", "10.0"), atom.format(3, " ", "GLY", "A", 2, "4.000", "5.000", "6.000", "20.0"), "ENDMDL", atom.format(4, " ", "TRP", "A", 3, "1.000", "1.000", "1.000", "1.0")]
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(text)], "file string, line int, value string")
    atoms = structures.parse_atoms(lines, ["file"])
    assert sorted((r["res_name"], r["x"], r["b_factor"]) for r in atoms.collect()) == [("ALA", 1.0, 10.0), ("GLY", 4.0, 20.0)]
    assert structures.residue_sequence(atoms, ["file"]).first()["sequence"] == "AG"


def test_hits(spark):
    lengths = spark.createDataFrame([("short", 80), ("long", 400)], "query string, query_length int")
    hits = spark.createDataFrame([("long", "1ABC-A", 0.75, 40, 100, 0.1), ("short", "1ABC-A,1ABC-B", 0.75, 40, 100, 0.5), ("short", "1ABC-C", 0.8, 60, 100, 0.5)], "query string, targets string, fident double, alnlen int, tlen int, qcov double")
    rows = structures.usable_hits(hits, lengths).collect()
    assert [(r["query"], r["chain"], r["chains"]) for r in rows] == [("short", "C", ["A", "B", "C"])]


def test_identifiers(spark):
    table = inputs.identifier_table(spark.createDataFrame([("P1", "UniProtKB-ID", "A_HUMAN"), ("P1", "RefSeq", "NP_1"), ("P1-2", "RefSeq", "NP_1"), ("P1", "Ensembl_PRO", "ENSP1")], "ac string, id_type string, value string"))
    found, missing = inputs.resolve(spark.createDataFrame([("NP_1",), ("ENSP1",), ("none",)], "protein_id string"), table)
    assert sorted(tuple(r) for r in found.collect()) == [("ENSP1", "P1"), ("NP_1", "P1-2")] and [r[0] for r in missing.collect()] == ["none"]


def test_report_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    store.write_report(rows, str(tmp_path / "r"))
    assert sorted(map(tuple, store.read_report(spark, str(tmp_path / "r"), "k string, v double").collect())) == [("a", 1.5), ("b", None)]
