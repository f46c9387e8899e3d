"""Odd lines of the feature sources and sinks, and identifier chains on small cases."""

from residuum.operators import identifiers
from residuum.plans import reports
from residuum.sources import features, inputs, writers


def lines(spark, *texts):
    return spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "f string, line int, value string")


def test_accessibility_odd_lines(spark):
    row = "    1   10 A a  E" + " " * 17 + " 135  27 " + "x".rjust(3) + " " * 10
    found = features.parse_accessibility(lines(spark, row, "  #  RES", row, "short", None, " " * 60, row.replace(" a ", " Z ")), ["f"]).collect()
    assert [(r["chain"], r["residue"], r["aa"], r["rsa"], r["main_chain"], r["side_chain"], r["phi"]) for r in sorted(found, key=lambda r: r["aa"])] == [("A", "10", "C", 1.0, 0.2, None, None), ("A", "10", "Z", None, None, None, None)]
    assert features.parse_accessibility(lines(spark, row), ["f"]).count() == 0


def test_bonds_without_values(spark):
    found = features.parse_bonds(lines(spark, "SSBOND   1 CYS A   10    CYS B   20", "SSBOND", "ATOM", None), ["f"]).collect()
    assert {(r["kind"], r["chain"], r["residue"], r["chain_b"], r["residue_b"], r["value"]) for r in found if r["chain"]} == {("ssbond", "A", "10", "B", "20", None), ("ssbond", "B", "20", "A", "10", None)}


def test_pockets_disorder_and_ligands(spark):
    text = spark.createDataFrame([("a A B 1 h G 0.5 1 2 3 4 0.9",), ("too few",), (None,), ("query aa chain pos hit aa chain pos site bb all n lddt id",)], "value string")
    assert [(r["hit_chain"], r["site_identity"], r["identity"]) for r in features.parse_pockets(text).collect()] == [("gap", 0.5, 0.9)]
    entries = spark.createDataFrame([('{"acc": "P1"}',), ("{",), (None,), ('{"acc": "P2", "mobidb_consensus": {"disorder": {"predictors": [{"method": "mobidb-lite", "scores": null, "regions": [["1", "x"]]}]}}}',)], "value string")
    assert [(r["accession"], [tuple(x) for x in r["regions"]]) for r in features.parse_disorder(entries).collect()] == [("P2", [(1, None, None)])]
    smiles, inchi = spark.createDataFrame([("CC\tL1",), ("broken",)], "value string"), spark.createDataFrame([("I1\tL1",), ("I2\tL2",)], "value string")
    assert {tuple(r) for r in features.ligands(smiles, inchi).collect()} == {("L1", "CC", "I1"), ("L2", None, "I2")}


def test_sequences_and_headers(spark, tmp_path):
    (tmp_path / "s.fasta").write_text(">sp|P1|N\nAC\nDE\n>Q2 more\nFG\n>EMPTY\n")
    assert {tuple(r) for r in features.read_sequences(spark, str(tmp_path)).collect()} == {("P1", "ACDE"), ("Q2", "FG"), ("EMPTY", "")}
    records = spark.createDataFrame([("P1 A2G<x,y;C3D text\n<E4F #t\nMAGHKL",), ("P2\nMAGHKL",)], "value string")
    found = {r["entry_id"]: [(m["change"], m["tags"]) for m in r["mutations"]] for r in inputs.parse_fasta_records(records).collect()}
    assert found == {"P1": [("A2G", ["x", "y"]), ("C3D", []), ("E4F", ["#t"])], "P2": []}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "ACDEFG"), ("b", "ACD"), (None, "A")], "id string, sequence string")
    assert {r[0] for r in writers.fasta(rows, width=3).collect()} == {">a\nACD\nEFG", ">b\nACD", None}
    table = writers.markdown(spark.createDataFrame([("x|y", None)], "k string, v int"))
    writers.write_text(table, str(tmp_path / "t"), order=["line"])
    assert "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))) == "| k | v |\n|---|---|\n| x\\|y |  |\n"


def test_chains_of_identifiers(spark):
    requests = spark.createDataFrame([("1ABC:-", 1), ("1ABC:A", 2), ("2xyz-", 3), ("9zzz:-", 4)], "request string, n int")
    chains = spark.createDataFrame([("1abc", "A", "Protein"), ("1abc", "B", "DNA"), ("1abc", "C", "Protein"), ("2xyz", "A", "Protein")], "structure string, chain string, kind string")
    assert sorted(map(tuple, identifiers.requested_chains(requests, chains).collect())) == [("1ABC:A", 1), ("1ABC:A", 2), ("1ABC:C", 1), ("2xyz:A", 3)]
    proteins = spark.createDataFrame([("g", "p", 0, "ACD", None), ("g", "q", 1, "ACDE", 0.5), ("g", "r", 2, "ACDE", 2.0), ("h", "s", 0, "A", None)], "gene string, protein string, order int, sequence string, e double")
    assert {r["gene"]: r["protein"] for r in identifiers.wild_types(proteins, tag="e").collect()} == {"g": "r", "h": "s"}
    assert {r["gene"]: r["protein"] for r in identifiers.wild_types(proteins).collect()} == {"g": "q", "h": "s"}


def test_recommendations(spark):
    rows = spark.createDataFrame([("1abc:A;0.9;1.0;2.1",), ("AF-X;1;1;-",), ("1abc;2",), ("-",), (None,)], "r string")
    found = [tuple(r) for r in rows.select(*reports.recommended_parts("r")).collect()]
    assert found == [("1abc:A", "0.9", "1.0", "2.1", False), ("AF-X", "1", "1", "-", True), *[("-",) * 4 + (False,)] * 3]


def test_checksums_and_codecs(spark):
    import zlib

    from residuum.functions import sequences

    texts = ["", "a", "Wikipedia", "é\U0001f600" * 5000, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(sequences.adler32("t")).collect()] == [None if t is None else zlib.adler32(t.encode()) for t in texts]
    pairs = spark.createDataFrame([("AB,C",), ("",), (None,)], "t string").select(sequences.homomers("t").alias("p")).select("p", sequences.homomer_text("p").alias("t")).collect()
    assert [(x["chain"], x["chains"]) for x in pairs[0]["p"]] == [("A", ["A", "B"]), ("B", ["A", "B"]), ("C", ["C"])] and [r["t"] for r in pairs] == ["AB,C", "", None]


def test_bins_around_the_median(spark):
    from residuum.operators import windows

    rows = [("few", i) for i in range(9)] + [("dense", i) for i in (1, 2, 3, 5, 6, 7, 8, 9, 10, 11)] + [("far", v) for v in (0, 1000, 5000, 5001, 5002, 5003, 5004, 5100, 9000, 20000)] + [("far", 5002)]
    found = {}
    for r in windows.median_bins(spark.createDataFrame(rows, "g string, v int"), ["g"], "v").collect():
        found.setdefault((r["g"], r["first"], r["last"]), set()).add(r["v"])
    assert found["few", None, None] == set(range(9)) and len(found["dense", 1, 11]) == 10
    assert found["far", 5000, 5004] == {5000, 5001, 5002, 5003, 5004} and found["far", None, None] == {0, 1000, 5100, 9000, 20000}
