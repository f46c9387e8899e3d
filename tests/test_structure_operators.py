"""Density, distances, fusion, conservation, CIF and refresh against definitions on small cases."""

import math
import random

import numpy as np
import pytest

from residuum.functions import sequences
from residuum.operators import conservation, density, distances, fusion, graphs, indels, store
from residuum.sources import cif, structures
from residuum.streaming import flows

# density


def test_predicted_centroid_turns_with_the_chain(spark):
    """In the frame of its neighbours the centroid is the tabulated one, whatever the chain's turn and place."""
    rng, rows, want = np.random.default_rng(1), [], {}
    for k, name in enumerate(["TRP", "GLY", "UNK", "ZZZ"] * 5):
        q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
        q *= np.sign(np.linalg.det(q))
        at = rng.normal(size=3) * 20
        before, after = np.array([rng.uniform(1, 4), 0, 0]), np.array([rng.uniform(-3, 3), rng.uniform(0.5, 3), 0])
        for i, p in enumerate((before, np.zeros(3), after)):
            rows.append((f"s{k}", i + 1, name, *map(float, q @ p + at)))
        want[f"s{k}"] = q @ np.array(density.SIDE_CENTROID.get(name, density.SIDE_CENTROID["UNK"])) + at
    df = spark.createDataFrame(rows, "s string, number int, name string, x double, y double, z double")
    found = {(r["s"], r["number"]): (r["cx"], r["cy"], r["cz"]) for r in density.predicted_centroids(df, ["s"]).collect()}
    for k, v in want.items():
        assert np.allclose(found[k, 2], v)
    assert found["s0", 1] == rows[0][3:] and found["s0", 3] == rows[2][3:]  # without both neighbours: the atom itself


def test_predicted_centroid_without_a_frame(spark):
    rows = [("line", i, "TRP", float(i), 0.0, 0.0) for i in range(3)] + [("gap", i, "TRP", float(i), float(i * i), 0.0) for i in (1, 2, 4)] + [("same", i, "TRP", 1.0, 1.0, 1.0) for i in range(3)]
    found = density.predicted_centroids(spark.createDataFrame(rows, "s string, number int, name string, x double, y double, z double"), ["s"])
    assert all((r["cx"], r["cy"], r["cz"]) == (r["x"], r["y"], r["z"]) for r in found.collect())


def test_density_of_two_residues(spark):
    """Two glycines: the whole sphere around each, less the lens that it shares with the other."""
    rows = [("s", "A", 1, "GLY", 0.0, 0.0, 0.0), ("s", "B", 1, "GLY", 8.0, 0.0, 0.0), ("t", "A", 1, "GLY", 0.0, 0.0, 0.0)]
    found = {(r["s"], r["chain"]): r["density"] for r in density.density_by_alpha(spark.createDataFrame(rows, "s string, chain string, number int, name string, x double, y double, z double"), ["s"]).collect()}
    big, small, d = density.ALPHA_RANGE["GLY"], density.RESIDUE_RADIUS["GLY"], 8.0
    lens = math.pi * (big + small - d) ** 2 * (d**2 + 2 * d * small - 3 * small**2 + 2 * d * big + 6 * small * big - 3 * big**2) / (12 * d)
    v = 4 / 3 * math.pi * (big**3 - small**3)
    assert found["s", "A"] == pytest.approx((v - lens) / v) and found["s", "A"] == pytest.approx(found["s", "B"]) and found["t", "A"] == 1.0


def test_distances_of_given_pairs(spark):
    atoms = spark.createDataFrame([("s", "A", 1, 1, "N", 0.0, 0.0, 0.0), ("s", "A", 1, 2, "CA", 3.0, 0.0, 0.0), ("s", "B", 2, 3, "N", 100.0, 0.0, 0.0), ("s", "B", 2, 4, "C", 100.0, 0.0, 0.0)], "s string, chain string, residue int, serial int, atom string, x double, y double, z double")
    pairs = spark.createDataFrame([("s", "A", 1, "B", 2), ("s", "A", 1, "B", 9)], "s string, chain string, residue int, chain_b string, residue_b int")
    found = {r["residue_b"]: tuple(r)[-3:] for r in distances.distances_of(pairs, atoms, ["s"]).collect()}
    assert found == {2: (97.0, "CA", "N"), 9: (None, None, None)}
    assert distances.least_distances(atoms, ["s"], 10.0).count() == 0


# fusion


def folded(rows):
    """The fold by sets: interfaces as dictionaries in a list, renumbered when several become one."""
    known = []
    for source in sorted({r[:3] for r in rows}):
        own = [(r[4], r[5]) for r in rows if r[:3] == source]
        score = next(r[3] for r in rows if r[:3] == source)
        near = [k for k in known if (n := sum(p in k["at"] for _, p in own)) and (n > len(own) / 2 or n > len(k["at"]) / 2)]
        if not near:
            near = [{"at": {}, "score": score, "best": source, "from": []}]
            known += near
        for k in near:
            better = score > k["score"]
            for residue, p in sorted(own, key=lambda x: (x[1], x[0])):
                if p not in k["at"] or better:
                    k["at"][p] = (*source[:2], residue)
            if better:
                k["score"], k["best"] = score, source
        near[0]["from"].append(source)
        for k in near[1:]:
            first = near[0]
            greater, lesser = (k, first) if k["score"] > first["score"] else (first, k)
            first["at"], first["score"], first["best"] = greater["at"] | lesser["at"], greater["score"], greater["best"]
            first["from"] += k["from"]
            known.remove(k)
    return known


def test_interface_fold_by_sets(spark):
    rng, rows, collapsed = random.Random(7), {}, 0
    for protein in ("p", "q", "r"):
        rows[protein] = []
        for s in range(40):
            score, start = float(rng.randrange(100)), rng.randrange(60)
            places = sorted(rng.sample(range(start, start + rng.choice([4, 8, 25])), rng.randrange(1, 4)))
            rows[protein] += [(f"s{s:02}", "A", "B", score, f"r{p}", p) for p in places]
    df = spark.createDataFrame([(p, *r) for p, own in rows.items() for r in own] + [(None, "s", "A", "B", 1.0, "r", 1), ("p", "s00", "A", "B", 1.0, "r", None)], "protein string, structure string, chain string, chain_b string, score double, residue string, position int")
    interfaces, positions, sources = fusion.fold_interfaces(df)
    got = {(r["protein"], r["number"]): (r["structure"], r["chain"], r["chain_b"], r["score"]) for r in interfaces.collect()}
    at = {(r["protein"], r["number"], r["position"]): (r["structure"], r["chain"], r["residue"]) for r in positions.collect()}
    of = {(r["protein"], r["number"], r["structure"]) for r in sources.collect()}
    for p, own in rows.items():
        want = folded(own)
        collapsed += 40 - sum(len(k["from"]) == 1 for k in want)
        assert {n: v for (q, n), v in got.items() if q == p} == {i: (*k["best"], k["score"]) for i, k in enumerate(want)}
        assert {(n, x): v for (q, n, x), v in at.items() if q == p} == {(i, x): v for i, k in enumerate(want) for x, v in k["at"].items()}
        assert {(n, s) for q, n, s in of if q == p} == {(i, s[0]) for i, k in enumerate(want) for s in k["from"]}
    assert collapsed
    assert all(x.count() == 0 for x in fusion.fold_interfaces(df.limit(0)))


def test_one_interface_joins_two(spark):
    rows = [("p", "1", "A", "B", 1.0, f"r{i}", i) for i in (1, 2, 3)] + [("p", "2", "A", "B", 5.0, f"t{i}", i) for i in (7, 8, 9)] + [("p", "3", "A", "B", 3.0, f"u{i}", i) for i in (2, 3, 7, 8)]
    interfaces, positions, sources = fusion.fold_interfaces(spark.createDataFrame(rows, "protein string, structure string, chain string, chain_b string, score double, residue string, position int"))
    assert [tuple(r) for r in interfaces.collect()] == [("p", 0, "2", "A", "B", 5.0)]
    assert sorted(r["position"] for r in positions.collect()) == [1, 2, 3, 7, 8, 9] and {r["number"] for r in sources.collect()} == {0}
    contacts = spark.createDataFrame([("p", s, "A", "B", 2, "q", 5, x) for s, x in (("1", 1.0), ("3", 4.0))], "protein string, structure string, chain string, chain_b string, position int, protein_b string, position_b int, score double")
    found = fusion.interface_contacts(sources, contacts).collect()
    assert [(r["number"], r["structure"], r["score"]) for r in found] == [(0, "3", 4.0)]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(50)] + [(500, 500), (None, 3)]
    parent = {x: x for e in edges if None not in e for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    found = {r["id"]: r["label"] for r in fusion.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert found == {x: root(x) for x in parent}


def test_genes_with_names_in_common(spark):
    names = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (3, "y"), (4, "z"), (5, None)], "gene int, name string")
    isoforms = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "a"), (4, "d")], "gene int, isoform string")
    genes, pairs = fusion.fused_genes(names, isoforms)
    assert {r["gene"]: r["fused_id"] for r in genes.collect()} == {1: "1|2|3", 2: "1|2|3", 3: "1|2|3", 4: "4", 5: "5"}
    assert {tuple(r)[1:] for r in pairs.collect()} == {("a", "b"), ("b", "a"), ("a", "c"), ("c", "a"), ("b", "c"), ("c", "b")}


def test_changes_that_touch(spark):
    rows = [("g", "del", 5, 9, ""), ("g", "sub", 9, 12, "AC"), ("g", "sub", 11, 11, "GGG"), ("g", "del", 20, 20, ""), ("g", "ins", 6, 7, "T"), ("g", "ins", 30, 31, "A"), ("g", "ins", 30, 31, "TT"), ("g", "ins", 12, 13, "C"), ("g", "snv", 12, 12, "K"), ("g", "snv", 13, 13, "L"), ("h", "snv", 6, 6, "M")]
    fused, single = fusion.fused_changes(spark.createDataFrame(rows, "gene string, kind string, left int, right int, inserted string"), ["gene"])
    assert {tuple(r) for r in fused.collect()} == {("g", "sub", 5, 12, "GGG"), ("g", "del", 20, 20, None), ("g", "ins", 30, 31, "TT"), ("g", "ins", 12, 13, "C")}
    assert {tuple(r)[:4] for r in single.collect()} == {("g", "snv", 13, 13), ("h", "snv", 6, 6)}


# conservation, stretches, networks


def test_matrix_and_conservation(spark):
    text = ["# a comment", "   A  R  -", "A  4 -1 -4", "R -1  5 -4", "- -4 -4  1", ""]
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "f string, line int, value string")
    scores = structures.parse_matrix(lines, ["f"])
    assert {(r["a"], r["b"]): r["score"] for r in scores.collect()}["R", "A"] == -1
    matrix = structures.matrix_rows(scores, ["f"], "AR-").drop("f")
    aligned = spark.createDataFrame([("k", "1", "AA-"), ("k", "2", "AR-"), ("one", "1", "A")], "k string, member string, aligned string")
    found = {(r["k"], r["place"]): r for r in conservation.conservation(aligned, matrix, ["k"], symbols="AR-").collect()}
    assert found["k", 1]["score"] == pytest.approx(1.0) == found["one", 1]["score"] and found["k", 3]["score"] == 0.0
    # each sequence: the mean over the columns of one over (kinds times those alike)
    w = (1 / 2 + 1 / 2 + 1 / 2) / 3
    t = -2 * w * math.log2(w) / math.log2(2)
    apart = math.sqrt(2.5**2 + 3**2)
    r = 2 * apart / (2 * math.sqrt(20) * 9)
    assert (found["k", 2]["t"], found["k", 2]["r"]) == (pytest.approx(t), pytest.approx(r))
    assert found["k", 2]["score"] == pytest.approx((1 - t) * math.sqrt(1 - r))


def test_stretches_and_trimming(spark):
    rows = [("XXABCDXABCDEFGHIJKXX",), ("ABCDEFGHIJX",), ("ABC",), ("XXX",), ("",), ("ABCDEFGHIJKXABCDEFGHIJ",)]
    df = spark.createDataFrame(rows, "s string").select("s", sequences.known_stretches("s").alias("k"), sequences.unknown_portions("s").alias("u"))
    found = {r["s"]: ([tuple(x) for x in r["k"]], [tuple(x) for x in r["u"]]) for r in df.collect()}
    assert found["XXABCDXABCDEFGHIJKXX"] == ([(7, "ABCDEFGHIJK")], [(0, 7), (18, 20)])
    assert found["ABCDEFGHIJX"] == ([(0, "ABCDEFGHIJ")], [(10, 11)]) and found["ABC"] == ([(0, "ABC")], [])
    assert found["XXX"] == ([], [(0, 3)]) and found[""] == ([], []) and len(found["ABCDEFGHIJKXABCDEFGHIJ"][0]) == 2
    rows = spark.createDataFrame([("ABCDEFG", "--CDE--"), ("AB", "--")], "a string, b string")
    assert [tuple(r[0]) for r in rows.select(sequences.trimmed("a", "b", 1)).collect()] == [("BCDEF", "-CDE-", 1), ("", "", 1)]


def test_networks_over_a_gap(spark):
    places = graphs.alignment_places(spark.createDataFrame([("k", "AC-D", "A-GD")], "k string, target string, template string"), ["k"])
    before = spark.createDataFrame([("k", "B", 1, 1, 10.0), ("k", "B", 1, 2, 4.0), ("k", "B", 1, 3, 5.0)], "k string, chain string, residue int, position int, score double")
    after = spark.createDataFrame([("k", "B", 1, 1, 9.0), ("k", "B", 1, 2, 2.0), ("k", "B", 1, 3, 8.0)], "k string, chain string, residue int, position int, score double")
    found = {r["node"]: r["kind"] for r in graphs.superimposed(before, after, places, ["k"]).collect()}
    assert found == {"1A": "common", "2C/-": "lost", "-/2G": "new", "3D": "changed"}


def test_analyses(spark):
    rows = [(k, t, w, m) for k in ("ins", "del", "sub") for t in (False, True) for w in (0, 1) for m in (0, 1)]
    df = spark.createDataFrame(rows, "k string, t boolean, w int, m int").select("*", indels.analyses("k", "t", "w", "m").alias("a"))
    found = {tuple(r)[:4]: r["a"] for r in df.collect()}
    assert found["ins", False, 0, 0] == [] and found["ins", False, 1, 0] == ["FRA"] and found["del", True, 0, 1] == ["FRC"]
    assert found["sub", False, 0, 1] == ["FRA", "InCl", "CFRI"] and found["del", False, 1, 1] == ["FRA", "InCl", "CFRI", "CFRA"]


# CIF

CIF = """data_1ABC
# a comment with loop_ in it
_struct.title 'It''s 5'-end'
_refine.ls_d_res_high   2.10
_cell.text
;first line
_atom_site.id
;
loop_
_atom_site.group_PDB
_atom_site.id
_atom_site.label_atom_id
_atom_site.label_alt_id
_atom_site.label_comp_id
_atom_site.label_asym_id
_atom_site.auth_seq_id
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.pdbx_PDB_model_num
ATOM 1 "O5'" . DA A 1 1.5 -2.0 3 1
ATOM 2 CA B ALA A 2 1 2 3 1
HETATM 3 ZN A ZN A ? 1 2 3 1
ATOM 4 N . ALA A 3 1 2 ? 2
loop_
_other.a
_other.b
1 2 3
"""


def test_cif(spark):
    texts = spark.createDataFrame([("f", CIF), ("empty", ""), ("none", None), ("broken", "loop_ _atom_site.id 'unclosed")], "file string, value string")
    atoms = sorted(cif.parse_atoms(texts.where("file <> 'broken'"), ["file"]).collect(), key=lambda r: r["serial"])
    assert [(r["serial"], r["atom"], r["res_num"], r["x"], r["z"]) for r in atoms] == [(1, "O5'", 1, 1.5, 3.0), (3, "ZN", None, 1.0, 3.0)]
    assert {r["file"]: r["resolution"] for r in cif.resolution(texts, ["file"]).collect()} == {"f": 2.1, "empty": None, "none": None, "broken": None}
    assert cif.category_rows(CIF, "cell", ["text"]) == [("first line\n_atom_site.id",)]
    assert cif.category_rows(CIF, "struct", ["title", "absent"]) == [("It''s 5'-end", None)]
    assert cif.category_rows(CIF, "other", ["b"]) == [("2",)]


def test_cif_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.cif").write_text(CIF.replace("2.10", f"{i}.5"))
    found = cif.resolution(cif.read_cif(spark, str(tmp_path)), ["file"]).collect()
    assert sorted(r["resolution"] for r in found) == [0.5, 1.5, 2.5]


# refresh


def test_refresh(spark):
    state = spark.createDataFrame([("a", 5), ("b", 5)], "id string, modified_at int")
    seen = spark.createDataFrame([("a", 4), ("a", 5), ("b", 6), ("b", 7), ("c", 1), (None, 9), ("d", None)], "id string, modified_at int")
    due, after = store.refresh(state, seen)
    assert {tuple(r) for r in due.collect()} == {("b", 7), ("c", 1)} and {tuple(r) for r in after.collect()} == {("a", 5), ("b", 7), ("c", 1)}


def test_refresh_stream_with_late_and_repeated_notices(spark, tmp_path):
    folder, schema = tmp_path / "in", "id string, modified_at timestamp"
    folder.mkdir()
    query = None
    got = []
    for i, rows in enumerate(([("a", 5), ("a", 6), ("b", 5)], [("a", 4), ("a", 6), ("b", 7)], [("b", 6), ("c", 1)])):
        (folder / f"{i}.json").write_text("\n".join(f'{{"id": "{k}", "modified_at": "2024-01-{d:02}T00:00:00"}}' for k, d in rows))
        stream = flows.due(spark.readStream.schema(schema).json(str(folder)), "60 days")
        query = stream.writeStream.foreachBatch(lambda df, _: got.append({(r["id"], r["modified_at"].day) for r in df.collect()})).outputMode("update").option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start()
        query.awaitTermination(120)
    assert [x for x in got if x] == [{("a", 6), ("b", 5)}, {("b", 7)}, {("c", 1)}]
