"""What must not grow with the square of a group: results on groups in which all rows are alike, and parts by definition."""

from itertools import permutations

from pyspark.sql import functions as F

from residuum.operators import aggregates, alignment, conservation, distances, fusion, identifiers, joins, profiles


def test_equal_sequences_of_one_large_group(spark):
    """All of one stem and sequence: 1.6 billion pairs, if they were made."""
    rows = spark.range(40_000).select(F.col("id").alias("transcript"), F.lit(1).alias("stem"), F.lit("AC").alias("sequence"))
    found = identifiers.equal_sequences(rows, rows.where("transcript % 2 = 1").withColumnRenamed("transcript", "isoform"))
    assert found.agg(F.count("*"), F.min("isoform"), F.max("isoform")).first() == (40_000, 1, 1)


def test_pairs_are_aligned_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("target string, template string")
    def align(a, b):
        import pandas as pd

        calls.add(len(a))
        return pd.DataFrame({"target": a, "template": b})

    rows = spark.createDataFrame([(i, "AC" if i % 2 else None, "AD") for i in range(50)], "k int, a string, b string")
    found = {tuple(r) for r in alignment.align_distinct(rows, align).select("k", "target", "template").collect()}
    assert found == {(i, "AC" if i % 2 else None, "AD") for i in range(50)}
    assert calls.value == 2


def test_partners_of_isoforms_by_definition(spark):
    genes = [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5)]
    own = [(1, 10), (1, 11), (2, 11), (2, 12), (2, 13), (3, 14), (3, 10), (4, 20), (4, 21), (5, 30), (6, 30), (6, 30)]
    expected = {}
    for (g, x), (h, y) in permutations(set(own), 2):
        label = dict(genes)
        if label[g] == label[h] and g != h and x != y:
            expected.setdefault((label[g], x), set()).add(y)
    found = fusion.isoform_partners(spark.createDataFrame(genes, "gene int, fused int"), spark.createDataFrame(own, "gene int, isoform int"))
    assert {(r["fused"], r["isoform"]): r["n_partners"] for r in found.where("n_partners > 0").collect()} == {k: len(v) for k, v in expected.items()}


def clustered():
    """Points of two dense heaps, some copies and ties among them, and some far off."""
    import random

    rng = random.Random(5)
    rows = [(i, round(rng.gauss(0, 0.02), 3), round(rng.gauss(0, 0.02), 3), 0.0) for i in range(150)] + [(200 + i, rng.uniform(-1, 1), rng.uniform(-1, 1), 0.1) for i in range(40)]
    return rows + [(300 + i, 0.5, 0.5, 0.0) for i in range(12)] + [(400, None, 0.1, 0.1)]


def gap(p, q):
    return sum((a - b) ** 2 for a, b in zip(p[1:], q[1:])) ** 0.5


def test_nearest_in_rounds_is_exact(spark):
    rows = [r for r in clustered() if r[1] is not None]
    expected = set()
    for p in rows:
        near = sorted((gap(p, q), q[0]) for q in rows if q[0] != p[0] and gap(p, q) <= 0.3)[:4]
        expected |= {(p[0], k, i + 1) for i, (_, k) in enumerate(near)}
    found = joins.nearest_within(spark.createDataFrame(clustered(), "k long, x double, y double, z double"), "k", ["x", "y", "z"], 0.3, 4)
    assert {(r["k"], r["k_b"], r["place"]) for r in found.collect()} == expected


def test_neighbour_stats_by_definition(spark):
    import statistics

    rows = [r for r in clustered() if r[1] is not None]
    expected = {}
    for p in rows:
        near = [(gap(p, q), q[1]) for q in rows if 0 < gap(p, q) <= 0.05]
        if near:
            expected[p[0]] = (len(near), round(statistics.median(v for _, v in near), 9), round(sum(v / d for d, v in near) / sum(1 / d for d, _ in near), 9))
    found = distances.neighbour_stats(spark.createDataFrame(clustered(), "k long, x double, y double, z double"), "k", ["x", "y", "z"], "x", 0.05, block=20)
    assert {r["k"]: (r["n"], round(r["median"], 9), round(r["weighted"], 9)) for r in found.collect()} == expected


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def letters_of(spark, tmp_path):
    """Aligned sequences in a file so small that Spark would broadcast whatever is made of it."""
    rows = [("g", i, ["AAR-", "ARR-", "A-RA"][i % 3]) for i in range(6)] + [("h", 9, "AR-A")]
    spark.createDataFrame(rows, "k string, member int, aligned string").write.parquet(f"{tmp_path}/a")
    matrix = spark.createDataFrame([("A", [4.0, -1.0, -4.0]), ("R", [-1.0, 5.0, -4.0]), ("-", [-4.0, -4.0, 1.0])], "symbol string, row array<double>")
    return spark.read.parquet(f"{tmp_path}/a"), matrix


def test_letters_are_not_broadcast(spark, tmp_path):
    aligned, matrix = letters_of(spark, tmp_path)
    scores = conservation.conservation(aligned, matrix, ["k"], symbols="AR-")
    assert broadcasts(scores) == 1  # the matrix
    found = {(r["k"], r["place"]): r for r in scores.collect()}
    # by definition: in column 2 each of three symbols is that of two members of six
    assert found["g", 2]["n"] == 6 and abs(found["g", 2]["g"] - 1 / 3) < 1e-12
    # every sequence of g weighs 1/6 in columns of one symbol and of three; 1/(2 * 4) or 1/(2 * 2) in the last
    w = [(1 / 6 + 1 / 6 + 1 / 6 + x) / 4 for x in (1 / 8, 1 / 8, 1 / 4)]
    from math import log2

    h = -sum(2 * x * log2(2 * x) for x in w)
    assert abs(found["g", 2]["t"] - h / log2(3)) < 1e-12


def test_scores_of_letters_in_place(spark, tmp_path):
    aligned, _ = letters_of(spark, tmp_path)
    scores = spark.createDataFrame([("g", 1, 0.1), ("g", 3, 0.3), ("g", 4, None), ("h", 2, 0.2)], "k string, place int, score double")
    found = conservation.of_sequence(scores, aligned, ["k"])
    assert broadcasts(found) == 0
    own = {"AAR-": [(1, 0.1), (3, 0.3)], "ARR-": [(1, 0.1), (3, 0.3)], "A-RA": [(1, 0.1), (2, 0.3), (3, None)]}
    expected = {("g", i, p, s) for i in range(6) for p, s in own[["AAR-", "ARR-", "A-RA"][i % 3]]} | {("h", 9, 2, 0.2)}
    assert {tuple(r) for r in found.collect()} == expected


def test_isoforms_in_columns_without_rows_for_places(spark):
    majors = spark.createDataFrame([("g", "ABC")], "gene string, sequence string")
    isoforms = spark.createDataFrame([("g", 1, "ABC"), ("g", 2, "AXXC"), ("g", 3, "YAB")], "gene string, isoform int, sequence string")
    insertions = spark.createDataFrame([("g", 2, 1, 2), ("g", 3, 0, 1), ("g", 3, 3, 1)], "gene string, isoform int, position int, length int")
    deletions = spark.createDataFrame([("g", 2, 2), ("g", 3, 3)], "gene string, isoform int, position int")
    found = fusion.isoform_columns(majors, isoforms, insertions, deletions)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    # columns: one before A, A, two after A, B, C, one after C; letters of isoform 3 end before its last insertion
    assert {r["isoform"]: r["aligned"] for r in found.collect()} == {None: "-A--BC-", 1: "-A--BC-", 2: "-AXX-C-", 3: "YA--B--"}


def test_a_common_position_is_dealt_out(spark):
    """All structures cover the same two positions."""
    covered = spark.range(300).select(F.lit("p").alias("protein"), F.col("id").alias("structure"), F.lit("A").alias("chain"), F.lit("B").alias("chain_b"), F.explode(F.array(F.lit(1), F.lit(2))).alias("position"))
    known = spark.createDataFrame([("p", 7, 1), ("p", 8, 3)], "protein string, number int, position int")
    found = profiles.overlapping(covered.where("structure % 2 = 0 OR position = 1"), known.unionByName(known.withColumn("position", F.lit(2))))
    assert "_part" in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    assert {(r["structure"], r["number"], r["overlap"]) for r in rows} == {(s, 7, 2 - s % 2) for s in range(300) if s % 2 == 0} | {(s, 7, 1) for s in range(1, 300, 2)} | {(s, 8, 1) for s in range(0, 300, 2) if 1 > 0.5 * 2}


def test_equal_scores_of_cells_are_ties(spark):
    """Two bonds of equal scores in another order of rows: the contact comes first."""
    values = {"hbond": (0.3, 0.2, 0.1), "cnt": (0.1, 0.2, 0.3)}
    for flip in (1, -1):
        rows = [(1, "mc", bond, "ligand", v) for bond, vs in values.items() for v in vs[::flip]]
        edges = spark.createDataFrame(rows, "k int, side string, bond string, partner string, score double").coalesce(1)
        found = profiles.interaction_class(profiles.edge_profile(edges, ["k"]), ["k"]).first()
        assert found["interaction_class"] == "mc cnt ligand"
    large = spark.createDataFrame([(1e30,), (2e30,)], "v double")
    assert large.agg(aggregates.exact_sum("v")).first()[0] == 1e30 + 2e30


def exchanged(df):
    """Numbers of tasks that are given, not left to Spark."""
    return df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM")


def test_tasks_grow_with_the_rows(spark, sf_dir):
    from residuum.operators import durable
    from residuum.plans import load

    rows = spark.range(1001)
    assert durable.parts_of(rows, 100) == 11 and durable.parts_of(rows.where("id < 0")) == 1
    assert durable.dealt(rows, 11, "id").rdd.getNumPartitions() == 11
    queries = load().QUERIES
    for name in ("fused_ranges", "contact_rollup", "full_annotation", "atom_lines", "partner_report"):
        assert exchanged(queries[name](spark, sf_dir)), name


def test_few_partners_of_very_many_interactions_are_broadcast(spark, tmp_path, monkeypatch):
    from residuum.plans import reports

    ppi = spark.range(600).select((F.col("id") % 5).alias("protein_a"), (F.col("id") % 2).alias("protein_b"), F.col("id").alias("complex_id"), F.lit("A").alias("chain_a"), F.lit("B").alias("chain_b"), F.lit(0.5).alias("score"))
    proteins = spark.range(5).select(F.col("id").alias("protein_id"), F.concat(F.lit("P"), "id").alias("primary_id"))
    session = spark.createDataFrame([(0,), (0,), (3,)], "protein_id long")
    expected = {(f"P{i % 5}", f"P{i % 2}", i, i % 2 == 1) for i in range(600) if i % 5 in (0, 3)}
    for few in (10, 0):
        monkeypatch.setattr(reports, "FEW", few)
        found = reports.partner_report(ppi, session, proteins)
        assert {tuple(r) for r in found.select("name_a", "name_b", "complex_id", "expanded").collect()} == expected and found.count() == len(expected)


def test_betweenness_from_all_nodes_at_once():
    import random

    import pytest

    from residuum.operators import graphs

    rng = random.Random(8)
    for n in (2, 9, 40):
        near = {u: {} for u in range(n)}
        for _ in range(3 * n):
            u, v = rng.sample(range(n - n // 9), 2)
            near[u][v] = near[v][u] = rng.choice([1.0, 2.0, 0.5, 1 / 3])
        expected = dict.fromkeys(near, 0.0)
        for source in near:
            for node, share in graphs._dependency(near, source).items():
                expected[node] += share / 2
        assert graphs._all_dependencies(near) == pytest.approx(expected, abs=1e-9)


def shuffles(df):
    """Exchanges of rows in the plan that Spark would run."""
    import re

    return len(re.findall(r"\bExchange (?:hashpartitioning|SinglePartition)", df._jdf.queryExecution().executedPlan().toString()))


def test_components_within_proteins(spark):
    """Rows are shuffled once, and proteins too large for a task give the same by tables."""
    import random

    rng = random.Random(8)
    rows = [(p, s, c, "Z", rng.randrange(12 + p)) for p in range(6) for s in range(12) for c in "AB" for _ in range(rng.randrange(1, 5))] + [(None, 1, "A", "Z", 1), (2, None, "A", "Z", None)]
    covered = spark.createDataFrame(rows, "protein long, structure int, chain string, chain_b string, position int")
    whole, tables, some = (fusion.interface_components(covered, most=m) for m in (10**6, 0, 50))
    assert shuffles(whole) == 1
    found = [sorted(map(tuple, df.collect())) for df in (whole, tables, some)]
    assert found[0] == found[1] == found[2] and len({r[4] for r in found[0]}) < len(found[0])


def test_substituents_within_structures(spark):
    """Atoms are shuffled once, and structures too large for a task give the same by tables; some atoms tie, some are at one place."""
    import random

    rng = random.Random(9)
    rows = [(s, "AB"[r % 2], r, 100 * r + i, "NCOH"[i], *(float(rng.randrange(14)) for _ in range(3))) for s in range(3) for r in range(30 + s) for i in range(4)] + [(0, "A", 99, 1, "C", None, 1.0, 1.0)]
    atoms = spark.createDataFrame(rows, "structure int, chain string, residue int, serial int, atom string, x double, y double, z double")
    whole, tables, some = (distances.nearest_substituents(atoms, ["structure"], top=5, reach=7.0, sphere=5.0, most=m) for m in (10**6, 0, 124))
    assert shuffles(whole) == 1
    found = [sorted((tuple(r)[:8], [tuple(x) for x in r["sphere"]]) for r in df.collect()) for df in (whole, tables, some)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 100
