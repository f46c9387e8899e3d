"""Every query of the catalogue against its SQL twin, on the smallest tables."""

import pytest
from oracle import connect, spark_rows, sql_rows

from residuum.plans import load

CATALOG = load()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(CATALOG.ORACLES))
def test_twin(spark, sf_dir, con, name):
    assert spark_rows(CATALOG.QUERIES[name](spark, sf_dir)) == sql_rows(con, CATALOG.ORACLES[name])


def test_every_twin_has_a_query():
    assert set(CATALOG.ORACLES) <= set(CATALOG.QUERIES)


def test_betweenness_of_a_path(spark):
    """A path of four nodes: the two in the middle lie on two of the three pairs of others each."""
    from residuum.operators.graphs import betweenness

    edges = spark.createDataFrame([("s", 1, 2, 1.0), ("s", 2, 3, 1.0), ("s", 3, 4, 1.0)], "grp string, a int, b int, score double")
    found = {r["node"]: r["betweenness"] for r in betweenness(edges, "grp").collect()}
    assert found[1] == found[4] == 0 and found[2] == found[3] > 0


def shortest(near, source):
    """Distance and number of shortest paths from a node, by relaxation."""
    far = {source: 0.0}
    for _ in near:
        for u in list(far):
            for v, d in near[u].items():
                if far[u] + d < far.get(v, float("inf")) - 1e-12:
                    far[v] = far[u] + d
    paths = {source: 1}
    for v in sorted(far, key=far.get):
        if v != source:
            paths[v] = sum(paths[u] for u in near if v in near[u] and u in far and abs(far[u] + near[u][v] - far[v]) < 1e-12)
    return far, paths


@pytest.mark.parametrize("with_negative", [False, True])
def test_betweenness_by_definition(spark, with_negative):
    """Small random graphs with repeated edges, ties and scores of either sign."""
    import random

    from residuum.operators.graphs import betweenness

    rng, rows = random.Random(21), []
    for g in range(6):
        rows += [(f"g{g}", rng.randrange(8), rng.randrange(8), rng.choice([1.0, 2.0, 0.5, -1.0, 0.0])) for _ in range(18)]
    found = {(r["grp"], r["node"]): r["betweenness"] for r in betweenness(spark.createDataFrame(rows, "grp string, a int, b int, score double"), "grp", with_negative=with_negative).collect()}
    for g in {r[0] for r in rows}:
        best = {}
        for _, a, b, s in (r for r in rows if r[0] == g and r[1] != r[2]):
            key = (min(a, b), max(a, b))
            best[key] = max(best.get(key, float("-inf")), abs(s) if with_negative else s)
        near = {n: {} for k in best for n in k}
        for (a, b), s in best.items():
            if s > 0:
                near[a][b] = near[b][a] = 1 / s
        ways = {n: shortest(near, n) for n in near}
        for v in near:
            total = 0.0
            for s in near:
                for t in near:
                    if s < t and v not in (s, t) and t in ways[s][0] and v in ways[s][0] and t in ways[v][0] and abs(ways[s][0][v] + ways[v][0][t] - ways[s][0][t]) < 1e-9:
                        total += ways[s][1][v] * ways[v][1][t] / ways[s][1][t]
            assert found[g, v] == pytest.approx(total)


def gapped_score(a, b, score, open_, extend):
    """Greatest score of a global alignment with free ends, cell by cell with every gap length."""
    n, m = len(a), len(b)
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            gap = lambda k, free: 0.0 if free else open_ + extend * (k - 1)
            ways = [best[i - 1][j - 1] + score(a[i - 1], b[j - 1])]
            ways += [best[i - k][j] + gap(k, j == m) for k in range(1, i + 1)]
            ways += [best[i][j - k] + gap(k, i == n) for k in range(1, j + 1)]
            best[i][j] = max(ways)
    return best[n][m]


def test_global_alignments_are_best():
    import random

    import numpy as np

    from residuum.operators import alignment

    rng, letters = random.Random(22), "ACDE"
    table = np.full((5, 5), -1.0)
    for i in range(4):
        for j in range(4):
            table[i, j] = 4.0 if i == j else rng.choice([-2.0, -1.0, 1.0])
    table = np.maximum(table, table.T)
    score = lambda p, q: table[letters.index(p), letters.index(q)]
    for _ in range(300):
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(2))
        x, y = alignment.aligned(a, b, table, letters)
        assert len(x) == len(y) and x.replace("-", "") == a and y.replace("-", "") == b
        total, i, n = 0.0, 0, len(x)
        while i < n:
            j = i
            if x[i] == "-" or y[i] == "-":
                side = x if x[i] == "-" else y
                while j < n and side[j] == "-":
                    j += 1
                free = not side[:i].replace("-", "") or not side[j:].replace("-", "")
                total += 0.0 if free else alignment.OPEN + alignment.EXTEND * (j - i - 1)
            else:
                total, j = total + score(x[i], y[i]), i + 1
            i = j
        assert total == pytest.approx(gapped_score(a, b, score, alignment.OPEN, alignment.EXTEND)), (a, b, x, y)


def test_store_keys_may_be_null(spark):
    from residuum.operators import store

    kept = spark.createDataFrame([("p", None), ("q", "A1B")], "protein string, change string")
    rows = spark.createDataFrame([("p", None), ("q", "A1B"), ("q", None), ("q", None)], "protein string, change string")
    assert [tuple(r) for r in store.new_rows(kept, rows, ["protein", "change"]).collect()] == [("q", None)]
    assert store.upserted(kept, rows, ["protein", "change"]).count() == 3


def test_conservation_of_long_names(spark, sf_dir, tmp_path):
    """Names of up to 30 letters in one brand: it has 30 columns, as by the SQL at that width; another brand has 24, as ever."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    names = ["abcdefgh ijklmnop abcdefgh wxyz", "abcdefgh ijklmnop abcdefgh wxy", "abcdefgh ijklmnop abcd", "red bolt"]
    rows = [(i, n[:30], "long", "t") for i, n in enumerate(names)] + [(10 + i, n[:20], "short", "t") for i, n in enumerate(names)]
    pq.write_table(pa.table({k: list(v) for k, v in zip(("p_partkey", "p_name", "p_brand", "p_type"), zip(*rows, strict=True), strict=True)}), tmp_path / "part.parquet")
    sql = CATALOG.ORACLES["column_conservation"]
    wide = sql
    for old, new in (("'-')), 24, '-')", "'-')), 30, '-')"), ("range(1, 25)", "range(1, 31)"), ("0)) / 24 AS w", "0)) / 30 AS w")):
        assert old in wide
        wide = wide.replace(old, new)
    con = connect(str(tmp_path))
    by_brand = lambda rows, brand: [r for r in rows[1] if f"'{brand}'" in r]
    found = spark_rows(CATALOG.QUERIES["column_conservation"](spark, str(tmp_path)))
    for brand, columns, expected in (("long", 30, wide), ("short", 24, sql)):
        own = by_brand(found, brand)
        assert len(own) == columns and own == by_brand(sql_rows(con, expected), brand)
