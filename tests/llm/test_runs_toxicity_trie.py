"""Periodic runs, toxic passages and the prefix trie against plain versions, and their odd rows."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[1]))
sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from oracle import connect, spark_rows, sql_rows  # noqa: E402

from residuum.llm import prefix_trie, queries, tandem_runs, toxicity  # noqa: E402

DOCS, TURNS = "doc_id long, text string", "conv_id long, turn long, role string, text string"
CLASHES = ("found", "_found", "_h", "_w", "_n", "_id", "id", "key", "family", "part", "label", "a.b")


def clashing(df):
    return df.select("*", *(F.lit(1).alias(c) for c in CLASHES if c not in df.columns))


# runs


def periodic_words(rng, n):
    words = []
    while len(words) < n:
        words += [f"w{rng.randrange(3)}" for _ in range(rng.randrange(1, 9))] * rng.choice([1, 1, 2, 3, 5])
    return words


@pytest.mark.parametrize("least", [1, 4, 12])
def test_runs_by_definition(least):
    rng = random.Random(least)
    for _ in range(150):
        docs = [periodic_words(rng, rng.randrange(1, 70)) for _ in range(rng.randrange(1, 6))]
        coded = [np.array([int(w[1:]) for w in d], np.int64) for d in docs]
        assert [[tuple(map(int, r)) for r in x] for x in tandem_runs.runs(coded, least)] == [brute.runs(d, least) for d in docs]


def test_runs_query_by_definition(spark):
    """Rows of the checked result over texts with runs, unchanged and changed by the rule of the ids."""
    rng = random.Random(5)
    rows = [(i, " ".join(periodic_words(rng, rng.randrange(1, 90)))) for i in range(120)] + [(i, None) for i in range(200, 230)] + [(300, ""), (301, " \n "), (302, "x " * 5000), (302, "x " * 5000)]
    docs = spark.createDataFrame(rows, DOCS)
    found = tandem_runs.digest(*tandem_runs.find(tandem_runs.periodic(docs)))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((brute.run_row(i, t) for i, t in rows), key=repr)


def test_runs_twin(spark, sf_dir):
    assert spark_rows(queries.QUERIES["op11_tandem_runs"](spark, sf_dir)) == sql_rows(connect(sf_dir), queries.ORACLES["op11_tandem_runs"])


def test_runs_of_long_texts():
    rng = random.Random(3)
    base = [rng.randrange(900) for _ in range(20_000)]
    for words, want in (([0] * 200_000, [(0, 200_000, 1)]), (base * 10, [(0, 200_000, 20_000)])):
        assert [tuple(map(int, r)) for r in tandem_runs.runs([np.array(words, np.int64)])[0] if r[1] > 50] == want


def test_runs_odd_rows(spark):
    docs = clashing(spark.createDataFrame([(1, None), (1, "a " * 20), (1, "a " * 20), (None, "b c " * 9), (3, "")], DOCS))
    found, name = tandem_runs.find(docs)
    assert found.columns[:-1] == docs.columns and name not in docs.columns
    got = sorted((r[name]["n_words"], [tuple(x) for x in r[name]["runs"]], r[name]["collapsed"]) for r in found.collect())
    assert got == [(0, [], ""), (0, [], ""), (18, [(0, 18, 2)], "b c"), (20, [(0, 20, 1)], "a"), (20, [(0, 20, 1)], "a")]
    assert tandem_runs.digest(*tandem_runs.find(tandem_runs.periodic(spark.createDataFrame([], DOCS)))).count() == 0


# toxicity


def test_segments_by_definition():
    rng = np.random.default_rng(1)
    for n in [0, 1, 2, 5, *rng.integers(3, 60, 200)]:
        scores = rng.normal(-0.2, 1, int(n))
        assert [(a, b) for a, b, _ in toxicity.segments(scores)] == brute.maximal_segments(scores.tolist())


def test_segments_take_linear_time():
    import time

    scores = np.tile([1.0, -0.4, 0.7, -1.2], 250_000)
    start = time.perf_counter()
    toxicity.segments(scores)
    assert time.perf_counter() - start < 20


def test_rate():
    rate = toxicity.rate_of(np.array([1.0, -1.0]), np.array([0.25, 0.75]))
    assert abs(rate - np.log(3)) < 1e-6


def toxic_rows(n, seed=4):
    """Invented prose in which some tenth of the documents has words of abuse, one label in 30 being wrong."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(rng.randrange(20, 300))]
        bad = rng.random() < 0.12
        if bad:
            for _ in range(rng.randrange(1, 6)):
                words.insert(rng.randrange(len(words)), f"abuse{'abcdefgh'[rng.randrange(8)]}")
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad != (rng.random() < 1 / 30))))
    return rows, labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_rows(3000)
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks.where("doc_id % 4 <> 2"))
    found, name = toxicity.scored(docs, model)
    got = {r["doc_id"]: r[name] for r in found.collect()}
    held = [(got[i], "abuse" in t, t) for i, t in rows if i % 4 == 2]
    assert sum(r["score"] >= 0.3 for r, bad, _ in held if bad) >= 0.95 * sum(bad for _, bad, _ in held)
    assert sum(r["score"] >= 0.3 for r, bad, _ in held if not bad) <= 0.01 * len(held)
    for r, bad, t in held:
        assert 0 <= r["score"] <= 1
        for p in r["passages"]:
            assert p["expected"] < toxicity.SIGNIFICANT and (not bad or "abuse" in t[p["start"] : p["end"]])


def test_toxicity_odd_rows(spark):
    rows, labels = toxic_rows(400)
    docs = clashing(spark.createDataFrame([*rows, (None, None), (7, ""), (5000, "!? 12"), (5001, "w1 " * 200_000), (5002, "é\U0001f600 abusea abuseb abusec")], DOCS))
    marks = spark.createDataFrame([*labels, (1, None), (2, 0), (2, 1), (None, 1), (77_777, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    found, name = toxicity.scored(docs, model)
    assert found.columns[:-1] == docs.columns
    got = {r["doc_id"]: (r[name], r["text"]) for r in found.where("doc_id >= 5000 or doc_id is null").collect()}
    assert len(got) == 4 and got[None][0]["score"] == got[5000][0]["score"] <= got[5002][0]["score"]
    spans = [got[5002][1][p["start"] : p["end"]] for p in got[5002][0]["passages"]]
    assert all(s.startswith("abuse") for s in spans)
    for marks_ in (marks.limit(0), marks.where("toxic = 0"), marks.where("toxic = 1")):
        assert toxicity.train(docs, marks_) is None
    found, name = toxicity.scored(docs, None)
    assert {r[0] for r in found.select(f"{name}.score").distinct().collect()} == {0.0}
    assert toxicity.scored(spark.createDataFrame([], DOCS), model)[0].count() == 0


# prefix trie


def conversations(seed, n=400):
    """Ids with gaps, families with and without a base, equal turns and conversations, null roles, texts and numbers."""
    rng = random.Random(seed)
    openings = [[("user", f"q{k}"), (None, f"a{k}"), ("user", None)] for k in range(4)]
    rows = []
    for c in rng.sample(range(-250, 2500), n):
        own = [*rng.choice(openings)[: rng.randrange(4)], *((rng.choice(["user", None, ""]), rng.choice(["x", "yé", "", None])) for _ in range(rng.randrange(5)))]
        numbers = [rng.choice([i, i, None, 3]) for i in range(len(own))]
        rows += [(c, i, role, text) for i, (role, text) in zip(numbers, own)]
    rows += [(None, 0, "user", "left out"), (100, 0, "user", "a|b"), (101, 0, "user", "a"), (101, 0, "user|a", "b")]
    rng.shuffle(rows)
    return rows


def head_of(c):
    return zlib.crc32(str(c).encode()) % 6


def as_sets(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


def head_column():
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6



@pytest.mark.parametrize("part", [200_000, 3])
def test_trie_by_definition(spark, monkeypatch, part):
    monkeypatch.setattr(prefix_trie, "PART", part)
    rows = conversations(part)
    df = spark.createDataFrame(rows, TURNS)
    assert as_sets(prefix_trie.trie(df, head_column())) == sorted(brute.trie(rows, head_of), key=repr)
    assert as_sets(prefix_trie.trie(df)) == sorted(brute.trie(rows, lambda c: 0), key=repr)


def test_trie_twin(spark, sf_dir):
    assert spark_rows(queries.QUERIES["op13_prefix_trie"](spark, sf_dir)) == sql_rows(connect(sf_dir), queries.ORACLES["op13_prefix_trie"])


def test_trie_members(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (102, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "u", "b")]
    found = {tuple(r) for r in prefix_trie.members(spark.createDataFrame(rows, TURNS)).collect()}
    assert found == {(1, 2, 1), (1, 2, 3), (1, 1, 2), (1, 1, 102)}


def test_trie_odd_rows(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "u", "x")], TURNS)).count() == 0
    long = [(5, i, "u", "same") for i in range(200)] + [(6, i, "u", "same") for i in range(200)]
    df = clashing(spark.createDataFrame(long, TURNS))
    found = as_sets(prefix_trie.trie(df, head_column()))
    assert found == sorted(brute.trie(long, head_of), key=repr)
    longer = spark.range(2 * 20_000).select((F.col("id") % 2).alias("conv_id"), (F.col("id") / 2).cast("long").alias("turn"), F.lit("u").alias("role"), F.lit("same").alias("text"))
    root = prefix_trie.trie(longer).where("depth = 0").first()
    assert (root["n_convs"], root["n_leaves"], root["saved_tokens"]) == (2, 1, 4 * 20_000)
