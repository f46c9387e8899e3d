"""Similar lines: what is shuffled once is not shuffled twice, and few bits of words rule out no similar pair."""

import random
import re

from pyspark.sql import functions as F

from residuum.llm import line_dedup


def test_keyed_lines_are_shuffled_once(spark, monkeypatch):
    """Both sides of the join on keys are one shuffle, with lines that are gone among them."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    lines = [rng.sample(words, 30) for _ in range(60)]
    lines += [[*x[:29], f"v{i}"] for i, x in enumerate(lines[:20])]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    kept, whole = [], line_dedup.cut
    monkeypatch.setattr(line_dedup, "cut", lambda df: kept.append(df) or whole(df))
    monkeypatch.setattr(line_dedup, "FAMILY", 2)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = {r["doc"] for r in line_dedup.kept_lines(docs).collect()}
        pairs = next(df for df in reversed(kept) if df.columns == ["doc", "pos", "doc_b", "pos_b"])
        pairs.collect()
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert left == set(range(60))
    assert re.search(r"ReusedExchange \[key#", plan)


def test_few_bits_of_words_bound_what_sets_share(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        x, y = ({rng.randrange(300) * 0x9E3779B97F4A7C15 % (1 << 62) for _ in range(rng.randrange(1, 60))} for _ in "xy")
        rows.append((list(x), list(y), len(x & y)))
    sets = spark.createDataFrame(rows, "x array<long>, y array<long>, common int")
    for bits in (3, 15):
        monkeypatch.setattr(line_dedup, "SENT_BITS", bits)
        most = line_dedup.alike_at_most(F.size("x"), line_dedup.short(F.col("x")), line_dedup.short(F.col("y")))
        found = sets.select("common", most.alias("most")).collect()
        assert all(r["most"] >= r["common"] for r in found)
    assert sum(r["most"] - r["common"] for r in found) < 300
