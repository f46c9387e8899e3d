"""Near duplicates in buckets of very many different texts: no link may be lost."""

import random

import numpy as np

from residuum.llm import components, near_dedup


def test_links_in_large_buckets(spark):
    """Texts of six words over a small vocabulary, alike if they differ in one: every word is in hundreds of texts."""
    rng = random.Random(11)
    texts = sorted({" ".join(f"w{rng.randrange(16)}" for _ in range(6)) for _ in range(2500)})
    label, first = list(range(len(texts))), {}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, text in enumerate(texts):
        own = text.split(" ")
        for p in range(6):
            a, b = sorted((root(i), root(first.setdefault((p, *own[:p], *own[p + 1 :]), i))))
            label[b] = a
    expected = {i: root(i) for i in range(len(texts))}
    assert len(set(expected.values())) < len(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert found == expected


def test_pairs_that_counts_rule_out_are_no_rows(spark):
    """1,200 texts, all in one bucket, that have a passage in common and else nothing: 720,000 pairs, none of them a row."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"w{rng.randrange(10**9)}" for _ in range(60)])) for i in range(1200)]
    rows.append((1200, rows[7][1].replace("p3 ", "q ")))
    docs = spark.createDataFrame(rows, "id long, text string")
    known = near_dedup.sketched(docs, "id", "text", 4, 2, 3, 0).select("id", "n", "bag", "odd")
    members = known.select("id", "id").toDF("id", "label").selectExpr("1L AS key", "id", "label")
    found = near_dedup._met(members, known, 0.8)
    assert [tuple(r) for r in found.select("a", "b").collect()] == [(7, 1200)]


def test_bits_of_words_keep_alike_pairs(spark):
    rng = random.Random(4)
    rows, pairs = [], []
    for i in range(0, 80, 2):
        text = [f"w{rng.randrange(400)}" for _ in range(200)]
        copy = list(text)
        for j in rng.sample(range(200), 40 if i % 4 else 90):
            copy[j] = f"v{rng.randrange(10**6)}"
        rows += [(i, " ".join(text).encode()), (i + 1, " ".join(copy).encode())]
        pairs.append((i, i + 1))
    texts, pairs_ = spark.createDataFrame(rows, "id long, text binary"), spark.createDataFrame(pairs, "a long, b long")
    kept = {r["a"] for r in near_dedup._closer(pairs_, texts, 0.8).collect()}
    alike = {a for a, b in pairs if near_dedup.alike(rows[a][1].split(), rows[b][1].split())}
    assert alike == kept == {i for i in range(0, 80, 2) if i % 4}


def test_pairs_that_marks_rule_out_are_no_rows(spark):
    """600 texts, all in one bucket: a word pair over and over, and a quarter of common words in other numbers. Counts in 128 buckets allow most pairs, the labelled words few."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(["is", "one"] * 300 + [rng.choice(words) for _ in range(240)])) for i in range(600)]
    rows.append((600, rows[7][1].replace("is one is one is one", "is one", 20)))
    docs = spark.createDataFrame(rows, "id long, text string")
    known = near_dedup.sketched(docs, "id", "text", 4, 2, 3, 0).select("id", "n", "bag", "odd")
    members = known.selectExpr("1L AS key", "id", "id AS label")
    loose = near_dedup._met(members, known, 0.8).count()
    found = near_dedup._met(members, known, 0.8, docs.selectExpr("id", "cast(text AS binary) AS text"))
    assert [tuple(r) for r in found.select("a", "b").collect()] == [(7, 600)]
    assert loose > 1000


def test_a_pair_of_many_buckets_is_one_row(spark, monkeypatch):
    """Two alike texts that share ten buckets, all of them crowded, are joined once, without a distinct() afterwards; what texts are compared by is not kept for each bucket."""
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(120))) for i in range(80)]
    rows.append((80, rows[7][1].replace(" w", " v", 5)))
    docs = spark.createDataFrame(rows, "id long, text string")
    known = near_dedup.sketched(docs, "id", "text", 4, 2, 3, 0).select("id", "n", "bag", "odd").cache()
    members = known.selectExpr("explode(sequence(1L, 10L)) AS key", "id", "id AS label")
    kept, cut = [], near_dedup.cut
    monkeypatch.setattr(near_dedup, "cut", lambda df: kept.append(df.columns) or cut(df))
    monkeypatch.setattr(type(docs), "distinct", lambda df: df)
    found = near_dedup._met(members, known, 0.8, docs.selectExpr("id", "cast(text AS binary) AS text"))
    assert [tuple(r) for r in found.select("a", "b").collect()] == [(7, 80)]
    assert {tuple(columns) for columns in kept if "key" in columns} == {("key", "id", "label")}


def test_first_occurrences_alone_have_bits():
    values = np.array([5, 7, 5, 5, 9, 7], np.uint64)
    all_, two = near_dedup.labelled(values), near_dedup.labelled(values, 2)
    assert two.tolist() == all_[[0, 1, 2, 4, 5]].tolist()
    assert not len(near_dedup.labelled(values[:0], 2))


def test_labels_of_many_edges_are_not_broadcast(spark, monkeypatch):
    """A path, a star and a ring: their labels come from shuffles alone where edges are many, and are those of broadcasts."""
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7), (300, 300)]
    expected = {i: 0 for i in range(21)} | {i: 100 for i in range(100, 130)} | {i: 200 for i in range(200, 209)}
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {r["id"]: r["label"] for r in components.components(frame).collect()} == expected
    monkeypatch.setattr(components, "SENT", 0)
    monkeypatch.setattr(components.F, "broadcast", lambda df: 1 / 0)
    assert {r["id"]: r["label"] for r in components.components(frame).collect()} == expected


def test_the_driver_is_freed_in_every_round(spark):
    """A path of 40 takes several rounds; what each leaves in the driver is collected before the next one."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    whole = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    before = whole()
    assert {r["label"] for r in components.components(edges).collect()} == {0}
    assert whole() - before >= 3
