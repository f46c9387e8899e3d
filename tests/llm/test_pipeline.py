"""The pipeline: every stage works on what its predecessor kept, and its decisions take effect."""

import sys
from itertools import combinations
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from residuum.llm import decontamination, near_dedup  # noqa: E402


def test_stages(spark, sf_dir, tmp_path):
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append({r["doc_id"]: r["text"] if i < 4 else None for r in docs.collect()})
    assert all(set(after) <= set(before) for before, after in zip(kept, kept[1:], strict=False))
    gone = brute.removed_lines(sorted(kept[0].items()))
    for i, text in kept[0].items():
        lines = [x for p, x in enumerate((text or "").split("\n")) if p not in gone[i]]
        if gone[i] and not any(x.split() for x in lines):
            assert i not in kept[1]
        else:
            assert kept[1][i] == (text if not gone[i] else "\n".join(lines))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert set(kept[3]) == {i for i, t in kept[2].items() if not brute.contamination(t, items)[1]}
    words = {i: decontamination.words_of((t or "").encode()) for i, t in kept[1].items()}
    label = {i: i for i in words}
    for a, b in combinations(sorted(words), 2):
        if words[a] and words[b] and label[a] != label[b] and near_dedup.alike(words[a], words[b]):
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {i: new if x == old else x for i, x in label.items()}
    assert set(kept[2]) == {i for i, x in label.items() if i == x}
    tokenizer, places, own = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY)), {}, {}
    for r in docs.collect():
        own.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {i: sorted(x) for i, x in own.items()} == {i: brute.pieces(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in kept[3].items()}
    for at in places.values():
        assert [o for o, _ in sorted(at)] == [sum(n for _, n in sorted(at)[:k]) for k in range(len(at))] and sum(n for _, n in at) <= 2048
    result = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in result.collect()} == set(kept[4])


def test_stages_on_odd_rows(spark, sf_dir):
    """Null and empty texts, repeated rows, nulls in other columns, and no row at all pass through every stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(900_001, None, None, None, None), (900_002, "", "en", "a", 0), (900_003, "one two three", "en", "a", 13), (900_003, "one two three", "en", "a", 13)], docs.schema)
    for rows, least in ((docs.limit(0), 0), (docs.limit(60).unionByName(odd), 1)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            rows = stage(spark, rows, sf_dir)
            assert i == 4 or rows.columns == docs.columns
        assert rows.count() >= least
