"""Benchmark decontamination by winnowing.

Words of an item are hashed in runs of ``k``; of every ``n - k + 1`` neighbouring runs the
one with the least hash is a fingerprint. Two texts that share ``n`` words in a row share
those runs, hence a fingerprint: no shared span of ``n`` words goes unseen. Fingerprints of
documents are joined to those of the benchmark, and every hit is extended in both
directions to the longest equal span; spans of ``n`` words or more count.

The benchmark side is broadcast in blocks of at most ``block_bytes`` of text. A benchmark
within one block, which is checked, costs one pass over the documents and no shuffle; a
larger one takes a pass for each block and a shuffle of the hits only.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residuum.llm.common import Rolling, cut, free_name, map_batches, quoted

#: Bytes that separate words become spaces, capitals become small letters.
_TABLE = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("item", T.StringType())]))),
])


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and all that is not ASCII."""
    return text.translate(_TABLE).split() if text else []


class Index:
    """Fingerprints of one block of benchmark items, small enough to broadcast."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int, k: int):
        self.n, self.k = n, k
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[str | None, np.ndarray]] = []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if ids:
                self.items.append((item, np.array(ids, np.int64)))
        rolling, at, short = Rolling(), [], defaultdict(list)
        for i, (_, ids) in enumerate(self.items):
            if len(ids) < n:
                short[len(ids)].append((rolling(ids.astype(np.uint64), len(ids))[0], i))
            else:
                hashes = rolling(ids.astype(np.uint64), k)
                at += [(hashes[p], i, p) for p in winnowed(hashes, n - k + 1)]
        at.sort()
        self.prints = np.array([x[0] for x in at], np.uint64)
        self.at = [(i, int(p)) for _, i, p in at]
        self.short = {m: (np.array([h for h, _ in sorted(x)], np.uint64), [i for _, i in sorted(x)]) for m, x in short.items()}


def winnowed(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the least hash of every ``width`` neighbours, the last of equals."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes[::-1], width)
    places = np.argmin(windows, axis=1) + np.arange(len(windows))
    return np.unique(len(hashes) - 1 - places)


def hits(words: list[bytes], index: Index, rolling: Rolling) -> list[tuple[int, int, str | None]]:
    """Spans (first, end, item) of the longest equal runs, each at least as long as a window."""
    get = index.vocabulary.get
    ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
    known = ids >= 0
    if not known.any():
        return []
    values, found = ids.astype(np.uint64), []
    n, k = index.n, index.k
    if len(ids) >= n and len(index.prints):
        hashes = rolling(values, k)
        places = winnowed(hashes, n - k + 1)
        low = np.searchsorted(index.prints, hashes[places], "left")
        high = np.searchsorted(index.prints, hashes[places], "right")
        done: dict[tuple[int, int], int] = {}
        for j in np.flatnonzero(high > low):
            p = int(places[j])
            for i, q in index.at[low[j] : high[j]]:
                if done.get((i, p - q), -1) >= p:
                    continue
                first, end = extended(ids, p, index.items[i][1], q)
                done[i, p - q] = end - 1
                if end - first >= n:
                    found.append((first, end, index.items[i][0]))
    for m, (prints, owners) in index.short.items():
        hashes = rolling(values, m)
        low, high = np.searchsorted(prints, hashes, "left"), np.searchsorted(prints, hashes, "right")
        for p in np.flatnonzero(high > low):
            for i in owners[low[p] : high[p]]:
                if np.array_equal(ids[p : p + m], index.items[i][1]):
                    found.append((int(p), int(p) + m, index.items[i][0]))
    return found


def extended(a: np.ndarray, p: int, b: np.ndarray, q: int) -> tuple[int, int]:
    """The longest equal run through places p and q, as places of ``a``; empty if they differ."""
    if a[p] != b[q]:
        return p, p
    back, ahead = min(p, q), min(len(a) - p, len(b) - q)
    left = np.flatnonzero(a[p - back : p][::-1] != b[q - back : q][::-1])
    right = np.flatnonzero(a[p : p + ahead] != b[q : q + ahead])
    return p - (int(left[0]) if len(left) else back), p + (int(right[0]) if len(right) else ahead)


def _sized(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Items with text, and the number of blocks they take."""
    items = benchmark.select(F.col(quoted(item_col)).cast("string").alias("item"), F.col(quoted(text_col)).cast("binary").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    return items, -(-2 * total // block_bytes) if total > block_bytes else 1


def _index(items: DataFrame, n: int, k: int) -> Index:
    return Index([(r[0], bytes(r[1])) for r in items.select("item", "text").collect()], n, k)


def find(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 10, k: int = 5, block_bytes: int = 64_000_000, out: str = "hits") -> tuple[DataFrame, str]:
    """Every row of ``docs`` with its hit spans in a further column, and that column's name.

    The column is a struct of ``n_words`` and ``spans`` (first word, word after the last,
    item). An item of fewer than ``n`` words, but not none, counts as one whole window.
    Null and empty texts have no words and no spans; repeated rows each get their own; an
    empty benchmark gives no spans. Should ``docs`` have a column named ``out``, the new
    one gets underscores in front.
    """
    spark, name = docs.sparkSession, free_name(docs.columns, out)
    items, count = _sized(benchmark, item_col, item_text_col, block_bytes)
    if count == 1:
        return _scan(spark, docs, _index(items, n, k), text_col, name), name
    key, part = free_name(docs.columns, "text_sha"), free_name(docs.columns, "part")
    sha, spans = F.sha2(F.col(quoted(text_col)), 256).alias(key), F.col(f"{name}.spans")
    some = []
    for b in range(count):
        block = _index(items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == b), n, k)
        part_found = _scan(spark, docs.select(F.col(quoted(text_col))), block, text_col, name)
        some.append(cut(part_found.where(F.size(spans) > 0).select(sha, spans.alias(part)).dropDuplicates([key])))
    spans = reduce(DataFrame.unionByName, some).groupBy(key).agg(F.flatten(F.collect_list(part)).alias(part))
    counted = _scan(spark, docs, Index([], n, k), text_col, name).withColumn(key, sha)
    whole = F.struct(F.col(f"{name}.n_words").alias("n_words"), F.coalesce(F.col(part), F.col(f"{name}.spans")).alias("spans"))
    return counted.join(spans, key, "left").withColumn(name, whole).drop(key, part), name


def _scan(spark: SparkSession, docs: DataFrame, index: Index, text_col: str, name: str) -> DataFrame:
    shared, at = spark.sparkContext.broadcast(cloudpickle.dumps(index)), docs.columns.index(text_col)
    names = [*docs.columns, name]
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("item", pa.string())])))])

    def run(batches):
        rolling, own = Rolling(), cloudpickle.loads(shared.value)
        for batch in batches:
            out = []
            for text in batch.column(at).cast(pa.binary()).to_pylist():
                words = words_of(text)
                spans = hits(words, own, rolling)
                out.append({"n_words": len(words), "spans": [{"first": a, "last": b, "item": i} for a, b, i in spans]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names)

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, _FOUND)]))


def digest(found: DataFrame, name: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document: words, words within a hit, items that occur, and whether there is any."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = defaultdict(list)
            for r in rows:
                n, spans = r["h"]["n_words"], r["h"]["spans"]
                edge = np.zeros(n + 1, np.int64)
                for s in spans:
                    edge[s["first"]] += 1
                    edge[s["last"]] -= 1
                hit = int((np.cumsum(edge[:n]) > 0).sum()) if spans else 0
                items = sorted({s["item"] for s in spans if s["item"] is not None})
                for k, v in (("doc_id", r["id"]), ("n_words", n), ("n_hit", hit), ("n_items", len(items)), ("items_sha256", hashlib.sha256(",".join(items).encode()).hexdigest()), ("contaminated", hit > 0)):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], batch.schema.field(0).type), *(pa.array(out[k], t) for k, t in (("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())))], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kept = found.select(F.col(quoted(id_col)).alias("id"), F.col(name).alias("h"))
    return kept.mapInArrow(run, f"doc_id {kept.schema[0].dataType.simpleString()}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
