"""Substring deduplication by fixed-block anchors.

A repeat is a run of ``length`` words that also starts in a document of smaller id. The
words of each document are cut into non-overlapping blocks of half that length: wherever a
run stands, it holds one whole block. Three passes over the texts follow:

1. blocks are hashed and marked in a bitmap, those that occur twice in a second one;
2. every rolling window of block length probes the first bitmap; hits are marked in a third;
3. runs around hits (in the probing and in the indexed document) are hashed, and a shuffle
   by hash finds in how early a document each of them occurs.

The bitmaps have a fixed size, only let runs pass early, and are never wrong on the side
that matters; the shuffle decides exactly. Each task sends a hash once, with the least of
its documents, so that a passage that a third of all documents hold costs one row a task.
Neighbouring covered runs join to the longest repeats, whose words go.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from residuum.llm.common import Rolling, WordHashes, covered, cut, quoted

#: Bits of a bitmap, and of the 4 KiB pieces in which it is gathered.
BITS, PIECE = 1 << 27, 1 << 15


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of what is not white space (space, tab to carriage return)."""
    return text.split() if text else []


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash marks two bits."""
    return (hashes & np.uint64(BITS - 1)).astype(np.int64), (hashes >> np.uint64(37)).astype(np.int64)


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for slots in _slots(hashes):
        out &= (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0
    return out


def _pieces(bitmap: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The pieces that have a bit set."""
    rows = bitmap.reshape(-1, PIECE // 8)
    some = np.flatnonzero(rows.any(axis=1))
    return pa.array(some, pa.int32()), pa.array([rows[i].tobytes() for i in some], pa.binary())


def _mark(bitmap: np.ndarray, hashes: np.ndarray) -> None:
    for slots in _slots(hashes):
        np.bitwise_or.at(bitmap, slots >> 3, (np.uint8(1) << (slots & 7).astype(np.uint8)))


def _gathered(pieces: DataFrame, column: str) -> np.ndarray:
    """Pieces of all tasks put together; ``BITS / 8`` bytes at most reach the driver."""
    bitmap = np.zeros(BITS // 8, np.uint8).reshape(-1, PIECE // 8)
    for i, bits in pieces.where(F.col(column).isNotNull()).groupBy("piece").agg(F.bitmap_or_agg(column)).collect():
        bitmap[i] = np.frombuffer(bytes(bits), np.uint8)
    return bitmap.reshape(-1)


class _Reader:
    """Word hashes of each text of a batch."""

    def __init__(self, length: int):
        self.length, self.block = length, (length + 1) // 2 if length > 1 else 1
        self.hashes, self.rolling = WordHashes(), Rolling()

    def values(self, text: bytes | None) -> np.ndarray:
        return self.hashes.of(words_of(text))

    def anchors(self, values: np.ndarray) -> np.ndarray:
        return self.rolling(values, self.block)


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """(id, run hashes): for every document with a repeat, the hashes of its repeated runs.

    Documents shorter than ``length`` words, null and empty texts have none; rows without an
    id neither lose words nor count as earlier; rows that share an id do not repeat each
    other. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("binary").alias("text")).where("id is not null and text is not null")
    id_type = texts.schema["id"].dataType
    if not isinstance(id_type, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    texts = texts.withColumn("id", F.col("id").cast("long"))

    def blocks(batches):
        read = _Reader(length)
        for batch in batches:
            own = [h for t in batch.column(1).to_pylist() if len(h := read.anchors(read.values(t))[:: read.block])]
            if own:
                h, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    counted = texts.mapInArrow(blocks, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))

    def index(batches):
        once, twice = np.zeros(BITS // 8, np.uint8), np.zeros(BITS // 8, np.uint8)
        for batch in batches:
            h, n = (c.to_numpy() for c in batch.columns)
            _mark(once, h.view(np.uint64))
            _mark(twice, h[n > 1].view(np.uint64))
        for which, bitmap in ((1, once), (2, twice)):
            pieces, bits = _pieces(bitmap)
            for i in range(0, len(pieces), 512):
                yield pa.RecordBatch.from_arrays([pieces[i : i + 512], *(bits[i : i + 512] if which == w else pa.nulls(len(bits[i : i + 512]), pa.binary()) for w in (1, 2))], ["piece", "once", "twice"])

    marked = cut(counted.mapInArrow(index, "piece int, once binary, twice binary"))
    once, twice = (spark.sparkContext.broadcast(_gathered(marked, c)) for c in ("once", "twice"))

    def probe(batches):
        read, bitmap = _Reader(length), np.zeros(BITS // 8, np.uint8)
        for batch in batches:
            for t in batch.column(1).to_pylist():
                h = read.anchors(read.values(t))
                if len(h):
                    hit = _marked(once.value, h)
                    hit[:: read.block] = False
                    _mark(bitmap, h[hit])
        pieces, bits = _pieces(bitmap)
        for i in range(0, len(pieces), 512):
            yield pa.RecordBatch.from_arrays([pieces[i : i + 512], bits[i : i + 512]], ["piece", "hit"])

    hit = spark.sparkContext.broadcast(_gathered(texts.mapInArrow(probe, "piece int, hit binary"), "hit"))

    def runs(batches):
        read = _Reader(length)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            hashes, owners = [], []
            for i, t in zip(ids, batch.column(1).to_pylist(), strict=True):
                values = read.values(t)
                if len(values) < length:
                    continue
                h = read.anchors(values)
                is_hit = _marked(once.value, h)
                at = h[:: read.block]
                is_hit[:: read.block] = _marked(twice.value, at) | _marked(hit.value, at)
                places = np.flatnonzero(is_hit)
                if len(places):
                    n = len(values) - length + 1
                    slack = length - read.block
                    near = covered(np.maximum(places - slack, 0), slack + 1, n + slack + 1)[:n]
                    own = np.unique(read.rolling(values, length)[near])
                    hashes.append(own)
                    owners.append(np.full(len(own), i))
            if hashes:
                h, i = np.concatenate(hashes), np.concatenate(owners)
                order = np.lexsort((i, h))
                h, i = h[order], i[order]
                first = np.append(True, h[1:] != h[:-1])
                least = i[np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))]
                keep = first | (i != least)
                yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(i[keep]), pa.array(~first[keep])], ["h", "id", "late"])

    found = cut(texts.mapInArrow(runs, "h long, id long, late boolean"))
    first = F.min("id").over(Window.partitionBy("h"))
    late = found.where("not late").withColumn("first", first).where("id > first").select("id", "h").unionByName(found.where("late").select("id", "h"))
    return late.groupBy("id").agg(F.collect_set("h").alias("runs"))


def removed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50, out: str = "kept") -> DataFrame:
    """(id, n_words, n_removed, kept text): every row of ``docs`` without its repeated words.

    Kept words are joined by one space. Rows without repeats keep all their words.
    """
    found = repeats(docs, id_col=id_col, text_col=text_col, length=length)
    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))
    joined = texts.join(found.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").select("id", "text", "runs")

    def strip(batches):
        read = _Reader(length)
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            runs = batch.column(2)
            for j, t in enumerate(batch.column(1).to_pylist()):
                words = words_of(t)
                n_words.append(len(words))
                if runs[j].is_valid and len(words) >= length:
                    own = np.asarray(runs[j].values).view(np.uint64)
                    starts = np.flatnonzero(np.isin(read.rolling(read.hashes.of(words), length), own))
                    stay = ~covered(starts, length, len(words))
                    n_removed.append(int(len(words) - stay.sum()))
                    words = [words[i] for i in np.flatnonzero(stay)]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", out])

    id_field = T.StructField("id", docs.schema[id_col].dataType)
    return joined.mapInArrow(strip, T.StructType([id_field, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField(out, T.StringType())]))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def sha256_of(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()
