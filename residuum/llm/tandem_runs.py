"""Periodic runs of words, by the branching tandem repeats of a suffix tree.

A run is a stretch of words with smallest period q that no neighbour extends, of ``least``
words and two periods at least. The last square (a word sequence twice in a row) of a run is
branching: the words after its two halves differ, so both halves begin leaves of the tree
node of depth q, in different branches. The tree of a block of documents is held as sorted
suffixes with the depths between neighbours, its nodes as ranges of these; for each node, the
leaves outside of its largest branch are tried (the smaller halves: n log n in all), which
finds every branching repeat. Each is rotated to the left for as far as words agree, and
those that cover the same stretch are merged to the one of smallest period.

The sort doubles the compared length in each round and keeps the ranks of every round, which
answer how far two places agree in a few steps. It works on whole columns of numbers, for
many short documents at once; a long document is a block of its own, so that memory is
bounded by ``BLOCK`` words or the longest text. A run makes some six words in a row repeat
(``gram``); documents in which none do are told apart by a rolling hash and get no tree.

Defined results: a null or empty text has no words and no run; documents are judged by
themselves, so repeated rows and ids are no matter; columns keep their names, and the result
is a struct of a free name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residuum.llm.common import Rolling, WordHashes, free_name, mix, quoted

#: Least words of a run.
LEAST = 12
#: Words of a block of documents, and leaves that are tried at a time.
BLOCK, TRIED = 200_000, 2_000_000
#: Rows whose words are held at a time.
ROWS = 256

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


class WordIds(dict):
    """A number for each different word."""

    def __missing__(self, word):
        value = self[word] = len(self)
        return value


class Suffixes:
    """Sorted suffixes of a sequence of symbols, with the ranks of each doubling round.

    ``rank[k][i]`` is the same for two places if and only if 2**k symbols from there agree.
    The last symbol of each document has to occur nowhere else.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.order = np.argsort(symbols, kind="stable")
        first = self._starts(symbols[self.order])
        rank = np.empty(n, np.int64)
        rank[self.order] = first
        self.rank = [rank]
        open_ = self._shared(first)
        while len(open_):
            places, step = self.order[open_], 1 << (len(self.rank) - 1)
            old = rank[places]
            key = old * n + rank[places + step]
            by = np.argsort(key, kind="stable")
            self.order[open_] = places = places[by]
            same = self._starts(key[by])
            rank = rank.copy()
            rank[places] = open_[same]
            self.rank.append(rank)
            first = rank[places]
            open_ = open_[self._shared(first)]

    @staticmethod
    def _starts(values: np.ndarray) -> np.ndarray:
        """For each of sorted values where the equal ones begin."""
        new = np.r_[True, values[1:] != values[:-1]] if len(values) else np.empty(0, bool)
        return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))

    @staticmethod
    def _shared(first: np.ndarray) -> np.ndarray:
        """Indices of values that have an equal neighbour."""
        if not len(first):
            return np.empty(0, np.int64)
        same = first[1:] == first[:-1]
        return np.flatnonzero(np.r_[same, False] | np.r_[False, same])

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and ``b`` on agree (``a != b``)."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            same = self.rank[k][a] == self.rank[k][b]
            move = np.where(same, 1 << k, 0)
            a += move
            b += move
            out += move
        return out

    def agree_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols right before ``a`` and ``b`` agree; ``a < b``."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            step = 1 << k
            inside = a >= step
            same = inside & (self.rank[k][np.where(inside, a - step, 0)] == self.rank[k][np.where(inside, b - step, 1)])
            move = np.where(same, step, 0)
            a -= move
            b -= move
            out += move
        return out


def ranges(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each border between sorted suffixes the range [low, high) of its tree node.

    ``depth[p]`` is how far the suffixes p - 1 and p agree, with nothing before the first one.
    """
    n = len(depth)
    low, high, stack = [0] * n, [n] * n, []
    values = depth.tolist()
    for p, d in enumerate(values):
        while stack and values[stack[-1]] > d:
            high[stack.pop()] = p
        low[p] = 0 if not stack else (low[stack[-1]] if values[stack[-1]] == d else stack[-1])
        stack.append(p)
    return np.array(low, np.int64), np.array(high, np.int64)


def branching(tree: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of all branching tandem repeats: leaves of smaller branches are tried in both directions."""
    order, n = tree.order, len(tree.order)
    depth = np.zeros(n, np.int64)
    pairs = np.flatnonzero(tree.rank[0][order[1:]] == tree.rank[0][order[:-1]]) + 1
    depth[pairs] = tree.agree(order[pairs - 1], order[pairs])
    low, high = ranges(depth)
    inner = np.flatnonzero(depth > 0)
    inner = inner[np.lexsort((inner, high[inner], low[inner]))]
    if not len(inner):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.r_[True, (low[inner][1:] != low[inner][:-1]) | (high[inner][1:] != high[inner][:-1])]
    # branches of a node: from its low end to its first border, and from each border to the next
    begin = np.concatenate([low[inner[new]], inner])
    after = np.r_[inner[1:], 0]
    last = np.r_[new[1:], True]
    end = np.concatenate([inner[new], np.where(last, high[inner], after)])
    node = np.concatenate([np.cumsum(new)[new] - 1, np.cumsum(new) - 1])
    size = end - begin
    largest = np.full(int(node.max()) + 1, -1)
    by = np.argsort(size, kind="stable")
    largest[node[by]] = by
    small = np.ones(len(node), bool)
    small[largest] = False
    own = inner[new][node]
    begin, size, node_low, node_high, period = begin[small], size[small], low[own][small], high[own][small], depth[own][small]
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    found, total = [], np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + TRIED, "right")))
        s = slice(at, to)
        each = np.repeat(np.arange(to - at), size[s])
        leaf = order[np.arange(len(each)) - np.repeat(np.cumsum(size[s]) - size[s], size[s]) + begin[s][each]]
        q, a, b = period[s][each], node_low[s][each], node_high[s][each]
        for start, other in ((leaf, leaf + q), (leaf - q, leaf - q)):
            inside = (other >= 0) & (other < n)
            there = where[np.where(inside, other, 0)]
            hit = np.flatnonzero(inside & (there >= a) & (there < b))
            found.append(np.stack([start[hit], q[hit]]))
        at = to
    start, q = np.concatenate(found, axis=1)
    fork = tree.agree(start, start + q) == q
    return start[fork], q[fork]


def runs(words: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """For each document (numbers of its words) rows of start, length and period, by start, then period."""
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    offsets = np.cumsum(lengths) - lengths
    doc = np.repeat(np.arange(len(words)), lengths)
    symbol = np.concatenate([np.r_[w, -1] for w in words]).astype(np.int64)
    # documents have symbols of their own, and an end that is like nothing else
    key = np.where(symbol < 0, -1, symbol)
    tree = Suffixes(np.unique(doc * (int(key.max()) + 2) + key + 1, return_inverse=True)[1].astype(np.int64))
    start, q = branching(tree)
    back = tree.agree_before(start, start + q)
    begin, end = start - back, start + 2 * q
    long = end - begin >= np.maximum(least, 2 * q)
    rows = np.stack([begin, end, q], axis=1)[long]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]] if len(rows) else rows
    of = doc[rows[:, 0]]
    out = np.stack([rows[:, 0] - offsets[of], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    out = out[np.lexsort((out[:, 2], out[:, 0], of))]
    return np.split(out, np.searchsorted(np.sort(of), np.arange(1, len(words))))


def kept(n: int, found: np.ndarray) -> np.ndarray:
    """Mask of the words that stay: none that a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def gram(least: int) -> int:
    """How many words in a row stand twice in a document with a run: both q and ``least`` - q are at least as many, or one is."""
    return max(1, least // 2)


def find(docs: DataFrame, *, text_col: str = "text", least: int = LEAST) -> tuple[DataFrame, str]:
    """``docs`` and a struct (n_words, runs, collapsed): the periodic runs of each text, and the text with a period of each."""
    name = free_name(docs.columns, "found")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, FOUND)])
    place = docs.columns.index(text_col)
    n_gram = gram(least)

    def judge(block):
        """Runs of the documents of a block that have some words in a row twice."""
        ids = WordIds()
        found = runs([np.fromiter(map(ids.__getitem__, w), np.int64, len(w)) for w in block], least)
        return found

    def run(batches):
        hashes, rolling, none = WordHashes(), Rolling(), np.empty((0, 3), np.int64)
        for batch in (b.slice(low, ROWS) for b in batches for low in range(0, len(b), ROWS)):
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            words = [t.split() if t else [] for t in texts]
            found = [none] * len(words)
            block, size = [], 0
            for i in _with_repeats(words, hashes, rolling, n_gram):
                if block and size + len(words[i]) > BLOCK:
                    for j, r in zip(block, judge([words[j] for j in block])):
                        found[j] = r
                    block, size = [], 0
                block.append(i)
                size += len(words[i])
            if block:
                for j, r in zip(block, judge([words[j] for j in block])):
                    found[j] = r
            rest = [b" ".join(w if not len(r) else [x for x, k in zip(w, kept(len(w), r)) if k]) for w, r in zip(words, found)]
            all_runs = np.concatenate(found) if found else none
            parts = pa.StructArray.from_arrays([pa.array(all_runs[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), parts)
            struct = pa.StructArray.from_arrays([pa.array(list(map(len, words)), pa.int64()), lists, pa.array(rest, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[f"c{i}" for i in range(batch.num_columns + 1)])

    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    out = numbered.mapInArrow(run, T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)]))
    return out.toDF(*schema.names), name


def _with_repeats(words: list[list[bytes]], hashes: WordHashes, rolling: Rolling, n: int) -> list[int]:
    """Documents in which some ``n`` words in a row stand twice (by hash: it may be one too many)."""
    out, low = [], 0
    while low < len(words):
        high, size = low + 1, len(words[low])
        while high < len(words) and size < BLOCK:
            size += len(words[high])
            high += 1
        long = [i for i in range(low, high) if len(words[i]) > n]
        if long:
            values = np.concatenate([hashes.of(words[i]) for i in long])
            lengths = np.array([len(words[i]) for i in long])
            doc = np.repeat(np.arange(len(long)), lengths)
            grams = rolling(values, n)
            own = doc[: len(grams)] == doc[n - 1 :]
            of = doc[: len(grams)][own]
            grams = mix(grams[own] + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            by = np.argsort(grams)
            same = np.flatnonzero(grams[by[1:]] == grams[by[:-1]])
            out.extend(long[i] for i in np.unique(of[by[same]]))
        low = high
    return out


def periodic(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the documents changed to which the checked result's rule gives a periodic end.

    With h the CRC-32 of the id in decimal and g a tenth of it: where h ends in 0 and there
    are n words, words from place a = g % n on are repeated with period 1 + (n - a) // (3 + g % 8).
    """
    n, a, g, p = F.col("_n"), F.col("_a"), F.col("_g"), F.col("_p")
    h = F.crc32(F.col(quoted(id_col)).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce(F.col(quoted(text_col)), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.withColumns({"_h": h, "_w": F.when(h % 10 == 0, words)}).withColumns({"_n": F.size("_w"), "_g": F.floor(F.col("_h") / 10)})
    chosen = chosen.withColumn("_a", F.when(n > 0, g % n)).withColumn("_p", 1 + F.floor((n - a) / (3 + g % 8)))
    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.element_at("_w", (F.when(i < a, i).otherwise(a + (i - a) % p) + 1).cast("int"))), " ")
    return chosen.withColumn(text_col, F.when((F.col("_h") % 10 == 0) & (n > 0), text).otherwise(F.col(quoted(text_col)))).select(*map(quoted, docs.columns))


def digest(found: DataFrame, name: str, *, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one, and hashes of all runs and of the collapsed text."""
    runs_, first = F.col(f"{name}.runs"), F.col("_longest")
    longest = F.array_max(F.transform(runs_, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform(runs_, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("_longest", longest).select(
        id_col, F.size(runs_).cast("long").alias("n_runs"), (-first["start"]).alias("start"), first["length"].alias("length"), (-first["period"]).alias("period"),
        F.floor(1000 * first["length"] / -first["period"]).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col(f"{name}.collapsed"), 256).alias("collapsed_sha256"))
