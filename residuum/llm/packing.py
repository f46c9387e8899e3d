"""Packing of tokenised documents into sequences: dominance reduction, then best fit.

Tokens of each document, and the separator, are cut into pieces of at most one sequence.
Where pieces go depends on their lengths alone, so the instance is a count for each length:
as many numbers as a sequence has tokens, however many documents there are. On it the
dominance criterion of Martello and Toth fixes small sets of lengths that some optimal
packing has together; what remains is packed by best fit in decreasing order. The plan maps
the rank of a piece among those of its length to a sequence and an offset; ranks come from
a shuffle by length and a chunk of ids, so a length that many pieces share is dealt to many
tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from residuum.llm.common import cut, kept_in_worker, quoted

#: Rows of a (length, chunk) group, about.
CHUNK_ROWS = 200


class Encoder:
    """Token ids as the vocabulary file's tokenizer gives them, remembered by word.

    The vocabulary drops white space, so a text's ids are those of its words. Texts that in
    lower case have no character from U+0240 on take this way; any other, or one with a
    special token's marks, is given to the tokenizer whole.
    """

    PLAIN = bytes([9, 10, 11, 12, 13, *range(0x20, 0x7F), *range(0x80, 0xC0), *range(0xC2, 0xC9)])
    ODD = ("\x85", "<|")
    PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str, most: int = 250_000):
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.find, self.most = regex.compile(self.PIECE).findall, most
        self.ids: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(0x100) if b not in set(printed)]
        letter = {b: chr(b) for b in printed} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
        self.letters = {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x21, 0x240)}

    def is_plain(self, text: str) -> bool:
        return not text.encode().translate(None, self.PLAIN) and not any(x in text for x in self.ODD)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        words = [w.split() if self.is_plain(w := t.lower()) else None for t in texts]
        self._know(set().union(*(w for w in words if w)))
        get = self.ids.__getitem__
        return [np.array(self.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if w is None else b"".join(map(get, w)) for t, w in zip(texts, words, strict=True)]

    def _know(self, need: set[str]) -> None:
        """Put the ids of these words into ``ids``. Words are remembered in two generations, so
        that a full one leaves those that are in use."""
        new = need.difference(self.ids)
        if new and len(self.ids) + len(new) > self.most:
            self.old, self.ids, new = self.ids, {}, need
        old = [w for w in new if w in self.old]
        if old:
            self.ids.update(zip(old, map(self.old.__getitem__, old), strict=True))
            new = new.difference(old)
        if new:
            self._learn(new)

    def _learn(self, words: set[str]) -> None:
        """A word of letters is one piece; any other one's ids are those of its pieces."""
        mixed = [w for w in words if not w.isalpha()]
        split = [(w[:-1], w[-1]) if w[-1] in ".,;:!?" and w[:-1].isalpha() else self.find(w) for w in mixed]
        known = self.ids
        single = {w for w in words.difference(mixed) if w not in known}
        single.update(p for parts in split for p in parts if p not in known)
        if single:
            single = list(single)
            text = " ".join([w if w.isascii() else w.translate(self.letters) for w in single])
            ids = np.array(self.pieces.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(single):
                raise ValueError("the vocabulary has tokens without a word end")
            at, raw = (4 * ends).tolist(), ids.tobytes()
            known.update(zip(single, map(raw.__getitem__, map(slice, [0, *at[:-1]], at)), strict=True))
        known.update((w, b"".join(map(known.__getitem__, parts))) for w, parts in zip(mixed, split, strict=True))


def pieces(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the pieces of every row of ``docs``.

    A null or empty text is the separator alone. Only documents longer than ``capacity``
    are cut; their last piece may be shorter.
    """
    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))

    def run(batches):
        encoder, end = kept_in_worker(("encoder", path), lambda: Encoder(path)), np.array([separator], "<u4").tobytes()
        for batch in batches:
            for low in range(0, len(batch), 64):
                part, rows = batch.slice(low, 64), []
                coded = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                for i, raw in enumerate(coded):
                    raw += end
                    for p, at in enumerate(range(0, len(raw), 4 * capacity)):
                        own = raw[at : at + 4 * capacity]
                        rows.append((i, p, at // 4, len(own) // 4, zlib.crc32(own), own if with_ids else None))
                i, p, at, length, crc, own = zip(*rows, strict=True)
                columns = [part.column(0).take(pa.array(i)), pa.array(p, pa.int32()), pa.array(at, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in own], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)
        encoder.old = {}  # a worker that goes on to other work keeps less

    fields = [T.StructField("id", texts.schema[0].dataType), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]
    return texts.mapInArrow(run, T.StructType(fields))


class Plan:
    """Where the pieces of each length go: runs of ranks to runs of sequences at one offset."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, {n: c for n, c in counts.items() if c}
        self.sizes = sorted(self.left)
        self.rank: dict[int, int] = defaultdict(int)
        self.rows: list[tuple[int, int, int, int]] = []  # length, first rank, first sequence, offset
        self.sequences = self.fixed = 0
        self._reduce()
        self._best_fit()

    def _place(self, size: int, count: int, sequence: int, offset: int) -> None:
        self.rows.append((size, self.rank[size], sequence, offset))
        self.rank[size] += count
        self.left[size] -= count
        if not self.left[size]:
            del self.left[size]
            self.sizes.pop(bisect.bisect_left(self.sizes, size))

    def _largest(self, most: int, without: tuple[int, ...] = ()) -> int | None:
        """The largest length of at most ``most`` that is left once ``without`` are taken."""
        i = bisect.bisect_right(self.sizes, most) - 1
        while i >= 0 and self.left[self.sizes[i]] <= without.count(self.sizes[i]):
            i -= 1
        return self.sizes[i] if i >= 0 else None

    def _smallest(self, n: int, without: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(n - len(out), self.left[s] - (s == without))
            if len(out) == n:
                break
        return out

    def _dominant(self, size: int) -> tuple[int, ...] | None:
        """A set with ``size`` that dominates every other feasible one, if there is one of up to three.

        A set dominates another if the other's members can be dealt to its members so that
        no member of it is exceeded: exchanging them then costs no sequence.
        """
        room = self.capacity - size
        first = self._largest(room, (size,))
        if first is None:
            return (size,)
        least = self._smallest(3, size)
        if first == room or len(least) < 2 or sum(least[:2]) > room:
            return (size, first)
        second = self._largest(room - first, (size, first))
        if second is not None and (len(least) < 3 or sum(least) > room):
            half = self._largest(room // 2, (size,))  # no pair's lesser member is larger
            if half is None or half <= second:
                return (size, first, second)
        return None

    def _reduce(self) -> None:
        for size in reversed(self.sizes.copy()):
            while self.left.get(size):
                chosen = self._dominant(size)
                if chosen is None:
                    break
                times = min(self.left[s] // chosen.count(s) for s in set(chosen))
                if len(chosen) == 3:  # with one more of each left, the choice stays the same
                    times = max(1, times - 1)
                offset = 0
                for s in chosen:
                    self._place(s, times, self.sequences, offset)
                    offset += s
                self.sequences += times
                self.fixed += times

    def _best_fit(self) -> None:
        spaces: list[int] = []  # room left in open sequences, ascending
        runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

        def opened(room: int, sequence: int, count: int) -> None:
            if room and count:
                if not runs[room]:
                    bisect.insort(spaces, room)
                runs[room].append((sequence, count))

        for size in reversed(self.sizes.copy()):
            while self.left.get(size):
                n, i = self.left[size], bisect.bisect_left(spaces, size)
                if i < len(spaces):
                    room = spaces[i]
                    sequence, count = runs[room].pop()
                    if not runs[room]:
                        spaces.pop(i)
                    used = min(n, count)
                    self._place(size, used, sequence, self.capacity - room)
                    opened(room - size, sequence, used)
                    opened(room, sequence + used, count - used)
                else:
                    each = min(self.capacity // size, n)
                    count, offset = max(1, n // each), 0
                    for _ in range(each):
                        self._place(size, count, self.sequences, offset)
                        offset += size
                    opened(self.capacity - offset, self.sequences, count)
                    self.sequences += count

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rows = sorted(self.rows)
        size, rank, sequence, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else (np.empty(0, np.int64),) * 4
        return (size << 48) + rank, rank, sequence, offset


def packed(cut_pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; an empty table stays empty.

    Ties and repeated rows each get a place of their own.
    """
    spark = cut_pieces.sparkSession
    counts = {r[0]: r[1] for r in cut_pieces.groupBy("length").count().collect()}
    plan = spark.sparkContext.broadcast(Plan(counts, capacity).arrays())
    chunks = min(1 << 16, -(-max(counts.values(), default=1) // CHUNK_ROWS))
    dealt = cut_pieces.withColumn("chunk", F.pmod(F.xxhash64("id", "piece"), F.lit(chunks)))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n")
    base = dealt.groupBy("length", "chunk").agg(F.count("*").alias("n")).select("length", "chunk", before.alias("base"))
    place = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("id", "piece", "ids_crc32"))
    ranked = dealt.withColumn("rank", place.cast("long") - 1).join(base, ["length", "chunk"]).withColumn("rank", F.col("rank") + F.col("base")).drop("chunk", "base")
    at, last = ranked.columns.index("length"), ranked.columns.index("rank")

    def run(batches):
        keys, ranks, sequences, offsets = plan.value
        for batch in batches:
            size, rank = batch.column(at).to_numpy(), batch.column(last).to_numpy()
            i = np.searchsorted(keys, (size << 48) + rank, "right") - 1
            kept = [c for j, c in enumerate(batch.columns) if j != last]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequences[i] + rank - ranks[i]), pa.array(offsets[i])], names)

    fields = [f for f in ranked.schema.fields if f.name != "rank"] + [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    names = [f.name for f in fields]
    return ranked.mapInArrow(run, T.StructType(fields))


def pack(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, separator: int = 0) -> DataFrame:
    """Where each piece of each document goes: (id, piece, start, length, ids_crc32, sequence_id, offset).

    Other columns of ``docs`` are left out, whatever their names; see ``pieces`` for null texts.
    """
    return packed(cut(pieces(docs, path, id_col=id_col, text_col=text_col, capacity=capacity, separator=separator)), capacity)


def sequences(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, separator: int = 0) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, ready for training."""
    places = pack(docs, path, id_col=id_col, text_col=text_col, capacity=capacity, separator=separator)
    own = pieces(docs, path, id_col=id_col, text_col=text_col, capacity=capacity, separator=separator, with_ids=True)
    keys = ["id", "piece", "start", "length", "ids_crc32"]
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy("start"))
    both = places.withColumn("copy", copy).join(own.withColumn("copy", copy), [*keys, "copy"])
    return both.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
