"""Near-duplicate documents by Order MinHash, verified by banded alignment.

The runs of three words of a text, each labelled with its occurrence number, are hashed once
for each of ``sketches`` functions. A sketch is the ``several`` runs of least hash in the
order in which they stand in the text, so two texts share it in proportion to what they
share in the same order. Texts that share a sketch are in a bucket. Texts of up to ``SHORT``
words have too few runs for this to be sure, so they meet by an exact prefix join as well: of
two alike texts, each with its words from the rarest on, the first ``(1 - similarity) n + 1``
have a word in common, and each such word is a bucket.

Copies (equal words) are one representative from the start. Each member of a bucket is then
aligned with its leader, the one of least id, so a group of thousands of near copies costs no
pair for each two of them; linked texts become classes. In buckets that hold more than one class
even so, up to ``LEADERS`` members of each, others in each bucket, meet those of the other
classes, and up to ``SMALL`` pairs of each two classes are aligned. At last all pairs of
different classes that are left in a bucket are looked at, without a cap. Counts of words,
their parities and, in crowded buckets, bits of the words seen are compared within the join, so
that a pair becomes a row, and a single one, only if they allow that it is alike; texts are fetched for these alone. The number of jobs does not depend on the
table but for the rounds in which classes are joined, the logarithm of their longest path.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from residuum.llm.common import Rolling, WordHashes, cut, free_name, freed, mix, quoted
from residuum.llm.components import components
from residuum.llm.decontamination import words_of

WORDS, SKETCHES, SEVERAL, SIMILARITY = 3, 40, 2, 0.8
#: Pairs in which a text has at most so many words are all candidates.
SHORT = 50
#: Least number of words with which different texts can be alike, given the similarity.
LEAST = 5
#: Members of a class that stand for it in a bucket before the rest are looked at.
LEADERS = 4
#: Pairs of two classes that are aligned before the rest are.
SMALL = 4
#: Buckets of the word counts that bound an edit distance, and of those whose parities do.
BAG, ODD = 128, 256
#: Bits of the labelled words of a text, for the pairs that these leave, occurrences of a word that have
#: one, and how many texts a bucket has at most that is joined without them.
SEEN, OFTEN, CROWD = 4096, 8, 64


def _settled(df: DataFrame) -> DataFrame:
    """``df`` materialised; what that took goes from the driver."""
    df = cut(df)
    freed(df.sparkSession)
    return df


def seeds(sketches: int) -> np.ndarray:
    """An odd multiplier for each hash function."""
    return mix(np.arange(1, sketches + 1, dtype=np.uint64)) | np.uint64(1)


def occurrences(runs: np.ndarray) -> np.ndarray | None:
    """How many equal values stand before each; None if all are different."""
    order = np.argsort(runs, kind="stable")
    sorted_runs = runs[order]
    first = np.append(True, sorted_runs[1:] != sorted_runs[:-1])
    if first.all():
        return None
    start = np.maximum.accumulate(np.where(first, np.arange(len(runs)), 0))
    label = np.empty(len(runs), np.uint64)
    label[order] = (np.arange(len(runs)) - start).astype(np.uint64)
    return label


def labelled(runs: np.ndarray, most: int | None = None) -> np.ndarray:
    """The hashes, each occurrence of an equal one after the first made another; of each hash the first ``most``, if that is given."""
    label = occurrences(runs) if len(runs) else None
    if label is None:
        return mix(runs)
    if most is not None:
        runs, label = runs[label < most], label[label < most]
    return mix(runs + label * np.uint64(0x9E3779B97F4A7C15))


def sketch(values: np.ndarray, rolling: Rolling, multipliers: np.ndarray, words: int = WORDS, several: int = SEVERAL) -> np.ndarray:
    """A hash for each sketch of a text, given the hashes of its words; none if it has none."""
    if not len(values):
        return np.empty(0, np.uint64)
    runs = labelled(rolling(values, min(words, len(values))))
    hashes = runs[None, :] * multipliers[:, None]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    several = min(several, len(runs))
    least, each = np.empty((len(multipliers), several), np.int64), np.arange(len(multipliers))
    for j in range(several):  # a few passes for the minimum cost less than a partition
        least[:, j] = hashes.argmin(axis=1)
        hashes[each, least[:, j]] = np.iinfo(np.uint64).max
    least.sort(axis=1)
    out = multipliers.copy()
    for j in range(several):
        out = mix(out * np.uint64(31) + runs[least[:, j]])
    return out


def distance_within(a: np.ndarray, b: np.ndarray, most: int, narrow: int = 6) -> int | None:
    """Edit distance of two sequences if at most ``most``, else None.

    Common ends are passed at once. A band of up to ``narrow`` diagonals to either side
    follows the furthest place on each diagonal; where it does not suffice, the band of
    ``most`` is gone through column by column, each column one bit vector.
    """
    if abs(len(a) - len(b)) > most:
        return None
    lead = _same(a, 0, b, 0)
    a, b = a[lead:], b[lead:]
    tail = _same(a[::-1], 0, b[::-1], 0)
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if not n or not m:
        return n + m if n + m <= most else None
    at = {0: _same(a, 0, b, 0)}
    for e in range(min(narrow, most) + 1):
        if e:
            new = {}
            for d in range(max(-e, -n), min(e, m) + 1):  # diagonal: place in b less place in a
                i = max(at.get(d, -2) + 1, at.get(d + 1, -2) + 1, at.get(d - 1, -1))
                i = min(i, n, m - d)
                if i >= 0 and i + d >= 0:
                    new[d] = i + _same(a, i, b, i + d)
            at = new
        if at.get(m - n, -1) >= n:
            return e
    return _by_columns(a.tolist(), b.tolist(), most) if most > narrow else None


def _by_columns(a: list, b: list, most: int) -> int | None:
    """Edit distance if at most ``most``; differences down a column are two bit vectors.

    Rows of ``a`` farther than ``most`` from the diagonal cannot be on a path that counts:
    they enter the vectors when the band reaches them and leave when it has passed.
    """
    n, places, step = len(a), {}, max(64, most // 2)
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    low, high = 0, min(n, most)  # rows low..high-1 are in the vectors
    up, down, score = (1 << high) - 1, 0, high  # score: distance at row ``high``
    equal = {x: sum(1 << i for i in p if i < high) for x, p in places.items()}
    for j, x in enumerate(b):
        if high < n:  # the next row: one more than the one above
            up |= 1 << (high - low)
            y = a[high]
            equal[y] = equal.get(y, 0) | 1 << (high - low)
            high += 1
            score += 1
        full = (1 << (high - low)) - 1
        same = equal.get(x, 0) & full
        v = same | down
        h = (((same & up) + up) ^ up) | same
        plus, minus = (down | ~(h | up)) & full, up & h & full
        top = 1 << (high - low - 1)
        score += bool(plus & top) - bool(minus & top)
        plus = (plus << 1 | 1) & full
        minus = minus << 1 & full
        up, down = (minus | ~(v | plus)) & full, plus & v
        if j + 1 - most > low + step:  # drop rows that the band has passed
            up, down = up >> step, down >> step
            equal = {y: rest for y, bits in equal.items() if (rest := bits >> step)}
            low += step
    return score if score <= most else None


def _same(a: np.ndarray, i: int, b: np.ndarray, j: int) -> int:
    """How far a from i and b from j are equal."""
    most, k, step = min(len(a) - i, len(b) - j), 0, 16
    while k < most:
        step = min(step, most - k)
        differ = a[i + k : i + k + step] != b[j + k : j + k + step]
        where = differ.argmax()
        if differ[where]:
            return k + int(where)
        k, step = k + step, step * 4
    return k


def alike(a: list[bytes], b: list[bytes], similarity: float = SIMILARITY) -> bool:
    """Whether the edit distance in words is at most ``1 - similarity`` of the longer text."""
    most = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    number: dict[bytes, int] = {}
    x, y = (np.array([number.setdefault(w, len(number)) for w in t], np.int64) for t in (a, b))
    surplus = np.bincount(x, minlength=len(number)) - np.bincount(y, minlength=len(number))
    if max(surplus[surplus > 0].sum(), -surplus[surplus < 0].sum()) > most:  # no alignment has fewer edits
        return False
    return distance_within(x, y, most) is not None


def sketched(docs: DataFrame, id_col: str, text_col: str, sketches: int, several: int, words: int, most: int) -> DataFrame:
    """(id, mark, sha, n, keys, bag, odd, own): hash of the text, digest of its words, their number, keys
    of the sketches, counts of hashed words and bits of which are odd, and, of a text of at most ``most`` words, the labelled words."""
    text = F.col(quoted(text_col)).cast("binary")
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))

    def run(batches):
        hashes, rolling, multipliers = WordHashes(), Rolling(), seeds(sketches)
        for batch in batches:
            shas, sizes, keys, bags, odds, owns = [], [], [], [], [], []
            for text in batch.column(2).to_pylist():
                own = words_of(text)
                shas.append(hashlib.sha256(b" ".join(own)).digest() if own else None)
                sizes.append(len(own))
                values = hashes.of(own)
                keys.append(sketch(values, rolling, multipliers, words, several).view(np.int64))
                counts = np.bincount((values % np.uint64(ODD)).astype(np.int64), minlength=ODD)
                odds.append(np.packbits(counts & 1).view(np.int64))
                bags.append(np.minimum(counts.reshape(-1, BAG).sum(axis=0), 127).astype(np.int8))
                owns.append(labelled(values).view(np.int64) if 0 < len(own) <= most else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(shas, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(bags, pa.list_(pa.int8())), pa.array(odds, pa.list_(pa.int64())), pa.array(owns, pa.list_(pa.int64()))], ["id", "mark", "sha", "n", "keys", "bag", "odd", "own"])

    return rows.mapInArrow(run, "id long, mark long, sha binary, n long, keys array<long>, bag array<tinyint>, odd array<long>, own array<long>")


def _own_prefixes(reps: DataFrame, similarity: float) -> DataFrame:
    """(_id, prefix) of each short text: its rarest words in order, one more than alike texts can all differ in."""
    words = reps.where("own is not null").select("id", "n", F.explode("own").alias("key"))
    common = words.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")  # a word of one text has no bucket, but a place
    ranked = words.join(common, "key", "left").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("c", F.lit(1)).alias("c"), "key"))).alias("w"))
    return ranked.select(F.col("id").alias("_id"), F.slice("w.key", F.lit(1), (_differ(F.col("n"), similarity) + 2).cast("int")).alias("prefix"))


def _differ(n: Column, similarity: float) -> Column:
    return F.floor(n * (1 - similarity) + 1e-6)


def _possible(x: str, y: str, similarity: float) -> Column:
    """Can texts of these sizes and word counts be alike? Words that one has more often than the
    other each cost an edit."""
    n, m, a, b = F.col(f"{x}n"), F.col(f"{y}n"), F.col(f"{x}bag"), F.col(f"{y}bag")
    most = F.greatest(n, m) * (1 - similarity) + 1e-6
    more = lambda p, q: F.aggregate(F.zip_with(p, q, lambda i, j: F.greatest(i.cast("int") - j.cast("int"), F.lit(0))), F.lit(0), lambda s, v: s + v)
    return (F.abs(n - m) <= most) & (more(a, b) <= most) & (more(b, a) <= most)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) whose texts are alike."""
    left, right = (texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    rows = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            keep = [alike(words_of(x), words_of(y), similarity) for x, y in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.bool_())], ["a", "b", "alike"])

    return rows.mapInArrow(run, "a long, b long, alike boolean").where("alike").select("a", "b")


def _candidates(pairs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) whose sizes and word counts allow that they are alike."""
    left, right = (reps.select(F.col("id").alias(c), F.col("n").alias(f"{c}_n"), F.col("bag").alias(f"{c}_bag")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").where(_possible("a_", "b_", similarity)).select("a", "b")


def _near(similarity: float) -> Column:
    """Can texts of these sizes and parities of word counts (n, odd) be alike? A changed
    word turns two parities at most, one put in or left out a single one."""
    apart = F.abs(F.col("a.n") - F.col("b.n"))
    most = F.floor(F.greatest("a.n", "b.n") * (1 - similarity) + 1e-6)
    turned = sum((F.bit_count(F.get("a.odd", F.lit(i)).bitwiseXOR(F.get("b.odd", F.lit(i)))) for i in range(ODD // 64)), F.lit(0))
    return (apart <= most) & (turned <= 2 * most - apart)


def _seen(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(id, n, seen) of the texts that are asked for: their number of words, and ``SEEN`` bits of the first ``OFTEN`` occurrences of each."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sizes, seen = [], []
            for text in batch.column(1).to_pylist():
                own = words_of(text)
                bits = np.zeros(SEEN, np.uint8)
                bits[(labelled(hashes.of(own), OFTEN) % np.uint64(SEEN)).astype(np.int64)] = 1
                sizes.append(len(own))
                seen.append(np.packbits(bits).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(seen, pa.list_(pa.int64()))], ["id", "n", "seen"])

    return texts.join(asked, "id", "left_semi").select("id", "text").mapInArrow(run, "id long, n long, seen array<long>")


def _close(x: str, y: str, similarity: float) -> Column:
    """Can texts with these words be alike? A word that one has more often than the other leaves a bit
    there alone, or hides behind another's, and each costs an edit. Few bits would be left free by a
    text of a word over and over, so only its first occurrences count."""
    most = F.greatest(f"{x}n", f"{y}n") * (1 - similarity) + 1e-6
    more = lambda p, q: F.aggregate(F.zip_with(p, q, lambda i, j: F.bit_count(i.bitwiseAND(F.bitwise_not(j)))), F.lit(0), lambda s, v: s + v)
    return F.coalesce((more(f"{x}seen", f"{y}seen") <= most) & (more(f"{y}seen", f"{x}seen") <= most), F.lit(True))


def _met(members: DataFrame, reps: DataFrame, similarity: float, texts: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b, l_a, l_b) of different labels in the buckets of ``members`` (key, id, label) whose sizes and words allow that they are alike.

    What sizes, counts and, given the ``texts``, words seen in crowded buckets rule out is no row of the join, and
    two texts meet in the first of their buckets alone, so a bucket of many different texts costs comparisons, not pairs.
    What a text is compared by is kept once for each text, not for each of its buckets.
    """
    still = members.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("key")
    open_members = _settled(members.join(still, "key").select("key", "id", "label"))
    own = open_members.groupBy("id").agg(F.collect_set("key").alias("keys")).join(reps.select("id", "n", "odd", "bag"), "id")
    possible = _near(similarity) & _possible("a.", "b.", similarity)
    if texts is not None:
        crowded = open_members.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > CROWD).select("key")
        if not crowded.isEmpty():
            asked = open_members.join(crowded, "key", "left_semi").select("id").distinct()
            own = own.join(_seen(texts, asked).drop("n"), "id", "left")
            possible = possible & _close("a.", "b.", similarity)
    first = F.array_min(F.array_intersect("a.keys", "b.keys")) == F.col("a.key")
    rows = open_members.join(_settled(own), "id")
    met = rows.alias("a").join(rows.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.label") < F.col("b.label")) & possible & first)
    return met.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"), F.col("a.label").alias("l_a"), F.col("b.label").alias("l_b"))


def _some(members: DataFrame) -> DataFrame:
    """Up to ``LEADERS`` members of each label in each bucket (key, id, label), others in each bucket."""
    salt = F.pmod(F.xxhash64("id", "key"), F.lit(LEADERS)).alias("salt")
    return members.groupBy("key", "label", salt).agg(F.min("id").alias("id")).select("key", "id", "label")


def _few(pairs: DataFrame) -> DataFrame:
    """Up to ``SMALL`` pairs of each two labels: one alike pair joins them."""
    rank = F.row_number().over(Window.partitionBy("l_a", "l_b").orderBy(F.xxhash64("a", "b"), "a", "b"))
    return pairs.withColumn("_i", rank).where(F.col("_i") <= SMALL)


def _closer(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) that the words seen in each text allow to be alike, so that fewer texts are sent along."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    bits = _settled(_seen(texts, asked))
    left, right = (bits.select(F.col("id").alias(c), F.col("n").alias(f"{c}_n"), F.col("seen").alias(f"{c}_seen")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").where(_close("a_", "b_", similarity)).select("a", "b")


def _joined(label: DataFrame, pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(id, label): the labels after those of alike pairs have become one, the least."""
    of = lambda c: label.select(F.col("id").alias(c), F.col("label").alias(f"l_{c}"))
    links = _verified(pairs, texts, similarity).join(of("a"), "a").join(of("b"), "b").where("l_a <> l_b").select(F.col("l_a").alias("a"), F.col("l_b").alias("b"))
    least = components(_settled(links.distinct())).select(F.col("id").alias("_id"), F.col("label").alias("_least"))
    return label.join(least, F.col("label") == F.col("_id"), "left").select("id", F.coalesce("_least", "label").alias("label"))


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, sketches: int = SKETCHES, several: int = SEVERAL, words: int = WORDS, short: int = SHORT) -> DataFrame:
    """(id, class_id) for each distinct id: the least id among the texts that links join to it.

    Texts are compared by their lower-cased words. Null and empty texts, and those without a
    word, are in a class of their own, rows without an id in none; an empty table gives no
    rows. Rows that share an id count as one document with one of their texts, that of the
    least hash. Other columns, whatever their names, are not looked at.
    """
    known = _settled(sketched(docs.where(F.col(quoted(id_col)).isNotNull()), id_col, text_col, sketches, several, words, int(short / similarity + 1e-6)))
    one = known.groupBy("id").agg(F.min(F.struct("mark", "sha")).alias("x")).select("id", F.col("x.sha").alias("sha"))
    copies = _settled(one.where("sha is not null").groupBy("sha").agg(F.min("id").alias("rep")))
    reps = known.join(copies, (known["sha"] == copies["sha"]) & (known["id"] == copies["rep"])).where(F.col("n") >= LEAST).dropDuplicates(["id"]).select("id", "n", "keys", "bag", "odd", "own")
    reps = _settled(reps.join(_own_prefixes(reps, similarity), F.col("id") == F.col("_id"), "left").select("id", "n", "keys", "bag", "odd", "prefix"))

    first = F.slice("prefix", F.lit(1), (_differ(F.col("n"), similarity) + 1).cast("int"))
    rows = reps.select("id", "n", F.explode(F.concat("keys", F.coalesce(first, F.array().cast("array<long>")))).alias("key"))
    buckets = rows.groupBy("key").agg(F.min(F.struct("id", "n")).alias("x"), F.max("id").alias("last")).where("x.id <> last").select("key", F.col("x.id").alias("lead"), F.col("x.n").alias("lead_n"))
    members = _settled(rows.join(buckets, "key"))
    involved = _settled(members.select("id").distinct())
    texts = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).cast("binary").alias("text")).join(involved, "id")
    texts = _settled(texts.withColumn("_row", F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("text")))).where("_row = 1").drop("_row"))

    near = F.abs(F.col("n") - F.col("lead_n")) <= F.greatest("n", "lead_n") * (1 - similarity) + 1e-6
    stars = members.where((F.col("id") != F.col("lead")) & near).select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    stars = _settled(_candidates(stars, reps, similarity))
    label = _settled(_joined(involved.select("id", F.col("id").alias("label")), stars, texts, similarity))
    of = lambda label: members.select("key", "id").join(label, "id")
    untried = lambda pairs, tried: pairs.select("a", "b").join(tried, ["a", "b"], "left_anti")
    tried = _settled(untried(_few(_met(_some(of(label)), reps, similarity, texts)), stars))
    label = _settled(_joined(label, tried, texts, similarity))
    # the above spares most pairs; what it has left out is looked at whole
    rest = _settled(untried(_met(of(label), reps, similarity, texts), stars.unionByName(tried)))
    label = _joined(label, _closer(rest, texts, similarity), texts, similarity)

    of_rep = copies.join(label, F.col("rep") == F.col("id"), "left").select("sha", F.coalesce("label", "rep").alias("label"))
    return one.join(of_rep, "sha", "left").select("id", F.coalesce("label", "id").alias("class_id"))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the one document of each class that has the least id; rows without an id stay."""
    own, copy = free_name(docs.columns, "_kept_id"), free_name(docs.columns, "_copy")
    kept = classes(docs, id_col=id_col, text_col=text_col, **options).where("id = class_id").select(F.col("id").alias(own))
    key = F.col(quoted(id_col)).cast("long")
    rows = docs.where(F.col(quoted(id_col)).isNotNull()).join(kept, key == F.col(own))
    rows = rows.withColumn(copy, F.row_number().over(Window.partitionBy(own).orderBy(own))).where(F.col(copy) == 1).select(*map(quoted, docs.columns))
    return rows.unionByName(docs.where(F.col(quoted(id_col)).isNull()))
