"""Toxic passages as maximal scoring segments of words.

Words get a score from labelled documents: the log-odds between toxic and other documents
with an informative Dirichlet prior (Monroe, Colaresi, Quinn 2008), whose weights are in how
many documents of the whole corpus a word stands; the score is drawn to zero by ``DOUBT``
standard errors, and ``DRIFT`` is taken from every word, so that ordinary text scores below
zero. A linear scan (Ruzzo, Tompa 1999) finds all maximal scoring segments of a text. How
significant a segment is follows from extreme-value theory (Karlin, Altschul 1990): the rate
solves E[exp(rate * score)] = 1 over the words of documents that are not toxic (the prior
with their counts), and a text of n words has some
n * exp(-rate * S) segments of score S by chance. The chances of a text's best segments are
joined (Karlin, Altschul 1993), and documents that had no part in the word scores set what
share of documents with such a chance is toxic.

Words are runs of letters and digits in lower case, in 2**22 hashed slots, so that all tables that are
gathered have a fixed size. Word scores and calibration are learnt from ``SAMPLE`` labelled
documents at most, those of least hash of the id; equal texts among them count once, with
the mean of their labels. The prior and the rate cover all documents.

Defined results: a null text is empty; an empty text, or one without a scoring word, gets the
share that holds for texts without any segment; without a toxic or without another labelled
document all scores are 0, and where no word tells them apart they are the toxic share. Labels that are null are left out; of several labels of a document
the largest counts. Documents with equal ids are each scored. Further columns stay as they
are; the result is a struct of a free name.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residuum.llm.common import cut, free_name, quoted

SLOTS = 1 << 22
#: Labelled documents that are learnt from, at most.
SAMPLE = 100_000
#: Weight of the prior, in share of the words of the labelled documents.
PRIOR = 0.02
#: Standard errors by which a score is drawn to zero, and what is taken from each word.
DOUBT, DRIFT = 1.64, 0.5
#: A passage is significant if by chance fewer than this many are expected in its text.
SIGNIFICANT = 0.05
#: Calibration counts documents in steps of the negative logarithm of their chance, up to the last one.
STEP, STEPS = 0.5, 200
#: Best segments of a text whose chances are joined, at most.
BEST = 5

WORD = re.compile(r"[^\W_]+")
PASSAGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())])
FOUND = T.StructType([T.StructField("chance", T.DoubleType()), T.StructField("passages", T.ArrayType(PASSAGE))])


@dataclass
class Model:
    """Scores of slots (all others score ``other``), the rate, and the toxic share by step of the logarithm."""

    slots: np.ndarray
    scores: np.ndarray
    other: float
    rate: float
    shares: np.ndarray


class Slots(dict):
    """Slot of a word as it stands in the text, remembered for as many words as ``most``."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.lower()) & (SLOTS - 1)
        return value


class Scores(dict):
    """Score of a word as it stands in the text."""

    def __init__(self, model: Model, most: int = 400_000):
        super().__init__()
        self.most, self.other = most, model.other
        self.known = dict(zip(model.slots.tolist(), model.scores.tolist()))

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.known.get(xxhash.xxh64_intdigest(word.lower()) & (SLOTS - 1), self.other)
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(first, end, sum) of all maximal scoring segments, in linear time.

    ``held`` has the candidates with the sums before and after them; ``lower`` points to the
    nearest earlier one that starts lower, so that no candidate is passed twice.
    """
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[tuple[int, int, float, float, int]] = []
    for p in places.tolist():
        first, end, left, right = p, p + 1, float(sums[p]), float(sums[p + 1])
        at = len(held) - 1
        while True:
            while at >= 0 and held[at][2] >= left:
                at = held[at][4]
            if at < 0 or held[at][3] >= right:
                held.append((first, end, left, right, at))
                break
            first, left, lower = held[at][0], held[at][2], held[at][4]
            del held[at:]
            at = lower
    return [(first, end, right - left) for first, end, left, right, _ in held]


def joint_chance(found: list[tuple[int, int, float]], n: int, rate: float) -> float:
    """Chance of segments as good as the best ones of a text of ``n`` words.

    For the r best ones with the sum x of their normalised scores it is exp(-x) x**(r-1) /
    (r! (r-1)!), and of these the least counts, each number r with half the weight of the one before.
    """
    best = sorted((s for _, _, s in found), reverse=True)[:BEST]
    least, x = 1.0, 0.0
    for r, s in enumerate(best, 1):
        x += rate * s - math.log(max(n, 1))
        if x > 0:
            p = math.exp(-x + (r - 1) * math.log(x) - math.lgamma(r + 1) - math.lgamma(r)) * 2**r
            least = min(least, -math.expm1(-p) if p < 1 else 1.0)
    return least


def rate_of(values: np.ndarray, weights: np.ndarray) -> float:
    """The rate > 0 at which the mean of exp(rate * value) is 1; there is one if values are below 0 in the mean and some are above."""
    weights = weights / weights.sum()
    low, high = 0.0, 1.0
    over = lambda r: float(np.sum(weights * np.exp(np.minimum(r * values, 700)))) > 1
    while not over(high) and high < 1e3:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    return (low + high) / 2


def _count_words(texts: DataFrame) -> DataFrame:
    """(slot, n): in how many rows each slot's words stand."""

    def run(batches):
        slots, total = Slots(), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    total[np.fromiter({slots[w] for w in set(WORD.findall(t))}, np.int64)] += 1
        some = np.flatnonzero(total)
        for low in range(0, len(some), 1 << 16):
            part = some[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(total[part], pa.int64())], names=["slot", "n"])

    return texts.mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))


def _sample_words(texts: DataFrame) -> DataFrame:
    """(digest, toxic, slots): the words of each different text of (text, toxic), with the mean of its labels."""

    def run(batches):
        slots = Slots()
        for batch in batches:
            texts_ = batch.column(0).to_pylist()
            own = [sorted({slots[w] for w in set(WORD.findall(t or ""))}) for t in texts_]
            keys = [xxhash.xxh128_digest(t or "") for t in texts_]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(1), pa.array(own, pa.list_(pa.int32()))], names=["digest", "toxic", "slots"])

    return texts.mapInArrow(run, "digest binary, toxic double, slots array<int>").groupBy("digest").agg(F.avg("toxic").alias("toxic"), F.any_value("slots").alias("slots"))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """(text, toxic, id) of at most ``sample`` labelled documents; their ids are broadcast."""
    known = labels.groupBy(F.col("id").alias("_id")).agg(F.max("toxic").cast("double").alias("_toxic")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).alias("text"))
    return texts.join(F.broadcast(known), "_id").select("text", F.col("_toxic").alias("toxic"), F.col("_id").alias("id"))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, calibrate: Column | None = None) -> Model | None:
    """The model of ``labels`` (id, 0 or 1). ``calibrate`` tells by id which third of them sets the shares and not the scores."""
    known = labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).alias("toxic")).where("id is not null and toxic is not null")
    rows = cut(_sample(docs, known, id_col, text_col, sample).withColumn("later", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(3)) == 0 if calibrate is None else calibrate))
    words = cut(_sample_words(rows.where("not later").select("text", "toxic")))
    classes = words.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other"), F.sum(F.size("slots") * F.col("toxic")).alias("n_toxic"), F.sum(F.size("slots") * (1 - F.col("toxic"))).alias("n_other")).first()
    if not classes["toxic"] or not classes["other"] or not classes["n_toxic"] or not classes["n_other"]:
        return None
    counts = words.select("toxic", F.explode("slots").alias("slot")).groupBy("slot").agg(F.sum("toxic").alias("y"), F.sum(1 - F.col("toxic")).alias("z"))
    corpus = cut(_count_words(docs.select(F.col(quoted(text_col)))))
    total = corpus.agg(F.sum("n")).first()[0]
    n_y, n_z = float(classes["n_toxic"]), float(classes["n_other"])
    strength = PRIOR * (n_y + n_z)
    a = F.col("n") * F.lit(strength / total)
    odds = lambda y, n: F.log((y + a) / (n + strength - y - a))
    error = F.sqrt(1 / (F.col("y") + a) + 1 / (F.col("z") + a))
    delta = odds(F.col("y"), n_y) - odds(F.col("z"), n_z)
    score = F.when(delta > 0, F.greatest(delta - DOUBT * error, F.lit(0.0))).otherwise(F.least(delta + DOUBT * error, F.lit(0.0)))
    known_words = counts.join(corpus, "slot").select("slot", ((F.col("z") + a) / (n_z + strength)).alias("share"), score.alias("score")).where("score <> 0").toArrow()
    slots, share, scores = (known_words.column(i).to_numpy() for i in range(3))
    base = float(classes["toxic"] / (classes["toxic"] + classes["other"]))
    if not (scores > DRIFT).any():
        return Model(slots[:0], scores[:0], -DRIFT, 1.0, np.full(STEPS + 1, base))
    values, weights = np.append(scores, 0.0) - DRIFT, np.append(share, max(1 - share.sum(), 1e-9))
    model = Model(slots, scores - DRIFT, -DRIFT, rate_of(values, weights), np.zeros(STEPS + 1))
    later, name = passages(rows.where("later").select("text", "toxic"), model)
    steps = later.select(_step(F.col(f"{name}.chance")).alias("step"), "toxic", F.xxhash64("text").alias("copy")).groupBy("copy").agg(F.max("step").alias("step"), F.avg("toxic").alias("toxic"))
    found = steps.groupBy("step").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()
    model.shares = _shares([(r["step"], r["n"], r["toxic"]) for r in found], base)
    return model


def _step(chance: Column) -> Column:
    """Texts without a segment are step 0, others are counted from step 1 on."""
    return F.when(chance >= 1, 0).otherwise(F.least(F.floor(-F.log(F.greatest(chance, F.lit(1e-300))) / STEP) + 1, F.lit(STEPS))).cast("int")


def _shares(found: list[tuple[int, int, float]], base: float) -> np.ndarray:
    """Toxic share of each step, rising with it: neighbours that fall are pooled, a row of the ``base`` share is added to each pool, and steps between are interpolated."""
    pools: list[list[float]] = []
    for step, n, y in sorted(found):
        pools.append([y, n, step, step])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    if not pools:
        return np.full(STEPS + 1, base)
    steps = [x for _, _, low, high in pools for x in (low, high)]
    shares = np.maximum.accumulate([(y + base) / (n + 1) for y, n, _, _ in pools])
    return np.interp(np.arange(STEPS + 1), steps, np.repeat(shares, 2))


def passages(docs: DataFrame, model: Model, *, text_col: str = "text", significant: float = SIGNIFICANT) -> tuple[DataFrame, str]:
    """``docs`` and a struct (chance, passages): significant passages by code points, with their score and the number expected by chance."""
    name = free_name(docs.columns, "found")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, FOUND)])
    place = docs.columns.index(text_col)

    def run(batches):
        score = Scores(model)
        for batch in batches:
            out = []
            for t in batch.column(place).to_pylist():
                words = WORD.findall(t or "")
                values = np.fromiter(map(score.__getitem__, words), float, len(words))
                found = segments(values)
                passages_ = []
                if found:
                    spans = [m.span() for m in WORD.finditer(t)]
                    for first, end, s in found:
                        expected = len(words) * math.exp(-model.rate * s)
                        if expected < significant:
                            passages_.append({"start": spans[first][0], "end": spans[end - 1][1], "score": s, "expected": expected})
                out.append({"chance": joint_chance(found, len(words), model.rate), "passages": passages_})
            kind = pa.struct([("chance", pa.float64()), ("passages", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[f"c{i}" for i in range(batch.num_columns + 1)])

    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    out = numbered.mapInArrow(run, T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)]))
    return out.toDF(*schema.names), name


def scored(docs: DataFrame, model: Model | None, *, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` and a struct (chance, passages, score): the toxic share among documents with such a chance."""
    if model is None:
        name = free_name(docs.columns, "found")
        nothing = F.struct(F.lit(1.0).alias("chance"), F.array().cast(T.ArrayType(PASSAGE)).alias("passages"), F.lit(0.0).alias("score"))
        return docs.withColumn(name, nothing), name
    found, name = passages(docs, model, text_col=text_col)
    share = F.element_at(F.array(*map(F.lit, model.shares.tolist())), _step(F.col(f"{name}.chance")) + 1)
    # within a step of equal shares the chance still orders documents
    more = 1e-6 * (1 - F.col(f"{name}.chance"))
    return found.withColumn(name, F.col(name).withField("score", F.least(share + more, F.lit(1.0)))), name
