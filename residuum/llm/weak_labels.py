"""Quality classifier from weak labels.

Several heuristics, and annotators where there are any, vote on a document: bad, good or
nothing. How accurate each of them is, is estimated by expectation maximisation from how
their votes overlap; the statistics it needs are counts of vote patterns, a table of fixed
size. The posterior of a pattern labels the documents that have it, and these labels train
a hashed linear scorer, which reads the text alone. There is a model for each aspect (form
and civility); a document is rejected if either scorer is confident that it is bad.

The scorer is fitted on a bounded sample (``sample`` documents, by least hash of the id, four
fifths of all ids at most); everything else covers all documents. Its cutoffs come from the
scores of every document outside of the sample, summed up to a histogram of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residuum.llm.common import Rolling, cut, free_name, freed, map_batches, quoted
from residuum.llm.quality_rules import SYMBOLS, numbered, repeated_ids

BAD, NONE, GOOD = -1, 0, 1
SLOTS = 1 << 20
#: Documents that the scorer is fitted on, at most, and features that it weighs, at most.
SAMPLE, FEATURES = 12_000, 2048
#: Share of the documents with good labels outside of the sample that a cutoff may reject.
LOSS = 0.002
#: Scores are counted in steps of this size, up to this size.
STEP, FAR = 0.05, 100.0
INSULTS = frozenset(b"clown clowns disgusting idiot idiots imbecile loser losers moron morons pathetic scum stupid trash worthless".split())
_SHAPE = bytes(
    0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b
    for b in range(256)
)
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MARKS = b".,;:!?\"'()[]|#*$%&<>"
_WHOLE, _PREFIX = crc32(b"w:"), crc32(b"p:")
_SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Facts:
    """What labellers look at."""

    words: int
    distinct: int
    symbols: float
    capitals: float
    repeats: float
    copied_lines: float
    doubled: float
    mean_length: float
    enders: float
    insults: int


def facts(text: bytes, ids: np.ndarray, number: dict[bytes, int], rolling: Rolling) -> Facts:
    """``ids`` and ``number`` are the words of ``text`` as ``numbered`` gives them."""
    words, distinct = len(ids), len(number)
    n = max(1, words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    chars = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    capitals, small = int(chars[0x41:0x5B].sum()), int(chars[0x61:0x7B].sum())
    low = text.translate(_LETTERS)
    insults = sum(w.translate(_LETTERS).strip(_MARKS) in INSULTS for w in number) if any(map(low.__contains__, INSULTS)) else 0
    return Facts(
        words, distinct, int(chars[list(SYMBOLS)].sum()) / n, capitals / max(1, capitals + small), (repeated_ids(ids, rolling, 8) if distinct < words else 0) / n,
        1 - len(set(lines)) / max(1, len(lines)), int((ids[1:] == ids[:-1]).sum()) / n,
        (len(text) - int(chars[list(_SPACES)].sum())) / n, int(chars[list(b".!?")].sum()) / n, insults,
    )


def _vote(bad: bool, good: bool = False) -> int:
    return BAD if bad else GOOD if good else NONE


def plain(f: Facts) -> bool:
    """Prose in every respect looked at."""
    return f.words >= 20 and f.symbols < 0.05 and f.capitals < 0.15 and f.repeats < 0.05 and f.copied_lines < 0.1 and f.doubled < 0.05 and 0.01 < f.enders < 0.4


#: Labellers by aspect; each gets the facts and the annotation of its aspect (1 good, 0 bad, or none).
#: The absence of one defect says little, so a labeller that looks for one only votes for bad.
FORM = {
    "symbols": lambda f, a: _vote(f.symbols > 0.35),
    "capitals": lambda f, a: _vote(f.words >= 10 and f.capitals > 0.5),
    "repeats": lambda f, a: _vote(f.repeats > 0.4),
    "copied_lines": lambda f, a: _vote(f.copied_lines > 0.4),
    "doubled": lambda f, a: _vote(f.words >= 10 and f.doubled > 0.2),
    "variety": lambda f, a: _vote(f.words >= 50 and f.distinct < 0.15 * f.words),
    "sentences": lambda f, a: _vote(f.words >= 50 and f.enders < 0.002),
    "length": lambda f, a: _vote(f.words >= 3 and f.mean_length > 25),
    "plain": lambda f, a: _vote(False, plain(f)),
    "annotators": lambda f, a: _vote(a == 0, a == 1),
}
CIVILITY = {
    "insults": lambda f, a: _vote(f.insults * 400 >= max(1, f.words)),
    "many_insults": lambda f, a: _vote(f.insults >= 3),
    "annotators": lambda f, a: _vote(a == 0, a == 1),
}
#: Two of them; their scores travel as one complex number.
ASPECTS = {"form": FORM, "civility": CIVILITY}


def bucket(x: float) -> int:
    """Powers of two below one."""
    return int(np.clip(np.ceil(-np.log2(x)), 0, 9)) if x > 0 else 10


def bins(f: Facts) -> list[bytes]:
    """Features of the whole text: binned facts."""
    if not f.words:
        return [b"empty"]
    shares = (("distinct", f.distinct / f.words), ("symbols", f.symbols), ("capitals", f.capitals), ("repeats", f.repeats), ("copied", f.copied_lines), ("doubled", f.doubled), ("enders", f.enders))
    return [*(f"{k}={bucket(v)}".encode() for k, v in shares), b"words=%d" % min(12, f.words.bit_length()), b"insults=%d" % min(3, f.insults)]


def features(text: bytes, words: list[bytes], rolling: Rolling, cache: WordSlots) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text, as slots and values: bins, and what its words give, by the root of their number."""
    own = np.array([slot(b) for b in bins(facts(text, *numbered(words), rolling))])
    slots, counts = np.unique(np.concatenate([cache[w] for w in words] or [own[:0]]), return_counts=True)
    return np.append(slots, own), np.append(counts / np.sqrt(max(1, len(words))), np.ones(len(own))).astype(np.float32)


def slot(name: bytes) -> int:
    return crc32(name) % SLOTS


def shape_feature(form: bytes) -> bytes:
    return b"s:" + bytes(b for i, b in enumerate(form) if i == 0 or b != form[i - 1])[:12]


def plain_features(word: bytes) -> list[bytes]:
    plain = word.translate(_LETTERS).strip(_MARKS)
    return [b"w:" + plain, *(b"p:" + plain[:n] for n in range(5, min(8, len(plain))))]


def word_features(word: bytes) -> list[bytes]:
    """The word in small letters, its beginnings, and its shape: runs of one kind as one, up to twelve."""
    return [shape_feature(word.translate(_SHAPE)), *plain_features(word)]


class WordSlots(dict):
    """Slots of a word's features, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> np.ndarray:
        if len(self) > 100_000:
            self.clear()
        own = self[word] = np.array([slot(n) for n in word_features(word)])
        return own


class WordScores(dict):
    """What a word adds to the scores of both aspects, as the parts of a complex number."""

    def __init__(self, form: dict[int, float], civility: dict[int, float]):
        super().__init__()
        self.weight = {s: complex(form.get(s, 0.0), civility.get(s, 0.0)) for s in form.keys() | civility.keys()}
        self.shapes: dict[bytes, complex] = {}

    def of(self, names: list[bytes]) -> complex:
        return sum([self.weight.get(slot(n), 0j) for n in names])

    def __missing__(self, word: bytes) -> complex:
        if len(self) > 300_000:
            self.clear()
        form, plain, get = word.translate(_SHAPE), word.translate(_LETTERS).strip(_MARKS), self.weight.get
        total = self.shapes.get(form)
        if total is None:
            if len(self.shapes) > 100_000:
                self.shapes.clear()
            total = self.shapes[form] = self.of([shape_feature(form)])
        total += get(crc32(plain, _WHOLE) % SLOTS, 0j)
        if len(plain) > 5:  # a checksum goes on where it was left
            sum5 = crc32(plain[:5], _PREFIX)
            total += get(sum5 % SLOTS, 0j)
            if len(plain) > 6:
                sum6 = crc32(plain[5:6], sum5)
                total += get(sum6 % SLOTS, 0j)
                if len(plain) > 7:
                    total += get(crc32(plain[6:7], sum6) % SLOTS, 0j)
        self[word] = total
        return total


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for each vote pattern (rows of -1, 0, 1; counts of documents), and each labeller's accuracy.

    A labeller that votes is right at its accuracy, whatever the document; whether it votes
    tells nothing. Votes are taken as independent once the truth is known, and good and bad
    as equally likely before it votes, so a lone vote counts as much as its labeller is
    worth. A pattern without a vote has one half.
    """
    if not len(votes):
        return np.empty(0), np.empty(0)
    accuracy = np.full(votes.shape[1], 0.9)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-votes @ np.log(accuracy / (1 - accuracy))))
        right = counts @ ((votes == GOOD) * p[:, None] + (votes == BAD) * (1 - p)[:, None])
        accuracy = np.clip((right + 9) / (counts @ (votes != NONE) + 10), 0.55, 0.995)
    return p, accuracy


def fit(target: np.ndarray, owner: np.ndarray, slots: np.ndarray, value: np.ndarray, rounds: int = 100, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, intercept) of a logistic scorer of soft labels, by Adam on the whole sample.

    A feature is an owner (place in ``target``), a slot and a value.
    """
    if not len(target):
        return np.empty(0, np.int64), np.empty(0), 0.0
    slots, column = np.unique(slots, return_inverse=True)
    w, m, v = (np.zeros(len(slots) + 1) for _ in range(3))
    w[-1] = np.log(max(target.mean(), 1e-3) / max(1 - target.mean(), 1e-3))
    score_of = lambda: np.bincount(owner, value * w[column], len(target)) + w[-1]
    for t in range(1, rounds + 1):
        error = 1 / (1 + np.exp(-np.clip(score_of(), -30, 30))) - target
        grad = np.append(np.bincount(column, value * error[owner], len(slots)), error.sum()) / len(target) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return slots, w[:-1], float(w[-1])


def vote_table(docs: DataFrame, labels: DataFrame | None, *, id_col: str, text_col: str, marks: dict[str, tuple[str, int]]) -> DataFrame:
    """(id, sha, one array of votes for each aspect); ``marks`` names an aspect's column of
    ``labels`` and its value for good."""
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))

    def run(batches):
        rolling = Rolling()
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                f = facts(text or b"", *numbered((text or b"").split()), rolling)
                out.append({k: [x(f, None) for name, x in own.items() if name != "annotators"] for k, own in ASPECTS.items()})
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[k] for o in out], pa.list_(pa.int32())) for k in ASPECTS)], ["id", *ASPECTS])

    votes = rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema[0].dataType), *(T.StructField(k, T.ArrayType(T.IntegerType())) for k in ASPECTS)]))
    if labels is None:
        return votes.select("id", *(F.concat(k, F.array(F.lit(0))).alias(k) for k in ASPECTS))
    own = labels.groupBy(F.col(quoted(id_col)).alias("id")).agg(*(F.max(F.when(F.col(quoted(c)).isNotNull(), F.when(F.col(quoted(c)) == good, 1).otherwise(-1))).alias(f"_{k}") for k, (c, good) in marks.items()))
    return votes.join(own, "id", "left").select("id", *(F.concat(k, F.array(F.coalesce(F.col(f"_{k}"), F.lit(0)))).alias(k) for k in ASPECTS))


@dataclass(frozen=True)
class Model:
    """For each aspect: slots, weights and intercept; the posteriors of vote patterns, the votes
    of all documents, and the ids of the sample, for the cutoffs."""

    parts: dict[str, tuple[np.ndarray, np.ndarray, float]]
    posterior: dict[str, dict[tuple, float]]
    votes: DataFrame
    sample: DataFrame


def train(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", marks: dict[str, tuple[str, int]] | None = None, sample: int = SAMPLE, most: int = FEATURES) -> Model:
    """The model of ``docs``; ``labels`` are one more labeller of the ids that they have.

    Rows that share an id are sampled together; rows without one only count for the accuracies.
    """
    marks = marks or {"form": ("quality", 1), "civility": ("toxic", 0)}
    votes = cut(vote_table(docs, labels, id_col=id_col, text_col=text_col, marks=marks))
    posterior = {}
    for aspect in ASPECTS:
        patterns = [(tuple(r[0]), r[1]) for r in votes.groupBy(aspect).count().collect()]  # 3 to the labellers, at most
        good, _ = estimate(np.array([p for p, _ in patterns]).reshape(-1, len(ASPECTS[aspect])), np.array([c for _, c in patterns], float))
        posterior[aspect] = dict(zip([p for p, _ in patterns], good.tolist(), strict=True))
    voted = reduce(or_, (F.exists(k, lambda v: v != 0) for k in ASPECTS))
    fold = F.pmod(F.xxhash64("id"), F.lit(5))
    chosen = votes.where(voted & (fold > 0)).dropDuplicates(["id"]).select("id", *ASPECTS).orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = cut(chosen)  # ``sample`` rows at most, so it can be broadcast
    texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("text", *ASPECTS)

    def run(batches):
        rolling, cache = Rolling(), WordSlots()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                slots, values = features(r["text"] or b"", (r["text"] or b"").split(), rolling, cache)
                out.append(([posterior[k].get(tuple(r[k]), 0.5) for k in ASPECTS], slots, values))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.list_(pa.float64())), pa.array([o[1] for o in out], pa.list_(pa.int32())), pa.array([o[2] for o in out], pa.list_(pa.float32()))], ["good", "slots", "values"])

    data = cut(rows.mapInArrow(run, "good array<double>, slots array<int>, values array<float>"))
    parts = {}
    for i, aspect in enumerate(ASPECTS):
        y = F.col("good")[i]
        told = data.where(F.abs(y - 0.5) > 0.01)  # someone has voted
        bad = (told.agg(F.avg(1 - y)).first()[0]) or 0.0
        each = told.select(y.alias("y"), F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("n"), F.sum(1 - F.col("y")).alias("bad"))
        gain = F.abs(F.col("bad") - F.col("n") * F.lit(bad)) / F.sqrt(F.col("n") * F.lit(bad * (1 - bad) + 1e-6))
        picked = [r[0] for r in each.where("n >= 8").orderBy(gain.desc(), "slot").limit(most).collect()]
        keep = data.sparkSession.sparkContext.broadcast(np.sort(np.array(picked, np.int64)))

        def chosen_only(batches, keep=keep):
            for batch in batches:
                out_s, out_v = [], []
                for s, v in zip(batch.column(1), batch.column(2), strict=True):
                    s, v = np.asarray(s.values), np.asarray(v.values)
                    has = np.isin(s, keep.value)
                    out_s.append(s[has])
                    out_v.append(v[has])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out_s, pa.list_(pa.int32())), pa.array(out_v, pa.list_(pa.float32()))], ["y", "slots", "values"])

        own = told.select(y.alias("y"), "slots", "values").mapInArrow(chosen_only, "y double, slots array<int>, values array<float>").toArrow().combine_chunks()
        sizes = np.asarray(pc.list_value_length(own["slots"]))
        target = np.asarray(own["y"])
        slots, values = (np.asarray(pc.list_flatten(own[c])) for c in ("slots", "values"))
        slots, weights, intercept = fit(target, np.repeat(np.arange(len(sizes)), sizes), slots.astype(np.int64), values.astype(float))
        parts[aspect] = (slots, weights, intercept)
    del own, sizes, target, values
    freed(docs.sparkSession)  # the sample was in the driver
    return Model(parts, posterior, votes, chosen.select("id"))


def scores(docs: DataFrame, model: Model, *, text_col: str = "text", out: str = "quality") -> tuple[DataFrame, str]:
    """Every row of ``docs`` with a struct of its scores (log odds of good), and that column's name."""
    name, at = free_name(docs.columns, out), docs.columns.index(text_col)
    names = [*docs.columns, name]
    shared = docs.sparkSession.sparkContext.broadcast(model.parts)
    kind = T.StructType([T.StructField(k, T.DoubleType()) for k in ASPECTS])
    arrow = pa.struct([(k, pa.float64()) for k in ASPECTS])

    def run(batches):
        rolling, parts = Rolling(), shared.value
        cache = WordScores(*(dict(zip(slots.tolist(), weights.tolist(), strict=True)) for slots, weights, _ in (parts[k] for k in ASPECTS)))
        lead = complex(*(parts[k][2] for k in ASPECTS))
        for batch in batches:
            out = []
            for text in batch.column(at).cast(pa.binary()).to_pylist():
                text = text or b""
                ids, number = numbered(text.split())
                each = np.fromiter(map(cache.__getitem__, number), complex, len(number))
                total = lead + np.bincount(ids.astype(np.int64), minlength=len(number)) @ each / max(1, len(ids)) ** 0.5 + cache.of(bins(facts(text, ids, number, rolling)))
                out.append(dict(zip(ASPECTS, (total.real, total.imag), strict=True)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, arrow)], names)

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, kind)])), name


def cutoffs(rows: DataFrame, name: str, model: Model, *, id_col: str = "doc_id", loss: float = LOSS) -> dict[str, float]:
    """For each aspect the score below which a text is bad: the share ``loss`` of the documents
    outside of the sample that are good by their votes are below it, and it is never above 0.

    A histogram of the scores reaches the driver. Without such documents nothing is rejected.
    """
    own = rows.select(F.col(quoted(id_col)).alias("id"), name).join(F.broadcast(model.sample), "id", "left_anti")
    both = own.join(model.votes, "id")
    out = {}
    for aspect in ASPECTS:
        good = [p for p, x in model.posterior[aspect].items() if x > 0.5]
        is_good = F.concat_ws(",", aspect).isin([",".join(map(str, p)) for p in good]) if good else F.lit(False)
        step = F.floor(F.greatest(F.least(F.col(f"{name}.{aspect}"), F.lit(FAR)), F.lit(-FAR)) / STEP).alias("step")
        counts = sorted((r["step"], r["count"]) for r in both.where(is_good).groupBy(step).count().collect())
        allowed, below = loss * sum(n for _, n in counts), 0
        out[aspect] = -np.inf
        for at, n in counts:
            out[aspect] = min(0.0, at * STEP)
            if below + n > allowed:
                break
            below += n
    return out


def judged(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", out: str = "quality", loss: float = LOSS, with_text: bool = True) -> tuple[DataFrame, str]:
    """Every row of ``docs`` with a struct of its scores and ``kept``, and that column's name.

    Null and empty texts have the one feature of an empty text. Repeated rows get equal
    scores. Should ``docs`` have a column named ``out``, the new one gets underscores in front.
    The scores are made once, for the cutoffs and the result.
    """
    rows, name = scores(docs, model, text_col=text_col, out=out)
    if not with_text:
        rows = rows.select(*(quoted(c) for c in docs.columns if c != text_col), name)
    rows = cut(rows)
    least = cutoffs(rows, name, model, id_col=id_col, loss=loss)
    kept = reduce(and_, (F.col(f"{name}.{k}") >= F.lit(float(v)) for k, v in least.items()))
    return rows.withColumn(name, F.struct(*(F.col(f"{name}.{k}").alias(k) for k in ASPECTS), kept.alias("kept"))), name
