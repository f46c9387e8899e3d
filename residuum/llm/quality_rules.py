"""Quality rules with risk-controlled thresholds.

Each rule compares one measure of a document with a cutoff of a fixed grid. The rules start
switched off and are tightened one cutoff at a time, each from the loosest on, along one path
of steps. The labelled bad documents give the order: the step that catches most of them comes
next. Good documents have no part in it, so for them the path is a fixed sequence of tests: in
each stratum, after each step, the exact (Clopper-Pearson) upper bound on the share of good
documents that all rules together would reject is tested against ``risk``, up to the first
step that fails. A fixed sequence needs no correction for its length, and a step that rejects
no good document costs nothing. The level is divided by the number of strata only: with
confidence ``1 - delta`` no stratum loses more than ``risk`` of its good documents to the
rules. A stratum with fewer than ``labels_needed()`` good documents has no rules.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from math import ceil, exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residuum.llm.common import Rolling, cut, map_batches, quoted

#: Measures of a text, in the order of the result.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """Rejects where ``top / bottom`` is above the cutoff; ``low`` rejects below it."""

    name: str
    top: str
    bottom: str
    cutoffs: tuple[float, ...]
    low: bool = False


def grid(first: float, last: float, n: int = 24) -> tuple[float, ...]:
    """``n`` cutoffs from first to last in equal ratios."""
    return tuple(float(x) for x in np.geomspace(first, last, n))


RULES = (
    Rule("symbols", "n_symbols", "n_words", grid(0.02, 3.0)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", grid(0.02, 0.9)),
    Rule("repeated_words", "n_repeat_words", "n_words", grid(0.02, 0.9)),
    Rule("capitals", "n_capitals", "word_chars", grid(0.05, 0.9)),
    Rule("long_words", "word_chars", "n_words", grid(8.0, 40.0)),
)
STRATA = ("en", "de", "fr", "es")


def measure(text: bytes | None, rolling: Rolling, window: int = 8) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``. Null has no words and no lines."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    chars = len(text.decode("utf-8", "replace")) - sum(text.count(c) for c in SPACES)
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return (len(words), chars, int(counts[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated(words, rolling, window), len(lines), int(counts[0x41:0x5B].sum()))


def repeated(words: list[bytes], rolling: Rolling, window: int) -> int:
    """Words in runs of ``window`` words that the text has twice or more."""
    if len(words) <= window:
        return 0
    ids, number = numbered(words)
    return repeated_ids(ids, rolling, window) if len(number) < len(words) else 0


def numbered(words: list[bytes]) -> tuple[np.ndarray, dict[bytes, int]]:
    """The words as numbers in order of their first place, and the number of each."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    return np.fromiter(map(number.__getitem__, words), np.uint64, len(words)), number


def repeated_ids(ids: np.ndarray, rolling: Rolling, window: int) -> int:
    if len(ids) <= window:
        return 0
    hashes = rolling(ids, window)
    ordered = np.sort(hashes)
    if (ordered[1:] != ordered[:-1]).all():
        return 0
    values, group, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    places = np.flatnonzero(counts[group] > 1)  # equal hashes; the runs themselves decide
    rows = np.lib.stride_tricks.sliding_window_view(ids, window)[places]
    _, group, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = places[counts[group.reshape(-1)] > 1]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[: len(ids)] > 0).sum())


def measured(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` without its text and with the measures; a column of a measure's name is replaced."""
    keep = [c for c in docs.columns if c != text_col and c not in MEASURES]
    rows = docs.select(F.col(quoted(text_col)).cast("binary").alias("__text"), *map(F.col, map(quoted, keep)))

    def run(batches):
        rolling = Rolling()
        for batch in batches:
            values = [measure(t, rolling) for t in batch.column(0).to_pylist()]
            columns = [pa.array(x, pa.int64()) for x in zip(*values, strict=True)] or [pa.array([], pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], [*keep, *MEASURES])

    fields = [*rows.schema.fields[1:], *(T.StructField(m, T.LongType()) for m in MEASURES)]
    return map_batches(rows, run, T.StructType(fields))


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 in 100 words repeated."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def log_tail(rejected: int, n: int, risk: float) -> float:
    """Log of the chance of so few rejections or fewer among ``n``, were the rate ``risk``."""
    terms = [lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(risk) + (n - k) * log1p(-risk) for k in range(rejected + 1)]
    most = max(terms)
    return most + log(sum(exp(t - most) for t in terms))


def passes(rejected: int, n: int, risk: float, level: float) -> bool:
    """Whether the exact upper bound, at ``1 - level``, on the rejection rate is at most ``risk``."""
    return n > 0 and rejected <= risk * n and log_tail(rejected, n, risk) <= log(level)


def labels_needed(risk: float = 0.01, delta: float = 0.05, strata: tuple[str, ...] = STRATA) -> int:
    """Good documents that a stratum needs for a first step, if that step rejects none of them."""
    return ceil(log(delta / (len(strata) + 1)) / log1p(-risk))


def path(caught: list[list[int]]) -> list[tuple[int, int]]:
    """Steps (rule, place of the cutoff) given the bad documents that each cutoff of each rule
    catches, from the loosest cutoff on: most newly caught first, then loosest. Cutoffs that
    catch no more than the one before are passed over while the rule has one that does."""
    at, steps = [-1] * len(caught), []
    while True:
        ways = []
        for i, counts in enumerate(caught):
            had = counts[at[i]] if at[i] >= 0 else 0
            j = next((j for j in range(at[i] + 1, len(counts)) if counts[j] > had), at[i] + 1)
            if j < len(counts):
                ways.append((had - counts[j], j, i))
        if not ways:
            return steps
        _, j, i = min(ways)
        at[i] = j
        steps.append((i, j))


def _value(rule: Rule) -> Column:
    return F.when(F.col(rule.bottom) > 0, F.col(rule.top) / F.col(rule.bottom))


def stratum(col: str, strata: tuple[str, ...]) -> Column:
    """The value if it is one of ``strata``, else ``other``; so the number of strata is fixed."""
    return F.when(F.col(quoted(col)).isin(*strata), F.col(quoted(col))).otherwise("other")


def thresholds(holdout: DataFrame, good: Column, *, stratum_col: str = "stratum", strata: tuple[str, ...] = STRATA, rules: tuple[Rule, ...] = RULES, risk: float = 0.01, delta: float = 0.05) -> dict[tuple[str, str], float]:
    """{(stratum, rule): cutoff} from measured, labelled documents.

    All labelled documents count. What reaches the driver is a count for each rule and cutoff,
    and one for each stratum and step of the path, however many documents there are.
    """
    rows = cut(holdout.where(~base_failed()).withColumn("_good", good))
    orders = [sorted(rule.cutoffs, reverse=not rule.low) for rule in rules]  # from the loosest on
    hit = lambda i, j: (_value(rules[i]) < orders[i][j]) if rules[i].low else (_value(rules[i]) > orders[i][j])
    places = [(i, j) for i, order in enumerate(orders) for j in range(len(order))]
    bad = rows.where("NOT _good").agg(*(F.count(F.when(hit(i, j), 1)).alias(f"r{i}_{j}") for i, j in places)).first()
    steps = path([[bad[f"r{i}_{j}"] for j in range(len(order))] for i, order in enumerate(orders)])
    first = F  # the step that first rejects the document
    for k, (i, j) in enumerate(steps):
        first = first.when(hit(i, j), F.lit(k))
    first = first.otherwise(len(steps)) if steps else F.lit(0)
    lost: dict[str, list[int]] = {}
    for row in rows.where("_good").groupBy(F.col(stratum_col).alias("s"), first.alias("step")).agg(F.count("*").alias("n")).collect():
        lost.setdefault(row["s"], [0] * (len(steps) + 1))[row["step"]] = row["n"]
    out = {}
    for s, counts in lost.items():
        rejected = 0
        for k, (i, j) in enumerate(steps):
            rejected += counts[k]
            if not passes(rejected, sum(counts), risk, delta / (len(strata) + 1)):
                break
            out[s, rules[i].name] = orders[i][j]
    return out


def verdict(cutoffs: dict[tuple[str, str], float], *, stratum_col: str = "stratum", rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that reject a document."""
    named = []
    for rule in rules:
        for (s, name), c in sorted(cutoffs.items()):
            if name == rule.name:
                value = _value(rule)
                named.append(F.when((F.col(stratum_col) == s) & ((value < c) if rule.low else (value > c)), F.lit(name)))
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def apply(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality", strata: tuple[str, ...] = STRATA, rules: tuple[Rule, ...] = RULES, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """Each row of ``docs`` (id, measures) with ``base_failed``, ``failed`` rules and ``kept``.

    Null and empty texts have no words, so the base fails; rules whose measure has nothing
    to divide by do not reject; a null or unknown stratum is ``other``; documents labelled
    more than once are good if any label says so; repeated rows each get the verdict. With
    no labels only the base rejects. Labelled documents that the base rejects do not count.
    """
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"), stratum(stratum_col, strata).alias("stratum"))
    known = cut(measured(rows))
    marks = labels.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(label_col)).alias("label")).groupBy("doc_id").agg(F.max("label").alias("label"))
    cutoffs = thresholds(known.join(marks, "doc_id"), F.col("label") == 1, strata=strata, rules=rules, risk=risk, delta=delta)
    failed = known.withColumn("base_failed", base_failed()).withColumn("failed", verdict(cutoffs, rules=rules))
    return failed.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", *MEASURES[:5], "base_failed", "kept", F.array_join("failed", ",").alias("failed_rules"))
