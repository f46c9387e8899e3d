"""Personal data by boosted candidates. DataFrame and SQL functions only, on the whole path.

Base kinds (email, ip, card, phone) are patterns with a check; what they find is always
kept. Generators of high recall propose further, overlapping spans: any run that could be
an address or a number. Gradient boosted trees score a proposal by its format and what
stands around it. A proposal that a base span confirms is a positive; one that a base pattern
matches and its check turns down, and a date or time, a negative. Base patterns know the plain
forms only, so each of these also counts as people disguise it (``a (at) b (dot) c``, a phone
number without its plus, a card number in groups with dots) in the same context, and the trees
learn the forms. Proposals that no base pattern matches are what is searched; they are neither,
and not fitted on. The trees are fitted on a bounded sample of distinct proposals (``sample``,
by least hash, weighted by how often they occur), of three folds in four; the cutoff is the
least score above which those of the fourth fold, all of them, are positive at the rate
``precision``. Proposals over the cutoff that touch no base span and no better proposal are
added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residuum.llm.common import cut, quoted

#: Possessive groups and looks behind keep the search linear; they change no match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which there is no match.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": "+"}
GENERATORS = {
    "address_like": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:\x20?(?:@|\(at\)|\[at\])\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++",
    "number_like": r"(?<![A-Za-z0-9])[(+]?[0-9](?:[\x20().:/-]{0,3}[0-9]){6,40}+(?![A-Za-z0-9])",
}
CUES = r"(?i)(?:phone|mobile|tel|call|fax|mail|contact|card|visa|account|iban|ssn|social|passport|licen[cs]e|born|birth|address|id)[^A-Za-z]{0,3}$"
AROUND = 24
#: Proposals that the trees are fitted on, at most, and the rate of confirmed ones above the cutoff.
SAMPLE, PRECISION, TREES, DEPTH = 20_000, 0.98, 16, 4
FEATURES = ("length", "digits", "letters", "separators", "groups", "longest", "zeros", "dots", "cue", "open_left", "open_right", "sum_check", "at_sign")
#: Proposals that are a date or a time, not a number of someone.
DATE = r"^(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2}|[0-9]{1,2}:[0-9]{2})(?![0-9])"
#: Hits of a text that are placed in one go.
GO = 256


def spans(text: Column, pattern: str, kind: str) -> Column:
    """array<struct<kind, first, last, value, left, right>> of the leftmost matches that do not overlap.

    Texts between matches and the matches alternate, so their lengths add up to the places.
    """
    between, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(between.alias("gap"), F.concat(hits, F.array(F.lit(None).cast("string"))).alias("hit"), F.concat(F.slice(between, 2, F.greatest(F.size(between), F.lit(1))), F.array(F.lit(""))).alias("next"))
    empty = F.array().cast("array<struct<kind:string,first:int,last:int,value:string,left:string,right:string>>")
    size = lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["hit"]), F.lit(0))

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + F.length(pair["gap"])
        last = first + F.coalesce(F.length(pair["hit"]), F.lit(0))
        own = F.struct(F.lit(kind).alias("kind"), first.alias("first"), last.alias("last"), pair["hit"].alias("value"), F.right(pair["gap"], F.lit(AROUND)).alias("left"), F.left(pair["next"], F.lit(1)).alias("right"))
        return F.struct(last.alias("at"), F.when(pair["hit"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(own))).alias("out"))

    def placed(part: Column, at: Column) -> Column:
        return F.aggregate(part, F.struct(at.alias("at"), empty.alias("out")), step, lambda s: s["out"])

    # an array that grows by one is copied each time: many hits are taken in parts, whose starts come first
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits)) / GO).cast("int")), lambda i: F.slice(pairs, i * GO + 1, F.lit(GO)))
    lengths = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda n, p: n + size(p)))
    starts = F.aggregate(lengths, F.array(F.lit(0)), lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)))
    many = F.flatten(F.transform(F.arrays_zip(parts.alias("part"), F.slice(starts, F.lit(1), F.size(lengths)).alias("at")), lambda z: placed(z["part"], z["at"])))
    return F.when(F.size(hits) == 0, empty).when(F.size(hits) < GO, placed(pairs, F.lit(0))).otherwise(many)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits, every second from the right doubled, add up to a multiple of ten."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when((n - i) % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return (n > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0)


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    digits = digits_of(value)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _checked(kind: str):
    return lambda x: F.struct(x["kind"], x["first"], x["last"], _holds(kind, x["value"]).alias("ok"))


def base_matches(text: Column) -> Column:
    """Matches of all base kinds, by kind as listed and place, and whether they pass their check."""
    found = []
    for kind, pattern in BASE.items():
        need = text.contains(NEEDS[kind]) if len(NEEDS[kind]) == 1 else text.rlike(NEEDS[kind])
        none = F.array().cast("array<struct<kind:string,first:int,last:int,value:string,left:string,right:string>>")
        own = F.when(need, spans(text, pattern, kind)).otherwise(none)
        found.append(F.transform(own, _checked(kind)))
    return F.concat(*found)


def proposals(text: Column) -> Column:
    none = F.array().cast("array<struct<kind:string,first:int,last:int,value:string,left:string,right:string>>")
    return F.concat(*(F.when(text.rlike(r"@|[(\[]at[)\]]" if kind == "address_like" else "[0-9]{2}"), spans(text, p, kind)).otherwise(none) for kind, p in GENERATORS.items()))


def features(value: Column, left: Column, right: Column) -> list[Column]:
    """Numbers about the format of a proposal and what stands around it, as doubles."""
    digits, n = digits_of(value), F.length(value)
    groups = F.filter(F.split(value, "[^0-9]+", -1), lambda x: x != "")
    own = (
        n, F.length(digits), F.length(F.regexp_replace(value, "[^A-Za-z]", "")), F.length(F.regexp_replace(value, r"[A-Za-z0-9+@]", "")), F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), F.length(F.regexp_replace(value, "[^0]", "")), F.length(F.regexp_replace(value, r"[^.]", "")),
        left.rlike(CUES).cast("int"), left.rlike(r"(?:^|[\s(,;:])$").cast("int"), right.rlike(r"^(?:$|[\s),;:.])").cast("int"), F.when(F.length(digits).between(12, 19), luhn(digits).cast("int")).otherwise(0),
        value.rlike(r"@|[(\[]at[)\]]").cast("int"),
    )
    return [c.cast("double").alias(name) for c, name in zip(own, FEATURES, strict=True)]


def overlap(a: Column, b: Column) -> Column:
    return (a["first"] < b["last"]) & (b["first"] < a["last"])


def _tree(node, x: list[str]) -> Column:
    """A fitted tree as nested conditions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(F.col(x[split.featureIndex()]) <= float(split.threshold()), _tree(node.leftChild(), x)).otherwise(_tree(node.rightChild(), x))


def score_of(model: GBTClassificationModel) -> Column:
    """Probability of the boosted trees, as an expression over the feature columns."""
    margin = reduce(lambda a, b: a + b, (F.lit(float(w)) * _tree(t._java_obj.rootNode(), list(FEATURES)) for t, w in zip(model.trees, model.treeWeights, strict=True)))
    return 1 / (1 + F.exp(-2 * margin))


def disguised(kind: Column, value: Column) -> Column:
    """Array of a confirmed value as people disguise it, by its base kind."""
    digits = digits_of(value)
    at = lambda sign: F.replace(value, F.lit("@"), F.lit(sign))
    dot = lambda v, sign: F.regexp_replace(v, r"\.(?=[A-Za-z0-9-]+$)", sign)
    address = F.array(at(" (at) "), at("[at]"), dot(at(" (at) "), " (dot) "), dot(at(" [at] "), " [dot] "))
    phone = F.array(F.replace(value, F.lit("+"), F.lit("")), F.regexp_replace(digits, "^([0-9]{1,2})([0-9]{3})([0-9]{3})", "00$1-$2/$3-"))
    card = F.array(F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1."), F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1/"))
    return F.when(kind == "email", address).when(kind == "phone", phone).when(kind == "card", card).otherwise(F.array().cast("array<string>"))


def _fitted(found: DataFrame, sample: int, precision: float, trees: int, depth: int) -> tuple[Column, float] | None:
    """The score and its cutoff, or none if the sample has proposals of one label only; from (base, failed, proposed)."""
    first = lambda a: F.get(F.filter(a, lambda b: overlap(b, F.struct(F.col("p.first").alias("first"), F.col("p.last").alias("last")))), F.lit(0))["kind"]
    each = found.where(F.size("proposed") > 0).select("base", "failed", F.explode("proposed").alias("p")).select(first("base").alias("yes"), first("failed").alias("no"), "p.value", "p.left", "p.right")
    dated = F.col("value").rlike(DATE)
    kind = F.when(~dated, F.coalesce("yes", "no"))
    each = each.where(dated | F.col("yes").isNotNull() | F.col("no").isNotNull())
    forms = F.concat(F.array("value"), F.coalesce(disguised(kind, F.col("value")), F.array().cast("array<string>")))
    rows = each.select((F.col("yes").isNotNull() & ~dated).cast("double").alias("label"), F.explode(forms).alias("value"), "left", "right")
    rows = rows.groupBy("label", "value", "left", "right").agg(F.count("*").cast("double").alias("weight"))
    rows = rows.withColumn("_h", F.xxhash64("value", "left", "right"))
    rows = cut(rows.select("label", "weight", "_h", "value", F.pmod("_h", F.lit(4)).alias("fold"), *features(F.col("value"), F.col("left"), F.col("right"))))
    chosen = rows.where("fold > 0").orderBy("_h", "value", "label").limit(sample)
    data = cut(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(chosen).select("x", "label", "weight"))
    if len(data.select("label").distinct().collect()) < 2:
        return None
    score = score_of(GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.5, seed=7).fit(data))
    held = rows.where("fold = 0").groupBy(F.round(score, 2).alias("s")).agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("hits")).orderBy(F.desc("s")).collect()
    n = hits = 0
    cutoff = None
    for r in held:  # 101 scores at most
        n, hits = n + r["n"], hits + r["hits"]
        if hits >= precision * n:
            cutoff = r["s"]
    return None if cutoff is None else (score, cutoff)


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, precision: float = PRECISION, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """(id, base, added): for every row of ``docs`` the base spans and those the trees add.

    Spans are (kind, first, last), in code points, last exclusive. A null or empty text has
    none; repeated rows have the same; an empty table gives no rows.
    """
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    slim = lambda a: F.transform(a, lambda x: F.struct(x["kind"], x["first"], x["last"]))
    found = docs.select(F.col(quoted(id_col)).alias("id"), base_matches(text).alias("matches"), proposals(text).alias("proposed"))
    found = cut(found)
    found = found.select("id", slim(F.filter("matches", lambda x: x["ok"])).alias("base"), slim(F.filter("matches", lambda x: ~x["ok"] & F.when(x["kind"] == "card", x["last"] - x["first"] >= 13).otherwise((x["kind"] != "ip") | (x["last"] - x["first"] <= 15)))).alias("failed"), "proposed")
    fitted = _fitted(found, sample, precision, trees, depth)
    none = F.array().cast("array<struct<kind:string,first:int,last:int>>")
    if fitted is None:
        return found.select("id", "base", none.alias("added"))
    score, cutoff = fitted
    free = F.filter("proposed", lambda p: ~F.exists("base", lambda b: overlap(b, p)))
    row = F.monotonically_increasing_id()
    rows = cut(found.select(row.alias("row"), "id", "base", free.alias("free")))
    scored = rows.where(F.size("free") > 0).select("row", F.explode("free").alias("p")).select("row", "p", *features(F.col("p.value"), F.col("p.left"), F.col("p.right"))).select("row", "p", score.alias("s")).where(F.round("s", 2) >= cutoff)
    best = F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("s"), F.col("p.first").alias("first"), F.col("p.last").alias("last"), F.col("p.kind").alias("kind"))))
    chosen = F.aggregate(best, F.array().cast("array<struct<s:double,first:int,last:int,kind:string>>"), lambda out, x: F.when(F.exists(out, lambda y: overlap(x, y)), out).otherwise(F.concat(out, F.array(x))))
    added = scored.groupBy(F.col("row").alias("_row")).agg(F.transform(chosen, lambda x: F.struct(x["kind"], x["first"], x["last"])).alias("added"))
    return rows.join(added, F.col("row") == F.col("_row"), "left").select("id", "base", F.coalesce("added", none).alias("added"))


def redacted(docs: DataFrame, found: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "<{}>") -> DataFrame:
    """``docs`` with each span of its id replaced by its kind; for tables whose ids are unique."""
    every = found.select(F.col("id").alias("_id"), F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x["first"], x["last"], x["kind"]))).alias("_spans"))
    text, before, after = F.col(quoted(text_col)), *mark.split("{}")
    joined = docs.join(every, F.col(quoted(id_col)) == F.col("_id"), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda s, x: F.when(x["first"] < s["at"], s).otherwise(F.struct(x["last"].alias("at"), F.concat(s["out"], F.substring(text, s["at"] + 1, x["first"] - s["at"]), F.lit(before), x["kind"], F.lit(after)).alias("out")))
    whole = F.aggregate(F.coalesce("_spans", F.array().cast("array<struct<first:int,last:int,kind:string>>")), start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return joined.withColumn(text_col, F.when(F.size("_spans") > 0, whole).otherwise(text)).select(*map(quoted, docs.columns))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    kinds = [*BASE, *GENERATORS]
    rank = lambda x: F.array_position(F.array(*map(F.lit, kinds)), x["kind"])
    in_order = lambda a: F.array_sort(F.transform(a, lambda x: F.struct(rank(x).alias("rank"), x["first"], x["last"], x["kind"])))
    as_text = lambda a: F.array_join(F.transform(in_order(a), lambda x: F.concat_ws(":", x["kind"], x["first"].cast("string"), x["last"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("id").alias("doc_id"), *map(count, BASE), F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.concat("base", "added")).alias("spans"))
