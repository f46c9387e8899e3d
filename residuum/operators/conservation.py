"""Conservation of the columns of an alignment: symbol diversity, chemistry and gaps.

The score of a column is (1 - t)**a (1 - r)**b (1 - g)**c (Valdar 2002): t is the entropy of
its symbols weighted by how unusual their sequences are, r how far its kinds of symbols are
from each other in a substitution matrix, g the share of gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Symbols in their order, the last being the gap; exponents.
SYMBOLS = "ARNDCQEGHILKMFPSTWYVBZX-"
ENTROPY, CHEMISTRY, GAPS = 1.0, 0.5, 2.0


def columns_of(alignments: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """(keys, member, more, place, symbol) of aligned sequences (keys, member, aligned, more); J counts as L, places from 1."""
    letters = F.split(F.upper("aligned"), "")
    rows = alignments.select(*keys, "member", *more, F.posexplode(letters).alias("place", "symbol")).where("symbol <> ''")
    return rows.select(*keys, "member", *more, (F.col("place") + 1).alias("place"), F.when(F.col("symbol") == "J", "L").otherwise(F.col("symbol")).alias("symbol"))


def sequence_weights(cells: DataFrame, counts: DataFrame, keys: list[str], member: str = "member") -> DataFrame:
    """(keys, member, w): mean over the columns of one over (kinds of symbols there times how many have the member's)."""
    kinds = counts.groupBy(*keys, "place").agg(F.count("*").alias("kinds"))
    each = cells.join(counts.join(kinds.hint("merge"), [*keys, "place"]).hint("merge"), [*keys, "place", "symbol"], "left")
    return each.groupBy(*keys, member).agg((F.sum(F.coalesce(1 / (F.col("kinds") * F.col("n")), F.lit(0.0))) / F.count("*")).alias("w"))


def conservation(alignments: DataFrame, matrix: DataFrame, keys: list[str], *, symbols: str = SYMBOLS, exponents: tuple[float, float, float] = (ENTROPY, CHEMISTRY, GAPS)) -> DataFrame:
    """(keys, place, n, t, r, g, score) of every column of aligned sequences (keys, member, aligned).

    ``matrix`` has (symbol, row): the scores of each of ``symbols`` with all of them in this
    order, as many rows as symbols, so it is broadcast. Other symbols count as members, not as
    kinds. With one sequence the entropy is 0, and so is the chemistry of a column of one kind.

    Equal sequences of a group weigh alike, so their letters are looked at once. Letters are
    many more than the bytes of their table tell: they are joined by a sort of both sides, and
    never sent to the driver for a broadcast.
    """
    each = alignments.groupBy(*keys, F.col("aligned")).agg(F.count("*").alias("times")).select(*keys, "aligned", F.sha2("aligned", 256).alias("member"), "times")
    cells = columns_of(each, keys, "times")
    known = cells.where(F.col("symbol").isin(*symbols))
    counts = known.groupBy(*keys, "place", "symbol").agg(F.sum("times").alias("n"))
    weights = sequence_weights(cells, counts, keys)
    shares = known.join(weights.hint("merge"), [*keys, "member"]).groupBy(*keys, "place", "symbol").agg(F.sum(F.col("w") * F.col("times")).alias("p"))
    members = alignments.select(*keys, "member").distinct().groupBy(*keys).agg(F.count("*").alias("n"))
    entropy = shares.groupBy(*keys, "place").agg(F.sum(F.col("p") * F.log2("p")).alias("h"))
    sets = counts.join(F.broadcast(matrix), "symbol").groupBy(*keys, "place").agg(F.array_sort(F.collect_list(F.struct("symbol", "row"))).alias("rows"), F.sum(F.when(F.col("symbol") == symbols[-1], F.col("n")).otherwise(0)).alias("gaps"))
    k, width = F.size("rows"), len(symbols)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    total = F.aggregate("rows", F.array(*[F.lit(0.0)] * width), lambda s, x: add(s, x["row"]))
    sets = sets.withColumn("mean", F.transform(total, lambda x: x / F.size("rows")))
    apart = lambda row: F.sqrt(F.aggregate(F.zip_with("mean", row, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))
    sum_apart = F.aggregate("rows", F.lit(0.0), lambda s, x: s + apart(x["row"]))
    span = F.array_max(F.transform("rows", lambda x: F.array_max(x["row"]))) - F.array_min(F.transform("rows", lambda x: F.array_min(x["row"])))
    sets = sets.withColumn("r", F.coalesce(sum_apart / F.nullif(k * F.sqrt(F.lit(20.0)) * span, F.lit(0.0)), F.lit(0.0)))
    found = sets.join(entropy.hint("merge"), [*keys, "place"]).join(members.hint("merge"), keys)
    most = F.log2(F.least(F.col("n"), F.lit(width)))
    t, g = F.when(most > 0, 0.0 - F.col("h") / most).otherwise(0.0), F.col("gaps") / F.col("n")
    a, b, c = exponents
    found = found.withColumns({"t": t, "g": g})
    positive = lambda x: F.greatest(1 - F.col(x), F.lit(0.0))
    return found.select(*keys, "place", "n", "t", "r", "g", (positive("t") ** a * positive("r") ** b * positive("g") ** c).alias("score"))


def of_sequence(scores: DataFrame, alignments: DataFrame, keys: list[str], gap: str = SYMBOLS[-1]) -> DataFrame:
    """(keys, member, position, score): the scores of the columns where a member has no gap, numbered by its own places. A member's letters
    are numbered within its row, where it meets the scores of its alignment as one array: the
    exploded letters are neither joined nor sorted.
    """
    spans = scores.groupBy(*keys).agg(F.max("place").alias("_m")).select(*keys, F.explode(F.sequence(F.lit(1), F.col("_m"))).alias("place"))
    dense = spans.join(scores.select(*keys, "place", "score", F.lit(True).alias("known")).hint("merge"), [*keys, "place"], "left")
    arrays = dense.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "known", "score"))), lambda x: F.struct(x["known"].alias("known"), x["score"].alias("score"))).alias("_scores"))
    letters = F.transform(F.split(F.upper("aligned"), ""), lambda s, i: F.struct(s.alias("symbol"), i.alias("i")))
    own = F.filter(letters, lambda x: (x["symbol"] != "") & (x["symbol"] != gap))
    rows = alignments.join(arrays.hint("merge"), keys).select(*keys, "member", "_scores", F.posexplode(own).alias("_p", "_x"))
    found = rows.select(*keys, "member", (F.col("_p") + 1).alias("position"), F.get("_scores", F.col("_x.i")).alias("_s"))
    return found.where("_s.known").select(*keys, "member", "position", "_s.score")
