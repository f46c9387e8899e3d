"""Regions around insertions, deletions and substitutions, in the wild type and the mutant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residuum.operators.aggregates import feature_aggregates

# Classes without function, analyses by what is known.
NEUTRAL = ("Disorder", "Surface")
FLANK_SIZE = 4


def size_of(kind: Column, left: Column, right: Column, inserted: Column) -> Column:
    """Letters that an insertion adds or a deletion takes; the longer of both for a substitution."""
    letters, places = F.length(F.coalesce(inserted, F.lit(""))), right - left + 1
    return F.when(kind == "ins", letters).when(kind == "del", places).otherwise(F.greatest(letters, places))


def flank_size(size: Column) -> Column:
    """Half the size, up to the next even number."""
    half = F.floor(size / 2).cast("int")
    return half + half % 2


def regions(indels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, region, side, first, last): the changed places and both flanks, in wild type and mutant.

    ``indels`` has (keys, kind, left, right, inserted, terminal_end): kind ``ins``, ``del`` or
    ``sub``; an insertion stands between ``left`` and ``right``, the others cover both. A flank
    beyond the end of the protein that ``terminal_end`` names (left or right) is left out,
    and so are places below 1. Empty regions have no row. The mutant's right flank begins one
    place later after a deletion or substitution, as published.
    """
    kind, left, right = F.col("kind"), F.col("left"), F.col("right")
    n = F.length(F.coalesce("inserted", F.lit("")))
    size = size_of(kind, left, right, F.col("inserted"))
    f = flank_size(size)
    ins, sub = kind == "ins", kind == "sub"
    end = F.coalesce("terminal_end", F.lit(""))
    before = F.when(ins, left + 1).otherwise(left)
    after = F.when(ins, right).otherwise(right + 1)
    mutant_after = F.when(ins, right + size).when(sub, left + n + 1).otherwise(left + 1)
    region = lambda name, side, first, length, ok: F.struct(F.lit(name).alias("region"), F.lit(side).alias("side"), F.greatest(first, F.lit(1)).alias("first"), (first + length - 1).alias("last"), ok.alias("ok"))
    inside_wild = region("inside", "wt", left, right - left + 1, ~ins)
    inside_mutant = region("inside", "mut", F.when(ins, left + 1).otherwise(left), n, ins | sub)
    flanks = [region("left flank", s, before - f, f, end != "left") for s in ("wt", "mut")] + [region("right flank", "wt", after, f, end != "right"), region("right flank", "mut", mutant_after, f, end != "right")]
    each = indels.select(*keys, F.explode(F.array(inside_wild, inside_mutant, *flanks)).alias("x")).where("x.ok AND x.last >= x.first")
    return each.select(*keys, "x.region", "x.side", "x.first", "x.last")


def region_features(indels: DataFrame, positions: DataFrame, keys: list[str], features: dict[str, str]) -> DataFrame:
    """(keys, region, side, n, features): features of the places of each region, every place with weight one.

    ``indels`` names its proteins ``wt`` and ``mut``; ``positions`` has (protein, position,
    features). A region is as long as the change, so its places are rows of an equal join.
    """
    each = regions(indels, [*keys, "wt", "mut"])
    places = each.select(*keys, "region", "side", F.when(F.col("side") == "wt", F.col("wt")).otherwise(F.col("mut")).alias("protein"), F.explode(F.sequence("first", "last")).alias("position"))
    rows = places.join(positions, ["protein", "position"]).withColumns({"quality": F.lit(1.0), "coverage": F.lit(1.0)})
    return rows.groupBy(*keys, "region", "side").agg(F.count("*").alias("n"), *feature_aggregates(features))


def flank_outcomes(indels: DataFrame, positions: DataFrame, keys: list[str], *, size: int = FLANK_SIZE, neutral: tuple[str, ...] = NEUTRAL) -> DataFrame:
    """(keys, left_class, right_class, outcome): most frequent class of the ``size`` places up to the left flank and from the right one on, and what they make together.

    Null classes do not count; of equally frequent ones the greatest stands. Outcomes:
    identical or a transition, of neutral or potent classes; null if a side has no class.
    """
    sides = F.array(F.struct(F.lit("l").alias("s"), F.greatest(F.col("left") - size + 1, F.lit(1)).alias("first"), F.col("left").alias("last")), F.struct(F.lit("r").alias("s"), F.col("right").alias("first"), (F.col("right") + size - 1).alias("last")))
    places = indels.select(*keys, F.col("wt").alias("protein"), F.explode(sides).alias("x")).where("x.last >= x.first").select(*keys, "protein", "x.s", F.explode(F.sequence("x.first", "x.last")).alias("position"))
    counts = places.join(positions.where("class IS NOT NULL"), ["protein", "position"]).groupBy(*keys, "s", "class").agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys, "s").agg(F.max_by("class", F.struct("n", "class")).alias("c"))
    both = best.groupBy(*keys).agg(F.max(F.when(F.col("s") == "l", F.col("c"))).alias("left_class"), F.max(F.when(F.col("s") == "r", F.col("c"))).alias("right_class"))
    found = indels.select(*keys).join(both, keys, "left")
    is_neutral = lambda c: F.col(c).isin(*neutral)
    same = F.when(is_neutral("left_class"), "Identical neutral").otherwise("Identical potent")
    differs = F.when(is_neutral("left_class") & is_neutral("right_class"), "Transition neutral,neutral").when(~is_neutral("left_class") & ~is_neutral("right_class"), "Transition potent,potent").otherwise("Transition neutral,potent")
    return found.withColumn("outcome", F.when(F.col("left_class").isNotNull() & F.col("right_class").isNotNull(), F.when(F.col("left_class") == F.col("right_class"), same).otherwise(differs)))


def analyses(kind: Column | str, terminal: Column | str, n_wt: Column | str, n_mut: Column | str) -> Column:
    """Which analyses structures of the wild type and the mutant allow: region of the flanks (FRA, at an end FRC), inclusion (InCl), comparison of flanks and inserts (CFRI), and of flanks across both (CFRA)."""
    kind, terminal, n_wt, n_mut = (F.col(x) if isinstance(x, str) else x for x in (kind, terminal, n_wt, n_mut))
    first = F.when(terminal, "FRC").otherwise("FRA")
    most, all_ = F.array(first, F.lit("InCl"), F.lit("CFRI")), F.array(first, F.lit("InCl"), F.lit("CFRI"), F.lit("CFRA"))
    return (
        F.when((n_wt == 0) & (n_mut == 0), F.array().cast("array<string>"))
        .when(n_mut == 0, F.when(kind == "ins", F.array(first)).otherwise(most))
        .when(n_wt == 0, F.when(kind == "del", F.array(first)).otherwise(most))
        .otherwise(all_)
    )


def insertion_score(inserted: Column, left_factor: Column, right_factor: Column) -> Column:
    """Root of the inserted length times the mean of the flanks' factors; a flank beyond the end counts as zero."""
    return F.sqrt(F.length(inserted)) * 0.5 * (F.coalesce(left_factor, F.lit(0.0)) + F.coalesce(right_factor, F.lit(0.0)))


def delta_classes(annotated: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, delta): places whose class in the model is not that of the annotation (keys, position, class); an unmapped place counts, two unknown classes are equal."""
    other = model.select(*keys, "position", F.col("class").alias("_class"), F.lit(True).alias("_mapped"))
    joined = annotated.join(other, [*keys, "position"], "left")
    differs = F.col("_mapped").isNull() | ~F.col("class").eqNullSafe(F.col("_class"))
    return joined.groupBy(*keys).agg(F.sum(differs.cast("long")).alias("delta"))


def delta_delta(annotated: DataFrame, wild: DataFrame, mutant: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, wt_delta, mut_delta, delta_delta): how much more the mutant's model differs from the annotation than the wild type's."""
    a, b = delta_classes(annotated, wild, keys).withColumnRenamed("delta", "wt_delta"), delta_classes(annotated, mutant, keys).withColumnRenamed("delta", "mut_delta")
    return a.join(b, keys).withColumn("delta_delta", F.col("mut_delta") - F.col("wt_delta"))
