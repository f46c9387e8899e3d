"""Aggregates over the structures that cover a position, as aggregate Columns.

Every one works in a ``groupBy(...).agg(...)`` with partial sums before the shuffle, except
the medians, which Spark gathers for each group.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from residuum.functions.scores import LONG_DISTANCE, col, locate


def weight_of(quality: Column | str, coverage: Column | str | None = None, power: int = 0) -> Column:
    """Quality times a power of the coverage; exposure features take the square."""
    return col(quality) if not power or coverage is None else col(quality) * col(coverage) ** power


def exact_sum(value: Column | str) -> Column:
    """Sum as a double that is the same in any order of the rows, so that equal sums are ties.

    It is taken over decimals of 18 places. Where a value or the sum is too large for them, or
    no number, it is the plain sum.
    """
    value = col(value)
    exact = value.try_cast("decimal(38,18)")
    return F.coalesce(F.when(F.count(exact) == F.count(value), F.try_sum(exact).cast("double")), F.sum(value).cast("double"))


def weighted_mean(value: Column | str, weight: Column | str, *, most: float | None = None) -> Column:
    """Mean by weight of the values that are not null (nor above ``most``); null without weight."""
    value, weight = col(value), col(weight)
    ok = value.isNotNull() if most is None else value <= most
    total = F.sum(F.when(ok, weight))
    return F.when(total > 0, F.sum(F.when(ok, value * weight)) / total)


def confidence(value: Column | str, weight: Column | str, *, most: float | None = None) -> Column:
    """(1 - 1 / (n + 1)) (max + median of the weights) / 2 over the values that count; 0 if none."""
    value, weight = col(value), col(weight)
    ok = value.isNotNull() if most is None else value <= most
    own = F.when(ok, weight)
    n = F.count(own)
    return F.when(F.sum(own) > 0, (1 - 1 / (n + 1)) * (F.max(own) + F.median(own)) / 2).otherwise(0.0)


def weighted_distance(value: Column | str, weight: Column | str) -> Column:
    """Weighted mean of distances; those beyond the long-distance threshold do not count."""
    return weighted_mean(value, weight, most=LONG_DISTANCE)


def propensity(value: Column | str) -> Column:
    """Share of rows with a value."""
    return F.count(col(value)) / F.count(F.lit(1))


def bool_propensity(value: Column | str) -> Column:
    """Share of rows where the value is true; nulls are in the denominator."""
    return F.sum(F.when(col(value), 1).otherwise(0)) / F.count(F.lit(1))


def weighted_majority(rows: DataFrame, keys: list[str], value: str, weight: str, out: str = "majority", *, last: bool = False) -> DataFrame:
    """The value with the largest sum of weights in each group; null is a value too.

    Without weight above zero the result is null. Of ties the least value wins, or the
    greatest if ``last``; null comes before all others.
    """
    sums = rows.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    order = F.struct("_w", F.col(value)) if last else F.struct("_w", F.col(value).isNull(), F.col("_n"))
    if not last:
        sums = sums.withColumn("_n", -F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_first())))
    best = sums.groupBy(*keys).agg(F.max_by(value, order).alias(out), F.max("_w").alias("_top"))
    return best.select(*keys, F.when(F.col("_top") > 0, F.col(out)).alias(out))


def exposure_change(rsa: Column | str) -> Column:
    """Share of buried or core among the exposure classes of a group; null if none is known."""
    place = locate(rsa)
    surface = F.sum(F.when(place == "Surface", 1).otherwise(0))
    core = F.sum(F.when(place.isin("Core", "Buried"), 1).otherwise(0))
    return F.when(core + surface > 0, core / (core + surface))


def spread(value: Column | str) -> Column:
    """Sample standard deviation; 0 of one value, null of none."""
    value = col(value)
    return F.when(F.count(value) == 1, 0.0).otherwise(F.stddev_samp(value))


def profile_mean(rows: DataFrame, keys: list[str], structure: str, weight: str, cells: list[str], values: list[str]) -> DataFrame:
    """Weighted mean of each cell of the interaction profiles of a group.

    A structure without a row for a cell counts there with zero, so the denominator is the
    sum of weights over the group's structures, not over the cell's rows.
    """
    total = rows.select(*keys, structure, weight).distinct().groupBy(*keys).agg(F.sum(weight).alias("_total"))
    sums = rows.groupBy(*keys, *cells).agg(*(F.sum(F.col(v) * F.col(weight)).alias(v) for v in values))
    return sums.join(total, keys).select(*keys, *cells, *((F.col(v) / F.col("_total")).alias(v) for v in values))


def centrality_mean(value: Column | str, weight: Column | str, has_row: Column) -> Column:
    """Weighted mean whose denominator has every row with centralities, also where this one is null."""
    return F.sum(F.when(has_row, F.coalesce(col(value), F.lit(0.0)) * col(weight))) / F.sum(F.when(has_row, col(weight)))


#: Aggregates by kind of feature; the registry names a kind for each feature.
def feature_aggregates(features: dict[str, str], quality: str = "quality", coverage: str = "coverage") -> list[Column]:
    """Aggregate Columns for features given by name and kind.

    Kinds: distance, number, probability, flag, exposure.
    """
    squared = weight_of(quality, coverage, 2)
    make = {
        "distance": lambda f: weighted_distance(f, quality),
        "number": lambda f: weighted_mean(f, quality),
        "probability": propensity,
        "flag": bool_propensity,
        "exposure": lambda f: weighted_mean(f, squared),
    }
    return [make[kind](name).alias(name) for name, kind in features.items()]


def recommend(rows: DataFrame, keys: list[str], *, same_letter: str, same_class: str, quality: str, order: Iterable[str]) -> DataFrame:
    """Every row with its ``tier`` and its ``preference`` within its group, 1 for the recommended.

    Tiers: same letter and class, same class, same letter, any. Within a tier the better
    quality comes first, a null one counts as zero, then the greater of ``order``.
    """
    tier = F.when(F.col(same_letter) & F.col(same_class), 1).when(F.col(same_class), 2).when(F.col(same_letter), 3).otherwise(4)
    ranked = Window.partitionBy(*keys).orderBy("tier", F.coalesce(F.col(quality), F.lit(0.0)).desc(), *(F.col(c).desc() for c in order))
    return rows.withColumn("tier", tier).withColumn("preference", F.row_number().over(ranked))


def average_rank(rows: DataFrame, keys: list[str], value: str, out: str = "rank") -> DataFrame:
    """Descending rank in the group, equal values sharing the mean of their places."""
    place = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(value).desc()))
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, value))
    return rows.withColumn(out, place + (ties - 1) / 2.0)


def consensus_rank(rows: DataFrame, group: str, position: str, template: str, label: str) -> DataFrame:
    """Templates of a group by how many of its positions they label as most others do.

    A position has a consensus if its top label is more frequent than one over the number of
    its labels; of equally frequent labels the least is on top.
    """
    each = rows.groupBy(group, position, template, label).agg(F.count("*").alias("_n"))  # the rows are read and shuffled once
    by_label = Window.partitionBy(group, position, label)
    ranked = each.withColumn("_c", F.when(F.col(label).isNotNull(), F.sum("_n").over(by_label)))
    own = Window.partitionBy(group, position)
    kinds = F.size(F.collect_set(label).over(own))
    whole = F.sum(F.when(F.col(label).isNotNull(), F.col("_n"))).over(own)
    best = F.min(F.when(F.col(label).isNotNull(), F.struct(-F.col("_c"), F.col(label).alias("_l")))).over(own)
    judged = ranked.withColumns({"_kinds": kinds, "_all": whole, "_best": best})
    agreed = judged.withColumn("_top", F.max("_c").over(own)).where(F.col("_top") / F.col("_all") > 1 / F.col("_kinds"))
    score = agreed.groupBy(group, template).agg(F.sum(F.when(F.col(label) == F.col("_best._l"), F.col("_n")).otherwise(0)).alias("score"))
    return average_rank(score, [group], "score")


def count_mode(rows: DataFrame, keys: list[str], value: Column, out: str = "mode") -> DataFrame:
    """Most frequent value of a group, the least of ties."""
    counts = rows.groupBy(*keys, value.alias("_v")).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).alias(out))


def histogram(rows: DataFrame, keys: list[str], value: str, bins: int = 50) -> DataFrame:
    """Equal bins over the range of all values; the greatest value is outside of the last bin.

    The range is one row, which is broadcast; there are no bins without one.
    """
    span = rows.agg(F.min(value).alias("_low"), F.max(value).alias("_high")).where("_high > _low")
    place = F.floor((F.col(value) - F.col("_low")) / ((F.col("_high") - F.col("_low")) / bins)).cast("int")
    return rows.where(F.col(value).isNotNull()).join(F.broadcast(span)).groupBy(*keys, place.alias("bin")).agg(F.count("*").alias("n")).where(F.col("bin") < bins)


def shares(rows: DataFrame, tag: str, label: str, labels: list[str]) -> DataFrame:
    """Distribution of labels for every tag and for all rows, as shares of the tag's rows."""
    each = rows.select(F.explode(F.array(F.lit("total"), F.col(tag))).alias("tag"), label)
    counts = [F.sum((F.col(label) == x).cast("long")) / F.count("*") for x in labels]
    return each.groupBy("tag").agg(F.count("*").alias("n"), *(c.alias(x) for c, x in zip(counts, labels, strict=True)))


# The features of a structure's residue by how they are put together over all structures.
STRUCTURAL = {
    **dict.fromkeys(("lig_dist", "metal_dist", "ion_dist", "chain_dist", "rna_dist", "dna_dist", "homo_dist"), "distance"),
    **dict.fromkeys((
        "b_factor", "pLDDT", "phi", "psi", "ssbond_length", "link_length", "inter_chain_median_kd", "inter_chain_dist_weighted_kd", "inter_chain_median_rsa", "inter_chain_dist_weighted_rsa", "intra_chain_median_kd",
        "intra_chain_dist_weighted_kd", "intra_chain_median_rsa", "intra_chain_dist_weighted_rsa", "inter_chain_interactions_median", "inter_chain_interactions_dist_weighted", "intra_chain_interactions_median", "intra_chain_interactions_dist_weighted"), "number"),
    **dict.fromkeys(("modres", "cis_conformation", "cis_follower"), "probability"),
    **dict.fromkeys(("intra_ssbond", "inter_ssbond", "intra_link", "inter_link"), "flag"),
    **dict.fromkeys(("surface_value", "mainchain_surface_value", "sidechain_surface_value"), "exposure"),
    "ssa": "category",
}


def structural_features(rows: DataFrame, keys: list[str], features: dict[str, str] = STRUCTURAL, *, quality: str = "quality", coverage: str = "coverage") -> DataFrame:
    """(keys, features): every feature of the residues of a group by its kind, in one aggregate; categories, by majority of the quality, in one more each."""
    plain = {name: kind for name, kind in features.items() if kind != "category"}
    found = rows.groupBy(*keys).agg(*feature_aggregates(plain, quality, coverage))
    for name, kind in features.items():
        if kind == "category":
            found = found.join(weighted_majority(rows, keys, name, quality, name), keys, "left")
    return found.select(*keys, *features)


# Least shares of equal letters in a pocket and in the whole sequence that make a class.
SITE_CLASSES, FULL_CLASSES = (0.99, 0.7), (0.9, 0.5)
POCKET_VALUES = ("bb_rmsd", "all_rmsd", "n_site", "site_lddt")


def pocket_strata(hits: DataFrame, keys: list[str], *, sites: tuple[float, float] = SITE_CLASSES, full: tuple[float, float] = FULL_CLASSES, values: tuple[str, ...] = POCKET_VALUES) -> DataFrame:
    """(keys, stratum_value ...): means of the values of pocket hits (query, hit, site_identity, identity, values) in seventeen strata, in one pass.

    ``alike`` and ``unlike`` weigh all hits by identity, or by the lack of it; the others are
    plain means over classes of the sequence (``seq_high``, ``seq_middle``, ``seq_low``), of
    the site, and of both. Hits of the query's own structure do not count; an empty stratum is null.
    """
    site, seq = F.col("site_identity"), F.col("identity")
    band = lambda x, limits: {"high": x >= limits[0], "middle": (x < limits[0]) & (x >= limits[1]), "low": x < limits[1]}
    one = F.lit(1.0)
    strata = {"alike": (F.lit(True), site * seq), "unlike": (F.lit(True), (1.5 - site) * (1.5 - seq))}
    strata |= {f"seq_{k}": (c, one) for k, c in band(seq, full).items()} | {f"site_{k}": (c, one) for k, c in band(site, sites).items()}
    strata |= {f"seq_{k}_site_{m}": (c & d, one) for k, c in band(seq, full).items() for m, d in band(site, sites).items()}
    mean = lambda v, c, w: F.sum(F.when(c, F.col(v) * w)) / F.nullif(F.sum(F.when(c & F.col(v).isNotNull(), w)), F.lit(0.0))
    return hits.where(F.col("query") != F.col("hit")).groupBy(*keys).agg(*(mean(v, c, w).alias(f"{name}_{v}") for name, (c, w) in strata.items() for v in values))
