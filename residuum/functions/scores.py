"""Scores and classes of positions, as Column expressions.

Thresholds, weights and factors below are fixed values: results depend on them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SURFACE_ABOVE, BURIED_ABOVE = 0.16, 0.05
RESOLUTION_WEIGHT, COVERAGE_WEIGHT, IDENTITY_WEIGHT = 0.25, 0.5, 1.0
MISSING_RESOLUTION = 3.0
LONG_DISTANCE = 8.0
CLASH_BELOW, NO_PARTNER = 1.2, 2.0
TYPE_FACTOR = {"substitution": 0.5, "deletion": 1.0}
FUNCTION_FACTOR = {
    "Protein interaction": 1.0,
    "DNA interaction": 1.0,
    "RNA interaction": 1.0,
    "ligand interaction": 0.5,
    "Peptide interaction": 0.5,
    "metal interaction": 0.2,
    "ion interaction": 0.2,
    "Surface": 0.0,
    "Buried": 0.4,
    "Core": 0.8,
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def locate(rsa: Column | str, *, binary: bool = False, surface: float = SURFACE_ABOVE, buried: float = BURIED_ABOVE) -> Column:
    """Exposure class of a relative surface area: Surface, Buried or Core; null of null.

    ``binary`` tells only Surface from Core.
    """
    rsa = col(rsa)
    inner = F.lit("Core") if binary else F.when(rsa > buried, "Buried").otherwise("Core")
    return F.when(rsa.isNull(), None).when(rsa > surface, "Surface").otherwise(inner)


def triple_locate(rsa: Column | str, main_chain: Column | str, side_chain: Column | str, **options) -> Column:
    """Exposure classes of the whole residue, its main chain and its side chain, as a struct."""
    return F.struct(locate(rsa, **options).alias("location"), locate(main_chain, **options).alias("main_chain"), locate(side_chain, **options).alias("side_chain"))


def classify(interaction_class: Column | str, location: Column | str) -> Column:
    """The interaction class, or the exposure class where there is no interaction."""
    own = col(interaction_class)
    return F.when(own.isNull() | (own == "No interaction"), col(location)).otherwise(own)


def rescaled(share: Column | str) -> Column:
    """Percentages above one become shares."""
    share = col(share)
    return F.when(share > 1.0, share / 100.0).otherwise(share)


def quality(resolution: Column | str, coverage: Column | str, identity: Column | str, plddt: Column | str | None = None) -> Column:
    """Quality of a structure for a protein: logistic in resolution and identity, linear in coverage.

    A missing resolution counts as 3.0; a model's confidence, scaled to at most one, multiplies.
    """
    r = F.coalesce(col(resolution), F.lit(MISSING_RESOLUTION))
    by_resolution = 1 / (1 + F.exp(1.5 * r - 4))
    by_identity = 1 / (1 + F.exp(10 * (0.4 - rescaled(identity))))
    total = RESOLUTION_WEIGHT + COVERAGE_WEIGHT + IDENTITY_WEIGHT
    mixed = (by_resolution * RESOLUTION_WEIGHT + rescaled(coverage) * COVERAGE_WEIGHT + by_identity * IDENTITY_WEIGHT) / total
    return mixed if plddt is None else mixed * F.coalesce(rescaled(plddt), F.lit(1.0))


def is_usable_template(identity: Column | str, resolution: Column | str, *, least_identity: float = 35.0, most_resolution: float = 4.5) -> Column:
    """Identity in percent (shares are rescaled) and resolution within limits; null resolution fails."""
    own = col(identity)
    percent = F.when(own <= 1.0, own * 100.0).otherwise(own)
    return (percent >= least_identity) & F.coalesce(col(resolution) <= most_resolution, F.lit(False))


def is_usable_hit(aligned: Column | str, query_length: Column | str, identity: Column | str, *, threshold: float = 0.35) -> Column:
    """A short alignment counts only for a short query at twice the identity threshold."""
    return (col(identity) >= threshold) & ((col(aligned) >= 50) | ((col(query_length) < 100) & (col(identity) >= 2 * threshold)))


def structure_kind(structure_id: Column | str) -> Column:
    """Kind of a structure identifier by its shape."""
    s = col(structure_id)
    return F.when(F.length(s) == 4, "entry").when(s.endswith("_AU"), "asymmetric unit").when(s.startswith("AF-"), "model").when(s.endswith("pdb.gz"), "file").when(s.contains("__"), "custom").otherwise("other")


def does_not_clash(*distances: Column | str) -> Column:
    """The nearest partner is not closer than a clash; without any partner there is none."""
    nearest = F.least(*map(col, distances)) if len(distances) > 1 else col(distances[0])
    return F.coalesce(nearest, F.lit(NO_PARTNER)) >= CLASH_BELOW


def lookup(table: dict[str, float], key: Column | str, default: float | None = None) -> Column:
    """Value of a small fixed table."""
    out = F.lit(default).cast("double")
    for name, value in table.items():
        out = F.when(col(key) == name, F.lit(value)).otherwise(out)
    return out


def position_score(mutation: Column | str, function: Column | str) -> Column:
    """Type factor times function factor."""
    return lookup(TYPE_FACTOR, mutation) * lookup(FUNCTION_FACTOR, function, 0.0)


def candidate_score(ligand_distance: Column | str, chain_distance: Column | str, *, ligand_weight: float = 1.0, chain_weight: float = 1.0, similarity: Column | str | None = None) -> Column:
    """Logistic of the distances to the nearest ligand and chain, mixed by weight, and optionally
    with a substitution score; a missing distance adds nothing."""
    near = lambda d: F.coalesce(1 / (1 + F.exp(col(d) - 10)), F.lit(0.0))
    mixed = (near(ligand_distance) * ligand_weight + near(chain_distance) * chain_weight) / (ligand_weight + chain_weight)
    return mixed if similarity is None else mixed * 1 / (1 + F.exp(-0.25 * col(similarity)))


def change_score(core: Column | str, surface: Column | str) -> Column:
    """Share of core among core and surface observations; null without any."""
    core, surface = col(core), col(surface)
    return F.when(core + surface > 0, core / (core + surface))


def distance(a: list[Column | str], b: list[Column | str]) -> Column:
    return F.sqrt(sum(((col(x) - col(y)) ** 2 for x, y in zip(a, b, strict=True)), F.lit(0.0)))


def sphere_volume(r: Column | str) -> Column:
    return F.lit(4.0 / 3.0) * F.pi() * col(r) ** 3


def sphere_overlap(r1: Column | str, r2: Column | str, d: Column | str) -> Column:
    """Volume that two spheres at distance d share."""
    r1, r2, d = col(r1), col(r2), col(d)
    lens = F.pi() * (r1 + r2 - d) ** 2 * (d**2 + 2 * d * r2 - 3 * r2**2 + 2 * d * r1 + 6 * r1 * r2 - 3 * r1**2) / (12 * d)
    return F.when(d >= r1 + r2, 0.0).when(d <= F.abs(r1 - r2), sphere_volume(F.least(r1, r2))).otherwise(lens)


def packed_profile(profile: Column | str) -> Column:
    """``A_12:3_4.5,...`` as a map from (chain, residue) to (degree, score)."""
    pairs = F.filter(F.split(col(profile), ","), lambda x: x.contains(":"))
    part = lambda x, i, j: F.get(F.split(F.get(F.split(x, ":"), F.lit(i)), "_"), F.lit(j))
    key = lambda x: F.struct(part(x, 0, 0).alias("chain"), part(x, 0, 1).alias("residue"))
    value = lambda x: F.struct(part(x, 1, 0).cast("int").alias("degree"), part(x, 1, 1).cast("double").alias("score"))
    return F.map_from_arrays(F.transform(pairs, key), F.transform(pairs, value))


def profile_text(profile: Column | str) -> Column:
    """The inverse of ``packed_profile``, in order of chain and residue."""
    entries = F.array_sort(F.map_entries(col(profile)))
    text = lambda e: F.format_string("%s_%s:%d_%s", e["key"]["chain"], e["key"]["residue"], e["value"]["degree"], e["value"]["score"].cast("string"))
    return F.array_join(F.transform(entries, text), ",")
