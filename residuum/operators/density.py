"""Contact density: what share of the space around a residue or atom its neighbours leave free.

A sphere, or a cone of it around the direction of the side chain, is compared with the
volumes that the spheres of neighbours share with it. Neighbours come from a join on equal
cubes of space within a structure, so the work grows with the atoms, not with their pairs.
"""

from __future__ import annotations

from math import pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from residuum.functions.scores import col, sphere_overlap
from residuum.operators.joins import within

# Radii of atoms by the first letter of their name, and of residues (in Å).
ATOM_RADIUS = {"C": 1.7, "O": 1.52, "N": 1.55, "F": 1.47, "P": 1.8, "S": 1.8, "X": 1.7, "A": 1.85, "I": 1.98, "B": 1.85, "R": 2.0, "V": 1.53}
RESIDUE_RADIUS = {
    "CYS": 3.029584442714009, "SEC": 3.029584442714009, "ILE": 3.3236043438778844, "SER": 2.942862799880502, "GLN": 3.392265173640708, "GLX": 3.392265173640708, "LYS": 3.4323769248759275,
    "TRP": 4.020778501571494, "PRO": 3.1681967871564782, "THR": 3.1209640826827605, "PHE": 3.7193696421024685, "ALA": 2.8009640812798096, "GLY": 2.5743877263600927, "HIS": 3.534660601593296,
    "ASN": 3.2435252870320834, "LEU": 3.3236043438778844, "ARG": 3.631344304999469, "ASP": 3.236792124221129, "ASX": 3.236792124221129, "VAL": 3.1681967871564782, "GLU": 3.3861111330098956,
    "TYR": 3.8021338661518342, "MET": 3.351107764635289, "UNK": 3.23342916549,
}
# Mean centroid of the side chain, seen from the alpha atom in the frame of its neighbours.
SIDE_CENTROID = {
    "ILE": (-0.90613294951389123, -1.2696649328274769, 0.75787678394555402), "GLN": (-1.2338776755913703, -1.6271318863182545, 0.98235396198659397), "GLY": (-0.0047299661865784631, -0.0088845691075302401, 9.8567539791531887e-05),
    "GLU": (-1.2149070583116599, -1.5273224890561412, 1.0878295037481032), "CYS": (-0.58968190337597537, -0.89958163307781258, 0.62776825003201231), "HIS": (-0.9776890826599115, -1.6575223413455686, 0.78038430859923047),
    "SER": (-0.59170713881015236, -0.65044117400421442, 0.79631448621746626), "LYS": (-1.4201311703581181, -1.8190188812624906, 1.0949225828431293), "PRO": (0.21186055970214385, -0.81932530473289122, 1.0393498184079177),
    "SEC": (-0.83941591976390406, -0.71433578942505138, 0.85735910033472262), "ASN": (-0.84857508137952831, -1.3074529598975138, 0.7776964830504921), "VAL": (-0.79991957561390237, -0.94684856115170413, 0.62104228622222646),
    "THR": (-0.65195583478889552, -0.90724937534582129, 0.82850637927897564), "ASP": (-0.90583763237409776, -1.1848068294814498, 0.82225350991223289), "TRP": (-1.528171801920162, -1.7410619994461729, 0.89554186538385805),
    "UNK": (-0.3674831972563582, -0.32646621880413212, 0.49726141188550765), "PHE": (-1.1835851942281017, -1.7644149833489573, 0.692845774001975), "ALA": (-0.40699060927186675, -0.36885898636123338, 0.49092580988001461),
    "MET": (-1.1860699223797722, -1.5396420763646954, 0.84853591931547168), "LEU": (-1.0557131262899473, -1.4510720809764079, 0.67350078632184163), "ARG": (-1.7179619489063336, -2.0937800414713896, 1.3885442733060744),
    "TYR": (-1.2761868751958905, -1.9287097734708729, 0.69640859762760676),
}
# Range and least cosine of the cone where only alpha atoms are known, and where all atoms are.
ALPHA_RANGE = {"CYS": 7.25, "ASP": 7.25, "SER": 7.0, "VAL": 7.5, "GLN": 7.75, "LYS": 8.0, "PRO": 7.5, "THR": 7.0, "PHE": 8.25, "ALA": 7.0, "HIS": 8.0, "GLY": 6.75, "ILE": 7.75, "GLU": 7.5, "LEU": 7.75, "ARG": 8.5, "TRP": 9.0, "ASN": 7.25, "TYR": 8.75, "MET": 8.0}
ALPHA_CONE = {"CYS": -0.85, "ASP": -0.90, "SER": -0.85, "VAL": -0.90, "GLN": -1.0, "LYS": -1.0, "PRO": -1.0, "THR": -1.0, "PHE": -0.90, "ALA": -0.85, "HIS": -0.95, "GLY": -1.0, "ILE": -0.85, "GLU": -1.0, "LEU": -1.0, "ARG": -1.0, "TRP": -0.6, "ASN": -1.0, "TYR": -0.85, "MET": -1.0}
ATOM_RANGE = {"CYS": 7.0, "SEC": 7.0, "GLN": 7.25, "ASP": 6.75, "ASX": 6.75, "SER": 6.5, "VAL": 7.5, "LYS": 7.5, "ASN": 6.75, "PRO": 7.0, "THR": 6.75, "PHE": 7.75, "ALA": 7.0, "HIS": 7.25, "GLY": 6.75, "ILE": 7.75, "LEU": 7.75, "ARG": 7.75, "TRP": 8.0, "GLU": 7.0, "GLX": 7.0, "TYR": 7.75, "MET": 7.5}
ATOM_CONE = {"CYS": -0.85, "SEC": -0.85, "GLN": -0.95, "ASP": -0.95, "ASX": -0.95, "SER": -0.9, "VAL": -0.85, "LYS": -0.9, "ASN": -0.95, "PRO": -0.85, "THR": -0.85, "PHE": -0.85, "ALA": -0.85, "HIS": -0.8, "GLY": -1.0, "ILE": -0.9, "LEU": -0.9, "ARG": -0.95, "TRP": -0.95, "GLU": -0.95, "GLX": -0.95, "TYR": -0.85, "MET": -1.0}
#: Range and cone of residues of unknown type; how near the cone an atom's own angle decides; how far off the first atom of a residue may be.
UNKNOWN_RANGE, UNKNOWN_CONE, NEAR_CONE, FAR = 8.0, -0.8, 0.1, 10.0

Vector = tuple[Column, Column, Column]


def fixed(table: dict, key: Column | str, default) -> Column:
    """Value of a fixed table, as one literal map: a branch for each entry makes code that is too long to compile."""
    value = lambda v: F.array(*map(F.lit, v)) if isinstance(v, tuple) else F.lit(v)
    entries = F.create_map(*(x for k, v in table.items() for x in (F.lit(k), value(v))))
    return F.coalesce(F.try_element_at(entries, col(key)), value(default))


def vector(prefix: str) -> Vector:
    return tuple(F.col(f"{prefix}{c}") for c in "xyz")


def minus(a: Vector, b: Vector) -> Vector:
    return tuple(p - q for p, q in zip(a, b, strict=True))


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def cosine(a: Vector, b: Vector) -> Column:
    """Cosine of the angle between two vectors; null if one has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / norm)))


def cone_volume(r: Column | str, cos: Column | str) -> Column:
    """Volume of the part of a sphere within an angle of a direction; the whole sphere for -1."""
    return F.lit(2.0 / 3.0 * pi) * col(r) ** 3 * (1 - col(cos))


def free_share(filled: Column, r: Column | str, cos: Column | str, own: Column | str) -> Column:
    """Share of the cone around a sphere of radius ``own`` that is not filled."""
    v = cone_volume(r, cos) - cone_volume(own, cos)
    return (v - filled) / v


def predicted_centroids(residues: DataFrame, keys: list[str]) -> DataFrame:
    """``residues`` (keys, number, name, x, y, z of the alpha atom) with the likely centroid of the side chain (cx, cy, cz).

    The frame has its first axis toward the alpha atom before, its second in the plane of
    both neighbours toward the one after, and the third square to both. Without neighbours of
    adjacent numbers, or where they are in line with the atom, the centroid is the alpha atom.
    """
    order = Window.partitionBy(*keys).orderBy("number")
    beside = {f"{p}{c}": f(c).over(order) for p, f in (("_b", F.lag), ("_a", F.lead)) for c in ("number", "x", "y", "z")}
    rows = residues.withColumns(beside)
    back, ahead, normal = (tuple(F.col(f"_{p}{c}") for c in "xyz") for p in "uvn")
    rows = rows.withColumns({f"_u{c}": F.col(f"_b{c}") - F.col(c) for c in "xyz"} | {f"_v{c}": F.col(f"_a{c}") - F.col(c) for c in "xyz"})
    rows = rows.withColumns({f"_n{c}": v for c, v in zip("xyz", cross(back, ahead), strict=True)} | {"_lu": F.sqrt(dot(back, back)), "_lv": F.sqrt(dot(ahead, ahead))}).withColumn("_ln", F.sqrt(dot(normal, normal)))
    known = (F.col("number") - F.col("_bnumber") == 1) & (F.col("_anumber") - F.col("number") == 1) & (F.col("_ln") > 1e-9 * F.col("_lu") * F.col("_lv"))
    # the axes are back, normal x back and normal, each over its length
    weight = F.when(known, F.transform(F.array("_lu", F.col("_ln") * F.col("_lu"), "_ln"), lambda x, i: F.get(fixed(SIDE_CENTROID, "name", SIDE_CENTROID["UNK"]), i) / x))
    rows = rows.withColumn("_w", F.coalesce(weight, F.array(*[F.lit(0.0)] * 3)))
    second = cross(normal, back)
    place = {c: F.get("_w", F.lit(0)) * back[i] + F.get("_w", F.lit(1)) * second[i] + F.get("_w", F.lit(2)) * normal[i] for i, c in enumerate("xyz")}
    return rows.select(*residues.columns, *((F.col(c) + F.coalesce(place[c], F.lit(0.0))).alias(f"c{c}") for c in "xyz"))


def density_by_alpha(residues: DataFrame, keys: list[str], chain: str = "chain") -> DataFrame:
    """(keys, chain, number, density): contact density where only alpha atoms are known.

    Distances are between predicted centroids; a neighbour counts if its centroid is in the
    cone, or if there is no angle because a centroid is on the alpha atom.
    """
    rows = predicted_centroids(residues, [*keys, chain])
    rows = rows.withColumns({"_range": fixed(ALPHA_RANGE, "name", UNKNOWN_RANGE), "_cone": fixed(ALPHA_CONE, "name", UNKNOWN_CONE), "_radius": fixed(RESIDUE_RADIUS, "name", RESIDUE_RADIUS["UNK"])})
    other = rows.select(*keys, chain, "number", "cx", "cy", "cz", "_radius")
    met = within(rows, other, ["cx", "cy", "cz"], max(*ALPHA_RANGE.values(), UNKNOWN_RANGE) + max(RESIDUE_RADIUS.values()), keys=keys)
    met = met.where((F.col(chain) != F.col(f"{chain}_b")) | (F.col("number") != F.col("number_b")))
    alpha = vector("")
    angle = cosine(minus(vector("c"), alpha), minus(tuple(F.col(f"c{c}_b") for c in "xyz"), alpha))
    counts = (F.col("distance") - F.col("_radius_b") <= F.col("_range")) & ((F.col("_cone") <= -1) | angle.isNull() | (F.col("_cone") <= angle))
    filled = met.where(counts).groupBy(*keys, chain, "number").agg(F.sum(sphere_overlap("_range", "_radius_b", "distance")).alias("_filled"))
    return _free(rows, filled, [*keys, chain, "number"])


def _free(rows: DataFrame, filled: DataFrame, key: list[str]) -> DataFrame:
    found = rows.join(filled, key, "left")
    return found.select(*key, free_share(F.coalesce("_filled", F.lit(0.0)), "_range", "_cone", "_radius").alias("density"))


def centroids(atoms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name, cx, cy, cz and named atoms): mean place of the atoms beyond the main chain (names of two letters or more); of all if there is no other."""
    side = F.length("atom") > 1
    mean = lambda c: F.coalesce(F.avg(F.when(side, F.col(c))), F.avg(c)).alias(f"c{c}")
    named = [F.max_by(F.struct("x", "y", "z"), F.when(F.col("atom") == a, F.col("serial"))).alias(f"_{a.lower()}") for a in ("CA", "CB", "N", "C")]
    return atoms.groupBy(*keys).agg(F.min_by("name", "serial").alias("name"), *map(mean, "xyz"), *named)


def _direction(rows: DataFrame) -> DataFrame:
    """Direction (dx, dy, dz) of each residue's side chain and its origin (ox, oy, oz).

    From the alpha to the beta atom; for glycine, and where one of them is missing, the line
    from the alpha atom to the nitrogen, turned by 120 degrees about that to the carbonyl, at the centroid.
    """
    part = lambda a: tuple(F.col(f"{a}.{c}") for c in "xyz")
    beta = (F.col("name") != "GLY") & F.col("_ca").isNotNull() & F.col("_cb").isNotNull()
    n, axis = minus(part("_n"), part("_ca")), minus(part("_c"), part("_ca"))
    k = tuple(v / F.nullif(F.sqrt(dot(axis, axis)), F.lit(0.0)) for v in axis)
    across, along = cross(k, n), dot(k, n)
    turned = tuple(-0.5 * n[i] - F.lit(sqrt(0.75)) * across[i] + 1.5 * along * k[i] for i in range(3))
    to_beta = minus(part("_cb"), part("_ca"))
    values = {f"d{c}": F.when(beta, to_beta[i]).otherwise(turned[i]) for i, c in enumerate("xyz")}
    return rows.withColumns(values | {f"o{c}": F.when(beta, F.col(f"_ca.{c}")).otherwise(F.col(f"c{c}")) for c in "xyz"})


def _angle(to: Vector) -> Column:
    """Cosine between a residue's direction and a place; 1 if it has no direction."""
    return F.when(F.col("dx").isNull(), F.lit(1.0)).otherwise(cosine(vector("d"), minus(to, vector("o"))))


def density_by_atoms(atoms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chain, residue, density): contact density from all atoms (keys, chain, residue, name, serial, atom, x, y, z).

    Distances are from the centroid. All atoms of a neighbour have the angle of its first
    one, but near the edge of the cone each has its own; a neighbour whose first atom is
    farther off than the range and ``FAR`` is left out.
    """
    own = [*keys, "chain", "residue"]
    rows = _direction(centroids(atoms, own)).withColumns({"_range": fixed(ATOM_RANGE, "name", UNKNOWN_RANGE), "_cone": fixed(ATOM_CONE, "name", UNKNOWN_CONE), "_radius": fixed(RESIDUE_RADIUS, "name", RESIDUE_RADIUS["UNK"])})
    rows = rows.select(*own, "_range", "_cone", "_radius", *(f"{p}{c}" for p in "cdo" for c in "xyz"))
    first = atoms.groupBy(*own).agg(F.min_by(F.struct("x", "y", "z"), "serial").alias("_first"))
    places = atoms.join(first, own).select(*keys, F.col("x").alias("cx"), F.col("y").alias("cy"), F.col("z").alias("cz"), "_first", _atom_radius().alias("_reach"))
    met = within(rows, places, ["cx", "cy", "cz"], max(*ATOM_RANGE.values(), UNKNOWN_RANGE) + max(ATOM_RADIUS.values()), keys=keys)
    start = tuple(F.col(f"_first_b.{c}") for c in "xyz")
    gap = minus(start, vector("c"))
    rough, exact = _angle(start), _angle(tuple(F.col(f"c{c}_b") for c in "xyz"))
    angle = F.when(F.abs(F.col("_cone") - rough) <= NEAR_CONE, exact).otherwise(rough)
    in_cone = (F.col("_cone") <= -1) | angle.isNull() | (F.col("_cone") <= angle)
    counts = (F.col("distance") - F.col("_reach_b") <= F.col("_range")) & (F.sqrt(dot(gap, gap)) <= F.col("_range") + FAR) & in_cone
    filled = met.where(counts).groupBy(*own).agg(F.sum(sphere_overlap("_range", "_reach_b", "distance")).alias("_filled"))
    return _free(rows, filled, own)


def _atom_radius() -> Column:
    return fixed(ATOM_RADIUS, F.substring("atom", 1, 1), ATOM_RADIUS["X"])


def density_of_atoms(atoms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chain, residue, serial, density): the same for each atom, in the whole sphere, over the atoms of other residues."""
    rows = atoms.withColumns({"_range": fixed(ATOM_RANGE, "name", UNKNOWN_RANGE), "_cone": F.lit(-1.0), "_radius": _atom_radius()})
    rows = rows.select(*keys, "chain", "residue", "serial", "x", "y", "z", "_range", "_cone", "_radius")
    other = rows.select(*keys, "chain", "residue", "x", "y", "z", "_radius")
    met = within(rows, other, ["x", "y", "z"], max(*ATOM_RANGE.values(), UNKNOWN_RANGE) + max(ATOM_RADIUS.values()), keys=keys)
    met = met.where(((F.col("chain") != F.col("chain_b")) | (F.col("residue") != F.col("residue_b"))) & (F.col("distance") - F.col("_radius_b") <= F.col("_range")))
    filled = met.groupBy(*keys, "chain", "residue", "serial").agg(F.sum(sphere_overlap("_range", "_radius_b", "distance")).alias("_filled"))
    return _free(rows, filled, [*keys, "chain", "residue", "serial"])


def density_by_distances(residues: DataFrame, distances: DataFrame, keys: list[str], ranges: dict[str, float] | None = None) -> DataFrame:
    """(keys, number, density) where only some distances (keys, a, b, distance) between residues are known, in the whole sphere.

    A distance holds both ways; of several for a pair the last, the greatest, stands.
    """
    rows = residues.withColumns({"_range": fixed(ranges or ALPHA_RANGE, "name", UNKNOWN_RANGE), "_cone": F.lit(-1.0), "_radius": fixed(RESIDUE_RADIUS, "name", RESIDUE_RADIUS["UNK"])})
    pair = distances.where("a <> b").groupBy(*keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("distance").alias("distance"))
    both = pair.unionByName(pair.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
    met = both.join(rows.select(*keys, F.col("number").alias("a"), "_range"), [*keys, "a"]).join(rows.select(*keys, F.col("number").alias("b"), F.col("_radius").alias("_radius_b")), [*keys, "b"])
    filled = met.where(F.col("distance") - F.col("_radius_b") <= F.col("_range")).groupBy(*keys, F.col("a").alias("number")).agg(F.sum(sphere_overlap("_range", "_radius_b", "distance")).alias("_filled"))
    return _free(rows, filled, [*keys, "number"])


def sparsity(residues: DataFrame, distances: DataFrame, keys: list[str], apart: int = 3) -> DataFrame:
    """(keys, sparsity): share of the pairs of residues ``apart`` places apart or more without a distance, to a tenth, at most 0.9."""
    n = residues.groupBy(*keys).agg(F.count("*").alias("_n"))
    known = distances.where(F.abs(F.col("a") - F.col("b")) >= apart).select(*keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().groupBy(*keys).agg(F.count("*").alias("_m"))
    pairs = (F.col("_n") - apart) * (F.col("_n") - apart + 1) / 2
    share = 1 - F.coalesce("_m", F.lit(0)) / F.nullif(pairs, F.lit(0))
    return n.join(known, keys, "left").select(*keys, F.when(F.col("_n") > apart, F.least(F.lit(0.9), F.round(share, 1))).alias("sparsity"))
