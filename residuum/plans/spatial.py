"""Contact density and distances in space, on the supplied vectors.

A structure is a hundred vectors of consecutive ids, so its size does not grow with the
table. A vector is a residue: its first three numbers place the alpha atom, the following
threes the others around it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.operators import density, distances
from residuum.plans.catalog import query, table
from residuum.sources import cif

NAMES = ("ALA", "CYS", "ASP", "GLU", "PHE", "GLY", "HIS", "ILE", "LYS", "LEU", "MET", "ASN", "PRO", "GLN", "ARG", "SER", "THR", "VAL", "TRP", "TYR", "XAA")
ATOMS = ("N", "CA", "C", "O", "CB", "SG", "H")
#: Å for a unit of the vectors: of the alpha atoms, and of the other atoms around theirs.
SCALE, AROUND = 60.0, 12.0
c = F.col


def residues(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    place = [(F.get("embedding", F.lit(i)).cast("double") * SCALE).alias(x) for i, x in enumerate("xyz")]
    name = F.get(F.array(*map(F.lit, NAMES)), (c("vec_id") % len(NAMES)).cast("int")).alias("name")
    return v.select(F.floor(c("vec_id") / 100).alias("structure"), F.when(c("vec_id") % 100 < 60, "A").otherwise("B").alias("chain"), (c("vec_id") + F.floor(c("vec_id") / 7)).alias("number"), name, *place, "vec_id", "embedding")


def atoms(spark, sf_dir):
    """The atoms of each residue; every eleventh residue has no beta atom, every thirteenth no main chain but the alpha atom."""
    at = lambda i, k: F.get("embedding", F.lit(3 * i + k)).cast("double") * AROUND
    each = F.array(*(F.struct(F.lit(a).alias("atom"), F.lit(i).alias("i"), *((F.lit(0.0) if a == "CA" else at(i + 1, k)).alias(f"d{x}") for k, x in enumerate("xyz"))) for i, a in enumerate(ATOMS)))
    rows = residues(spark, sf_dir).withColumn("a", F.explode(each)).where(~((c("a.atom") == "CB") & (c("vec_id") % 11 == 0)) & ~(c("a.atom").isin("N", "C") & (c("vec_id") % 13 == 0)))
    return rows.select("structure", "chain", c("number").alias("residue"), "name", (c("vec_id") * 10 + c("a.i")).alias("serial"), c("a.atom").alias("atom"), *((c(x) + c(f"a.d{x}")).alias(x) for x in "xyz"))


# the same tables in SQL


def _values(*columns: dict) -> str:
    keys = dict.fromkeys(k for d in columns for k in d)
    cell = lambda v: "NULL" if v is None else repr(float(v))
    return "(VALUES " + ", ".join(f"('{k}', {', '.join(cell(d.get(k)) for d in columns)})" for k in keys) + ")"


RESIDUES = f"""SELECT vec_id // 100 AS structure, CASE WHEN vec_id % 100 < 60 THEN 'A' ELSE 'B' END AS chain, vec_id + vec_id // 7 AS number, list_value({', '.join(f"'{n}'" for n in NAMES)})[vec_id % {len(NAMES)} + 1] AS name,
  CAST(embedding[1] AS DOUBLE) * {SCALE} AS x, CAST(embedding[2] AS DOUBLE) * {SCALE} AS y, CAST(embedding[3] AS DOUBLE) * {SCALE} AS z, vec_id, embedding FROM embeddings"""
ATOM_ROWS = f"""SELECT structure, chain, number AS residue, name, vec_id * 10 + i AS serial, list_value({', '.join(f"'{a}'" for a in ATOMS)})[i + 1] AS atom,
  {', '.join(f"{x} + CASE WHEN i = 1 THEN 0 ELSE CAST(embedding[3 * i + {4 + k}] AS DOUBLE) * {AROUND} END AS {x}" for k, x in enumerate('xyz'))}
  FROM (SELECT *, unnest(range({len(ATOMS)})) AS i FROM res) WHERE NOT (i = 4 AND vec_id % 11 = 0) AND NOT (i IN (0, 2) AND vec_id % 13 = 0)"""
LENS = "pi() * (R + r - d) ** 2 * (d ** 2 + 2 * d * r - 3 * r ** 2 + 2 * d * R + 6 * r * R - 3 * R ** 2) / (12 * d)"


def shared(big: str, small: str, d: str) -> str:
    lens = LENS.replace("R", "@").replace("r", small).replace("@", big).replace("d ", f"{d} ").replace(" d", f" {d}").replace("* d)", f"* {d})")
    return f"CASE WHEN {d} >= {big} + {small} THEN 0 WHEN {d} <= abs({big} - {small}) THEN 4.0 / 3 * pi() * least({big}, {small}) ** 3 ELSE {lens} END"


FREE = "(2.0 / 3 * pi() * (1 - cone) * (reach ** 3 - radius ** 3) - coalesce(filled, 0)) / (2.0 / 3 * pi() * (1 - cone) * (reach ** 3 - radius ** 3))"


def gap(a: str, b: str, p: str = "", q: str = "") -> str:
    return "sqrt(" + " + ".join(f"({a}.{p}{x} - {b}.{q}{x}) ** 2" for x in "xyz") + ")"


def cos_of(*pairs: tuple[str, str]) -> str:
    """Cosine of two vectors given as pairs of their components."""
    dot = " + ".join(f"({a}) * ({b})" for a, b in pairs)
    norm = "sqrt(" + " + ".join(f"({a}) ** 2" for a, _ in pairs) + ") * sqrt(" + " + ".join(f"({b}) ** 2" for _, b in pairs) + ")"
    return f"CASE WHEN {norm} > 0 THEN greatest(-1.0, least(1.0, ({dot}) / ({norm}))) END"


ALPHA = f"""WITH res AS ({RESIDUES}),
  kind(name, sx, sy, sz, reach, cone, radius) AS {_values({k: v[0] for k, v in density.SIDE_CENTROID.items()}, {k: v[1] for k, v in density.SIDE_CENTROID.items()}, {k: v[2] for k, v in density.SIDE_CENTROID.items()}, density.ALPHA_RANGE, density.ALPHA_CONE, density.RESIDUE_RADIUS)},
  unk AS (SELECT * FROM kind WHERE name = 'UNK'),
  side AS (
    SELECT res.structure, res.chain, number, res.x, res.y, res.z, coalesce(k.sx, u.sx) AS sx, coalesce(k.sy, u.sy) AS sy, coalesce(k.sz, u.sz) AS sz, coalesce(k.reach, {density.UNKNOWN_RANGE}) AS reach, coalesce(k.cone, {density.UNKNOWN_CONE}) AS cone, coalesce(k.radius, u.radius) AS radius,
      {', '.join(f"CASE WHEN number - lag(number) OVER w = 1 AND lead(number) OVER w - number = 1 THEN lag(res.{x}) OVER w - res.{x} END AS a{x}, lead(res.{x}) OVER w - res.{x} AS b{x}" for x in 'xyz')}
    FROM res LEFT JOIN kind k USING (name) CROSS JOIN unk u WINDOW w AS (PARTITION BY res.structure, res.chain ORDER BY number)),
  axis1 AS (SELECT *, ax / sqrt(ax * ax + ay * ay + az * az) AS e1, ay / sqrt(ax * ax + ay * ay + az * az) AS e2, az / sqrt(ax * ax + ay * ay + az * az) AS e3 FROM side),
  axis2 AS (SELECT *, bx - (bx * e1 + by_ * e2 + bz * e3) * e1 AS p1, by_ - (bx * e1 + by_ * e2 + bz * e3) * e2 AS p2, bz - (bx * e1 + by_ * e2 + bz * e3) * e3 AS p3 FROM (SELECT *, "by" AS by_ FROM axis1)),
  axis3 AS (SELECT *, p1 / sqrt(p1 * p1 + p2 * p2 + p3 * p3) AS f1, p2 / sqrt(p1 * p1 + p2 * p2 + p3 * p3) AS f2, p3 / sqrt(p1 * p1 + p2 * p2 + p3 * p3) AS f3 FROM axis2),
  cent AS (SELECT *, x + coalesce(sx * e1 + sy * f1 + sz * (e2 * f3 - e3 * f2), 0) AS cx, y + coalesce(sx * e2 + sy * f2 + sz * (e3 * f1 - e1 * f3), 0) AS cy, z + coalesce(sx * e3 + sy * f3 + sz * (e1 * f2 - e2 * f1), 0) AS cz FROM axis3)"""


@query("predicted_centroids", f"{ALPHA} SELECT structure, chain, number, round(cx, 6) AS cx, round(cy, 6) AS cy, round(cz, 6) AS cz FROM cent")
def predicted_centroids(spark, sf_dir):
    found = density.predicted_centroids(residues(spark, sf_dir), ["structure", "chain"])
    return found.select("structure", "chain", "number", *(F.round(f"c{x}", 6).alias(f"c{x}") for x in "xyz"))


@query("contact_density_alpha", f"""{ALPHA},
  met AS (SELECT a.structure, a.chain, a.number, a.reach, b.radius, a.cone, {gap('a', 'b', 'c', 'c')} AS d, {cos_of(*((f"a.c{x} - a.{x}", f"b.c{x} - a.{x}") for x in 'xyz'))} AS angle FROM cent a JOIN cent b ON a.structure = b.structure AND (a.chain <> b.chain OR a.number <> b.number)),
  filled AS (SELECT structure, chain, number, sum({shared('reach', 'radius', 'd')}) AS filled FROM met WHERE d - radius <= reach AND (cone <= -1 OR angle IS NULL OR cone <= angle) GROUP BY ALL)
  SELECT structure, chain, number, round({FREE}, 6) AS density FROM cent LEFT JOIN filled USING (structure, chain, number)""")  # fmt: skip
def contact_density_alpha(spark, sf_dir):
    found = density.density_by_alpha(residues(spark, sf_dir), ["structure"])
    return found.select("structure", "chain", "number", F.round("density", 6).alias("density"))


ATOM_TABLES = f"""WITH res AS ({RESIDUES}), atom AS ({ATOM_ROWS}), kind(name, reach, cone, radius) AS {_values(density.ATOM_RANGE, density.ATOM_CONE, density.RESIDUE_RADIUS)}, element(e, vdw) AS {_values(density.ATOM_RADIUS)},
  sized AS (SELECT atom.*, coalesce(vdw, {density.ATOM_RADIUS['X']}) AS vdw, coalesce(k.reach, {density.UNKNOWN_RANGE}) AS reach, coalesce(k.cone, {density.UNKNOWN_CONE}) AS cone, coalesce(k.radius, {density.RESIDUE_RADIUS['UNK']}) AS radius FROM atom LEFT JOIN element ON e = substr(atom, 1, 1) LEFT JOIN kind k USING (name))"""


def _named(a: str, prefix: str) -> str:
    return ", ".join(f"max(CASE WHEN atom = '{a}' THEN {x} END) AS {prefix}{x}" for x in "xyz")


@query("contact_density_atoms", f"""{ATOM_TABLES},
  own AS (SELECT structure, chain, residue, name, reach, cone, radius, {', '.join(f"coalesce(avg(CASE WHEN length(atom) > 1 THEN {x} END), avg({x})) AS c{x}" for x in 'xyz')}, {_named('CA', 'ca')}, {_named('CB', 'cb')}, {_named('N', 'n')}, {_named('C', 'co')},
    {', '.join(f"arg_min({x}, serial) AS s{x}" for x in 'xyz')} FROM sized GROUP BY structure, chain, residue, name, reach, cone, radius),
  turn AS (SELECT *, {', '.join(f"n{x} - ca{x} AS n{i}, (co{x} - ca{x}) / sqrt({' + '.join(f'(co{w} - ca{w}) ** 2' for w in 'xyz')}) AS k{i}" for i, x in enumerate('xyz'))}, name <> 'GLY' AND cbx IS NOT NULL AND cax IS NOT NULL AS beta FROM own),
  pointed AS (SELECT *, {', '.join(f"CASE WHEN beta THEN cb{x} - ca{x} ELSE -0.5 * n{i} - sqrt(0.75) * (k{(i + 1) % 3} * n{(i + 2) % 3} - k{(i + 2) % 3} * n{(i + 1) % 3}) + 1.5 * (k0 * n0 + k1 * n1 + k2 * n2) * k{i} END AS d{x}, CASE WHEN beta THEN ca{x} ELSE c{x} END AS o{x}" for i, x in enumerate('xyz'))} FROM turn),
  met AS (SELECT a.structure, a.chain, a.residue, a.reach, a.cone, b.vdw, a.dx, {gap('a', 'b', 'c')} AS d, sqrt({' + '.join(f'(a.c{x} - s.s{x}) ** 2' for x in 'xyz')}) AS first_gap,
      {cos_of(*((f"a.d{x}", f"s.s{x} - a.o{x}") for x in 'xyz'))} AS rough, {cos_of(*((f"a.d{x}", f"b.{x} - a.o{x}") for x in 'xyz'))} AS exact
    FROM pointed a JOIN sized b ON a.structure = b.structure JOIN own s ON s.structure = b.structure AND s.chain = b.chain AND s.residue = b.residue),
  angled AS (SELECT *, CASE WHEN dx IS NULL THEN 1.0 WHEN abs(cone - rough) <= {density.NEAR_CONE} THEN exact ELSE rough END AS angle FROM met),
  filled AS (SELECT structure, chain, residue, sum({shared('reach', 'vdw', 'd')}) AS filled FROM angled WHERE d - vdw <= reach AND first_gap <= reach + {density.FAR} AND (cone <= -1 OR angle IS NULL OR cone <= angle) GROUP BY ALL)
  SELECT structure, chain, residue, round({FREE}, 6) AS density FROM own LEFT JOIN filled USING (structure, chain, residue)""")  # fmt: skip
def contact_density_atoms(spark, sf_dir):
    found = density.density_by_atoms(atoms(spark, sf_dir), ["structure"])
    return found.select("structure", "chain", "residue", F.round("density", 6).alias("density"))


@query("contact_density_each_atom", f"""{ATOM_TABLES},
  filled AS (SELECT structure, chain, residue, serial, sum({shared('reach', 'vdw', 'd')}) AS filled
    FROM (SELECT a.structure, a.chain, a.residue, a.serial, a.reach, b.vdw, {gap('a', 'b')} AS d FROM sized a JOIN sized b ON a.structure = b.structure AND (a.chain <> b.chain OR a.residue <> b.residue)) WHERE d - vdw <= reach GROUP BY ALL)
  SELECT structure, chain, residue, serial, round({FREE}, 6) AS density FROM (SELECT structure, chain, residue, serial, reach, -1.0 AS cone, vdw AS radius FROM sized) LEFT JOIN filled USING (structure, chain, residue, serial)""")  # fmt: skip
def contact_density_each_atom(spark, sf_dir):
    found = density.density_of_atoms(atoms(spark, sf_dir), ["structure"])
    return found.select("structure", "chain", "residue", "serial", F.round("density", 6).alias("density"))


def sparse_distances(spark, sf_dir):
    """Distances of the alpha atoms of a structure up to 9 Å, every fifth missing."""
    from residuum.operators.joins import within

    rows = residues(spark, sf_dir).select("structure", "number", "x", "y", "z")
    return within(rows, rows, ["x", "y", "z"], 9.0, keys=["structure"]).where("number < number_b AND (number + number_b) % 5 <> 0").select("structure", c("number").alias("a"), c("number_b").alias("b"), "distance")


KNOWN = f"known AS (SELECT a.structure, a.number AS a, b.number AS b, {gap('a', 'b')} AS d FROM res a JOIN res b ON a.structure = b.structure AND a.number < b.number AND {gap('a', 'b')} <= 9 AND (a.number + b.number) % 5 <> 0)"


@query("contact_density_distances", f"""WITH res AS ({RESIDUES}), {KNOWN}, kind(name, reach, radius) AS {_values(density.ALPHA_RANGE, density.RESIDUE_RADIUS)},
  sized AS (SELECT structure, number, coalesce(k.reach, {density.UNKNOWN_RANGE}) AS reach, coalesce(k.radius, {density.RESIDUE_RADIUS['UNK']}) AS radius, -1.0 AS cone FROM res LEFT JOIN kind k USING (name)),
  ways AS (SELECT structure, a, b, d FROM known UNION ALL SELECT structure, b, a, d FROM known),
  filled AS (SELECT structure, number, sum({shared('reach', 'radius_b', 'd')}) AS filled FROM (SELECT x.structure, x.number, x.reach, y.radius AS radius_b, d FROM ways JOIN sized x ON x.structure = ways.structure AND x.number = a JOIN sized y ON y.structure = ways.structure AND y.number = b) WHERE d - radius_b <= reach GROUP BY ALL),
  n AS (SELECT structure, count(*) AS n FROM res GROUP BY 1), m AS (SELECT structure, count(*) AS m FROM known WHERE b - a >= 3 GROUP BY 1)
  SELECT structure, number, round({FREE}, 6) AS density, CASE WHEN n > 3 THEN least(0.9, round(1 - coalesce(m, 0) / ((n - 3) * (n - 2) / 2.0), 1)) END AS sparsity FROM sized LEFT JOIN filled USING (structure, number) JOIN n USING (structure) LEFT JOIN m USING (structure)""")  # fmt: skip
def contact_density_distances(spark, sf_dir):
    rows, known = residues(spark, sf_dir).select("structure", "number", "name"), sparse_distances(spark, sf_dir)
    found = density.density_by_distances(rows, known, ["structure"])
    return found.join(density.sparsity(rows, known, ["structure"]), "structure").select("structure", "number", F.round("density", 6).alias("density"), "sparsity")


@query("least_atom_distances", f"""WITH res AS ({RESIDUES}), atom AS ({ATOM_ROWS}),
  met AS (SELECT a.structure, a.chain, a.residue, b.chain AS chain_b, b.residue AS residue_b, {gap('a', 'b')} AS d, a.serial AS s, b.serial AS t, a.atom, b.atom AS atom_b FROM atom a JOIN atom b ON a.structure = b.structure AND a.residue < b.residue),
  best AS (SELECT structure, chain, residue, chain_b, residue_b, min({{'d': d, 's': s, 't': t, 'atom': atom, 'atom_b': atom_b}}) AS x FROM met GROUP BY ALL)
  SELECT structure, chain, residue, chain_b, residue_b, round(x.d, 6) AS distance, x.atom AS atom, x.atom_b AS atom_b FROM best WHERE x.d <= 6""")  # fmt: skip
def least_atom_distances(spark, sf_dir):
    found = distances.least_distances(atoms(spark, sf_dir), ["structure"], 6.0).where("residue < residue_b")
    return found.select("structure", "chain", "residue", "chain_b", "residue_b", F.round("distance", 6).alias("distance"), "atom", "atom_b")


@query("nearest_substituents", f"""WITH res AS ({RESIDUES}), atom AS ({ATOM_ROWS}),
  center AS (SELECT structure, chain, residue, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM atom GROUP BY ALL),
  near AS (SELECT a.structure, a.chain, a.residue, b.chain AS chain_b, b.residue AS residue_b, row_number() OVER (PARTITION BY a.structure, a.chain, a.residue, b.chain ORDER BY {gap('a', 'b')}, b.residue) AS i
    FROM center a JOIN center b ON a.structure = b.structure AND (a.chain <> b.chain OR a.residue <> b.residue) AND {gap('a', 'b')} <= 25),
  met AS (SELECT n.structure, n.chain, n.residue, n.chain_b, n.residue_b, i, {gap('a', 'b')} AS d, a.serial AS serial, b.serial AS serial_b FROM near n JOIN atom a ON a.structure = n.structure AND a.chain = n.chain AND a.residue = n.residue
    JOIN atom b ON b.structure = n.structure AND b.chain = n.chain_b AND b.residue = n.residue_b WHERE i <= 21 AND a.atom NOT LIKE 'H%' AND b.atom NOT LIKE 'H%'),
  kept AS (SELECT * FROM met WHERE d >= 1.2),
  best AS (SELECT structure, chain, residue, chain_b, min({{'d': d, 'i': i, 'serial_b': serial_b, 'serial': serial, 'residue_b': residue_b}}) AS x FROM kept GROUP BY ALL),
  ball AS (SELECT structure, chain, residue, chain_b, count(*) AS n_sphere, sum(d) AS total FROM (SELECT structure, chain, residue, chain_b, residue_b, min(d) AS d FROM kept WHERE d < 10 GROUP BY ALL) GROUP BY ALL)
  SELECT structure, chain, residue, chain_b, round(x.d, 6) AS distance, x.residue_b AS residue_b, x.serial AS serial, x.serial_b AS serial_b, coalesce(n_sphere, 0) AS n_sphere, round(coalesce(total, 0), 5) AS total FROM best LEFT JOIN ball USING (structure, chain, residue, chain_b)""")  # fmt: skip
def nearest_substituents(spark, sf_dir):
    found = distances.nearest_substituents(atoms(spark, sf_dir), ["structure"])
    total = F.aggregate("sphere", F.lit(0.0), lambda s, x: s + x["distance"])
    return found.select("structure", "chain", "residue", "chain_b", F.round("distance", 6).alias("distance"), "residue_b", "serial", "serial_b", F.size("sphere").cast("long").alias("n_sphere"), F.round(total, 5).alias("total"))


def cif_texts(spark, sf_dir):
    """A CIF text for each structure: a header, a text field with a keyword in it, and its atoms in two models, with quoted names."""
    number = lambda x: F.format_string("%.3f", x)
    name = F.when(c("atom") == "CB", "\"CB'\"").otherwise(c("atom"))
    alt = F.when(c("serial") % 10 == 3, F.when(c("residue") % 2 == 0, "A").otherwise("B")).otherwise(".")
    line = lambda model: F.concat_ws(" ", F.lit("ATOM"), "serial", name, alt, "name", "chain", "residue", F.lit("?"), number(c("x")), number(c("y")), number(c("z")), F.lit(model))
    rows = atoms(spark, sf_dir).select("structure", "serial", line("1").alias("one"), line("2").alias("two"))
    joined = lambda col: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("serial", col))), lambda x: x[col]), "\n").alias(col)
    items = ("group_PDB", "id", "label_atom_id", "label_alt_id", "label_comp_id", "auth_asym_id", "auth_seq_id", "pdbx_PDB_ins_code", "Cartn_x", "Cartn_y", "Cartn_z", "pdbx_PDB_model_num")
    head = "data_x\n_struct.title\n;Structure of 'loop_' words\n_atom_site.id 7\n;\n_refine.ls_d_res_high 1.%s # comment\nloop_\n" + "".join(f"_atom_site.{x}\n" for x in items)
    whole = F.concat(F.format_string(head, (c("structure") % 10).cast("string")), "one", F.lit("\n"), "two", F.lit("\n#\n"))
    return rows.groupBy("structure").agg(joined("one"), joined("two")).select("structure", whole.alias("value"))


@query("mmcif_atoms", f"""WITH res AS ({RESIDUES}), atom AS ({ATOM_ROWS})
  SELECT structure, CAST(serial AS INTEGER) AS serial, CASE atom WHEN 'CB' THEN 'CB''' ELSE atom END AS atom, name AS res_name, chain, CAST(residue AS INTEGER) AS res_num, round(x, 3) AS x, round(z, 3) AS z, 1 + (structure % 10) / 10 AS resolution
  FROM atom WHERE NOT (serial % 10 = 3 AND residue % 2 = 1)""")  # fmt: skip
def mmcif_atoms(spark, sf_dir):
    texts = cif_texts(spark, sf_dir)
    found = cif.parse_atoms(texts, ["structure"]).join(cif.resolution(texts, ["structure"]), "structure")
    return found.select("structure", "serial", "atom", "res_name", "chain", "res_num", "x", "z", "resolution")
