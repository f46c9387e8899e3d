"""Columns, stretches, networks over each other and regions of changes, on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.functions import sequences
from residuum.operators import conservation, graphs, indels
from residuum.plans.catalog import query, table

c = F.col


def matrix(spark):
    """A substitution matrix by rule: 4 to 6 for a symbol with itself, 0 to -4 otherwise."""
    n = len(conservation.SYMBOLS)
    score = lambda i, j: float(4 + i % 3) if i == j else float(-((i * j + i + j) % 5))
    return spark.createDataFrame([(s, [score(i, j) for j in range(n)]) for i, s in enumerate(conservation.SYMBOLS)], "symbol string, row array<double>")


SYMBOLS = conservation.SYMBOLS
#: Columns that an alignment of names has at least; longer names make it as wide as they are.
LEAST = 24


@query("column_conservation", f"""
    WITH a AS (SELECT p_brand AS brand, p_partkey AS member, rpad(upper(translate(p_name, ' ', '-')), 24, '-') AS s FROM part),
    m AS (SELECT s.i, '{SYMBOLS}'[s.i + 1:s.i + 1] AS symbol, t.j, CAST(CASE WHEN s.i = t.j THEN 4 + s.i % 3 ELSE -((s.i * t.j + s.i + t.j) % 5) END AS DOUBLE) AS v FROM (SELECT unnest(range(24)) AS i) s, (SELECT unnest(range(24)) AS j) t),
    cell AS (SELECT brand, member, place, CASE WHEN s[place:place] = 'J' THEN 'L' ELSE s[place:place] END AS symbol FROM (SELECT *, unnest(range(1, 25)) AS place FROM a)),
    known AS (SELECT * FROM cell WHERE symbol IN (SELECT symbol FROM m)), cnt AS (SELECT brand, place, symbol, count(*) AS n FROM known GROUP BY ALL), kind AS (SELECT brand, place, count(*) AS k FROM cnt GROUP BY ALL),
    w AS (SELECT brand, member, sum(coalesce(1.0 / (k * n), 0)) / 24 AS w FROM cell LEFT JOIN cnt USING (brand, place, symbol) LEFT JOIN kind USING (brand, place) GROUP BY ALL),
    p AS (SELECT brand, place, symbol, sum(w) AS p FROM known JOIN w USING (brand, member) GROUP BY ALL), h AS (SELECT brand, place, sum(p * log2(p)) AS h FROM p GROUP BY ALL),
    size AS (SELECT brand, count(*) AS n FROM a GROUP BY 1),
    mean AS (SELECT brand, place, j, avg(v) AS mu FROM cnt JOIN m USING (symbol) GROUP BY ALL),
    far AS (SELECT brand, place, symbol, sqrt(sum((mu - v) ** 2)) AS d FROM cnt JOIN m USING (symbol) JOIN mean USING (brand, place, j) GROUP BY ALL),
    span AS (SELECT brand, place, max(v) - min(v) AS span FROM cnt JOIN m USING (symbol) GROUP BY ALL),
    r AS (SELECT brand, place, sum(d) / (count(*) * sqrt(20) * any_value(span)) AS r FROM far JOIN span USING (brand, place) GROUP BY ALL),
    f AS (SELECT h.brand, h.place, size.n, CASE WHEN size.n > 1 THEN 0.0 - h / log2(least(size.n, 24)) ELSE 0 END AS t, r, coalesce(cnt.n, 0) / size.n AS g FROM h JOIN size USING (brand) JOIN r USING (brand, place) LEFT JOIN cnt ON cnt.brand = h.brand AND cnt.place = h.place AND cnt.symbol = '-')
    SELECT brand, CAST(place AS INTEGER) AS place, n, round(t, 6) + 0.0 AS t, round(r, 6) + 0.0 AS r, round(g, 6) AS g, round(greatest(1 - t, 0) * sqrt(greatest(1 - r, 0)) * greatest(1 - g, 0) ** 2, 6) AS score FROM f""")  # fmt: skip
def column_conservation(spark, sf_dir):
    """The names of a brand are an alignment as wide as its longest one: no name is cut, where the SQL takes 24 letters."""
    names = table(spark, sf_dir, "part").select(c("p_brand").alias("brand"), c("p_partkey").alias("member"), F.upper(F.translate("p_name", " ", "-")).alias("name"))
    widths = names.groupBy("brand").agg(F.greatest(F.max(F.length("name")), F.lit(LEAST)).alias("width"))
    rows = names.join(widths, "brand").select("brand", "member", F.rpad("name", c("width"), F.lit("-")).alias("aligned"))
    found = conservation.conservation(rows, matrix(spark), ["brand"])
    return found.select("brand", "place", "n", *((F.round(x, 6) + F.lit(0.0)).alias(x) for x in ("t", "r", "g", "score")))


@query("conserved_positions", f"""
    WITH a AS (SELECT p_type AS kind, p_partkey AS member, rpad(upper(translate(p_name, ' ', '-')), 24, '-') AS s FROM part),
    cell AS (SELECT kind, member, place, CASE WHEN s[place:place] = 'J' THEN 'L' ELSE s[place:place] END AS symbol FROM (SELECT *, unnest(range(1, 25)) AS place FROM a)),
    g AS (SELECT kind, place, 1 - count(*) FILTER (symbol = '-') / count(*) AS share FROM cell GROUP BY ALL HAVING count(*) FILTER (strpos('{SYMBOLS}', symbol) > 0) > 0)
    SELECT kind, member, CAST(row_number() OVER (PARTITION BY kind, member ORDER BY place) AS INTEGER) AS position, round(share, 6) AS filled FROM cell LEFT JOIN g USING (kind, place) WHERE symbol <> '-'""")  # fmt: skip
def conserved_positions(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(c("p_type").alias("kind"), c("p_partkey").alias("member"), F.rpad(F.upper(F.translate("p_name", " ", "-")), 24, "-").alias("aligned"))
    scores = conservation.conservation(rows, matrix(spark), ["kind"], exponents=(0.0, 0.0, 1.0))
    return conservation.of_sequence(scores, rows, ["kind"]).select("kind", "member", "position", F.round("score", 6).alias("filled"))


WITH_UNKNOWN = "replace(replace(upper(p_name), 'E', 'X'), ' ', 'X')"


@query("known_stretches", f"""
    WITH s AS (SELECT p_partkey, {WITH_UNKNOWN} AS seq FROM part), ch AS (SELECT p_partkey, seq, i, seq[i:i] = 'X' AS x FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM s)),
    runs AS (SELECT p_partkey, min(i) AS first, max(i) AS last, any_value(seq) AS seq FROM (SELECT *, i - row_number() OVER (PARTITION BY p_partkey ORDER BY i) AS k FROM ch WHERE NOT x) GROUP BY p_partkey, k),
    stretch AS (SELECT p_partkey, first, last, seq FROM runs WHERE last - first + 1 >= 3 OR strpos(seq, 'X') = 0),
    edges AS (SELECT p_partkey, first, last FROM stretch UNION ALL SELECT p_partkey, length(seq) + 1, length(seq) + 1 FROM s),
    gaps AS (SELECT p_partkey, coalesce(lag(last) OVER (PARTITION BY p_partkey ORDER BY first), 0) AS a, first - 1 AS b FROM edges)
    SELECT p_partkey, coalesce((SELECT string_agg(concat(first - 1, ':', seq[first:last]), ',' ORDER BY first) FROM stretch t WHERE t.p_partkey = s.p_partkey), '') AS known,
      coalesce((SELECT string_agg(concat(a, '-', b), ',' ORDER BY a) FROM gaps g WHERE g.p_partkey = s.p_partkey AND b > a), '') AS unknown FROM s""")  # fmt: skip
def known_stretches(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.translate(F.upper("p_name"), "E ", "XX").alias("seq"))
    known = F.transform(sequences.known_stretches("seq", least=3), lambda x: F.concat_ws(":", x["start"], x["letters"]))
    unknown = F.transform(sequences.unknown_portions("seq", least=3), lambda x: F.concat_ws("-", x["first"], x["end"]))
    return rows.select("p_partkey", F.array_join(known, ",").alias("known"), F.array_join(unknown, ",").alias("unknown"))


@query("trimmed_alignments", """
    WITH a AS (SELECT p_partkey, p_size % 4 AS l, p_size % 3 AS r, p_name AS target, repeat('-', p_size % 4) || substr(p_name, 1 + p_size % 4, length(p_name) - p_size % 4 - p_size % 3) || repeat('-', p_size % 3) AS template FROM part),
    b AS (SELECT *, greatest(l - 1, 0) AS cut, greatest(r - 1, 0) AS back FROM a)
    SELECT p_partkey, substr(target, 1 + cut, length(target) - cut - back) AS target, substr(template, 1 + cut, length(template) - cut - back) AS template, CAST(cut AS INTEGER) AS "left", 7 - CAST(cut AS INTEGER) AS place, target AS fused FROM b""")  # fmt: skip
def trimmed_alignments(spark, sf_dir):
    l, r, n = (c("p_size") % 4).cast("int"), (c("p_size") % 3).cast("int"), F.length("p_name")
    template = F.concat(F.repeat(F.lit("-"), l), F.substring("p_name", l + 1, n - l - r), F.repeat(F.lit("-"), r))
    rows = table(spark, sf_dir, "part").select("p_partkey", c("p_name").alias("target"), template.alias("template"))
    rows = rows.withColumn("x", sequences.trimmed("target", "template", 1))
    return rows.select("p_partkey", "x.target", "x.template", "x.left", sequences.moved(F.array(F.lit(7)), c("x.left"))[0].alias("place"), sequences.fused_alignment("template", "target").alias("fused"))


@query("superimposed_networks", """
    WITH al AS (SELECT s_suppkey AS k, concat(substr(s_name, 1, 4), '-', substr(s_name, 5)) AS target, concat('A', substr(s_name, 2, 6), '-', substr(s_name, 8)) AS template FROM supplier),
    ch AS (SELECT k, i, target[i:i] AS a, template[i:i] AS b FROM (SELECT *, unnest(range(1, length(target) + 1)) AS i FROM al)),
    pl AS (SELECT k, CASE WHEN a <> '-' THEN sum(CASE WHEN a <> '-' THEN 1 ELSE 0 END) OVER w END AS p, a, CASE WHEN b <> '-' THEN sum(CASE WHEN b <> '-' THEN 1 ELSE 0 END) OVER w END AS q, b FROM ch WINDOW w AS (PARTITION BY k ORDER BY i ROWS UNBOUNDED PRECEDING)),
    nm AS (SELECT k, p, q, CASE WHEN p = q AND a = b THEN concat(p, a) ELSE concat(CASE WHEN p IS NULL THEN '-' ELSE concat(p, a) END, '/', CASE WHEN q IS NULL THEN '-' ELSE concat(q, b) END) END AS node FROM pl),
    e AS (SELECT l_suppkey AS k, l_linestatus AS chain, l_orderkey % 9 AS residue, l_linenumber + l_partkey % 5 AS pos, l_returnflag AS f, sum(l_tax + 0.01) AS score FROM lineitem GROUP BY ALL),
    x AS (SELECT e.k, chain, residue, node, score FROM e JOIN nm ON nm.k = e.k AND nm.p = pos WHERE f = 'A'), y AS (SELECT e.k, chain, residue, node, score FROM e JOIN nm ON nm.k = e.k AND nm.q = pos WHERE f = 'R'),
    mx AS (SELECT k, max(score) FILTER (f = 'A') AS x, max(score) FILTER (f = 'R') AS y FROM e GROUP BY k)
    SELECT k, chain, residue, node, round(x.score, 6) AS before, round(y.score, 6) AS after, round(5 * (0.1 + coalesce(x.score / mx.x, y.score / mx.y)), 5) AS weight,
      CASE WHEN y.score IS NULL THEN 'lost' WHEN x.score IS NULL THEN 'new' WHEN abs(y.score / mx.x - x.score / mx.x) > 0.20001 THEN 'changed' ELSE 'common' END AS kind
    FROM x FULL JOIN y USING (k, chain, residue, node) JOIN mx USING (k)""")  # fmt: skip
def superimposed_networks(spark, sf_dir):
    name = c("s_name")
    alignments = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("k"), F.concat(F.substring(name, 1, 4), F.lit("-"), F.substring(name, 5, 99)).alias("target"), F.concat(F.lit("A"), F.substring(name, 2, 6), F.lit("-"), F.substring(name, 8, 99)).alias("template"))
    edges = table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("k"), c("l_linestatus").alias("chain"), (c("l_orderkey") % 9).alias("residue"), (c("l_linenumber") + c("l_partkey") % 5).cast("int").alias("position"), "l_returnflag").agg(F.sum(c("l_tax") + 0.01).alias("score"))
    own = lambda f: edges.where(c("l_returnflag") == f).drop("l_returnflag")
    found = graphs.superimposed(own("A"), own("R"), graphs.alignment_places(alignments, ["k"]), ["k"], least=0.20001)
    return found.select("k", "chain", "residue", "node", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"), F.round("weight", 5).alias("weight"), "kind")


def changes(spark, sf_dir):
    """A change for each order, in the protein of its customer."""
    k = c("o_orderkey") % 3
    kind = F.when(k == 0, "ins").when(k == 1, "del").otherwise("sub")
    left = (c("o_custkey") % 30).cast("int") + 1
    rows = table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("kind"), left.alias("left"), c("o_orderkey").alias("k"), (c("o_custkey") % 50).alias("wt"), (c("o_custkey") % 50 + 50).alias("mut"))
    right = c("left") + F.when(c("kind") == "ins", 1).otherwise((c("k") % 5).cast("int"))
    inserted = F.when(c("kind") == "del", "").otherwise(F.repeat(F.lit("A"), (1 + c("k") % 7).cast("int")))
    end = F.when(c("left") <= 2, "left").when(c("left") >= 29, "right")
    return rows.select("o_orderkey", "kind", "left", right.cast("int").alias("right"), inserted.alias("inserted"), end.alias("terminal_end"), "wt", "mut")


def positions(spark, sf_dir):
    """Places of a hundred proteins with an exposure and a class."""
    rows = table(spark, sf_dir, "lineitem").groupBy((c("l_partkey") % 100).alias("protein"), (c("l_orderkey") % 41).cast("int").alias("position")).agg(F.min("l_tax").alias("rsa"), F.max("l_returnflag").alias("f"), F.max("l_quantity").alias("q"), F.min("l_linestatus").alias("s"))
    return rows.where("position > 0").select("protein", "position", F.when(c("q") < 49, c("rsa")).alias("rsa"), F.when(c("q") > 20, F.when(c("s") == "O", "Surface").when(c("q") > 48, "Core").otherwise("Disorder")).alias("class"), (c("f") == "R").alias("bound"))


CHANGED = """
    ch AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'ins' WHEN 1 THEN 'del' ELSE 'sub' END AS kind, o_custkey % 30 + 1 AS l, o_custkey % 50 AS wt, o_custkey % 50 + 50 AS mut, 1 + o_orderkey % 7 AS n FROM orders),
    x AS (SELECT o_orderkey, kind, l, l + CASE kind WHEN 'ins' THEN 1 ELSE o_orderkey % 5 END AS r, CASE kind WHEN 'del' THEN 0 ELSE n END AS n, wt, mut, CASE WHEN l <= 2 THEN 'left' WHEN l >= 29 THEN 'right' ELSE '' END AS e FROM ch),
    sz AS (SELECT *, CASE kind WHEN 'ins' THEN n WHEN 'del' THEN r - l + 1 ELSE greatest(n, r - l + 1) END AS size FROM x), y AS (SELECT *, size // 2 + (size // 2) % 2 AS f FROM sz),
    pos AS (SELECT l_partkey % 100 AS protein, l_orderkey % 41 AS position, min(l_tax) AS rsa0, max(l_returnflag) AS fl, max(l_quantity) AS q, min(l_linestatus) AS s FROM lineitem WHERE l_orderkey % 41 > 0 GROUP BY ALL),
    po AS (SELECT protein, position, CASE WHEN q < 49 THEN rsa0 END AS rsa, CASE WHEN q > 20 THEN CASE WHEN s = 'O' THEN 'Surface' WHEN q > 48 THEN 'Core' ELSE 'Disorder' END END AS class, fl = 'R' AS bound FROM pos)"""


@query("indel_regions", f"""
    WITH {CHANGED},
    reg AS (SELECT o_orderkey, 'inside' AS region, 'wt' AS side, wt AS protein, l AS a, r AS b FROM y WHERE kind <> 'ins'
      UNION ALL SELECT o_orderkey, 'inside', 'mut', mut, CASE kind WHEN 'ins' THEN l + 1 ELSE l END, CASE kind WHEN 'ins' THEN l + 1 ELSE l END + n - 1 FROM y WHERE kind <> 'del'
      UNION ALL SELECT o_orderkey, 'left flank', 'wt', wt, CASE kind WHEN 'ins' THEN l + 1 ELSE l END - f, CASE kind WHEN 'ins' THEN l ELSE l - 1 END FROM y WHERE e <> 'left'
      UNION ALL SELECT o_orderkey, 'left flank', 'mut', mut, CASE kind WHEN 'ins' THEN l + 1 ELSE l END - f, CASE kind WHEN 'ins' THEN l ELSE l - 1 END FROM y WHERE e <> 'left'
      UNION ALL SELECT o_orderkey, 'right flank', 'wt', wt, CASE kind WHEN 'ins' THEN r ELSE r + 1 END, CASE kind WHEN 'ins' THEN r ELSE r + 1 END + f - 1 FROM y WHERE e <> 'right'
      UNION ALL SELECT o_orderkey, 'right flank', 'mut', mut, CASE kind WHEN 'ins' THEN r + size WHEN 'del' THEN l + 1 ELSE l + n + 1 END, CASE kind WHEN 'ins' THEN r + size WHEN 'del' THEN l + 1 ELSE l + n + 1 END + f - 1 FROM y WHERE e <> 'right')
    SELECT o_orderkey, region, side, count(*) AS n, round(avg(rsa), 6) AS rsa, round(count(class) / count(*), 6) AS class, round(avg(CASE WHEN bound THEN 1 ELSE 0 END), 6) AS bound
    FROM reg JOIN po USING (protein) WHERE position BETWEEN a AND b GROUP BY ALL""")  # fmt: skip
def indel_regions(spark, sf_dir):
    found = indels.region_features(changes(spark, sf_dir), positions(spark, sf_dir), ["o_orderkey"], {"rsa": "number", "class": "probability", "bound": "flag"})
    return found.select("o_orderkey", "region", "side", "n", *(F.round(x, 6).alias(x) for x in ("rsa", "class", "bound")))


@query("indel_flanks", f"""
    WITH {CHANGED},
    k AS (SELECT o_orderkey, 'l' AS s, class, count(*) AS n FROM y JOIN po ON protein = wt AND position BETWEEN l - 3 AND l WHERE class IS NOT NULL GROUP BY ALL UNION ALL SELECT o_orderkey, 'r', class, count(*) FROM y JOIN po ON protein = wt AND position BETWEEN r AND r + 3 WHERE class IS NOT NULL GROUP BY ALL),
    b AS (SELECT o_orderkey, s, arg_max(class, {{'n': n, 'c': class}}) AS c FROM k GROUP BY ALL),
    w AS (SELECT o_orderkey, (SELECT c FROM b WHERE b.o_orderkey = y.o_orderkey AND s = 'l') AS lc, (SELECT c FROM b WHERE b.o_orderkey = y.o_orderkey AND s = 'r') AS rc, kind, e <> '' AS terminal, wt % 3 AS nw, mut % 2 AS nm FROM y),
    z AS (SELECT *, lc IN ('Disorder', 'Surface') AS ln, rc IN ('Disorder', 'Surface') AS rn FROM w)
    SELECT o_orderkey, lc AS left_class, rc AS right_class, CASE WHEN lc IS NULL OR rc IS NULL THEN NULL WHEN lc = rc THEN CASE WHEN ln THEN 'Identical neutral' ELSE 'Identical potent' END WHEN ln AND rn THEN 'Transition neutral,neutral' WHEN ln OR rn THEN 'Transition neutral,potent' ELSE 'Transition potent,potent' END AS outcome,
      CASE WHEN nw = 0 AND nm = 0 THEN '' ELSE CASE WHEN terminal THEN 'FRC' ELSE 'FRA' END || CASE WHEN nm = 0 THEN CASE WHEN kind = 'ins' THEN '' ELSE ',InCl,CFRI' END WHEN nw = 0 THEN CASE WHEN kind = 'del' THEN '' ELSE ',InCl,CFRI' END ELSE ',InCl,CFRI,CFRA' END END AS analyses FROM z""")  # fmt: skip
def indel_flanks(spark, sf_dir):
    rows = changes(spark, sf_dir)
    found = indels.flank_outcomes(rows, positions(spark, sf_dir), ["o_orderkey"])
    which = rows.select("o_orderkey", F.array_join(indels.analyses("kind", c("terminal_end").isNotNull(), c("wt") % 3, c("mut") % 2), ",").alias("analyses"))
    return found.join(which, "o_orderkey").select("o_orderkey", "left_class", "right_class", "outcome", "analyses")


@query("delta_classes", """
    WITH o AS (SELECT l_suppkey AS protein, l_partkey % 90 AS position, min(l_returnflag) AS a, max(l_returnflag) AS w, max(CASE WHEN l_quantity > 25 THEN l_returnflag END) AS m, max(l_quantity) AS q FROM lineitem GROUP BY ALL),
    d AS (SELECT protein, count(*) FILTER (q <= 8 OR a IS DISTINCT FROM w) AS wt_delta, count(*) FILTER (q <= 20 OR a IS DISTINCT FROM m) AS mut_delta FROM o GROUP BY protein)
    SELECT protein, wt_delta, mut_delta, mut_delta - wt_delta AS delta_delta FROM d""")  # fmt: skip
def delta_classes(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("protein"), (c("l_partkey") % 90).alias("position")).agg(F.min("l_returnflag").alias("a"), F.max("l_returnflag").alias("w"), F.max(F.when(c("l_quantity") > 25, c("l_returnflag"))).alias("m"), F.max("l_quantity").alias("q"))
    own = lambda rows, x: rows.select("protein", "position", c(x).alias("class"))
    return indels.delta_delta(own(rows, "a"), own(rows.where("q > 8"), "w"), own(rows.where("q > 20"), "m"), ["protein"])
