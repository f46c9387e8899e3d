"""Fusion of what belongs together: interfaces, genes with a common name, changes of isoforms."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from residuum.operators.durable import EACH, cut, dealt

#: An interface joins a known one if more than this share of either is common.
OVERLAP = 0.5
FOLDED = "kind string, protein string, made int, number int, structure string, chain string, chain_b string, score double, position int, residue string"


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label): for each end of the edges the least id that a path leads to.

    Rounds of two steps on a table of (child, parent): every node's larger neighbours go to
    its least one, then every node's smaller ones do; the table ends as stars. Degrees are
    never gathered in one row: the least neighbour comes from an aggregate and a join.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    alone = pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    now = cut(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        after = cut(small)
        # stars: every parent is a root, and the table is as it was
        if after.exceptAll(now).limit(1).count() + now.exceptAll(after).limit(1).count() == 0:
            return alone.join(after.select(F.col("u").alias("id"), F.col("v").alias("label")), "id", "left").select("id", F.coalesce("label", "id").alias("label"))
        now = after


# interfaces


class _Known:
    """The interfaces of a protein so far: positions with their residues, and where each was best seen."""

    def __init__(self):
        self.made, self.positions, self.best, self.at, self.into = 0, {}, {}, {}, {}

    def add(self, source: tuple, score: float, rows: list[tuple]) -> int:
        """Take in an interface of a structure; the interface that it is in from now on."""
        common = Counter(k for position, _ in rows for k in self.at.get(position, ()))
        near = sorted(k for k, n in common.items() if n / len(rows) > OVERLAP or n / len(self.positions[k]) > OVERLAP)
        for k in near or [self._new(source, score)]:
            for position, residue in rows:
                self.at.setdefault(position, set()).add(k)
                if position not in self.positions[k] or score > self.best[k][0]:
                    self.positions[k][position] = (*source[:2], residue)
            if score > self.best[k][0]:
                self.best[k] = (score, source)
        for k in near[1:]:
            self._merge(near[0], k)
        return near[0] if near else self.made - 1

    def _new(self, source: tuple, score: float) -> int:
        k, self.made = self.made, self.made + 1
        self.positions[k], self.best[k], self.into[k] = {}, (score, source), k
        return k

    def _merge(self, first: int, other: int) -> None:
        """Both become the first; at positions that both have, the one of the lesser score stays."""
        lesser, greater = (first, other) if self.best[other][0] > self.best[first][0] else (other, first)
        best = self.best[greater]
        positions = self.positions[greater] | self.positions[lesser]
        for k in (first, other):
            del self.positions[k], self.best[k]
        self.positions[first], self.best[first], self.into[other] = positions, best, first
        for position in positions:
            at = self.at[position]
            if other in at:
                at.discard(other)
                at.add(first)

    def end(self, k: int) -> int:
        while self.into[k] != k:
            k = self.into[k]
        return k


def fold_interfaces(covered: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Interfaces of structures put together to interfaces of proteins, in the order of structure and chains.

    ``covered`` has a row for each residue of an interface with a position of the protein:
    (protein, structure, chain, chain_b, score, residue, position), ``score`` being that of
    the interface in its structure. An interface joins every known one of which, or of
    itself, over half is common; known ones that it so connects become one. The structure of
    the greatest score is recommended, and its residue at each position. Rows without a
    protein or position are left out.

    Returns interfaces (protein, number, structure, chain, chain_b, score), positions
    (protein, number, position, structure, chain, residue) and sources (protein, structure,
    chain, chain_b, number). A protein's rows are streamed in order: a task holds its
    interfaces, as large as its sequence allows, not the structures.
    """
    names = ("protein", "structure", "chain", "chain_b", "residue")
    rows = covered.where("protein IS NOT NULL AND position IS NOT NULL").select(*(F.col(n).cast("string").alias(n) for n in names), F.col("score").cast("double").alias("score"), F.col("position").cast("int").alias("position"))
    order = [F.asc_nulls_first(n) for n in ("protein", "structure", "chain", "chain_b", "position", "residue")]

    def run(batches):
        out, now, source, held, known = [], None, None, [], None

        def take():
            if held:
                made = known.add(source[1:], held[0][2], [(p, r) for p, r, _ in held])
                out.append(("source", now, made, None, *source[1:], None, None, None))
                held.clear()

        def give():
            take()
            if known is not None:
                number = {k: i for i, k in enumerate(sorted(known.best))}
                out.extend(("made", now, k, number[known.end(k)], None, None, None, None, None, None) for k in range(known.made))
                for k, (score, own) in known.best.items():
                    out.append(("interface", now, None, number[k], *own, score, None, None))
                    out.extend(("position", now, None, number[k], s, c, None, None, p, r) for p, (s, c, r) in known.positions[k].items())

        def batch():
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.string()]
            columns = list(zip(*out)) or [()] * len(kinds)
            found = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], names=[c.split(" ")[0] for c in FOLDED.split(", ")])
            out.clear()
            return found

        for rows_ in batches:
            for protein, structure, chain, chain_b, residue, score, position in zip(*(x.to_pylist() for x in rows_.columns)):
                if (protein, structure, chain, chain_b) != source:
                    take()
                    source_ = (protein, structure, chain, chain_b)
                    if protein != now:
                        give()
                        now, known = protein, _Known()
                    source = source_
                    if len(out) > 20_000:
                        yield batch()
                held.append((position, residue, score if score is not None else 0.0))
        give()
        yield batch()

    folded = cut(rows.repartition("protein").sortWithinPartitions(*order).mapInArrow(run, FOLDED))
    interfaces = folded.where("kind = 'interface'").select("protein", "number", "structure", "chain", "chain_b", "score")
    positions = folded.where("kind = 'position'").select("protein", "number", "position", "structure", "chain", "residue")
    made = folded.where("kind = 'made'").select("protein", "made", "number")
    sources = folded.where("kind = 'source'").drop("number").join(made, ["protein", "made"]).select("protein", "structure", "chain", "chain_b", "number")
    return interfaces, positions, sources


def interface_contacts(sources: DataFrame, contacts: DataFrame) -> DataFrame:
    """Contacts of positions across each fused interface: (protein, number, position, protein_b, position_b, structure, chain, chain_b, score).

    ``contacts``: (protein, structure, chain, chain_b, position, protein_b, position_b, score).
    Of several structures the contact of the greatest score stands, of ties the first.
    """
    own = contacts.join(sources, ["protein", "structure", "chain", "chain_b"])
    best = F.min(F.struct((-F.col("score")).alias("s"), "structure", "chain", "chain_b"))
    key = ["protein", "number", "position", "protein_b", "position_b"]
    return own.groupBy(*key).agg(best.alias("_x")).select(*key, "_x.structure", "_x.chain", "_x.chain_b", (-F.col("_x.s")).alias("score"))


def interface_components(covered: DataFrame, *, most: int = 100_000) -> DataFrame:
    """(protein, structure, chain, chain_b, label): interfaces that a chain of overlaps over half of either joins.

    Unlike the fold it does not depend on an order. Interfaces of equal positions are one
    from the start. No overlap leaves a protein, so rows are shuffled once, by it, and its
    interfaces are joined in the task that holds it. Proteins of more than ``most`` rows,
    which would be too much for a task, are joined by tables.
    """
    own = ["protein", "structure", "chain", "chain_b"]
    rows = covered.select(*own, "position").where("protein IS NOT NULL AND position IS NOT NULL")
    sizes = cut(rows.groupBy("protein").agg(F.count("*").alias("c")))
    large = sizes.where(F.col("c") > most).select("protein")
    n = sizes.agg(F.sum("c")).first()[0] or 0
    if not large.limit(1).count():
        return _components_in_tasks(rows, n)
    large = F.broadcast(large)  # one for each ``most`` rows at most
    return _components_in_tasks(rows.join(large, "protein", "left_anti"), n).unionByName(_components_by_tables(rows.join(large, "protein", "left_semi")))


def _interfaces(rows: DataFrame) -> DataFrame:
    """(protein, structure, chain, chain_b, set, id): the positions of each interface, and what those of equal positions have in common."""
    sets = rows.groupBy("protein", "structure", "chain", "chain_b").agg(F.array_sort(F.collect_set("position")).alias("set"))
    return sets.withColumn("id", F.md5(F.concat_ws(",", F.col("protein").cast("string"), F.lit(":"), F.col("set").cast("array<string>"))))


def _joined(sets: dict[str, list]) -> dict[str, str]:
    """The least id that overlaps lead to, for each set of one protein.

    If more than half of a set is common with another, the other has one of any half of its
    positions: the rarest half of each is looked up, in sets that are not yet joined with it.
    """
    into = {k: k for k in sets}

    def end(k: str) -> str:
        while into[k] != k:
            into[k] = k = into[into[k]]
        return k

    whole, at = {k: set(v) for k, v in sets.items()}, {}
    for k, v in sets.items():
        for position in v:
            at.setdefault(position, []).append(k)
    for k, v in sets.items():
        seen = {k}
        for position in sorted(v, key=lambda p: len(at[p]))[: len(v) - int(len(v) * OVERLAP)]:
            for other in at[position]:
                if other in seen:
                    continue
                seen.add(other)
                x, y = end(k), end(other)
                if x != y and len(whole[k] & whole[other]) > OVERLAP * min(len(v), len(whole[other])):
                    into[max(x, y)] = min(x, y)
    return {k: end(k) for k in sets}


def _components_in_tasks(rows: DataFrame, n: int) -> DataFrame:
    """Labels of the interfaces of whole proteins, ``n`` rows in all, streamed protein after protein."""
    found = _interfaces(dealt(rows, max(1, -(-n // EACH)), "protein")).sortWithinPartitions("protein")
    out = found.select("protein", "structure", "chain", "chain_b", F.col("id").alias("label"))

    def run(batches):
        held, sets, now = [], {}, None

        def given():
            label = _joined(sets)
            table = pa.Table.from_batches(held)
            return table.set_column(4, "label", pa.array([label[k] for k in table.column(4).to_pylist()], pa.string())).combine_chunks().to_batches()

        for batch in batches:
            proteins, start = batch.column(0).to_pylist(), 0
            ids, positions = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            kept = batch.select([0, 1, 2, 3, 4])
            for i, (protein, k, v) in enumerate(zip(proteins, ids, positions)):
                # several proteins are given at once: their ids differ, and so do the sets that meet
                if protein != now:
                    if len(sets) >= 2_000:
                        held.append(kept.slice(start, i - start))
                        yield from given()
                        held, sets, start = [], {}, i
                    now = protein
                sets[k] = [(protein, p) for p in v]
            held.append(kept.slice(start))
        if held:
            yield from given()

    return found.select("protein", "structure", "chain", "chain_b", "id", "set").mapInArrow(run, out.schema)


def _components_by_tables(rows: DataFrame) -> DataFrame:
    """The same for proteins of any size: the rarest half of each interface meets all positions of
    the others, so that positions that most have bring few pairs."""
    own = ["protein", "structure", "chain", "chain_b"]
    sets = cut(_interfaces(rows))
    each = sets.groupBy("id").agg(F.first("protein").alias("protein"), F.first("set").alias("set"))
    members = cut(each.select("id", "protein", F.size("set").alias("n"), F.explode("set").alias("position")))
    common = members.groupBy("protein", "position").agg(F.count("*").alias("c"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("c", "position"))
    rare = members.join(common, ["protein", "position"]).withColumn("i", rank).where(F.col("i") <= F.col("n") - F.floor(F.col("n") * OVERLAP))
    met = rare.select("protein", "position", F.col("id").alias("a")).join(members.select("protein", "position", F.col("id").alias("b")), ["protein", "position"]).where("a <> b").select("a", "b").distinct()
    left, right = (each.select(F.col("id").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    edges = met.join(left, "a").join(right, "b").where(shared > OVERLAP * F.least(F.size("set_a"), F.size("set_b"))).select("a", "b")
    label = components(edges).withColumnRenamed("label", "least")
    return sets.join(label, "id", "left").select(*own, F.coalesce("least", "id").alias("label"))


# genes


def fused_genes(names: DataFrame, isoforms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Genes that share a name, directly or by way of others, as one.

    ``names`` (gene, name) and ``isoforms`` (gene, isoform) give (gene, fused, fused_id), the
    ids of a fused gene being joined by ``|``, and (fused, isoform_a, isoform_b) for isoforms
    of different genes that have become one, in both directions.
    """
    rows = gene_labels(names, isoforms)
    ids = fused_ids(rows)
    several = rows.join(ids.where("n > 1"), "fused").join(isoforms.distinct(), "gene").select("fused", "gene", "isoform")
    other = several.select("fused", F.col("gene").alias("gene_b"), F.col("isoform").alias("isoform_b"))
    pairs = several.join(other, "fused").where("gene <> gene_b AND isoform <> isoform_b").select("fused", F.col("isoform").alias("isoform_a"), "isoform_b").distinct()
    return rows.join(ids, "fused").select("gene", "fused", "fused_id"), pairs


def gene_labels(names: DataFrame, isoforms: DataFrame) -> DataFrame:
    """(gene, fused): each gene with the least gene that common names lead to."""
    known = names.where("gene IS NOT NULL AND name IS NOT NULL")
    first = known.groupBy("name").agg(F.min("gene").alias("a"))
    label = components(known.join(first, "name").select("a", F.col("gene").alias("b")))
    genes = names.select("gene").unionByName(isoforms.select("gene")).where("gene IS NOT NULL").distinct()
    return cut(genes.join(label, genes["gene"] == label["id"], "left").select("gene", F.coalesce("label", "gene").alias("fused")))


def fused_ids(rows: DataFrame) -> DataFrame:
    """(fused, fused_id, n) of labelled genes (gene, fused): their ids joined by ``|``, and how many they are."""
    return rows.groupBy("fused").agg(F.array_join(F.transform(F.array_sort(F.collect_list("gene")), lambda g: g.cast("string")), "|").alias("fused_id"), F.count("*").alias("n"))


def isoform_partners(rows: DataFrame, isoforms: DataFrame) -> DataFrame:
    """(fused, isoform, n_partners): with how many isoforms each isoform is in a pair of ``fused_genes``.

    Two isoforms of a fused gene are no pair only if both belong to the same gene and to no
    other one. So the pairs, which grow with the square of a fused gene, need not be made:
    an isoform has all others but those that its only gene has alone. ``rows``: (gene, fused).
    """
    own = isoforms.where("isoform IS NOT NULL").select("gene", "isoform").distinct().join(rows, "gene")
    each = own.groupBy("fused", "isoform").agg(F.when(F.count("*") == 1, F.min("gene")).alias("only"))
    whole = each.groupBy("fused").agg(F.count("*").alias("_n"))
    alone = each.where("only IS NOT NULL").groupBy("fused", "only").agg(F.count("*").alias("_s"))
    met = each.join(whole, "fused").join(alone, ["fused", "only"], "left")
    return met.select("fused", "isoform", (F.col("_n") - F.coalesce("_s", F.lit(1))).alias("n_partners"))


# changes


def fused_changes(changes: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Deletions, substitutions and insertions of all isoforms put together, and the single changes outside of them.

    ``changes`` has (keys, kind, left, right, inserted): kind ``snv`` (at ``left``), ``del``,
    ``sub`` or ``ins``. Deletions and substitutions that share a place become one, a
    substitution if one of them is, with the longest of the inserted sequences (of ties the
    least); an insertion within such a range goes, and of insertions at one place the longest
    stays. Returns (keys, kind, left, right, inserted) of the fused ones, and the single
    changes, one for each place, that no range covers.
    """
    own = Window.partitionBy(*keys).orderBy("left", "right", "kind", "inserted")
    ranges = changes.where(F.col("kind").isin("del", "sub"))
    reach = F.max("right").over(own.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.coalesce((F.col("left") > F.col("_reach")).cast("int"), F.lit(1))).over(own.rowsBetween(Window.unboundedPreceding, 0))
    longest = F.min_by("inserted", F.struct(-F.length("inserted"), "inserted"))
    is_sub = F.col("kind") == "sub"
    fused = ranges.withColumn("_reach", reach).withColumn("_run", run).groupBy(*keys, "_run").agg(
        F.when(F.max(is_sub), "sub").otherwise("del").alias("kind"), F.min("left").alias("left"), F.max("right").alias("right"),
        F.min_by(F.when(is_sub, F.col("inserted")), F.when(is_sub, F.struct(-F.length("inserted"), "inserted"))).alias("inserted")).drop("_run")
    fused = cut(fused)
    inserted = changes.where("kind = 'ins'").groupBy(*keys, "left").agg(F.lit("ins").alias("kind"), F.min_by("right", F.struct(-F.length("inserted"), "inserted")).alias("right"), longest.alias("inserted"))
    single = changes.where("kind = 'snv'").groupBy(*keys, "left").agg(F.min("inserted").alias("inserted"), F.lit("snv").alias("kind"), F.col("left").alias("right"))
    columns = [*keys, "kind", "left", "right", "inserted"]
    return fused.select(*columns).unionByName(outside(inserted, fused, keys).select(*columns)), outside(single, fused, keys).select(*columns)


def outside(rows: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (keys, left, right) that lie within none of ``ranges``, which do not overlap each other.

    Both are put in one order: the last range that starts at or before a row is the only one
    that can hold it. So a row meets one range, whatever the ranges' lengths.
    """
    marks = ranges.select(*keys, F.col("left").alias("_at"), F.col("right").alias("_end"), F.lit(None).alias("_row"))
    marked = rows.select(*keys, F.col("left").alias("_at"), F.lit(None).cast("int").alias("_end"), F.struct(*rows.columns).alias("_row"))
    order = Window.partitionBy(*keys).orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = marks.unionByName(marked).withColumn("_last", F.last("_end", ignorenulls=True).over(order)).where(F.col("_row").isNotNull())
    return found.where(F.col("_last").isNull() | (F.col("_row.right") > F.col("_last"))).select("_row.*")


def isoform_columns(majors: DataFrame, isoforms: DataFrame, insertions: DataFrame, deletions: DataFrame) -> DataFrame:
    """(gene, isoform, aligned): all isoforms of a gene in common columns, by their lists of changes.

    ``majors`` (gene, sequence), ``isoforms`` (gene, isoform, sequence), ``insertions``
    (gene, isoform, position, length: letters put in after that place of the major sequence,
    0 before the first), ``deletions`` (gene, isoform, position). After each place there are
    as many columns as the longest insertion there; shorter ones are filled with gaps. The
    row of the major sequence has a null isoform. Where an isoform's letters end too early,
    gaps follow.
    """
    longest = insertions.where("gene IS NOT NULL AND position >= 0").groupBy("gene", "position").agg(F.max("length").alias("gap"))
    gaps = longest.groupBy("gene").agg(F.map_from_entries(F.collect_list(F.struct("position", "gap"))).alias("gaps"))
    columns = majors.select("gene", "sequence").where("sequence IS NOT NULL").join(gaps, "gene", "left")
    columns = columns.withColumn("columns", F.transform(F.sequence(F.lit(0), F.length("sequence")), lambda p: F.struct(F.when(p > 0, F.substring("sequence", p, F.lit(1))).otherwise("").alias("letter"), F.coalesce(F.try_element_at("gaps", p), F.lit(0)).alias("gap")))).select("gene", "columns")
    # all that is known of an isoform is put together before it meets its gene: one row each
    none = F.lit(None)
    own = isoforms.select("gene", "isoform", F.col("sequence").alias("own"), none.cast("struct<position:int,length:int>").alias("put_in"), none.cast("int").alias("gone"))
    put = insertions.select("gene", "isoform", none.cast("string").alias("own"), F.struct(F.col("position").cast("int").alias("position"), F.col("length").cast("int").alias("length")).alias("put_in"), none.cast("int").alias("gone"))
    lost = deletions.select("gene", "isoform", none.cast("string").alias("own"), none.cast("struct<position:int,length:int>").alias("put_in"), F.col("position").cast("int").alias("gone"))
    known = own.unionByName(put).unionByName(lost).groupBy("gene", "isoform").agg(F.max("own").alias("own"), F.collect_set("put_in").alias("put_in"), F.collect_set("gone").alias("gone")).where("own IS NOT NULL")
    rows = known.join(columns, "gene")
    length = lambda p: F.coalesce(F.array_max(F.transform(F.filter("put_in", lambda x: x["position"] == p), lambda x: x["length"])), F.lit(0))

    def after(state, column):
        p = state["place"]
        kept = ((p > 0) & ~F.array_contains("gone", p)).cast("int")
        n = length(p)
        letter = F.when(p == 0, "").when(kept == 1, F.rpad(F.substring("own", state["at"] + 1, F.lit(1)), 1, "-")).otherwise("-")
        put_in = F.rpad(F.substring("own", state["at"] + 1 + kept, n), column["gap"], "-")
        return F.struct((p + 1).alias("place"), (state["at"] + kept + n).alias("at"), F.concat(state["text"], letter, put_in).alias("text"))

    start = F.struct(F.lit(0).alias("place"), F.lit(0).alias("at"), F.lit("").alias("text"))
    aligned = rows.select("gene", "isoform", F.aggregate("columns", start, after, lambda s: s["text"]).alias("aligned"))
    major = F.array_join(F.transform("columns", lambda x: F.concat(x["letter"], F.rpad(F.lit(""), x["gap"], "-"))), "")
    return aligned.unionByName(columns.select("gene", F.lit(None).cast(isoforms.schema["isoform"].dataType).alias("isoform"), major.alias("aligned")))
