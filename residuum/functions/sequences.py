"""Amino-acid changes, tags, indels and aligned pairs, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from residuum.functions.scores import col

# Three-letter names, the genetic code in the order TCAG, property classes.
THREE_TO_ONE = {
    "ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I",
    "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V",
}
BASES = "TCAG"
CODE = "FFLLSSSSYY__CC_WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
PROPERTIES = {
    "aliphatic": "ILV",
    "hydrophobic": "ILVMFYWHKTCUAG",
    "aromatic": "FYWH",
    "positive": "HKR",
    "polar": "YWHKTCUDESNQ",
    "negative": "DE",
    "charged": "HKRDE",
    "small": "PGCUASNDTV",
    "tiny": "GCUAS",
}
HYDROPATHY = {
    "I": 4.5, "V": 4.2, "L": 3.8, "F": 2.8, "C": 2.5, "M": 1.9, "A": 1.8, "G": -0.4, "T": -0.7, "S": -0.8,
    "W": -0.9, "Y": -1.3, "P": -1.6, "H": -3.2, "E": -3.5, "Q": -3.5, "D": -3.5, "N": -3.5, "K": -3.9, "R": -4.5,
}

# Volumes of the letters in cubic Å.
VOLUME = {
    "I": 166.7, "V": 140.0, "L": 166.7, "F": 189.9, "C": 108.5, "U": 108.5, "M": 162.9, "A": 88.6, "G": 60.1, "T": 116.1, "S": 89.0,
    "W": 227.8, "Y": 193.6, "P": 112.7, "H": 153.2, "E": 138.4, "Q": 143.8, "D": 111.1, "N": 114.1, "K": 168.6, "R": 173.4, "X": 150.0,
}


def as_map(table: dict[str, object]) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def three_to_one(name: Column | str) -> Column:
    """One letter for a three-letter name in any case; X for another."""
    return F.coalesce(as_map(THREE_TO_ONE)[F.upper(col(name))], F.lit("X"))


def parse_change(text: Column | str) -> Column:
    """``A123B`` as (wt, pos, mut); ``123B`` has wild type X, ``A123`` no mutant. Else null."""
    text = col(text)
    part = lambda i: F.regexp_extract(text, r"^([A-Z]?)(-?[0-9]+)_?([A-Z]?)$", i)
    none = lambda c, default: F.when(c == "", default).otherwise(c)
    return F.when(part(2) != "", F.struct(none(part(1), F.lit("X")).alias("wt"), part(2).cast("int").alias("pos"), none(part(3), F.lit(None)).alias("mut")))


def parse_hgvs(text: Column | str) -> Column:
    """``p.Arg12His`` as (wt, pos, mut)."""
    part = lambda i: F.regexp_extract(col(text), r"^p\.\(?([A-Z][a-z]{2})([0-9]+)([A-Z][a-z]{2})\)?$", i)
    return F.when(part(2) != "", F.struct(three_to_one(part(1)).alias("wt"), part(2).cast("int").alias("pos"), three_to_one(part(3)).alias("mut")))


def parse_indel(text: Column | str) -> Column:
    """(kind, left, right, inserted) of ``A10_G12delinsGG``, ``A10_G12del``, ``A10del``, ``A10_C11insGG``; else null.

    Tried in that order, for the longer notation holds the shorter ones.
    """
    text = col(text)
    pattern = r"^[A-Z]?([0-9]+)(?:_[A-Z]?([0-9]+))?(delins|del|ins)([A-Z]*)$"
    part = lambda i: F.regexp_extract(text, pattern, i)
    left = part(1).try_cast("int")
    right = F.coalesce(part(2).try_cast("int"), left)
    kind = F.when(part(3) == "delins", "substitution").when(part(3) == "del", "deletion").when(part(3) == "ins", "insertion")
    return F.when(kind.isNotNull(), F.struct(kind.alias("kind"), left.alias("left"), right.alias("right"), part(4).alias("inserted")))


def indel_notation(indel: Column | str, sequence: Column | str) -> Column:
    """The notation of an indel with the letters of its flanks."""
    x, s = col(indel), col(sequence)
    flank = lambda p: F.concat(F.substring(s, p, F.lit(1)), p.cast("string"))
    ends = F.when(x["left"] == x["right"], flank(x["left"])).otherwise(F.concat_ws("_", flank(x["left"]), flank(x["right"])))
    return F.concat(ends, F.when(x["kind"] == "substitution", "delins").when(x["kind"] == "deletion", "del").otherwise("ins"), x["inserted"])


def apply_indel(sequence: Column | str, indel: Column | str) -> Column:
    """The sequence with an indel: letters between the flanks of an insertion, else in place of them."""
    s, x = col(sequence), col(indel)
    is_insertion = x["kind"] == "insertion"
    head = F.substring(s, F.lit(1), F.when(is_insertion, x["left"]).otherwise(x["left"] - 1))
    tail = F.substring(s, F.when(is_insertion, x["left"] + 1).otherwise(x["right"] + 1), F.length(s))
    return F.concat(head, x["inserted"], tail)


def apply_change(sequence: Column | str, pos: Column | str, mut: Column | str) -> Column:
    """The sequence with another letter at a place counted from one."""
    return F.overlay(col(sequence), col(mut), col(pos), F.lit(1))


def apply_changes(sequence: Column | str, changes: Column | str) -> Column:
    """Substitutions (pos, mut) applied from the right end, places counted from one."""
    ordered = F.reverse(F.array_sort(col(changes)))
    return F.aggregate(ordered, col(sequence), lambda s, x: F.concat(F.substring(s, F.lit(1), x["pos"] - 1), x["mut"], F.substring(s, x["pos"] + 1, F.length(s))))


def affected_positions(indel: Column | str) -> Column:
    """Places that a deletion or substitution takes out, in order; none for an insertion."""
    x = col(indel)
    return F.when(x["kind"] == "insertion", F.array().cast("array<int>")).otherwise(F.sequence(x["left"], x["right"]))


def translate(bases: Column | str) -> Column:
    """Protein of a coding sequence, up to the first stop; X for a codon that is none."""
    s = F.upper(F.regexp_replace(col(bases), "U", "T"))
    codons = F.when(F.length(s) >= 3, F.transform(F.sequence(F.lit(0), (F.length(s) / 3).cast("int") - 1), lambda i: F.substring(s, i * 3 + 1, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    digit = lambda c, i: F.instr(F.lit(BASES), F.substring(c, i, 1))
    index = lambda c: (digit(c, 1) - 1) * 16 + (digit(c, 2) - 1) * 4 + digit(c, 3)
    known = lambda c: c.rlike("^[TCAG]{3}$")
    letters = F.transform(codons, lambda c: F.when(known(c), F.substring(F.lit(CODE), index(c), F.lit(1))).otherwise("X"))
    return F.substring_index(F.array_join(letters, ""), "_", 1)


def is_valid_sequence(sequence: Column | str) -> Column:
    """At least five different letters."""
    return F.size(F.array_distinct(F.split(F.coalesce(col(sequence), F.lit("")), ""))) >= 5


def is_mutant_accession(accession: Column | str) -> Column:
    """Names of mutants carry ``del`` or ``ins``, but not equally many of both."""
    return F.regexp_count(col(accession), F.lit("del")) != F.regexp_count(col(accession), F.lit("ins"))


def identity_and_coverage(target: Column | str, template: Column | str, full_length: Column | str) -> Column:
    """(identity, coverage) of an aligned pair: equal letters and aligned letters.

    Identity is over places where neither has a gap, coverage over the full length.
    """
    pairs = F.arrays_zip(F.split(col(target), "").alias("a"), F.split(col(template), "").alias("b"))
    both = F.filter(pairs, lambda p: (p["a"] != "-") & (p["b"] != "-") & (p["a"] != "") & (p["b"] != ""))
    n = F.size(both)
    same = F.size(F.filter(both, lambda p: p["a"] == p["b"]))
    return F.struct(F.when(n > 0, same / n).alias("identity"), (n / col(full_length)).alias("coverage"))


def aligned_places(target: Column | str, template: Column | str) -> Column:
    """Array of (target place, template place) where both have a letter, counted from one."""
    a, b = F.split(col(target), ""), F.split(col(template), "")
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.array().cast("array<struct<i:int,j:int>>").alias("out"))

    def step(s: Column, p: Column) -> Column:
        i = s["i"] + ((p["a"] != "-") & (p["a"] != "")).cast("int")
        j = s["j"] + ((p["b"] != "-") & (p["b"] != "")).cast("int")
        both = (p["a"] != "-") & (p["b"] != "-") & (p["a"] != "") & (p["b"] != "")
        return F.struct(i.alias("i"), j.alias("j"), F.when(both, F.concat(s["out"], F.array(F.struct(i.alias("i"), j.alias("j"))))).otherwise(s["out"]).alias("out"))

    return F.aggregate(F.arrays_zip(a.alias("a"), b.alias("b")), start, step, lambda s: s["out"])


def tag_value(tags: Column | str, key: str) -> Column:
    """Number of the last tag ``key=value`` or ``key:value`` in a list of tags; null if there is none."""
    own = F.filter(col(tags), lambda t: t.rlike(rf"^#?{key}[=:]"))
    return F.regexp_extract(F.element_at(own, -1), r"[=:](.*)$", 1).try_cast("double")


def tag_text(tags: Column | str, key: str, default: str | None = None) -> Column:
    """Text of the first tag ``key:value``, or a default."""
    own = F.filter(col(tags), lambda t: t.startswith(f"{key}:"))
    return F.coalesce(F.substring_index(F.get(own, F.lit(0)), ":", -1), F.lit(default))


def function_type(tags: Column | str) -> Column:
    return tag_text(tags, "function", "OrganismalFitness")


def property_changes(wt: Column | str, mut: Column | str, *, charged_as_published: bool = True) -> Column:
    """A flag for each property class that one letter has and the other lacks, and their number without ``tiny``.

    The published charged flag tests the mutant among the negative letters only;
    ``charged_as_published=False`` tests both among the charged.
    """
    flags = {}
    for name, letters in PROPERTIES.items():
        other = PROPERTIES["negative"] if name == "charged" and charged_as_published else letters
        flags[name] = (F.instr(F.lit(letters), col(wt)) > 0) != (F.instr(F.lit(other), col(mut)) > 0)
    total = sum((f.cast("int") for n, f in flags.items() if n != "tiny"), F.lit(0))
    return F.struct(*(f.alias(n) for n, f in flags.items()), total.alias("total"))


def hydropathy_change(wt: Column | str, mut: Column | str) -> Column:
    return F.abs(as_map(HYDROPATHY)[col(wt)] - as_map(HYDROPATHY)[col(mut)])


def chunk_of(accession: Column | str) -> Column:
    """Partition key of a model store, from the last two characters of an accession: each one that
    is a digit stays, the second as the even number at or below it; another is an underscore."""
    first, second = F.substring(col(accession), -2, 1), F.substring(col(accession), -1, 1)
    digit = lambda c: c.rlike("^[0-9]$")
    even = F.when(digit(first) & digit(second), ((second.try_cast("int") / 2).cast("int") * 2).cast("string")).when(digit(second), second).otherwise("_")
    return F.concat(F.when(digit(first), first).otherwise("_"), even)


def interface_key(positions: Column | str) -> Column:
    """Number made of least and greatest place and their number; differing sets may share it."""
    p = F.transform(col(positions), lambda x: x.cast("long"))
    return (F.array_min(p) * F.lit(1_000_000_000) + F.array_max(p) * F.lit(10_000) + F.size(p)).cast("long")


def known_stretches(sequence: Column | str, *, unknown: str = "X", least: int = 10) -> Column:
    """Stretches of at least ``least`` known letters, with their starts from 0: an array of (start, letters).

    Shorter ones between unknown letters count as unknown. A sequence without any unknown
    letter is one stretch, however short.
    """
    pattern = f"[^{unknown}]{{{least},}}"
    gaps, found = F.split(col(sequence), pattern, -1), F.regexp_extract_all(col(sequence), F.lit(f"({pattern})"), F.lit(1))
    each = F.arrays_zip(F.transform(F.slice(gaps, F.lit(1), F.size(found)), lambda g: F.length(g)).alias("gap"), found.alias("letters"))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,letters:string>>").alias("out"))
    placed = F.aggregate(each, start, lambda s, x: F.struct((s["end"] + x["gap"] + F.length(x["letters"])).alias("end"), F.concat(s["out"], F.array(F.struct((s["end"] + x["gap"]).alias("start"), x["letters"].alias("letters")))).alias("out")), lambda s: s["out"])
    whole = F.array(F.struct(F.lit(0).alias("start"), col(sequence).alias("letters")))
    return F.when(~col(sequence).contains(unknown) & (F.length(col(sequence)) > 0), whole).otherwise(placed)


def unknown_portions(sequence: Column | str, *, unknown: str = "X", least: int = 10) -> Column:
    """What is between the known stretches: an array of (first, end), end exclusive."""
    known = F.concat(known_stretches(sequence, unknown=unknown, least=least), F.array(F.struct(F.length(col(sequence)).alias("start"), F.lit("").alias("letters"))))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<first:int,end:int>>").alias("out"))
    add = lambda s, x: F.struct((x["start"] + F.length(x["letters"])).alias("end"), F.when(x["start"] > s["end"], F.concat(s["out"], F.array(F.struct(s["end"].alias("first"), x["start"].alias("end"))))).otherwise(s["out"]).alias("out"))
    return F.aggregate(known, start, add, lambda s: s["out"])


def fused_alignment(a: Column | str, b: Column | str) -> Column:
    """Letters of the first of two sequences of one length, and those of the other where it has a gap."""
    return F.array_join(F.zip_with(F.split(col(a), ""), F.split(col(b), ""), lambda x, y: F.when(x == "-", y).otherwise(x)), "")


def trimmed(target: Column | str, template: Column | str, buffer: int = 0) -> Column:
    """Both aligned sequences without the columns where the template only begins or ends, but for ``buffer`` of these, and how many went on the left: (target, template, left)."""
    target, template = col(target), col(template)
    lead, tail = F.length(F.regexp_extract(template, "^-*", 0)), F.length(F.regexp_extract(template, "-*$", 0))
    left, right = F.greatest(lead - buffer, F.lit(0)), F.greatest(tail - buffer, F.lit(0))
    length = F.greatest(F.length(template) - left - right, F.lit(0))
    return F.struct(F.substring(target, left + 1, length).alias("target"), F.substring(template, left + 1, length).alias("template"), left.alias("left"))


def moved(positions: Column | str, left: Column | str) -> Column:
    """Positions of a whole sequence in one that lost ``left`` letters in front; null stays."""
    return F.transform(col(positions), lambda p: p - col(left))


def volume_change(wt: Column | str, mut: Column | str) -> Column:
    """Difference of the volumes of two letters in cubic Å."""
    return F.abs(as_map(VOLUME)[col(wt)] - as_map(VOLUME)[col(mut)])


def adler32(text: Column | str) -> Column:
    """Adler-32 checksum of a text's UTF-8 bytes; null for null."""
    pairs = F.regexp_extract_all(F.hex(F.encode(col(text), "UTF-8")), F.lit("(..)"), F.lit(1))
    start = F.struct(F.lit(1).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))

    def step(s: Column, x: Column) -> Column:
        low = (s["low"] + F.conv(x, 16, 10).cast("long")) % 65521
        return F.struct(low.alias("low"), ((s["high"] + low) % 65521).alias("high"))

    return F.aggregate(pairs, start, step, lambda s: s["high"] * 65536 + s["low"])


def homomers(text: Column | str) -> Column:
    """``AB,C`` as an array of (chain, equal chains): every chain with those of its group, itself among them."""
    groups = F.filter(F.split(col(text), ","), lambda g: g != "")
    each = lambda g: F.transform(F.split(g, ""), lambda c: F.struct(c.alias("chain"), F.split(g, "").alias("chains")))
    return F.flatten(F.transform(groups, each))


def homomer_text(pairs: Column | str) -> Column:
    """The inverse: each group once, in the order of its first chain."""
    return F.array_join(F.array_distinct(F.transform(col(pairs), lambda p: F.array_join(p["chains"], ""))), ",")


def recommendation_text(structure: Column | str, residue: Column | str, identity: Column | str, coverage: Column | str, resolution: Column | str) -> Column:
    """``1abc:A 12:G;0.90;1.00;2.1``: structure and residue with identity and coverage to two places and resolution to one, a dash where that is null; null without a structure."""
    number = lambda x, f: F.coalesce(F.format_string(f, col(x).cast("double")), F.lit("-"))
    shown = lambda x, f: F.when(col(x).isNotNull(), number(x, f)).otherwise("-")
    return F.when(col(structure).isNotNull(), F.concat_ws(";", F.concat_ws(" ", col(structure), col(residue)), shown(identity, "%.2f"), shown(coverage, "%.2f"), shown(resolution, "%.1f")))
