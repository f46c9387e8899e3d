"""Line deduplication by an exact set-similarity join. DataFrame functions only.

A line is the set of its lower-cased words. It goes if an earlier line (by document, then
place) has Jaccard similarity of ``threshold`` or more to it; lines are judged on the input.

Equal sets are one line from the start, that of the earliest. Tokens are ordered by rarity,
as a table of ``1 << BUCKETS`` counts has it, in the order of 56 further bits of their hashes:
any common order is exact, a good one is fast. Two similar sets share a token of their
prefixes, and a join on these, with the length, the positional and a bitmap filter, gives the
candidates, whose Jaccard is then computed on their words.

How many lines have a token in their prefix is counted exactly, once prefixes are known. A
prefix token of more than ``FREQUENT`` lines would join too many: it keys no line, and a line
with such a token is keyed by parts of its set as well: tokens are dealt by hash to one part more than similar
sets of its length can differ in tokens, so one part is the same in both. A part has some
tokens each, so its key is rare, however frequent they are, and a line has about as many parts
as prefix tokens. Lengths go in tiers, each twice the one before, with as many parts as its
longest sets need; near the end of its tier a line has the parts of the next as well.

Lines that vary one line would meet by the square even so: each line first meets the earliest
line with its rarest or second rarest token, and what that removes has no need to look for
another; it only stays there for others to meet.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residuum.llm.common import cut, free_name, freed, quoted

THRESHOLD = 0.9
#: log2 of the counts of the rarity table.
BUCKETS = 16
#: Tokens of more lines than this key no line; the first tier; sets up to this size are parted within their row.
FREQUENT, TIER, LONG = 1024, 8, 256
#: Lines with a token from which on they first meet the earliest of them.
FAMILY = 32
#: Tokens of a line, from the rarest, that its bitmap shows.
SHOWN = 32
#: Rows up to which a table is small enough to broadcast; they are counted.
FEW = 200_000
#: Low bits of a word's hash that are sent along for a pair at first.
SENT_BITS = 15
#: log2 of the bits of a filter of ids or lines, at least and at most.
ID_BITS, MOST_BITS = 20, 25


def _settled(df: DataFrame) -> DataFrame:
    """``df`` materialised; what that took goes from the disks."""
    df = cut(df)
    freed(df.sparkSession)
    return df


def words(text: Column) -> Column:
    """Lower-cased runs of what is not a space, tab, line feed or carriage return."""
    text = F.lower(text)
    for c in "\t\r\n":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


def has_word(line: Column) -> Column:
    return line.rlike(r"[^ \t\r]")


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, pos, line) of every row with an id and a text."""
    rows = docs.where(F.col(quoted(id_col)).isNotNull() & F.col(quoted(text_col)).isNotNull())
    return rows.select(F.col(quoted(id_col)).cast("long").alias("doc"), F.posexplode(F.split(F.col(quoted(text_col)), "\n", -1)).alias("pos", "line"))


def rarity(docs: DataFrame, text_col: str) -> Column:
    """An array with a number for each bucket of tokens: four times the logarithm of how many
    tokens are in the bucket. Tokens are told apart roughly here."""
    rough = F.split(F.replace(F.lower(F.col(quoted(text_col))), F.lit("\n"), F.lit(" ")), " ", -1)
    counts = docs.select(F.explode(rough).alias("t")).groupBy(_bucket(F.xxhash64("t")).alias("b")).count().collect()
    table = [0] * (1 << BUCKETS)
    for b, n in counts:
        table[b] = rank(n)
    return F.split(F.lit(",".join(map(str, table))), ",", -1).cast("array<tinyint>")  # folded to one literal


def rank(n: int) -> int:
    return min(127, int(4 * log2(n + 1)))


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BUCKETS).cast("int")


def keys(tokens: Column, table: Column) -> Column:
    """Distinct tokens as numbers in order of rarity: rank in the first byte, then the hash."""
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))
    return F.sort_array(F.array_distinct(F.transform(hashes, lambda h: F.call_function("shiftleft", F.get(table, _bucket(h)).cast("long"), F.lit(56)) + F.shiftrightunsigned(h, 8))))


def bitmap(k: Column) -> Column:
    """64 bits that the ``SHOWN`` rarest tokens mark.

    A fold over the tokens: spelled out, the terms make a method too long for the JVM to compile.
    """
    mark = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(F.slice(k, 1, SHOWN), F.lit(0).cast("long"), lambda bits, t: bits.bitwiseOR(mark(t)))


def at_least(threshold: float, n: Column) -> Column:
    """The least whole number that is ``threshold`` times n or more."""
    return F.ceil(F.lit(threshold) * n - 1e-9).cast("int")


def first_lines(docs: DataFrame, table: Column, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(doc, pos, n, prefix, bits, set): of all lines with equal word sets the earliest; ``set`` is a hash of the words."""
    rows = lines_of(docs, id_col, text_col).where(has_word(F.col("line"))).select("doc", "pos", keys(words(F.col("line")), table).alias("k"))
    n = F.size("k")
    width = F.when(n * (1 - threshold) >= threshold - 1e-9, n - at_least(threshold, n) + 1).otherwise(F.lit(0))  # fewer words: equal sets only
    own = F.struct("doc", "pos", n.alias("n"), F.slice("k", F.lit(1), width).alias("prefix"), bitmap(F.col("k")).alias("bits"))
    rows = rows.select(F.xxhash64("k").alias("set"), F.hash("k").alias("s2"), own.alias("x"))
    return rows.groupBy("set", "s2").agg(F.min("x").alias("x")).select("set", "x.*")


def bases(n: Column, threshold: float) -> Column:
    """Least lengths of the tier of n and, if a similar set can be in it, of the next."""
    own = (F.lit(TIER) * F.pow(F.lit(2.0), F.floor(F.log2(n / TIER)))).cast("int")
    return F.when(n >= F.lit(threshold) * 2 * own - 1e-9, F.array(own, 2 * own)).otherwise(F.array(own))


def part_count(base: Column, threshold: float) -> Column:
    """One more than the tokens in which similar sets shorter than twice ``base`` can differ."""
    return (F.floor((4 * base - 2) * ((1 - threshold) / (1 + threshold)) + 1e-9) + 1).cast("int")


def most_apart(n: Column, threshold: float) -> Column:
    """Tokens in which a set of n and a similar one can differ, at most."""
    return F.floor((n + F.floor(n / threshold + 1e-9)) * ((1 - threshold) / (1 + threshold)) + 1e-9)


def parted(tokens: Column, n: Column, tier: Column, threshold: float) -> Column:
    """Keys of the parts of a set, given a tier (base, count). Empty parts have none, unless there
    are so few others that all may differ."""
    filled = F.size(F.array_distinct(F.transform(tokens, lambda t: F.pmod(t, tier["count"]))))
    own = F.transform(F.sequence(F.lit(0), tier["count"] - 1), lambda r: F.filter(tokens, lambda t: F.pmod(t, tier["count"]) == r))
    keys = F.transform(own, lambda x, r: F.when(F.size(x) > 0, F.xxhash64(tier["base"], r, x)))
    few = F.transform(own, lambda x, r: F.xxhash64(tier["base"], r, x))
    return F.when(filled <= most_apart(n, threshold), few).otherwise(F.array_compact(keys))


def _long_parts(lines: DataFrame, threshold: float) -> DataFrame:
    """Keys of the parts of long lines (doc, pos, n, bits, gone, tokens), a row for each, in steps linear in their length."""
    own = ("doc", "pos", "n", "bits", "gone", "base")
    each = lines.select("doc", "pos", "n", "bits", "gone", "tokens", F.explode(bases(F.col("n"), threshold)).alias("base"))
    count = part_count(F.col("base"), threshold)
    empty = each.select(*own, F.explode(F.sequence(F.lit(0), count - 1)).alias("r"), F.lit(None).cast("long").alias("t"))
    dealt = each.select(*own, F.explode("tokens").alias("t")).select(*own, F.pmod("t", count).cast("int").alias("r"), "t").unionByName(empty)
    parts = dealt.groupBy(*own, "r").agg(F.count("t").alias("size"), F.bit_xor(F.xxhash64("t")).alias("x"))  # a task holds whole lines, so little is shuffled
    filled = parts.groupBy("doc", "pos", "base").agg(F.sum((F.col("size") > 0).cast("int")).alias("filled"))
    kept = parts.join(filled, ["doc", "pos", "base"]).where((F.col("size") > 0) | (F.col("filled") <= most_apart(F.col("n"), threshold)))
    return kept.select(F.xxhash64("base", "r", F.coalesce("x", F.lit(0)), "size").alias("key"), "doc", "pos", "n", "bits", "gone", F.col("n").alias("room"))


def _filters(threshold: float) -> Column:
    """May ``a`` (the later line) and ``b`` be similar? Length, place of the shared token, bitmaps.

    Of the rarest tokens of two sets that differ in d, no more than 2 d differ; of whole sets, d.
    A line that is gone already, and so has no need to look for another, has its ``room`` negated.
    """
    both = F.col("a.n") + F.col("b.n")
    need = at_least(threshold / (1 + threshold), both)
    shorter, longer = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    left = F.least(F.col("a.room"), F.abs("b.room"))  # asks both sides for the same columns, so that they are one shuffle
    apart = F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits")))
    differ = (both - 2 * need) * F.when(longer <= SHOWN, 1).otherwise(2)
    earlier = (F.col("b.doc") < F.col("a.doc")) | ((F.col("b.doc") == F.col("a.doc")) & (F.col("b.pos") < F.col("a.pos")))
    return (shorter >= F.lit(threshold) * longer - 1e-9) & (apart <= differ) & (left >= need) & earlier


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.col("a.doc").alias("doc"), F.col("a.pos").alias("pos"), F.col("b.doc").alias("doc_b"), F.col("b.pos").alias("pos_b")).distinct()


def _candidates(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs of the lines that share a key, of those that are not gone and an earlier one each."""
    return _pairs(rows.alias("a").join(rows.alias("b"), (F.col("a.key") == F.col("b.key")) & _filters(threshold)))


def _rank_of(token: Column) -> Column:
    return F.shiftright(token, 56).cast("int")


def keyed(lines: DataFrame, docs: DataFrame, table: Column, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(key, room) and what the filters need, for every key of each line; ``room`` is the number of
    tokens that a line can share from that of the key on, negated if the line is gone.

    Two similar lines share a token of their prefixes. If it is of few lines it is a key of
    both; else both have a token of many lines and are keyed by their parts.
    """
    own, out = ("doc", "pos", "n", "bits", "gone"), ("key", "doc", "pos", "n", "bits", F.when(F.col("gone"), -F.col("room")).otherwise(F.col("room")).alias("room"))
    rows = lines.select(*own, "set", F.posexplode("prefix").alias("i", "key")).withColumn("room", F.col("n") - F.col("i"))
    counts = _settled(rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    hot = counts.where(F.col("c") > FREQUENT).select("key")
    sent = F.broadcast(hot) if hot.count() <= FEW else hot
    shared = counts.where(F.col("c") <= FREQUENT).select(F.xxhash64("key").alias("h"))
    bits = _filter_bits(shared)  # a token that only one line has goes before the shuffle
    tokens = marked_rows(rows.select("key", *own, "room"), F.xxhash64("key"), hash_filter(shared, bits), bits, "shared").where("shared").drop("shared").join(sent, "key", "left_anti").select(*out)
    met = _settled(rows.join(sent, "key", "left_semi").select(*own, "set").distinct())
    if not met.limit(1).count():
        return tokens
    lines_with_hot = _with_tokens(met, docs, table, id_col, text_col)
    n = F.col("n")
    # a long line that can be similar to one that is not has both kinds of parts, so either kind finds all its pairs
    own_parts = F.flatten(F.transform(F.transform(bases(n, threshold), lambda b: F.struct(b.alias("base"), part_count(b, threshold).alias("count"))), lambda t: parted(F.col("tokens"), n, t, threshold)))
    parts = lines_with_hot.where(n <= int(LONG / threshold)).select(F.explode(own_parts).alias("key"), *own, n.alias("room"))
    return tokens.unionByName(parts.unionByName(_long_parts(lines_with_hot.where(n > LONG), threshold)).select(*out))


def _with_tokens(lines: DataFrame, docs: DataFrame, table: Column, id_col: str, text_col: str) -> DataFrame:
    """``lines`` (doc, pos, set, ...) with their ``tokens``, by reading the texts again; only lines that may be asked for are shuffled."""
    ends = lines.select(F.xxhash64("doc", "pos").alias("h"))
    bits = _filter_bits(ends)
    asked = marked_rows(lines_of(docs, id_col, text_col), F.xxhash64("doc", "pos"), hash_filter(ends, bits), bits, "asked").where("asked")
    texts = asked.select(F.col("doc").alias("_doc"), F.col("pos").alias("_pos"), keys(words(F.col("line")), table).alias("tokens"))
    same = (F.col("doc") == F.col("_doc")) & (F.col("pos") == F.col("_pos")) & (F.col("set") == F.xxhash64("tokens"))
    return _settled(lines.join(texts, same).drop("_doc", "_pos", "set"))


def _filter_bits(hashes: DataFrame) -> int:
    """Eight bits for each hash, ``MOST_BITS`` at most."""
    return min(MOST_BITS, max(ID_BITS, (8 * hashes.agg(F.approx_count_distinct("h")).first()[0] + 1).bit_length()))


def _with_leaders(lines: DataFrame, threshold: float) -> DataFrame:
    """Pairs of each line with the earliest one that has its rarest or second rarest token, for tokens of many lines."""
    own = F.struct("doc", "pos", "n", "bits", "room")
    rows = lines.select("doc", "pos", "n", "bits", F.posexplode(F.slice("prefix", 1, 2)).alias("i", "key")).withColumn("room", F.col("n") - F.col("i"))
    leaders = rows.where(_rank_of(F.col("key")) >= rank(FAMILY)).groupBy("key").agg(F.count("*").alias("m"), F.min(own).alias("x")).where(F.col("m") >= FAMILY)
    leaders = leaders.select("key", "x.*")
    return _pairs(rows.alias("a").join(leaders.alias("b"), (F.col("a.key") == F.col("b.key")) & _filters(threshold)))


def _marked(lines: DataFrame, gone: DataFrame) -> DataFrame:
    """``lines`` with a flag ``gone``; a small table of them, which is counted, is broadcast."""
    flags = gone.select(F.col("doc").alias("_doc"), F.col("pos").alias("_pos"), F.lit(True).alias("_gone"))
    flags = F.broadcast(flags) if gone.count() <= FEW else flags
    return lines.join(flags, (F.col("doc") == F.col("_doc")) & (F.col("pos") == F.col("_pos")), "left").withColumn("gone", F.coalesce("_gone", F.lit(False))).drop("_doc", "_pos", "_gone")


def hash_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """(piece, bits): the one column of hashes as ``1 << bits`` bits in pieces of 4 KiB, for rows that surely are not among them.

    A table to be broadcast, of a size that ``bits`` bounds: as a literal it would stand in every text of the plan.
    """
    place = _place(F.col("h"), bits)
    return cut(hashes.toDF("h").groupBy(F.bitmap_bucket_number(place).alias("_piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")))


def _place(hashed: Column, bits: int) -> Column:
    return F.pmod(hashed, F.lit(1 << bits)) + 1


def marked_rows(rows: DataFrame, hashed: Column, table: DataFrame, bits: int, flag: str) -> DataFrame:
    """``rows`` with a column ``flag``: may the hash be among those of the filter?"""
    place = _place(hashed, bits)
    within = F.bitmap_bit_position(place)
    piece, own = free_name(rows.columns, "_piece"), free_name(rows.columns, "_bits")
    byte = F.conv(F.hex(F.substring(own, (F.shiftright(within, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = F.call_function("shiftright", byte, within.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1
    joined = rows.join(F.broadcast(table.toDF(piece, own)), F.bitmap_bucket_number(place) == F.col(piece), "left")
    return joined.select(*(F.col(quoted(c)) for c in rows.columns), F.coalesce(marked, F.lit(False)).alias(flag))


def short(words: Column) -> Column:
    """Distinct low bits of the hashes of words."""
    return F.array_distinct(F.transform(words, lambda h: h.bitwiseAND((1 << SENT_BITS) - 1).cast("smallint")))


def alike_at_most(n: Column, x: Column, y: Column) -> Column:
    """How many words two sets share at most, of which the first has ``n``, given their ``short`` ones:
    as many as these share, and those words of the first that fell together with another."""
    return F.size(F.array_intersect(x, y)) + n - F.size(x)


def _similar(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """Later lines (doc, pos) of those pairs whose word sets are similar indeed.

    The texts are read again and only lines that may be of a pair are shuffled, once for both
    ends. The filter has eight bits a line, ``MOST_BITS`` at most; beyond, more lines pass it.
    For every pair a few bits of each word are sent to the other end; all bits only for those
    pairs that these leave, which are few.
    """
    ends = pairs.select(F.xxhash64("doc", "pos").alias("h")).unionByName(pairs.select(F.xxhash64("doc_b", "pos_b").alias("h")))
    bits = _filter_bits(ends)
    rows = marked_rows(lines_of(docs, id_col, text_col), F.xxhash64("doc", "pos"), hash_filter(ends, bits), bits, "asked").where("asked")
    rows = rows.select("doc", "pos", F.array_distinct(F.transform(words(F.col("line")), lambda w: F.xxhash64(w))).alias("w"))
    each = lambda x: rows.select(F.col("doc").alias(f"{x}doc"), F.col("pos").alias(f"{x}pos"), F.col("w").alias(f"{x}w"))
    own = ("doc", "pos", "doc_b", "pos_b")
    enough = lambda common, n, m: common >= F.lit(threshold) * (n + m - common) - 1e-9

    def met(pairs: DataFrame, *sent: Column) -> DataFrame:
        near = pairs.join(each("x_"), (F.col("doc") == F.col("x_doc")) & (F.col("pos") == F.col("x_pos"))).select(*own, *sent)
        return near.join(each("y_"), (F.col("doc_b") == F.col("y_doc")) & (F.col("pos_b") == F.col("y_pos")))

    most = alike_at_most(F.col("x_n"), F.col("x_s"), short(F.col("y_w")))
    left = met(pairs, F.size("x_w").alias("x_n"), short(F.col("x_w")).alias("x_s")).where(enough(most, F.col("x_n"), F.size("y_w"))).select(*own)
    common = F.size(F.array_intersect("x_w", "y_w"))
    return met(left, F.col("x_w")).where(enough(common, F.size("x_w"), F.size("y_w"))).select("doc", "pos").distinct()


def kept_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc, pos) of every line with a word that no earlier line removes."""
    table = rarity(docs, text_col)
    first = _settled(first_lines(docs, table, id_col, text_col, threshold))
    lines = first.where(F.size("prefix") > 0)
    led = _settled(_with_leaders(lines, threshold))
    gone = _settled(_similar(led, docs, id_col, text_col, threshold))
    pairs = _candidates(keyed(_marked(lines, gone), docs, table, id_col, text_col, threshold), threshold)
    pairs = _settled(pairs.join(led, ["doc", "pos", "doc_b", "pos_b"], "left_anti"))
    more = _settled(_similar(pairs, docs, id_col, text_col, threshold))
    return first.select("doc", "pos").join(gone.unionByName(more), ["doc", "pos"], "left_anti")


def judged(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc, n_lines, removed): for each distinct id its number of lines with a word and the places of those that go.

    Places count from 0 over all lines. Null and empty texts have no lines; lines without a
    word stay; an empty table gives no rows. Rows without an id are left out, rows that
    share one count as one document, each place with all its texts.
    """
    kept = kept_lines(docs, id_col=id_col, text_col=text_col, threshold=threshold).groupBy("doc").agg(F.collect_set("pos").alias("kept"))
    lines = F.split(F.coalesce(F.col(quoted(text_col)), F.lit("")), "\n", -1)
    places = F.filter(F.transform(lines, lambda x, i: F.when(has_word(x), i)), lambda i: i.isNotNull())
    own = docs.where(F.col(quoted(id_col)).isNotNull()).select(F.col(quoted(id_col)).cast("long").alias("doc"), places.alias("own"))
    own = own.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_set("own"))).alias("own"))
    gone = F.array_sort(F.array_except("own", F.coalesce("kept", F.array().cast("array<int>"))))
    return own.join(kept, "doc", "left").select("doc", F.size("own").cast("long").alias("n_lines"), gone.alias("removed"))


def cleaned(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, drop_empty: bool = True) -> DataFrame:
    """``docs`` without the lines that go; a document that loses all its words goes if ``drop_empty``.

    Other columns stay as they are, also counts of characters. Rows without an id, and
    documents that had no word before, stay.
    """
    own = free_name(docs.columns, "gone")
    gone = cut(judged(docs, id_col=id_col, text_col=text_col, threshold=threshold).where(F.size("removed") > 0).select(F.struct("doc", "n_lines", "removed").alias(own)))
    removed = F.col(f"{own}.removed")
    key = F.col(quoted(id_col)).cast("long")
    flag = free_name([*docs.columns, own], "touched")
    flagged = marked_rows(docs, F.xxhash64(key), hash_filter(gone.select(F.xxhash64(f"{own}.doc")), ID_BITS), ID_BITS, flag)
    lines = F.split(F.col(quoted(text_col)), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(removed, i)), "\n")
    rows = flagged.where(F.col(flag)).join(gone, key == F.col(f"{own}.doc"), "left")
    if drop_empty:
        rows = rows.where(removed.isNull() | (F.size(removed) < F.col(f"{own}.n_lines")))
    rows = rows.withColumn(text_col, F.when(removed.isNotNull(), left).otherwise(F.col(quoted(text_col))))
    return flagged.where(~F.col(flag)).select(*map(quoted, docs.columns)).unionByName(rows.select(*map(quoted, docs.columns)))


def digest(found: DataFrame) -> DataFrame:
    places = F.array_join(F.transform("removed", lambda p: p.cast("string")), ",")
    return found.select(F.col("doc").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), places.alias("removed_lines"))


