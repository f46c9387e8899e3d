"""Prefix trie of conversations, merged family by family.

A family is a block of consecutive conversation ids, whose conversations tend to start
alike. Turns are cut to a digest and a length before anything is shuffled, then dealt by
family and streamed in order: each family's conversations are rebuilt from the first turns
of its base and put into the family's own small trie. Only the nodes of these tries are
shuffled on, with one row for each family that has a node, so that the root or a first turn
that all conversations share has as many rows as there are families. Sums over subtrees
need no walk down the merged trie: a node counts in the family that has its smallest member,
each family sums over its own subtrees, and the sums are added up node by node.

Defined results: rows without conversation id are left out; turns are ordered by number, null
first, then by the digest of role and text, so that rows with equal numbers have an order
and repeated rows are repeated turns; a null role or text is empty; further columns are
ignored; no conversation at all gives no node, and a conversation without turns after the
rebuilding ends at the root. ``c % size`` is taken not negative, so that the base is the
least id of its family.

Memory: a task holds the trie of one family, or of a part of it once that has over ``PART``
nodes (a part is merged like a family), and at least one conversation's path. Members that
end at a node are kept as joined ids per family, and hashed as a stream.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residuum.llm.common import cut

#: Conversations of consecutive ids that are a family.
SIZE = 100
#: Nodes after which a family's trie is handed on as a part.
PART = 200_000
#: Rows in a batch that a task hands on.
ROWS = 20_000

NODE = "family long, part int, place int, above int, key binary, depth long, chars long, conv_id long, n_convs long, n_children long, ends string"
SUMS = "family long, part int, key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
MERGED = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turns(conversations: DataFrame, head: Column, size: int = SIZE) -> DataFrame:
    """(family, conv_id, head, digest, chars) of each turn, dealt by family and in order."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        (F.col("conv_id") - F.pmod("conv_id", F.lit(size))).cast("long").alias("family"), F.col("conv_id").cast("long").alias("conv_id"), head.cast("int").alias("head"),
        "turn", F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"), F.char_length(text).cast("long").alias("chars"))
    return rows.repartition("family").sortWithinPartitions("family", "conv_id", F.asc_nulls_first("turn"), "digest").drop("turn")


class _Trie:
    """The trie of the conversations of a family that a task has read so far."""

    def __init__(self):
        self.child, self.rows, self.ends = {}, [[-1, bytes(16), 0, 0, None, 0, 0]], {}

    def step(self, at: int, digest: bytes, chars: int) -> int:
        place = self.child.get((at, digest))
        if place is None:
            above = self.rows[at]
            above[6] += 1
            place = self.child[at, digest] = len(self.rows)
            self.rows.append([at, hashlib.blake2b(above[1] + digest, digest_size=16).digest(), above[2] + 1, chars, None, 0, 0])
        return place

    def visit(self, at: int, conv: int) -> None:
        row = self.rows[at]
        row[5] += 1
        if row[4] is None:
            row[4] = conv


def family_tries(batches, most_head: int):
    """Nodes of each family's trie, from turns in order; a node's ``above`` is its parent's place."""
    out, trie, part = [], None, 0
    family = conv = at = None
    first: list = []
    seen = head = 0

    def end():
        if conv is not None:
            trie.ends.setdefault(at, []).append(str(conv))

    def give():
        if trie is not None:
            for place, (above, key, depth, chars, least, n, children) in enumerate(trie.rows):
                ends = trie.ends.get(place)
                out.append((family, part, place, above, key, depth, chars, least, n, children, ",".join(ends) if ends else None))

    for rows in batches:
        for fam, c, h, digest, chars in zip(*(x.to_pylist() for x in rows.columns)):
            if c != conv:
                end()
                if fam != family:
                    give()
                    family, part, trie, first = fam, 0, _Trie(), []
                elif len(trie.rows) > PART:
                    give()
                    part, trie = part + 1, _Trie()
                if len(out) >= ROWS:
                    yield _batch(out, NODE)
                conv, at, seen, head = c, 0, 0, h
                trie.visit(0, c)
                if c != fam:
                    for step in first[:h]:
                        at = trie.step(at, *step)
                        trie.visit(at, c)
            if c == fam:
                if seen < most_head:
                    first.append((digest, chars))
                own = True
            else:
                own = seen >= head
            seen += 1
            if own:
                at = trie.step(at, digest, chars)
                trie.visit(at, c)
    end()
    give()
    if out:
        yield _batch(out, NODE)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """The rows, which are forgotten, as a batch with the columns of ``schema``."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    columns = [c.split(" ") for c in schema.split(", ")]
    batch = pa.RecordBatch.from_arrays([pa.array(v, kinds[kind]) for v, (_, kind) in zip(zip(*rows), columns)], names=[name for name, _ in columns])
    rows.clear()
    return batch


def subtree_sums(batches):
    """For each family node the sums over its subtree of what counts in this family.

    Rows come by family, part and place; parents have smaller places than their children.
    """
    held, now, out = [], None, []

    def give():
        n = len(held)
        leaves, saved, children = [0] * n, [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            _, _, _, above, _, _, chars, _, convs, leaf, _, own = held[i]
            if own:
                leaves[i] += leaf
                saved[i] += (convs - 1) * chars
            if above >= 0:
                leaves[above] += leaves[i]
                saved[above] += saved[i]
                children[above] += own
        for i, (family, part, _, above, key, depth, _, conv, convs, _, ends, own) in enumerate(held):
            if own or leaves[i] or saved[i] or children[i] or ends is not None:
                out.append((family, part, key, depth, conv, held[above][7] if above >= 0 else None, convs, children[i], leaves[i], saved[i], ends))

    for rows in batches:
        for row in zip(*(x.to_pylist() for x in rows.columns)):
            if row[:2] != now:
                if held:
                    give()
                    held.clear()
                    if len(out) >= ROWS:
                        yield _batch(out, SUMS)
                now = row[:2]
            held.append(row)
    if held:
        give()
    if out:
        yield _batch(out, SUMS)


def merge(batches):
    """One row for each node, from its families' rows in order; ids of ends are hashed as they come."""
    out, now, sums, sha, some = [], None, None, None, False

    def give():
        if sums is not None:
            out.append((*sums, sha.hexdigest()))

    for rows in batches:
        for _, _, key, depth, conv, parent, convs, children, leaves, saved, ends in zip(*(x.to_pylist() for x in rows.columns)):
            if key != now:
                give()
                if len(out) >= ROWS:
                    yield _batch(out, MERGED)
                now, sha, some, sums = key, hashlib.sha256(), False, [conv, depth, parent, convs, 0, 0, 0]
            sums[4] += children
            sums[5] += leaves
            sums[6] += saved
            if ends is not None:
                sha.update(f",{ends}".encode() if some else ends.encode())
                some = True
    give()
    if out:
        yield _batch(out, MERGED)


def family_nodes(conversations: DataFrame, head: Column | None = None, size: int = SIZE, most_head: int = 5) -> DataFrame:
    """Nodes of all families' tries with what holds for the merged node, and the sums that the family adds to it.

    ``head`` is how many first turns a conversation has from the base of its family (the id
    that ``size`` divides), at most ``most_head``; its own turns follow after as many.
    """
    nodes = cut(turns(conversations, F.lit(0) if head is None else F.least(head, F.lit(most_head)), size).mapInArrow(lambda b: family_tries(b, most_head), NODE))
    whole = nodes.groupBy("key").agg(F.min(F.struct("conv_id", "family", "part")).alias("first"), F.sum("n_convs").alias("n"), (F.sum("n_children") == 0).cast("int").alias("leaf"))
    own = (F.col("first.family") == F.col("family")) & (F.col("first.part") == F.col("part"))
    known = nodes.join(whole, "key").select("family", "part", "place", "above", "key", "depth", "chars", F.col("first.conv_id").alias("conv_id"), F.col("n").alias("n_convs"), "leaf", "ends", own.cast("int").alias("own"))
    return known.repartition("family", "part").sortWithinPartitions("family", "part", "place").mapInArrow(subtree_sums, SUMS)


def trie(conversations: DataFrame, head: Column | None = None, size: int = SIZE, most_head: int = 5) -> DataFrame:
    """The nodes of the merged trie. (conv_id, depth) names a node: the turn ``depth`` of its smallest member ends it."""
    nodes = family_nodes(conversations, head, size, most_head)
    return nodes.repartition("key").sortWithinPartitions("key", "family", "part").mapInArrow(merge, MERGED)


def members(conversations: DataFrame, head: Column | None = None, size: int = SIZE, most_head: int = 5) -> DataFrame:
    """(conv_id, depth, member): which conversations end at each node, a row for each."""
    nodes = family_nodes(conversations, head, size, most_head).where("ends IS NOT NULL")
    return nodes.select("conv_id", "depth", F.explode(F.split("ends", ",").cast("array<long>")).alias("member"))
