"""A trie of conversation prefixes by collapsing whole sequences.

1. Conversations with the same turns become one weighted sequence: how many there
   are, the least conv_id (the representative) and the list of those that end there.
2. A sequence that is a proper prefix of another one is dropped by an anti-join; the
   sequences left are the leaves of the trie.
3. Each node of the trie lies on the path of some leaf. Its own figures (conversations
   that end there, characters it saves) are put on the path of one of them, its owner.
   A sum over the rest of each path, added up per node over all leaves below it, is
   then the sum over the node's subtree, each node counted once.

A prefix is known by its length and the exclusive or of two 64-bit hashes of its
turns, each hashed with its place; no texts are kept. Sums and hashes along a
conversation are taken in segments of SEGMENT turns, with one carried row for each
segment, so that a conversation of any length is split. The list of ends of a sequence is put together from
strings of neighbouring ids and digested as a stream, so that a sequence of any weight
needs little memory.

Nulls: a null turn number comes first, a null role or text is empty, rows without a
conv_id belong to no conversation and are left out. Turns with equal numbers are ordered
by role, then text; repeated rows are turns of their own. Other columns are ignored.
An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.durable import checkpoint

SEGMENT = 1024
IDS_PER_STRING = 4096
FAMILY = 100
HEAD = 6
KEY = ["depth", "a", "b"]

FOLDS = {
    "sum": (F.sum, lambda x, y: x + F.coalesce(y, F.lit(0))),
    "min": (F.min, F.least),
    "xor": (F.bit_xor, lambda x, y: x.bitwiseXOR(F.coalesce(y, F.lit(0)))),
}


def _along(rows: DataFrame, by: str, at: str, folds: dict[str, str], reverse: bool = False) -> DataFrame:
    """``rows`` with each column of ``folds`` folded from the start (or end) of its sequence up to its own row.

    ``rows`` should be a stored table; it is read for the segment totals too.
    """
    def order(c: str) -> Column:
        return F.col(c).desc() if reverse else F.col(c).asc()

    rows = rows.withColumn("_segment", F.floor(F.col(at) / SEGMENT))
    inner = Window.partitionBy(by, "_segment").orderBy(order(at)).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(by).orderBy(order("_segment")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(by, "_segment").agg(*[FOLDS[f][0](c).alias(c) for c, f in folds.items()])
    carried = totals.select(by, "_segment", F.count(F.lit(1)).over(outer).alias("_n"), *[FOLDS[f][0](c).over(outer).alias(f"_{c}") for c, f in folds.items()])
    local = rows.withColumns({c: FOLDS[f][0](c).over(inner) for c, f in folds.items()})
    joined = local.join(carried.filter("_n > 0").drop("_n"), [by, "_segment"], "left")
    return joined.withColumns({c: FOLDS[f][1](F.col(c), F.col(f"_{c}")) for c, f in folds.items()}).drop("_segment", *[f"_{c}" for c in folds])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text."""
    turn = F.col("turn").cast("bigint")
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.shiftright(turn, 10), F.lit(-2**63)).alias("part"))
    inner = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    outer = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("conv_id", "part").count().select("conv_id", "part", F.sum("count").over(outer).alias("before")).filter("before > 0")
    numbered = rows.withColumn("place", F.row_number().over(inner)).join(before, ["conv_id", "part"], "left")
    return numbered.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "role", "text")


def head_length() -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Turns of all conversations after each took its first turns from the first conversation of its family of 100.

    Conversation c takes the first :func:`head_length` turns of c - c % 100, then its own turns behind as many.
    ``turns`` should be a stored table; the result has a row of place 0 for each conversation, so that those left without turns stay.
    """
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEAD)).withColumnRenamed("conv_id", "family")
    convs = turns.select("conv_id").distinct().select("conv_id", family.alias("family"), head_length().alias("head"))
    taken = convs.join(heads, "family").filter("place <= head").select("conv_id", "place", "role", "text")
    lengths = heads.groupBy("family").agg(F.count(F.lit(1)).alias("there"))
    own = turns.withColumns({"family": family, "head": head_length()}).filter("place > head").join(lengths, "family", "left")
    gap = F.greatest(F.col("head") - F.coalesce("there", F.lit(0)), F.lit(0))
    starts = convs.select("conv_id", F.lit(0).cast("bigint").alias("place"), F.lit("").alias("role"), F.lit("").alias("text"))
    return taken.unionByName(own.select("conv_id", (F.col("place") - gap).alias("place"), "role", "text")).unionByName(starts)


def _hashed(turns: DataFrame) -> DataFrame:
    """conv, depth, the two hashes of the turn (0 for the start) and its size in code points."""
    def lane(salt: int) -> Column:
        return F.when(F.col("place") == 0, F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.lit(salt), "place", "role", "text"))

    return turns.select(F.col("conv_id").alias("conv"), F.col("place").cast("bigint").alias("depth"), lane(1).alias("a"), lane(2).alias("b"),
                        F.char_length("text").cast("bigint").alias("size"))


def _digest_ends(ends: DataFrame) -> DataFrame:
    """Of (depth, a, b, conv): depth, a, b and the SHA-256 of the ids in ascending order, joined by commas."""
    strings = ends.groupBy(*KEY, F.floor(F.col("conv") / IDS_PER_STRING).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*KEY, "ends_sha256"]
        current, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for *key, ids in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if key == current:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((*current, state.hexdigest()))
                current, state = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*current, state.hexdigest())], names)

    dealt = strings.repartition(*KEY).sortWithinPartitions(*KEY, "part").select(*KEY, "ids")
    return dealt.mapInArrow(digest, "depth bigint, a bigint, b bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie over (conv_id, place, role, text) rows with places 0 (the start), 1, 2, ... of each conversation.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    rows = checkpoint(_hashed(turns))
    whole = checkpoint(rows.groupBy("conv").agg(F.max("depth").alias("depth"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")))
    # Weighted sequences.
    sequences = checkpoint(whole.groupBy(*KEY).agg(F.count(F.lit(1)).alias("ending"), F.min("conv").alias("path")))
    kept = sequences.select(F.col("path").alias("conv"), F.col("depth").alias("length"))
    turn = checkpoint(rows.join(kept, "conv").select(F.col("conv").alias("path"), "depth", "length", "a", "b", "size", F.col("a").alias("own_a"), F.col("b").alias("own_b")))
    paths = checkpoint(_along(turn, "path", "depth", {"a": "xor", "b": "xor"}))
    # Leaves: sequences that are no proper prefix of another.
    inner = paths.filter("depth < length").select(*KEY).distinct()
    leaves = sequences.join(inner, KEY, "left_anti").select("path")
    paths = checkpoint(paths.join(leaves, "path", "left_semi"))
    nodes = paths.groupBy(*KEY).agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("n_leaves"))
    owned = nodes.join(sequences.select(*KEY, "ending", F.col("path").alias("least")), KEY, "left").select("path", "depth", "ending", "least")
    placed = checkpoint(paths.join(owned, ["path", "depth"], "left").withColumn("ending", F.coalesce("ending", F.lit(0))))
    below = _along(placed, "path", "depth", {"ending": "sum", "least": "min"}, reverse=True)
    parent = {"up_a": F.col("a").bitwiseXOR(F.col("own_a")), "up_b": F.col("b").bitwiseXOR(F.col("own_b"))}
    nodes = checkpoint(below.groupBy(*KEY).agg(
        F.sum("ending").alias("n_convs"), F.min("least").alias("conv_id"), F.min("path").alias("path"), F.count(F.lit(1)).alias("n_leaves"),
        F.max("size").alias("size"), F.max("own_a").alias("own_a"), F.max("own_b").alias("own_b")).withColumns(parent).drop("own_a", "own_b"))
    saving = nodes.select("path", "depth", ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    saved = checkpoint(paths.join(saving, ["path", "depth"], "left").select("path", *KEY, F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens")))
    saved = _along(saved, "path", "depth", {"saved_tokens": "sum"}, reverse=True).groupBy(*KEY).agg(F.sum("saved_tokens").alias("saved_tokens"))
    inside = nodes.filter("depth > 0")
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = inside.select(*up).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    figures = checkpoint(nodes.join(saved, KEY).join(children, KEY, "left").join(_digest_ends(whole.select(*KEY, "conv")), KEY, "left"))
    # One row per parent against its children: adaptive execution splits the children of a node that has many.
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return figures.join(parents, ["depth", "up_a", "up_b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations rebuilt by family (:func:`rebuilt_turns`)."""
    return prefix_trie(rebuilt_turns(checkpoint(ordered_turns(conversations))))
