"""Prefix trie of conversations: a minimal perfect hash over the digests of distinct prefixes, flat arrays, sums through parent slots.

A node is a distinct sequence of first turns. Its digest is two XORs of 64-bit hashes of (place, role, text), so a window gives all digests of a conversation
from hashes alone, and texts are read once and never shuffled. The trie is cut where it is thin: nodes that more than a limit of conversations
pass are its top (few: at most rows / limit); below, every subtree whose parent is in the top belongs to one shard, so a start that a third of
all conversations share is split by what follows it. A shard gives each of its nodes a slot by a minimal perfect hash of digests (each look-up is verified against
the digest in the slot), scatters counts into arrays by slot, finds each parent's slot, and adds up from the deepest level to
the first. The subtrees' sums go to the top, which is one such table itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsieve.llm import recurrence as R
from netsieve.llm.words import word_count
from netsieve.operators.sizing import checkpoint_table

BASE_STEP = 20
MAX_HEAD = 4
TOP_CONVERSATIONS = 64  # conversations through a node above which it belongs to the top
TOP_BITS = 18  # the top has at most 2^18 nodes: the limit grows with the rows
SHARD_NODES = 20_000
LEAST_SHARDS = 64
SALT = 7_046_029_254_386_353_131
NOTHING = hashlib.sha256(b"").hexdigest()
KEY = ("depth", "d1", "d2")


class NodeTable:
    """Minimal perfect hash of distinct keys (depth, d1, d2): n keys have the slots 0 to n - 1.

    In each level the keys that are alone at their place get the next slots, in order of places; the rest go to the next level. A key is looked for at
    the first level whose place is taken, and is there if the digest in that slot is its own.
    """

    def __init__(self, depth: np.ndarray, d1: np.ndarray, d2: np.ndarray):
        self.keys = [np.empty(len(depth), np.int64) for _ in range(3)]
        self.slots = np.empty(len(depth), np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, used = np.arange(len(depth)), 0
        while len(left):
            size = max(8, 2 * len(left))
            at = self._place(len(self.levels), size, depth[left], d1[left], d2[left])
            alone = np.bincount(at, minlength=size) == 1
            slot = used + np.cumsum(alone) - 1
            self.levels.append((alone, slot))
            mine = alone[at]
            self.slots[left[mine]] = slot[at[mine]]
            used += int(alone.sum())
            left = left[~mine]
        for own, values in zip(self.keys, (depth, d1, d2), strict=True):
            own[self.slots] = values

    @staticmethod
    def _place(level: int, size: int, depth: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        law = np.uint64(R.BASE)
        h = R.mixed(d1.view(np.uint64) + np.uint64((level + 1) * R.BASE % 2**64)) + R.mixed(d2.view(np.uint64) * law + depth.view(np.uint64) + np.uint64(level))
        return (R.mixed(h * law) % np.uint64(size)).astype(np.int64)

    def find(self, depth: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 for those that the table does not hold."""
        out = np.full(len(depth), -1, np.int64)
        left = np.arange(len(depth))
        for level, (alone, slot) in enumerate(self.levels):
            at = self._place(level, len(alone), depth[left], d1[left], d2[left])
            hit = alone[at]
            found, where = slot[at[hit]], left[hit]
            same = (self.keys[0][found] == depth[where]) & (self.keys[1][found] == d1[where]) & (self.keys[2][found] == d2[where])
            out[where[same]] = found[same]
            left = left[~hit]
            if not len(left):
                break
        return out


GIVEN = ("depth", "d1", "d2", "p1", "p2", "conv_id", "n_convs", "words", "n_children", "n_leaves", "saved_tokens")
TOLD = ("depth", "d1", "d2", "p1", "p2", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
TOLD_DDL = ", ".join(f"{c} long" for c in TOLD)


def add_up(nodes: pa.Table) -> pa.Table:
    """Sums over the subtrees of a forest of distinct nodes. ``n_children``, ``n_leaves`` and ``saved_tokens`` come in as what nodes outside the
    forest have added already. A node whose parent is outside has no ``parent_conv_id``."""
    given = {c: nodes.column(c).to_numpy().astype(np.int64) for c in GIVEN}
    table = NodeTable(given["depth"], given["d1"], given["d2"])
    flat = {c: np.empty_like(v) for c, v in given.items()}
    for c, values in given.items():
        flat[c][table.slots] = values
    depth = flat["depth"]
    parent = table.find(depth - 1, flat["p1"], flat["p2"])
    inner = parent >= 0
    children = flat["n_children"] + np.bincount(parent[inner], minlength=len(depth))
    leaves = flat["n_leaves"] + (children == 0)
    saved = flat["saved_tokens"] + (flat["n_convs"] - 1) * flat["words"]
    order = np.argsort(-depth, kind="stable")
    order = order[inner[order]]
    edges = np.flatnonzero(np.r_[True, np.diff(depth[order]) != 0, True]) if len(order) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        own = order[a:b]
        np.add.at(leaves, parent[own], leaves[own])
        np.add.at(saved, parent[own], saved[own])
    above = pa.array(flat["conv_id"][np.maximum(parent, 0)] if len(depth) else depth, mask=~inner)
    flat |= {"n_children": children, "n_leaves": leaves, "saved_tokens": saved}
    return pa.table({c: above if c == "parent_conv_id" else flat[c] for c in TOLD})


def hashed_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 0), t1, t2 (hashes of role and text), words. Order: turn, null first; rows of one turn by their hashes. Null
    roles and texts are empty; rows without a conversation are left out."""
    who, what = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.xxhash64(who, what).alias("t1"), F.xxhash64(F.lit(SALT), who, what).alias("t2"), word_count(what).alias("words"),
    ).filter("conv_id IS NOT NULL")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "t1", "t2", "words")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Turns with other heads: the first h turns of conversation c - c % 20, then c's own after its first h; h is CRC-32 of c modulo 4. A head
    goes to at most 20 conversations."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MAX_HEAD))
    own = turns.filter(F.col("place") >= h)
    heads = turns.filter((F.col("place") < MAX_HEAD - 1) & (F.col("conv_id") % BASE_STEP == 0)).withColumnRenamed("conv_id", "base")
    takers = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % BASE_STEP).alias("base"), h.alias("h"))
    head = takers.filter("h > 0").join(heads, "base").filter("place < h").select(*turns.columns)
    # heads lie before all own turns, as own places start at h
    return own.unionByName(head)


def prefix_paths(turns: DataFrame, members: DataFrame) -> DataFrame:
    """conv_id, depth, digest (d1, d2), the parent's digest (p1, p2) and words of the last turn, for every prefix of every member, the empty one included."""
    order = Window.partitionBy("conv_id").orderBy("place")
    rows = turns.withColumn("depth", F.row_number().over(order).cast("long"))
    rows = rows.withColumn("x1", F.xxhash64("depth", "t1", "t2")).withColumn("x2", F.xxhash64(F.lit(SALT), "depth", "t1", "t2"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("d1", F.bit_xor("x1").over(upto)).withColumn("d2", F.bit_xor("x2").over(upto))
    rows = rows.select("conv_id", *KEY, F.col("d1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("x2")).alias("p2"), "words")
    zero = F.lit(0).cast("long")
    return rows.unionByName(members.select("conv_id", *[zero.alias(c) for c in (*KEY, "p1", "p2", "words")]))


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, d1, d2, ends_sha256: SHA-256 of the ascending conv_ids of each node (rows depth, d1, d2, conv_id), joined by commas.

    Sorted by node and number and streamed, so however many conversations end at one node, a task holds one batch of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, first = None, None, True
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            new = np.zeros(len(columns[0]), bool)
            for c in columns[:3]:
                new[1:] |= c[1:] != c[:-1]
            edges = [0, *np.flatnonzero(new).tolist(), len(new)] if len(new) else [0]
            ids, out = columns[3].tolist(), []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                now = tuple(int(c[a]) for c in columns[:3])
                if now != key:
                    if state is not None:
                        out.append((*key, state.hexdigest()))
                    key, state, first = now, hashlib.sha256(), True
                state.update(("" if first else ",").encode() + ",".join(map(str, ids[a:b])).encode())
                first = False
            yield _ends(out)
        if state is not None:
            yield _ends([(*key, state.hexdigest())])

    rows = ends.select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return rows.mapInArrow(run, "depth long, d1 long, d2 long, ends_sha256 string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)], names=[*KEY, "ends_sha256"])


def trie(turns: DataFrame, members: DataFrame, top_conversations: int = TOP_CONVERSATIONS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The nodes of the trie of turns (conv_id, place, t1, t2, words); ``members`` (conv_id, distinct) are the conversations, also those without turns.

    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    paths = checkpoint_table(prefix_paths(turns, members), "prefix-paths")
    nodes = paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2")
    )
    nodes = checkpoint_table(nodes, "prefix-nodes")
    rows, distinct = paths.count(), nodes.count()
    limit = max(top_conversations, rows >> TOP_BITS)
    is_top = (F.col("depth") == 0) | (F.col("n_convs") > limit)
    top = nodes.filter(is_top)  # at most rows / limit + 1 nodes, as each row passes one node of its depth
    marks = F.broadcast(top.select(*KEY, F.col("conv_id").alias("top_conv")))
    node = F.struct(*KEY)
    convs = paths.join(marks, list(KEY), "left").groupBy("conv_id").agg(F.max(node).alias("end"), F.min(F.when(F.col("top_conv").isNull(), node)).alias("root"))
    convs = checkpoint_table(convs, "prefix-convs")

    zero = F.lit(0).cast("long")
    shards = max(LEAST_SHARDS, math.ceil(distinct / shard_nodes))
    low = nodes.filter(~is_top).join(convs.select("conv_id", "root"), "conv_id")
    low = low.select(
        *KEY, "p1", "p2", "conv_id", "n_convs", "words", *[zero.alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
        F.pmod(F.xxhash64("root"), F.lit(shards)).alias("shard"),
    )
    low = checkpoint_table(low.groupBy("shard").applyInArrow(lambda t: add_up(t.select(list(GIVEN))), TOLD_DDL), "prefix-low")

    over = low.filter("parent_conv_id IS NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
    over = over.agg(F.count(F.lit(1)).alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    high = top.join(over, list(KEY), "left").select(
        *KEY, "p1", "p2", "conv_id", "n_convs", "words",
        F.coalesce("c", zero).alias("n_children"), F.coalesce("l", zero).alias("n_leaves"), F.coalesce("s", zero).alias("saved_tokens"),
    )
    high = high.groupBy(F.lit(0).alias("one")).applyInArrow(lambda t: add_up(t.select(list(GIVEN))), TOLD_DDL)

    above = marks.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), "top_conv")
    low = low.join(F.broadcast(above), ["depth", "p1", "p2"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_conv"))
    ends = end_digests(convs.select("end.*", "conv_id"))
    out = low.select(*TOLD).unionByName(high).join(ends, list(KEY), "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    )


def conversation_trie(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rebuild: bool = False, **options
) -> DataFrame:
    """The prefix trie of a table of turns, with ``rebuild`` of conversations with exchanged heads.

    Cases: rows with a null conversation are left out; a null turn is the first; rows of one turn follow the hashes of role and text; null or empty roles and texts are empty;
    repeated rows are turns of their own; texts count whole; a conversation left without turns ends at the root; empty table: no rows; further columns are left out.
    """
    turns = checkpoint_table(hashed_turns(conversations, conv, turn, role, text), "prefix-turns")
    members = turns.select("conv_id").distinct()
    return trie(rebuilt_turns(turns) if rebuild else turns, members, **options)
