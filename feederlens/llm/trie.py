"""Prefix trie of conversations, counted in perfectly hashed flat arrays.

Every prefix of a conversation is a node, known by a chained digest. A pass
over the conversations, each in one piece and in order, gives the nodes it
passes through. Nodes of more conversations than ``members`` are the top of
the trie; below it hang whole subtrees, which are dealt to shards. A shard
enumerates its distinct digests, gives each a slot by a minimal perfect hash
whose hits are verified against the stored digests, scatters counts into flat
arrays by slot, and adds leaves and savings up through an array of parent
slots, deepest nodes first. The top, small by its bound, is added up the same
way from what its subtrees send.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feederlens.llm import grams
from feederlens.llm.scratch import Scratch, shuffle_partitions

#: Conversations in this many neighbours of an id share its first turns.
SHARING = 5
MAX_SHARED = 9

#: Conversations of a node that hangs below the top: at least and at most so many, between them by the rows of the table.
MEMBERS = (64, 50_000)
#: Nodes of a shard, about.
SHARD_ROWS = 500_000

ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()

PATH = "digest binary, parent binary, depth long, size long, conv_id long, ends boolean, shard long"
NODE = (
    "digest binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class PerfectHash:
    """Slots 0 to n-1 of n distinct digests, by levels of bins that one key has alone.

    ``slots`` looks digests up and verifies each hit; what was not built in gets -1.
    """

    def __init__(self, digests: np.ndarray):
        self.levels, self.keys = [], np.empty_like(digests)
        left, base = digests, 0
        while len(left):
            bins = len(left) + len(left) // 2 + 1
            at = self._bins(left, len(self.levels), bins)
            alone = np.bincount(at, minlength=bins) == 1
            rank = np.cumsum(alone) - 1 + base
            mine = alone[at]
            self.levels.append((bins, alone, rank))
            self.keys[rank[at[mine]]] = left[mine]
            base += int(mine.sum())
            left = left[~mine]

    @staticmethod
    def _bins(digests: np.ndarray, level: int, bins: int) -> np.ndarray:
        seed = np.uint64(level * grams.MULTIPLIERS[0] & grams.MASK)
        turned = grams.mix(digests["a"] + seed) ^ digests["b"]
        return (grams.mix(turned) % np.uint64(bins)).astype(np.int64)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        found = np.full(len(digests), -1, np.int64)
        left = np.arange(len(digests))
        for level, (bins, alone, rank) in enumerate(self.levels):
            at = self._bins(digests[left], level, bins)
            hit = alone[at]
            slots = rank[at[hit]]
            same = self.keys[slots] == digests[left[hit]]
            found[left[hit][same]] = slots[same]
            # A key that is in the table has its slot on the first level with a bin of one; others are not there.
            left = left[~hit]
        return found


def as_digests(values: pa.Array) -> np.ndarray:
    """16-byte values as pairs of 64-bit numbers; null is as the root's."""
    raw = b"".join(v or ROOT for v in values.to_pylist())
    return np.frombuffer(raw, [("a", "<u8"), ("b", "<u8")])


def shared_turns(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % MAX_SHARED


def _turns(conversations: DataFrame) -> DataFrame:
    """(block, conv_id, turn, digest, size): each turn as the digest of its role and text, and the text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        (F.col("conv_id") - F.col("conv_id") % SHARING).alias("block"),
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )


class _Paths:
    """Nodes of rebuilt conversations, for turns that come in order, block after block."""

    def __init__(self, top: frozenset[bytes] | None, shards: int):
        self.top, self.shards = top, shards
        self.out: list[tuple] = []
        self.block = self.conv_id = None

    def _step(self, turn: bytes, size: int) -> None:
        digest = hashlib.blake2b(self.node + turn, digest_size=16).digest()
        self._enter(digest, self.node, self.depth + 1, size)

    def _enter(self, digest: bytes, parent: bytes | None, depth: int, size: int) -> None:
        if self.held:
            self.out.append((*self.held, False, self.shard_of_held))
        if self.shard is None and self.top is not None and digest not in self.top:
            self.shard = int.from_bytes(digest[:7], "little") % self.shards
        self.held, self.shard_of_held = (digest, parent, depth, size, self.conv_id), self.shard
        self.node, self.depth = digest, depth

    def _begin(self, block: int, conv_id: int) -> None:
        if block != self.block:
            self.block, self.first = block, []
        self.conv_id, self.seen, self.held, self.shard = conv_id, 0, None, None
        self._enter(ROOT, None, 0, 0)
        self.skipped = 0
        if conv_id != block:
            self.skipped = shared_turns(conv_id)
            for turn, size in self.first[: self.skipped]:
                self._step(turn, size)

    def end(self) -> None:
        if self.conv_id is not None:
            self.out.append((*self.held, True, self.shard_of_held))

    def turn(self, block: int, conv_id: int, digest: bytes, size: int) -> None:
        if conv_id != self.conv_id:
            self.end()
            self._begin(block, conv_id)
        if conv_id == block and self.seen < MAX_SHARED:
            self.first.append((digest, size))
        if self.seen >= self.skipped:
            self._step(digest, size)
        self.seen += 1


def _paths(turns: DataFrame, top: frozenset[bytes] | None = None, shards: int = 1) -> DataFrame:
    """A row for each node that each rebuilt conversation passes through, the root included.

    A block's own conversation comes first, so its first turns are at hand for
    the others; nothing else is held.
    """
    names = [x.split()[0] for x in PATH.split(", ")]
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = _Paths(top, shards)

        def flush():
            columns, paths.out = list(zip(*paths.out, strict=True)), []
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                paths.turn(*row)
                if len(paths.out) >= 20_000:
                    yield flush()
        paths.end()
        if paths.out:
            yield flush()

    own_first = F.col("conv_id") != F.col("block")
    return (
        turns.repartition("block")
        .sortWithinPartitions("block", own_first, "conv_id", F.col("turn").asc_nulls_first(), "digest")
        .select("block", "conv_id", "digest", "size")
        .mapInArrow(walked, PATH)
    )


def _ends(conv_ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(conv_ids))).encode()).hexdigest()


def _added_up(parent: np.ndarray, depth: np.ndarray, *values: np.ndarray) -> None:
    """Adds each value to its parent's, deepest first; ``parent`` is -1 above the table."""
    order = np.argsort(-depth, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        rows = rows[parent[rows] >= 0]
        for value in values:
            np.add.at(value, parent[rows], value[rows])


def _shard(table: pa.Table) -> pa.Table:
    """Nodes of whole subtrees, from the rows of the conversations that pass through them."""
    digests, parents = as_digests(table["digest"]), as_digests(table["parent"])
    distinct, where = np.unique(digests, return_index=True)
    table_of = PerfectHash(distinct)
    slot, n = table_of.slots(digests), len(distinct)
    conv_id, ends = table["conv_id"].to_numpy(), table["ends"].to_numpy()
    n_convs = np.bincount(slot, minlength=n)
    lowest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(lowest, slot, conv_id)
    at = np.empty(n, np.int64)
    at[slot[where]] = where
    parent = table_of.slots(parents[at])
    depth, size = table["depth"].to_numpy()[at], table["size"].to_numpy()[at]
    children = np.bincount(parent[parent >= 0], minlength=n)
    leaves, saved = (children == 0).astype(np.int64), (n_convs - 1) * size
    _added_up(parent, depth, leaves, saved)
    ended: dict[int, list[int]] = {}
    for s, c in zip(slot[ends].tolist(), conv_id[ends].tolist(), strict=True):
        ended.setdefault(s, []).append(c)
    below = parent < 0
    above = table["parent"].combine_chunks().take(pa.array(at))
    return pa.table({
        "digest": pa.nulls(n, pa.binary()),
        "above": pa.array([p if b else None for p, b in zip(above.to_pylist(), below.tolist(), strict=True)], pa.binary()),
        "conv_id": lowest, "depth": depth,
        "parent_conv_id": pa.array(lowest[parent], mask=below),
        "n_convs": n_convs, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
        "ends_sha256": [_ends(ended[s]) if s in ended else NO_ENDS for s in range(n)],
    })


def _top(table: pa.Table) -> pa.Table:
    """Nodes of the top, from their counts and what hangs below them."""
    digests = as_digests(table["digest"])
    table_of = PerfectHash(digests)
    slot, n = table_of.slots(digests), table.num_rows
    at = np.empty(n, np.int64)
    at[slot] = np.arange(n)
    column = {c: table[c].to_numpy()[at] for c in ("conv_id", "depth", "size", "n_convs", "n_children", "n_leaves", "saved_tokens")}
    is_root = column["depth"] == 0
    parent = np.where(is_root, -1, table_of.slots(as_digests(table["parent"])[at]))
    children = column["n_children"] + np.bincount(parent[parent >= 0], minlength=n)
    leaves = column["n_leaves"] + (children == 0)
    saved = column["saved_tokens"] + (column["n_convs"] - 1) * column["size"]
    _added_up(parent, column["depth"], leaves, saved)
    return pa.table({
        "digest": table["digest"].combine_chunks().take(pa.array(at)), "above": pa.nulls(n, pa.binary()),
        "conv_id": column["conv_id"], "depth": column["depth"],
        "parent_conv_id": pa.array(column["conv_id"][parent], mask=is_root),
        "n_convs": column["n_convs"], "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
        "ends_sha256": pa.nulls(n, pa.string()),
    })


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of sorted ids; a node's ids go through one hash, and none are held."""

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for digest, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if digest != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = digest, hashlib.sha256(str(conv_id).encode())
                else:
                    state.update(f",{conv_id}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done, strict=True)], names=["digest", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names=["digest", "ends_sha256"])

    return (
        ends.repartition("digest").sortWithinPartitions("digest", "conv_id").select("digest", "conv_id")
        .mapInArrow(hashed, "digest binary, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame, members: int | None = None) -> DataFrame:
    """One row for each node of the trie of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``).

    Turns go by ``turn``, null first, equal ones by a digest of role and text,
    so repeated rows are turns of their own. Null role or text is empty. Rows
    without ``conv_id`` are of no conversation and are left out; other columns
    are not read. An empty table has no nodes, not even a root. A conversation
    goes through one task, turn after turn, and its texts through none: only
    digests are dealt. A digest is 16 bytes; equal ones are one node.
    Stores the digests, the paths and the nodes; runs their jobs when called.
    """
    scratch = Scratch(conversations.sparkSession)
    turns = scratch.keep(_turns(conversations), "turns")
    partitions = shuffle_partitions(conversations.sparkSession)
    rows = turns.count()
    if members is None:
        members = min(MEMBERS[1], max(MEMBERS[0], rows // (64 * partitions)))
    # Of nodes with more members there are fewer than rows of paths over members.
    counted = _paths(turns).groupBy("digest").agg(F.count("*").alias("n"))
    top = frozenset(bytes(r.digest) for r in counted.where(F.col("n") > members).collect()) | {ROOT}
    shards = max(partitions, -(-2 * rows // SHARD_ROWS))
    paths = scratch.keep(_paths(turns, top, shards), "paths")
    scratch.free("turns")

    nodes = scratch.keep(
        paths.where(F.col("shard").isNotNull())
        .select("shard", "digest", "parent", "depth", "size", "conv_id", "ends")
        .groupBy("shard").applyInArrow(_shard, NODE),
        "nodes",
    )
    hung = nodes.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("digest")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    above = paths.where(F.col("shard").isNull())
    counts = above.groupBy("digest").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("size").alias("size"),
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
    )
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    tops = scratch.keep(
        counts.join(hung, "digest", "left")
        .select("digest", "parent", "depth", "size", "conv_id", "n_convs", *filled)
        .groupBy().applyInArrow(_top, NODE),
        "top",
    )
    ends = _hashed_ends(above.where("ends").select("digest", "conv_id"))
    whole_tops = tops.drop("ends_sha256").join(ends, "digest", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))
    )
    # As many rows as the top has nodes.
    names = F.broadcast(tops.select(F.col("digest").alias("above"), F.col("conv_id").alias("_above_conv_id")))
    hanging = nodes.join(names, "above", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "_above_conv_id")
    )
    return hanging.select(RESULT).unionByName(whole_tops.select(RESULT))
