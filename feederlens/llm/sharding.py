"""Balanced shards by Karmarkar-Karp differencing.

Documents with equal text stay together. A group of at least ``1 / PARCELS`` of
all bytes is a parcel of its own; the others are dealt by hash into ``PARCELS``
parcels, summed where they lie. Parcels, then, are at most twice ``PARCELS``
however much there is, and differencing runs over them: again and again the two
partial partitions with the largest spread are combined, the heaviest part of
one with the lightest of the other, until one partition is left. Parcels of
many sizes leave a spread of bytes, unless one group alone is larger than a
shard's share.

Shards are assigned to documents by two lookups in tables of that proven size.
Slots are numbered without bringing a shard into one task: rows are counted by
shard and bucket, and each bucket numbers its own behind those before it.

Null text has no bytes and, like empty text, checksum 0. Repeated rows are
equal texts, so they stay together and each gets its slot; null doc_ids come
first. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from feederlens.llm.scratch import Scratch, shuffle_partitions

SHARDS = 16
PARCELS = 16_384

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def difference(sizes: Sequence[int], parts: int) -> list[int]:
    """The part of each item, by largest differencing.

    A partial partition is its part sums, heaviest first; the smallest sum is
    kept apart from the heap's key as the spread is what counts. Part members
    are linked trees, so combining two partitions costs the number of parts,
    not of items.
    """
    if not sizes:
        return []
    # A part: (sum, tree); a tree: None, an item, or a pair of trees.
    heap = [
        (-size, i, [(size, i)] + [(0, None)] * (parts - 1)) for i, size in enumerate(sizes)
    ]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        joined = [
            (a + b, _pair(x, y)) for (a, x), (b, y) in zip(one, reversed(other), strict=True)
        ]
        joined.sort(key=lambda part: -part[0])
        heapq.heappush(heap, (joined[-1][0] - joined[0][0], count, joined))
        count += 1
    result = [0] * len(sizes)
    for part, (_, tree) in enumerate(heap[0][2]):
        waiting = [tree]
        while waiting:
            tree = waiting.pop()
            if isinstance(tree, tuple):
                waiting += tree
            elif tree is not None:
                result[tree] = part
    return result


def _pair(one, other):
    if one is None or other is None:
        return other if one is None else one
    return (one, other)


def shard(docs: DataFrame, shards: int = SHARDS, parcels: int = PARCELS) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): its shard and its slot there."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = scratch.keep(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("h1"),
            F.xxhash64(F.lit(1), "text").alias("h2"),
        ),
        "rows",
    )
    groups = scratch.keep(rows.groupBy("h1", "h2").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).scalar()
    # At most `parcels` groups have that share each, and the others make at most `parcels` sums.
    heavy = F.col("size") * parcels >= total
    parcel = F.pmod("h1", F.lit(parcels)).cast("int")
    large = groups.where(heavy).select(F.lit(None).cast("int").alias("parcel"), "h1", "h2", "size")
    small = (
        groups.where(~heavy).groupBy(parcel.alias("parcel")).agg(F.sum("size").alias("size"))
        .select("parcel", F.lit(None).cast("long").alias("h1"), F.lit(None).cast("long").alias("h2"), "size")
    )
    found = sorted(
        (tuple(r) for r in large.unionByName(small).collect()),
        key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1] or 0, r[2] or 0),
    )
    placed = [
        (p, h1, h2, s)
        for (p, h1, h2, _), s in zip(found, difference([r[3] for r in found], shards), strict=True)
    ]
    table = spark.createDataFrame(placed, "parcel int, h1 long, h2 long, shard int")
    own = F.broadcast(table.where("parcel is null").select("h1", "h2", F.col("shard").alias("own")))
    shared = F.broadcast(table.where("parcel is not null").select("parcel", F.col("shard").alias("shared")))
    dealt = (
        rows.withColumn("parcel", parcel)
        .join(own, ["h1", "h2"], "left")
        .join(shared, "parcel", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own", "shared").alias("shard"))
    )
    return with_slots(dealt).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_slots(dealt: DataFrame) -> DataFrame:
    """``dealt`` with ``slot``, gapless from 0 in each ``shard``, by bucket and doc_id."""
    buckets = 4 * shuffle_partitions(dealt.sparkSession)
    rows = dealt.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    # One row for each shard and bucket.
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(order) - 1)
        .join(offsets, ["shard", "bucket"])
        .withColumn("slot", F.col("first") + F.col("place"))
        .withColumn("shard", F.col("shard").cast("int"))
        .drop("bucket", "first", "place")
    )
