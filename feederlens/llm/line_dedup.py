"""Line dedup with a reversible index: sharded cuckoo filters over exact reference counts.

A line's key is the line stripped and with A-Z lower-cased. A key of at least
``MIN_CHARS`` code points in at least ``MIN_DOCS`` documents loses its lines in
all documents but that of the largest doc_id.

``LineIndex`` holds, in tables of the shared folder,

* ``postings``: which document holds which key (its 128-bit hash), the ground
  for taking documents out again,
* ``refs``: for each key the exact number of its documents and the largest,
* ``filters``: for each shard a cuckoo filter of the repeated keys. Documents
  put in or taken out add or remove the keys that pass the bound; no filter is
  built anew.

Cleaning asks the filters first, beside the text: only lines that may be
repeated are shuffled to the exact counts, which decide. Filters go to the
tasks if they are small, which is checked; beyond that the keys of the lines
are dealt to their shards, each shard in ``DEALS`` parts with its filter in
front, and asked there, batch after batch. Either way gives the same result.

Null or empty text is one empty line. Rows of one doc_id count as one
document; a null doc_id is one document that is never the largest. Counting is
partial before each shuffle, so a line of a third of all documents is one row
of each task. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from feederlens.llm import grams
from feederlens.llm.cuckoo import CuckooFilter
from feederlens.llm.scratch import Scratch, shuffle_partitions

MIN_CHARS = 20
MIN_DOCS = 3
#: Filters of up to this many bytes together go to every task.
MAX_FILTER_BYTES = 32_000_000
#: Beyond that, parts in which a shard's lines are asked, as one line may be in most documents.
DEALS = 8

SPACES = " \t\n\v\f\r"
_REFS = "key binary, shard int, n_docs long, max_doc long"
_FILTERS = "shard int, held binary"


def line_key(line: str) -> bytes | None:
    """128-bit hash of the line's key; None if it is too short to count."""
    stripped = line.strip(SPACES)
    if len(stripped) < MIN_CHARS:
        return None
    # bytes.lower() knows A-Z only.
    return xxhash.xxh3_128_digest(stripped.encode("utf-8").lower())


def _shard(key: bytes, shards: int) -> int:
    return int.from_bytes(key[:4], "little") % shards


def _keys64(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8")[1::2]


def _line_keys(docs: DataFrame, shards: int, filters: dict[int, bytes] | None = None) -> DataFrame:
    """(doc_id, key, shard) of the lines of ``docs``, each key once a row; with filters only what they hold."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = None if filters is None else {s: CuckooFilter.load(b) for s, b in shared.value.items()}
        for batch in batches:
            ids, keys, places = [], [], []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = {line_key(line) for line in (text or "").split("\n")} - {None}
                ids += [doc_id] * len(found)
                keys += found
            places = [_shard(k, shards) for k in keys]
            if loaded is not None and keys:
                held = np.zeros(len(keys), bool)
                for shard, at in _by_shard(places):
                    if shard in loaded:
                        held[at] = loaded[shard].contains(_keys64([keys[i] for i in at]))
                ids, keys, places = ([x for x, h in zip(c, held, strict=True) if h] for c in (ids, keys, places))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(places, pa.int32())],
                names=["doc_id", "key", "shard"],
            )

    if filters is not None:
        shared = docs.sparkSession.sparkContext.broadcast(filters)
    return docs.select("doc_id", "text").mapInArrow(grams.tidied(keyed), "doc_id long, key binary, shard int")


def _by_shard(places: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(places, kind="stable")
    shards, firsts = np.unique(np.asarray(places)[order], return_index=True)
    for shard, at in zip(shards.tolist(), np.split(order, firsts[1:]), strict=True):
        yield shard, at


def _change(key: tuple, held: pa.Table, changed: pa.Table) -> pa.Table:
    """One shard's filter after keys were added (``up``) or removed."""
    raw = held.column("held").to_pylist()
    up = changed.column("up").to_pylist()
    keys = changed.column("key").to_pylist()
    more = _keys64([k for k, u in zip(keys, up, strict=True) if u == 1])
    less = _keys64([k for k, u in zip(keys, up, strict=True) if u == -1])
    if raw and not any(u == 0 for u in up):
        one = CuckooFilter.load(raw[0])
        one.remove(less)
        if not one.add(more):
            # No room: the index calls again with every key of the shard, marked 0.
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "held": pa.array([None], pa.binary())})
    else:
        one = CuckooFilter.of(_keys64([k for k, u in zip(keys, up, strict=True) if u >= 0]))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "held": pa.array([one.dump()], pa.binary())})


def _asked(lines: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows of ``lines`` whose key its shard's filter holds; one filter is held at a time."""
    schema = "doc_id long, key binary, shard int"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, one = None, None
        for batch in batches:
            places = list(zip(batch.column("shard").to_pylist(), batch.column("deal").to_pylist(), strict=True))
            keys = batch.column("key").to_pylist()
            wanted = np.zeros(len(keys), bool)
            firsts = [i for i in range(len(places)) if i == 0 or places[i] != places[i - 1]]
            for a, b in zip(firsts, [*firsts[1:], len(places)], strict=True):
                if places[a] != place:
                    place, one = places[a], None
                if keys[a] is None:
                    # The filter goes before the lines of its part.
                    one, a = CuckooFilter.load(batch.column("held")[a].as_py()), a + 1
                if one is not None and a < b:
                    wanted[a:b] = one.contains(_keys64(keys[a:b]))
            yield batch.filter(pa.array(wanted)).select(["doc_id", "key", "shard"])

    deals = F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1)))
    front = filters.select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("key"), "shard", "held", deals.alias("deal")
    )
    dealt = lines.select(
        "doc_id", "key", "shard", F.lit(None).cast("binary").alias("held"),
        F.pmod(F.xxhash64("doc_id"), F.lit(DEALS)).cast("int").alias("deal"),
    )
    return (
        front.unionByName(dealt).repartition("shard", "deal")
        .sortWithinPartitions("shard", "deal", F.col("key").isNotNull())
        .mapInArrow(grams.tidied(ask), schema)
    )


class LineIndex:
    """Keys of the documents put in and not taken out since."""

    def __init__(self, spark: SparkSession, shards: int | None = None, min_docs: int = MIN_DOCS):
        self.spark = spark
        self.scratch = Scratch(spark)
        self.shards = shards or 4 * shuffle_partitions(spark)
        self.min_docs = min_docs
        self.postings: list[DataFrame] = []
        self.refs = spark.createDataFrame([], _REFS)
        self.filters = spark.createDataFrame([], _FILTERS)

    def _all_postings(self) -> DataFrame:
        none = self.spark.createDataFrame([], "doc_id long, key binary, shard int")
        return reduce(DataFrame.unionByName, self.postings, none)

    def insert(self, docs: DataFrame) -> None:
        """Puts in documents (``doc_id``, ``text``); those already held are replaced."""
        if self.postings:
            self.delete(docs.select("doc_id"))
        batch = self.scratch.keep(_line_keys(docs, self.shards).distinct(), "postings")
        self.postings.append(batch)
        counts = batch.groupBy("key", "shard").agg(
            F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc")
        )
        self._update(counts, None)

    def delete(self, doc_ids: DataFrame) -> None:
        """Takes out the documents of the column ``doc_id``; unknown ones are passed over."""
        ids = doc_ids.select(F.col("doc_id").alias("gone_id")).distinct()
        match = F.col("doc_id").eqNullSafe(F.col("gone_id"))
        held = self._all_postings()
        gone = self.scratch.keep(held.join(ids, match, "left_semi"), "gone")
        rest = self.scratch.keep(held.join(ids, match, "left_anti"), "postings")
        self.postings = [rest]
        touched = gone.groupBy("key", "shard").agg((-F.count("*")).alias("n_docs"))
        # The largest document of a key is sought anew only where one was taken out.
        largest = (
            rest.join(touched.select("key"), "key", "left_semi")
            .groupBy("key").agg(F.max("doc_id").alias("max_doc"))
        )
        self._update(touched.withColumn("max_doc", F.lit(None).cast("long")), largest)

    def _update(self, counts: DataFrame, largest: DataFrame | None) -> None:
        """Adds to the counts, and tells the filters which keys now pass the bound or no longer do."""
        old = self.refs.select("key", "shard", "n_docs", "max_doc", F.col("n_docs").alias("was"))
        merged = (
            old.unionByName(counts.withColumn("was", F.lit(0).cast("long")))
            .groupBy("key", "shard")
            .agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"), F.sum("was").alias("was"))
        )
        if largest is not None:
            fewer = largest.select("key", F.col("max_doc").alias("now"), F.lit(True).alias("touched"))
            merged = merged.join(fewer, "key", "left").withColumn(
                "max_doc", F.when(F.col("touched"), F.col("now")).otherwise(F.col("max_doc"))
            ).drop("now", "touched")
        merged = self.scratch.keep(merged, "refs")
        repeated, before = F.col("n_docs") >= self.min_docs, F.col("was") >= self.min_docs
        changed = merged.where(repeated != before).select(
            "shard", "key", F.when(repeated, 1).otherwise(-1).alias("up")
        )
        filters = self._changed(self.filters, changed)
        full = filters.where("held is null").select("shard")
        every = merged.where(repeated).join(full, "shard", "left_semi").select("shard", "key", F.lit(0).alias("up"))
        self.refs = merged.where("n_docs > 0").drop("was")
        self.filters = self.scratch.keep(
            filters.where("held is not null").unionByName(self._changed(None, every)), "filters"
        )

    def _changed(self, filters: DataFrame | None, changed: DataFrame) -> DataFrame:
        if filters is None:
            filters = self.spark.createDataFrame([], _FILTERS)
        made = filters.groupBy("shard").cogroup(changed.groupBy("shard")).applyInArrow(_change, _FILTERS)
        return self.scratch.keep(made, "changed")

    def dropped(self, docs: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
        """(doc_id, keys) of the keys that each document of ``docs`` loses."""
        total = self.filters.select(F.octet_length("held").alias("n")).agg(F.sum("n")).first()[0] or 0
        if total <= max_filter_bytes:
            found = _line_keys(docs, self.shards, {r.shard: bytes(r.held) for r in self.filters.collect()})
        else:
            found = _asked(_line_keys(docs, self.shards), self.filters)
        lines = found.select("doc_id", "key").distinct()
        repeated = self.refs.where(F.col("n_docs") >= self.min_docs).select("key", "max_doc")
        return (
            lines.join(repeated, "key")
            .where(~F.col("doc_id").eqNullSafe(F.col("max_doc")))
            .groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
        )

    def clean(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the lines that are repeated, with ``n_lines`` and ``n_dropped``.

        Null text stays null; columns of the two names are replaced.
        """
        docs = docs.drop("n_lines", "n_dropped")
        lost = self.dropped(docs).select(F.col("doc_id").alias("lost_id"), "keys")
        row = docs.select(F.struct("*").alias("row"), "doc_id", "text")
        joined = row.join(lost, F.col("doc_id").eqNullSafe(F.col("lost_id")), "left").select("row", "text", "keys")
        schema = docs.select(F.struct("*").alias("row"), "text", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).schema
        cleaned = joined.mapInArrow(grams.tidied(_without), schema)
        return cleaned.select(
            *(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns),
            "n_lines", "n_dropped",
        )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines_before, dropped = [], [], []
        keys = batch.column("keys").to_pylist()
        for text, lost in zip(batch.column("text").to_pylist(), keys, strict=True):
            lines = (text or "").split("\n")
            lost = set(lost or ())
            kept = [x for x in lines if line_key(x) not in lost] if lost else lines
            texts.append(None if text is None else "\n".join(kept))
            lines_before.append(len(lines))
            dropped.append(len(lines) - len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.string()), pa.array(lines_before, pa.int64()), pa.array(dropped, pa.int64())],
            names=["row", "text", "n_lines", "n_dropped"],
        )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` judged by an index of itself."""
    index = LineIndex(docs.sparkSession)
    index.insert(docs)
    return index.clean(docs)
