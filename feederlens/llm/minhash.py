"""Near-duplicate documents by MinHash: banding, verification, connected components.

A document's set are its distinct word shingles. Documents of one set are one
class, named by its smallest doc_id; only classes are compared. Every class
has ``BANDS * ROWS`` minima of universal hashes; classes that agree in one
band share a bucket.

Buckets that share classes make a block: the connected classes of the bucket
graph. A block whose comparisons fit a task (``MAX_WORK``, ``MAX_BYTES``, checked
by counts) is settled in one: each class in turn is held against all those not
yet in its component, by signature first, then by its full set. Nothing but
the resulting components leaves the task.

A larger block is worked off by all tasks, by its rarest shingles. Ordered by
how many sets of the block have them, linked sets have one in common among the
first of both that lies early enough, in both, for what follows it to reach the
limit; its place bounds the size of the other set. Each set is first held
against one: of those that share such shingles, the one most often the set of
the commonest shingles among the sets of a shingle. Then every set outside a
shingle's largest component is held against all those of other components that
fit, in cells of two bounded pieces of the block. So every link is found, or
its ends are connected anyway, and sets with many shingles of their own meet none.

Pairs whose signatures agree far too little are given up; all others are
decided on the full sets. Components come from alternating large-star and
small-star. Sets are computed for classes that share a bucket only; the ids of
those go to all tasks if their number is checked to be small, otherwise a join
on doc_id brings them there.

Null or empty text and text without words has an empty set and is linked with
nothing. Rows sharing a doc_id are one document, whose texts' classes are of
one component. A null doc_id is linked with
nothing, has a null component and is kept. An empty table gives an empty
result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from feederlens.llm import grams
from feederlens.llm.components import connected
from feederlens.llm.scratch import Scratch

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
BANDS = 40
ROWS = 5
#: Signatures estimate the similarity with a deviation of at most 0.036; pairs
#: this far below the limit are given up.
SLACK = 0.18
#: Members times shingles and a share of the other signatures, and bytes, of a block that one task settles.
MAX_WORK = 1 << 32
MAX_BYTES = 64_000_000
#: After a block of so many bytes the worker gives memory back.
RELEASE_BYTES = 2_000_000
#: Bytes, and sets, of a piece of a larger block.
PIECE_BYTES = 4_000_000
PIECE_SETS = 1024
#: So many ids (16 MB) may go to all tasks.
MAX_SENT_IDS = 2_000_000

_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def _lower(text: str | None) -> list[bytes]:
    # bytes.lower() knows A-Z only.
    return text.encode("utf-8").lower().split() if text else []


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; shorter texts are one shingle."""
    words = [_lower(t) for t in texts]
    flat, lengths = grams.word_hashes(words)
    ends = np.cumsum(lengths)
    hashes = grams.gram_hashes(flat, n)
    sets = []
    for length, end in zip(lengths.tolist(), ends.tolist(), strict=True):
        if length >= n:
            sets.append(np.unique(hashes[end - length : end - n + 1]))
        elif length:
            whole = grams.gram_hashes(flat[end - length : end], length)
            # A shorter sequence is never equal to a shingle of n words.
            sets.append(grams.mix(whole + np.uint64(length)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of all hash functions for each set, none of them empty."""
    flat = np.concatenate(sets)
    firsts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    minima = np.empty((len(sets), len(_FACTORS)), np.uint64)
    hashed = np.empty_like(flat)
    for i, (factor, term) in enumerate(zip(_FACTORS, _TERMS, strict=True)):
        np.multiply(flat, factor, out=hashed)
        hashed += term
        minima[:, i] = np.minimum.reduceat(hashed, firsts)
    return minima


def _band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(minima), BANDS), np.uint64)
    for row in range(ROWS):
        keys = grams.mix(keys * np.uint64(grams.MULTIPLIERS[1]) + minima[:, row::ROWS])
    return grams.mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _signed(n: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in grams.in_slices(texts, 1_000_000):
                sets = shingle_sets(texts[a:b], n)
                full = [s for s in sets if len(s)]
                bands = iter(_band_keys(signatures(full)) if full else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands"],
                )

    return signed


def _full(n: int):
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in grams.in_slices(texts, 1_000_000):
                sets = shingle_sets(texts[a:b], n)
                some = [i for i, s in enumerate(sets) if len(s)]
                if not some:
                    continue
                minima = (signatures([sets[i] for i in some]) >> np.uint64(32)).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a).take(pa.array(some)),
                        pa.array([m.tobytes() for m in minima], pa.binary()),
                        pa.array([sets[i].tobytes() for i in some], pa.binary()),
                    ],
                    names=["id", "signature", "members"],
                )

    return full


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ["block", "row", "id"]
        raw = batch.column("members").to_pylist()
        for a, b in grams.in_slices(raw):
            sizes = np.array([len(s) // 8 for s in raw[a:b]])
            held = [pa.array(np.repeat(batch.column(n).to_numpy()[a:b], sizes)) for n in names]
            shingles = np.frombuffer(b"".join(raw[a:b]), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*held, pa.array(np.repeat(sizes, sizes)), pa.array(shingles)], names=[*names, "size", "shingle"]
            )


def _link(
    sets: list[np.ndarray], minima: np.ndarray, part: np.ndarray, percent: int, against: Iterable[tuple[int, np.ndarray]]
) -> None:
    """Each set held ``against`` others not yet of its label: labels ``part`` of linked ones become the smaller."""
    sizes = np.array([len(s) for s in sets])
    _, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    numbers = np.split(numbers, np.cumsum(sizes)[:-1])
    marked = np.zeros(int(sizes.sum()), bool)
    for centre, others in against:
        others = others[part[others] != part[centre]]
        others = others[100 * np.minimum(sizes[others], sizes[centre]) >= percent * np.maximum(sizes[others], sizes[centre])]
        if not len(others):
            continue
        alike = np.count_nonzero(minima[others] == minima[centre], axis=1) / minima.shape[1]
        others = others[alike + SLACK >= percent / 100]
        if not len(others):
            continue
        marked[numbers[centre]] = True
        places = np.cumsum(sizes[others]) - sizes[others]
        held = marked[np.concatenate([numbers[i] for i in others.tolist()])]
        common = np.add.reduceat(held, places, dtype=np.int64)
        marked[numbers[centre]] = False
        linked = 100 * common >= percent * (sizes[centre] + sizes[others] - common)
        for other in np.unique(part[others[linked]]).tolist():
            low, high = sorted((part[centre], other))
            part[part == high] = low


def _settled(percent: int):
    """The components of one block: (a, b) ties each class to its component's smallest."""

    def settled(block: pa.Table) -> pa.Table:
        tied = of_block(block)
        if block.nbytes >= RELEASE_BYTES:
            grams.release()
        return tied

    def of_block(block: pa.Table) -> pa.Table:
        order = np.argsort(block.column("id").to_numpy(), kind="stable")
        ids = block.column("id").to_numpy()[order]
        raw, signed = (block.column(n).to_pylist() for n in ("members", "signature"))
        part = np.arange(len(ids))
        _link(
            [np.frombuffer(raw[i], np.uint64) for i in order.tolist()],
            np.stack([np.frombuffer(signed[i], "<u4") for i in order.tolist()]), part, percent,
            # Pairs with a smaller one have been compared, or were of one component.
            ((i, np.arange(i + 1, len(ids))) for i in range(len(ids))),
        )
        tied = ids != ids[part]
        return pa.table({"a": pa.array(ids[tied]), "b": pa.array(ids[part][tied])})

    return settled


def _crossed(percent: int):
    """The ties (a, b) between components that pairs (a, b) of the rows of two pieces of a block bring."""

    def crossed(pairs: pa.Table, held: pa.Table) -> pa.Table:
        tied = of_cell(pairs, held)
        if held.nbytes >= RELEASE_BYTES:
            grams.release()
        return tied

    def of_cell(pairs: pa.Table, held: pa.Table) -> pa.Table:
        rows, places = np.unique(held.column("row").to_numpy(), return_index=True)
        raw, signed = (held.column(n).take(pa.array(places)).to_pylist() for n in ("members", "signature"))
        was = held.column("component").to_numpy()[places]
        part = was.copy()
        asking, asked = (np.searchsorted(rows, pairs.column(n).to_numpy()) for n in ("a", "b"))
        order = np.argsort(asking, kind="stable")
        centres, firsts = np.unique(asking[order], return_index=True)
        _link(
            [np.frombuffer(s, np.uint64) for s in raw], np.stack([np.frombuffer(s, "<u4") for s in signed]), part, percent,
            zip(centres.tolist(), np.split(asked[order], firsts[1:]), strict=True),
        )
        ties = np.unique(np.stack([was, part])[:, was != part], axis=1)
        return pa.table({"a": pa.array(ties[0]), "b": pa.array(ties[1])})

    return crossed


class _Groups:
    """Links between classes, worked off bucket by bucket."""

    def __init__(self, docs: DataFrame, n: int, percent: int):
        self.n, self.percent = n, percent
        self.docs = docs.select("doc_id", "text")
        self.scratch = Scratch(docs.sparkSession)
        self.signed = self.scratch.keep(
            self.docs.mapInArrow(grams.tidied(_signed(n)), "doc_id long, n_shingles long, set_key binary, bands array<long>"),
            "signed",
        )
        known = self.signed.where("doc_id is not null and set_key is not null")
        self.classes = self.scratch.keep(
            known.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "classes"
        )

    def repeated(self) -> DataFrame | None:
        """The doc_ids of several rows; None if there are none."""
        ids = self.signed.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
        found = self.scratch.keep(ids.select("doc_id"), "repeated")
        return None if found.isEmpty() else found

    def ties(self, repeated: DataFrame) -> DataFrame:
        """(a, b) between the classes that one of the ``repeated`` doc_ids has texts in."""
        held = (
            self.signed.join(repeated, "doc_id").select("doc_id", "set_key").distinct()
            .join(self.classes.select("set_key", F.col("id").alias("a")), "set_key")
        )
        return held.select("doc_id", "a").join(held.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b")

    def components(self) -> DataFrame:
        """(node, component) of all classes that are linked with a smaller one."""
        scratch = self.scratch
        spread = self.classes.select("id", F.explode("bands").alias("bucket"))
        shared = spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
        ties = spread.join(shared, "bucket").select(F.col("id").alias("a"), F.col("first").alias("b"))
        blocks = connected(ties, scratch)
        named = scratch.keep(
            blocks.select(F.col("node").alias("id"), F.col("component").alias("block"))
            .unionByName(blocks.select(F.col("component").alias("id"), F.col("component").alias("block")).distinct()),
            "blocks",
        )
        near = F.broadcast(named) if named.count() <= MAX_SENT_IDS else named
        chosen = self.docs.join(near.select("id"), self.docs.doc_id == F.col("id"), "left_semi")
        self.sets = scratch.keep(
            chosen.mapInArrow(grams.tidied(_full(self.n)), "id long, signature binary, members binary").join(near, "id"), "sets"
        )
        length = F.octet_length("members").cast("long")
        sizes = self.sets.groupBy("block").agg(F.count("*").alias("n"), F.sum(length).alias("bytes"))
        work = F.col("n") * (F.col("bytes") / 8 + F.col("n") * (BANDS * ROWS // 2))
        fits = (work <= MAX_WORK) & (F.col("bytes") <= MAX_BYTES)
        large = scratch.keep(sizes.where(~fits).select("block"), "large")
        small = self.sets.join(large, "block", "left_anti")
        stars = scratch.keep(
            small.groupBy("block").applyInArrow(_settled(self.percent), "a long, b long"), "settled"
        ).select(F.col("a").alias("node"), F.col("b").alias("component"))
        if large.isEmpty():
            return stars
        return stars.unionByName(self._by_rarest(large))

    def _by_rarest(self, large: DataFrame) -> DataFrame:
        """Components of the classes of ``large`` blocks."""
        scratch, percent = self.scratch, self.percent
        self.whole = scratch.keep(
            self.sets.join(large, "block", "left_semi").withColumn("row", F.monotonically_increasing_id()), "whole"
        )
        spread = self.whole.select("block", "row", "id", "members").mapInArrow(
            grams.tidied(_spread), "block long, row long, id long, size long, shingle long"
        )
        common = spread.groupBy("block", "shingle").agg(F.count("*").alias("n")).where("n > 1")
        own = Window.partitionBy("row")
        # Shingles that no other set has come first, then the rarest.
        placed = (
            spread.join(common, ["block", "shingle"])
            .withColumn("place", F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "shingle")) - 1)
            .withColumn("weight", F.sum("n").over(own) / F.col("size"))
        )
        # What follows is all that a set may have in common with one that shares no earlier shingle.
        entries = scratch.keep(
            placed.where(100 * (F.col("size") - F.col("place")) >= percent * F.col("size")).select(
                "block", "shingle", "row", "id", "size", "weight",
                F.expr(f"(size - place) * {100 + percent} div {percent} - size").alias("reach"),
            ),
            "entries",
        )
        fit = (F.col("size") <= F.col("other.reach")) & (F.col("other.size") <= F.col("reach"))
        key = ["block", "shingle"]
        heads = entries.groupBy(key).agg(F.max(F.struct("weight", "row", "size", "reach")).alias("other"))
        votes = (
            entries.join(heads, key).where(fit & (F.col("row") != F.col("other.row")))
            .groupBy("block", F.col("row").alias("a"), F.col("other.row").alias("b")).agg(F.count("*").alias("n"))
        )
        nearest = votes.groupBy("block", "a").agg(F.max(F.struct("n", "b")).alias("to")).select("block", "a", "to.b")
        stars = connected(self._ties_of(nearest, None), scratch)

        named = scratch.keep(self._named(entries.drop("weight"), stars), "named")
        parts = named.groupBy(*key, "component").agg(
            F.count("*").alias("n"), F.min("size").alias("least"), F.max("reach").alias("farthest")
        )
        several = parts.groupBy(key).agg(
            F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("most"),
            F.min("least").alias("least"), F.max("farthest").alias("farthest"),
        ).where("parts > 1")
        rest = (
            named.join(several, key)
            .where((F.col("component") != F.col("most.component")) & (F.col("least") <= F.col("reach")) & (F.col("size") <= F.col("farthest")))
            .select(*key, F.struct("row", "component", "size", "reach", F.col("most.component").alias("most")).alias("other"))
        )
        apart = F.col("component") != F.col("other.component")
        once = (F.col("component") == F.col("other.most")) | (F.col("row") > F.col("other.row"))
        pairs = rest.join(named, key).where(apart & once & fit).select(
            "block", F.col("other.row").alias("a"), F.col("row").alias("b")
        )
        ties = stars.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return connected(ties.unionByName(self._ties_of(pairs.distinct(), stars)), scratch)

    def _named(self, rows: DataFrame, stars: DataFrame | None) -> DataFrame:
        """``rows`` with the component of their id."""
        if stars is None:
            return rows.withColumn("component", F.col("id"))
        named = rows.join(stars.withColumnRenamed("node", "id"), "id", "left")
        return named.withColumn("component", F.coalesce("component", "id"))

    def _ties_of(self, pairs: DataFrame, stars: DataFrame | None) -> DataFrame:
        """(a, b) between the components of ``stars`` that linked pairs (block, a, b) of rows tie."""
        pairs = self.scratch.keep(pairs, "pairs")
        # Rows held against the same ones are dealt to the same pieces.
        asking = self._pieces(pairs.groupBy("block", F.col("a").alias("row")).agg(F.min("b").alias("by")), "asking")
        asked = self._pieces(pairs.select("block", F.col("b").alias("row"), F.col("b").alias("by")).distinct(), "asked")
        placed = self.scratch.keep(
            pairs.join(asking.select(F.col("row").alias("a"), F.col("piece").alias("asking")), "a")
            .join(asked.select(F.col("row").alias("b"), F.col("piece").alias("asked")), "b"),
            "placed",
        )
        cell = ["block", "asking", "asked"]
        cells = self.scratch.keep(placed.select(cell).distinct(), "cells")
        sides = [
            side.withColumnRenamed("piece", name).join(cells, ["block", name]).select(*cell, "row")
            for side, name in ((asking, "asking"), (asked, "asked"))
        ]
        held = sides[0].unionByName(sides[1]).join(self._named(self.whole.drop("block"), stars), "row")
        return (
            placed.select(*cell, "a", "b").groupBy(cell)
            .cogroup(held.select(*cell, "row", "component", "signature", "members").groupBy(cell))
            .applyInArrow(_crossed(self.percent), "a long, b long")
        )

    def _pieces(self, rows: DataFrame, name: str) -> DataFrame:
        """(block, row, piece) of ``rows`` (block, row, by), in the order of ``by``."""
        sized = rows.join(self.whole.select("row", F.octet_length("members").cast("long").alias("bytes")), "row")
        before = Window.partitionBy("block").orderBy("by", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filled = F.sum(F.greatest(F.col("bytes"), F.lit(PIECE_BYTES // PIECE_SETS))).over(before)
        return self.scratch.keep(sized.select("block", "row", filled.alias("filled")).select(
            "block", "row", F.expr(f"filled div {PIECE_BYTES}").alias("piece")
        ), name)


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (``doc_id``, ``text``).

    Documents of ``percent`` similar shingle sets are linked; a component's
    document of the smallest doc_id is kept.
    """
    groups = _Groups(docs, n, percent)
    stars, repeated = groups.components(), groups.repeated()
    if repeated is not None:
        stars = connected(
            stars.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(groups.ties(repeated)),
            groups.scratch,
        )
    stars = stars.select(F.col("node").alias("id"), "component")
    classes = groups.classes.select("set_key", "id").join(stars, "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component")
    )
    rows = groups.signed.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    if repeated is not None:
        # A row without words is of its document's component.
        own = rows.join(repeated, "doc_id").groupBy("doc_id").agg(F.min("component").alias("own"))
        rows = rows.join(own, "doc_id", "left").withColumn("component", F.coalesce("component", "own"))
    return (
        rows.select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, n: int = SHINGLE_WORDS, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """The rows of ``docs`` that are kept; all rows of a kept doc_id stay."""
    gone = near_duplicates(docs, n, percent).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs.doc_id == gone.gone_id, "left_anti")
