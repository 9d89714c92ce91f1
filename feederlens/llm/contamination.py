"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items are short and documents long, so their Jaccard similarity says nothing;
what counts is how much of an item's shingle set a document contains. Items are
partitioned by the size of their sets. Each partition has its number of hash
functions, and an item's sketch are its minima under them: a minimum is an
evenly drawn member of the item's set, so a document that contains the share
``c`` of the item holds each minimum with probability ``c``. A document that
holds the partition's least number of them is a candidate; the numbers are set
so that at a containment of 0.8 one pair in some million is missed. Candidates
are decided by exact containment of the shingle sets.

Only built-in functions are used. Documents meet the sketches by one join on
the shingle hash; the sketches go to all tasks up to a checked number of rows,
beyond it the join shuffles. Neither side makes pairs among itself, and a
passage found in a third of all documents costs those documents' rows only.

Words are runs of letters and digits, lower-cased. A text of fewer words than a
shingle is one shingle; where items are that short, documents give their
n-grams of the same length too, so the item is found inside them. Null, empty or wordless text has none and never
matches. Rows sharing a doc_id are one document whose best row counts, and so
with item_ids; null ids are ids of their own. An empty table on either side
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from feederlens.llm.scratch import Scratch

SHINGLE_WORDS = 5
CONTAINED_PERCENT = 80

#: Up to this many shingles in an item: hash functions, and minima a candidate must hold.
PARTITIONS = ((8, 9, 1), (32, 11, 2), (128, 12, 2), (512, 14, 3), (None, 16, 4))

#: Sketch rows or ids that may go to all tasks.
MAX_SENT_ROWS = 500_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(text: Column, n: int = SHINGLE_WORDS, short: Sequence[int] = ()) -> Column:
    """Hashes of the word n-grams in order, then of the ``short`` ones; null for text without words."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def runs(h: Column, k: int) -> Column:
        # As the hash of a whole text of k words.
        return F.transform(F.sequence(F.lit(1), F.size(h) - k + 1), lambda i: F.xxhash64(F.slice(h, i, k)))

    def grams(h: Column) -> Column:
        size = F.size(h)
        several = F.transform(
            F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(n)))
        )
        usual = F.when(size >= n, several).when(size > 0, F.array(F.xxhash64(h)))
        fewer = [F.when(size >= k, runs(h, k)).otherwise(F.array().cast("array<bigint>")) for k in short]
        return F.concat(usual, *fewer) if fewer else usual

    # The word hashes are named once, so that they are computed once.
    return F.element_at(F.transform(F.array(hashed), grams), 1)


def _by_size(place: int) -> Column:
    size, value = F.size("item_set"), F.lit(PARTITIONS[-1][place])
    for partition in reversed(PARTITIONS[:-1]):
        value = F.when(size <= partition[0], partition[place]).otherwise(value)
    return value


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_SENT_ROWS else df


def contained(
    docs: DataFrame, items: DataFrame, n: int = SHINGLE_WORDS, percent: int = CONTAINED_PERCENT
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) of each document that contains ``percent`` of an item.

    ``docs`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``.
    """
    scratch = Scratch(docs.sparkSession)
    sets = scratch.keep(
        items.select("item_id", F.array_distinct(shingles(F.col("text"), n)).alias("item_set"), F.size(words(F.col("text"))).alias("n_words"))
        .where("item_set is not null")
        .select("item_id", "item_set", "n_words", F.xxhash64("item_set").alias("set_id"),
                _by_size(1).alias("functions"), _by_size(2).alias("least")),
        "items",
    )
    short = sorted(r["n_words"] for r in sets.where(F.col("n_words") < n).select("n_words").distinct().collect())
    member = sets.dropDuplicates(["set_id"]).select("set_id", "functions", "least", F.explode("item_set").alias("shingle"))
    drawn = (
        member.select("set_id", "least", "shingle", F.explode(F.sequence(F.lit(1), "functions")).alias("function"))
        .groupBy("set_id", "least", "function")
        .agg(F.min_by("shingle", F.xxhash64("function", "shingle")).alias("shingle"))
    )
    sketch = scratch.keep(
        drawn.groupBy("set_id", "least", "shingle").agg(F.count("*").alias("minima")), "sketch"
    )
    spread = docs.select("doc_id", F.explode(shingles(F.col("text"), n, short)).alias("shingle"))
    held = spread.join(_sent(sketch), "shingle").distinct()
    candidates = scratch.keep(
        held.groupBy("doc_id", "set_id").agg(F.sum("minima").alias("minima"), F.first("least").alias("least"))
        .where("minima >= least").select(F.col("doc_id").alias("candidate"), "set_id"),
        "candidates",
    )
    ids = candidates.select("candidate").distinct()
    few = docs.select("doc_id", "text").join(_sent(ids), F.col("doc_id").eqNullSafe(F.col("candidate")), "left_semi")
    whole = few.select("doc_id", F.array_distinct(shingles(F.col("text"), n, short)).alias("doc_set"))
    shared = (
        whole.join(candidates, F.col("doc_id").eqNullSafe(F.col("candidate")))
        .join(_sent(sets.select("set_id", "item_id", "item_set")), "set_id")
        .select(
            "doc_id", "item_id", F.size(F.array_intersect("doc_set", "item_set")).cast("long").alias("n_shared"),
            F.size("item_set").cast("long").alias("n_item"),
        )
        .where(100 * F.col("n_shared") >= percent * F.col("n_item"))
    )
    # The best row of a document and an item.
    return shared.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("share"), "n_shared", "n_item")).alias("best")
    ).select("doc_id", "item_id", "best.n_shared", "best.n_item")


def keep_clean(docs: DataFrame, items: DataFrame, n: int = SHINGLE_WORDS, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id contains no item."""
    found = contained(docs, items, n, percent).select(F.col("doc_id").alias("found_id")).distinct()
    return docs.join(found, docs.doc_id.eqNullSafe(found.found_id), "left_anti")
