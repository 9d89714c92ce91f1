"""Repeated passages: every word covered by a window that an earlier document also has.

A window is ``WINDOW`` consecutive words. Its anchor is the smallest hash among
its ``ANCHOR``-word phrases, so equal windows have equal anchors.

1. Documents of equal words are one class, named by the smallest doc_id; all
   windows of a later copy start in an earlier document, so later copies are
   settled at once and left out of what follows.
2. Anchors found in two documents or more recur; windows with such an anchor
   are counted by their 128-bit hash. Those of two documents or more are
   confirmed, with the smallest doc_id that has them.
3. Documents with recurring anchors are dealt into blocks. Each block gets the
   confirmed windows that its documents hold and compiles the phrases anchoring
   them into one Aho-Corasick automaton over word numbers; every document of
   the block is streamed through it. Around each occurrence the windows are
   looked up; those of a smaller doc_id cover their words.

So automata are sharded with the text and hold no more than the block can use,
whatever the corpus holds. Lists of documents go to all tasks up to a checked
number of rows; beyond it they are joined by doc_id.

Null or empty text has no words. Rows of one doc_id never remove words from
each other; a null doc_id counts as larger than all others. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from feederlens.llm import grams
from feederlens.llm.scratch import Scratch, shuffle_partitions

WINDOW = 50
ANCHOR = 8
_LAST = (1 << 63) - 1
#: Rows of up to some 50 bytes that may go to all tasks.
MAX_SENT_ROWS = 500_000


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    done, covered = values, 1
    while 2 * covered <= width:
        done = np.minimum(done[: len(done) - covered], done[covered:])
        covered *= 2
    rest = width - covered
    return np.minimum(done[: len(done) - rest], done[rest:]) if rest else done


def _windows(flat: np.ndarray, lengths: np.ndarray, window: int):
    """Starts of all windows in the flat words, the text of each, and all places' anchors."""
    starts, texts = grams.gram_starts(lengths, window)
    anchors = _sliding_min(grams.gram_hashes(flat, ANCHOR), window - ANCHOR + 1)
    return starts, texts, anchors


def _window_keys(flat: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    return grams.gram_hashes(flat, window), grams.gram_hashes(flat, window, grams.MULTIPLIERS[1])


def _signed(value: np.ndarray) -> pa.Array:
    return pa.array(value.view(np.int64))


def class_key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, counts = [], []
        for text in batch.column("text").to_pylist():
            words = grams.split_words(text)
            counts.append(len(words))
            keys.append(class_key(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(keys, pa.binary()), pa.array(counts, pa.int64())],
            names=["id", "class_key", "n_words"],
        )


def _anchors(window: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_numpy(), batch.column("text").to_pylist()
            for a, b in grams.in_slices(texts):
                flat, lengths = grams.word_hashes([grams.split_words(t) for t in texts[a:b]])
                starts, of, values = _windows(flat, lengths, window)
                if not len(starts):
                    continue
                values = values[starts]
                new = np.ones(len(values), bool)
                new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
                yield pa.RecordBatch.from_arrays(
                    [_signed(values[new]), pa.array(ids[a:b][of[new]])], names=["anchor", "id"]
                )

    return anchors


def _candidates(window: int):
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_numpy(), batch.column("text").to_pylist()
            wanted = batch.column("anchors").to_pylist()
            for a, b in grams.in_slices(texts):
                flat, lengths = grams.word_hashes([grams.split_words(t) for t in texts[a:b]])
                starts, of, values = _windows(flat, lengths, window)
                if not len(starts):
                    continue
                # Anchors of all texts of the slice together: one too many is only a candidate more.
                known = np.array([x for w in wanted[a:b] for x in w], np.int64).view(np.uint64)
                held = np.isin(values[starts], known)
                one, two = _window_keys(flat, window)
                at, of = starts[held], of[held]
                yield pa.RecordBatch.from_arrays(
                    [_signed(one[at]), _signed(two[at]), _signed(values[at]), pa.array(ids[a:b][of])],
                    names=["w1", "w2", "anchor", "id"],
                )

    return candidates


def covered_words(words: list[bytes], doc: int, confirmed: dict, automaton, window: int) -> np.ndarray:
    """Which words lie in a confirmed window of a smaller document than ``doc``."""
    flat, lengths = grams.word_hashes([words])
    cover = np.zeros(len(words) + 1, np.int64)
    if len(words) < window:
        return cover[:-1] > 0
    one, two = _window_keys(flat, window)
    symbols = tuple((flat & np.uint64(0xFFFFFFFF)).tolist())
    ends = [end for end, _ in automaton.iter(symbols)]
    # Windows that hold the phrase ending at `end`.
    tried = np.zeros(len(one) + 1, np.int64)
    for end in ends:
        tried[max(0, end - window + 1)] += 1
        tried[min(len(one), end - ANCHOR + 2)] -= 1
    for start in np.flatnonzero(np.cumsum(tried[:-1]) > 0).tolist():
        first = confirmed.get((int(one[start]), int(two[start])))
        if first is not None and first < doc:
            cover[start] += 1
            cover[start + window] -= 1
    return np.cumsum(cover[:-1]) > 0


def _automaton(texts: list[list[bytes]], wanted: set[int]):
    """Automaton of the phrases of ``texts`` whose hash is an anchor in ``wanted``."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    known = np.array(sorted(wanted), np.uint64)
    for words in texts:
        flat, _ = grams.word_hashes([words])
        hashes = grams.gram_hashes(flat, ANCHOR)
        for at in np.flatnonzero(np.isin(hashes, known)).tolist():
            automaton.add_word(tuple((flat[at : at + ANCHOR] & np.uint64(0xFFFFFFFF)).tolist()))
    automaton.make_automaton()
    return automaton


def _located(window: int):
    """One block: its documents with text, and the confirmed windows that they hold."""

    def located(key, docs: pa.Table, found: pa.Table) -> pa.Table:
        confirmed, wanted = {}, set()
        w1, w2, anchor = (found.column(n).to_numpy().view(np.uint64).tolist() for n in ("w1", "w2", "anchor"))
        for one, two, phrase, first in zip(w1, w2, anchor, found.column("first").to_pylist(), strict=True):
            confirmed[one, two] = first
            wanted.add(phrase)
        ids = docs.column("id").to_pylist()
        words = [grams.split_words(t) for t in docs.column("text").to_pylist()]
        rows = []
        if wanted:
            automaton = _automaton(words, wanted)
            for doc, one in zip(ids, words, strict=True):
                gone = covered_words(one, doc, confirmed, automaton, window)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                for start, end in edges.reshape(-1, 2).tolist():
                    rows.append((doc, class_key(one), start, end))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "class_key", "start", "end"]
        )

    return located


def _sent(df: DataFrame) -> DataFrame:
    """A written frame, for all tasks if its rows are few enough."""
    return F.broadcast(df) if df.count() <= MAX_SENT_ROWS else df


def _ranked(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "text")


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, class_key, start, end): words ``start`` to before ``end`` of a text that repeat.

    ``id`` is the doc_id (the largest long for null), ``class_key`` the hash of
    the words, which tells texts of one doc_id apart.
    """
    scratch = Scratch(docs.sparkSession)
    ranked = _ranked(docs)
    rows = scratch.keep(ranked.mapInArrow(_classes, "id long, class_key binary, n_words long"), "rows")
    firsts = rows.where(F.col("n_words") >= window).groupBy("class_key").agg(F.min("id").alias("first"))
    copies = scratch.keep(
        rows.join(firsts, "class_key").where("id > first")
        .select("id", "class_key", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")).distinct(),
        "copies",
    )
    # A doc_id with several rows may have other texts too, so it stays; that costs time only.
    single = rows.groupBy("id").agg(F.count("*").alias("n")).where("n = 1").select("id")
    settled = scratch.keep(copies.select("id").join(single, "id", "left_semi").distinct(), "settled")
    texts = ranked.join(_sent(settled), "id", "left_anti")
    anchors = scratch.keep(texts.mapInArrow(_anchors(window), "anchor long, id long").distinct(), "anchors")
    recurring = (
        anchors.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high").select("anchor")
    )
    wanted = scratch.keep(
        anchors.join(recurring, "anchor").groupBy("id").agg(F.collect_list("anchor").alias("anchors")), "wanted"
    )
    scratch.free("anchors")
    blocks = 4 * shuffle_partitions(docs.sparkSession)
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    few = texts.join(_sent(wanted.select("id")), "id", "left_semi")
    hits = scratch.keep(few.join(wanted, "id").select("id", "text", "anchors", block), "hits")
    windows = scratch.keep(
        hits.mapInArrow(_candidates(window), "w1 long, w2 long, anchor long, id long").distinct(), "windows"
    )
    confirmed = (
        windows.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    )
    found = windows.join(confirmed, ["w1", "w2"]).where("id > first").select(block, "w1", "w2", "anchor", "first").distinct()
    spans = (
        hits.select("block", "id", "text").groupBy("block").cogroup(found.groupBy("block"))
        .applyInArrow(_located(window), "id long, class_key binary, start long, end long")
    )
    return scratch.keep(copies.unionByName(spans).distinct(), "spans")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, kept = [], [], []
        spans = batch.column("spans").to_pylist()
        for text, lost in zip(batch.column("text").to_pylist(), spans, strict=True):
            words = grams.split_words(text)
            counts.append(len(words))
            if lost:
                key = class_key(words)
                gone = np.zeros(len(words), bool)
                for span in lost:
                    if span["class_key"] == key:
                        gone[span["start"] : span["end"]] = True
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_text"],
        )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of each row of ``docs`` (``doc_id``, ``text``).

    ``kept_text`` are the words left, joined by one space.
    """
    docs = docs.select("doc_id", "text")
    spans = repeated_spans(docs, window)
    lost = spans.groupBy("id").agg(F.collect_list(F.struct("class_key", "start", "end")).alias("spans"))
    if spans.count() <= MAX_SENT_ROWS:
        lost = F.broadcast(lost)
    ranked = docs.withColumn("id", F.coalesce("doc_id", F.lit(_LAST)))
    return ranked.join(lost, "id", "left").select("doc_id", "text", "spans").mapInArrow(
        _without, "doc_id long, n_words long, n_removed long, kept_text string"
    )
