"""Quality rules: repetition counts and compression bands of a document.

A document is judged by how far zstandard shrinks it. Repetitive text shrinks
far more, noise far less than prose, and short text shrinks less than long, so
each length has its own band. The whole document is compressed, which
sees what repeats from far away, and each fixed chunk alone, which sees a long
document of which much is noise or one line over and over.

The bands come from the table itself (``limits``): the median ratio of all its
distinct texts by length, and so many spreads to either side. Lengths of few
texts borrow from the lengths beside them, and as far as even those are few the
band leans on the fixed ``BANDS``, which hold for all others as well: there is
no number of texts at which it jumps. So the table is read twice, and a
document's band, not its measures, depends on the others; give a stored table
or another cheap plan.

Null or empty text has no words and fails the base rules. Repeated rows count
once, ties and the other columns change nothing; an empty table gives an empty
result. A table of which most is junk of one kind takes that for prose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from feederlens.llm import grams
from feederlens.llm.scratch import Scratch

#: Up to this many bytes: lowest and highest ratio of compressed to plain size, whatever the table.
#: Below 64 bytes the frame's own bytes decide, so nothing is asked.
BANDS = (
    (63, 0.0, 9.0),
    (127, 0.55, 1.35),
    (255, 0.42, 1.10),
    (511, 0.44, 0.92),
    (1023, 0.42, 0.82),
    (2047, 0.40, 0.75),
    (4095, 0.39, 0.70),
    (8191, 0.375, 0.66),
    (16383, 0.365, 0.64),
    (65535, 0.35, 0.62),
    (None, 0.32, 0.60),
)
CHUNK = 4096
#: Lowest and highest ratio of one chunk, and the share of chunks that may lie outside.
CHUNK_BAND = (0.30, 0.80)
CHUNK_SHARE = 0.25
LEVEL = 3

#: Length classes of a doubling; how much less the next class counts than the one before it.
CLASSES_PER_DOUBLING = 4
BORROW = 0.2
#: With so many distinct texts or chunks, a class and what it borrows count as much as the fixed band.
HALF_TRUST = 25
#: Spreads (median absolute deviations) below and above the median that prose may lie.
#: Chosen on the labels of one table, checked on those of another (README); prose with keys and numbers lies high.
LOW_SPREADS = 4.5
HIGH_SPREADS = 8.0
#: Many near copies in a table have less spread than prose has.
MIN_SPREAD = 0.003

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "whole_ratio double, n_chunks long, n_chunks_outside long, whole_inside boolean"
)
_TYPES = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.int64(), pa.bool_()]

#: Log2 of length, median ratio, spread and trust (0 to 1) of each class, of whole texts (False) and of chunks (True).
Limits = dict[bool, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    if "\n" not in text:
        return 0
    spoken = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(spoken) - len(set(spoken))


def _repeats(words: list[list[bytes]]) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in that text."""
    flat, lengths = grams.word_hashes(words)
    starts, texts = grams.gram_starts(lengths, REPEAT_WINDOW)
    if not len(starts):
        return np.zeros(len(words), np.int64)
    keys = grams.gram_hashes(flat, REPEAT_WINDOW)[starts]
    keys = grams.mix(keys + texts.astype(np.uint64) * np.uint64(grams.MULTIPLIERS[1]))
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(flat) + 1, np.int64)
    np.add.at(edge, starts[twice], 1)
    np.add.at(edge, starts[twice] + REPEAT_WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    ends = np.cumsum(lengths)
    return covered[ends] - covered[ends - lengths]


def _pieces(raw: bytes) -> list[bytes]:
    pieces = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]
    # A last chunk of under half the size has a ratio of its own; the whole document answers for it.
    return [p for p in pieces if len(p) >= CHUNK // 2]


def _fixed(n_bytes: int, chunk: bool) -> tuple[float, float]:
    return CHUNK_BAND if chunk else next((low, high) for most, low, high in BANDS if most is None or n_bytes <= most)


def _inside(n_bytes: int, ratio: float, chunk: bool, limits: Limits) -> bool:
    """Whether a whole text or a chunk of ``n_bytes`` compresses as prose does."""
    low, high = band(n_bytes, chunk, limits)
    return bool(low <= ratio <= high)


def band(n_bytes: int, chunk: bool, limits: Limits) -> tuple[float, float]:
    """Lowest and highest ratio of prose of this length."""
    low, high = _fixed(n_bytes, chunk)
    places, medians, spreads, trusts = limits.get(chunk, ((),) * 4)
    if not len(places) or n_bytes <= BANDS[0][0]:
        return low, high
    at = np.log2(n_bytes)
    median, spread, trust = (np.interp(at, places, x) for x in (medians, spreads, trusts))
    # Lengths that the table does not have trust it the less the further they lie off.
    off = max(places[0] - at, at - places[-1], 0.0) * CLASSES_PER_DOUBLING
    trust = trust * BORROW**off
    own = max(low, median - LOW_SPREADS * spread), min(high, median + HIGH_SPREADS * spread)
    return low + trust * (own[0] - low), high + trust * (own[1] - high)


def _measure(texts: list[str], limits: Limits) -> list[list]:
    words = [grams.split_words(t) for t in texts]
    packer = zstandard.ZstdCompressor(level=LEVEL)
    rows = []
    for text, one, repeats in zip(texts, words, _repeats(words).tolist(), strict=True):
        raw = text.encode("utf-8")
        pieces = _pieces(raw)
        ratios = [len(packer.compress(p)) / len(p) for p in pieces]
        whole = len(packer.compress(raw)) / len(raw) if raw else None
        rows.append([
            len(one),
            len(text) - sum(map(text.count, SPACES)),
            sum(map(text.count, SYMBOLS)),
            _lines(text),
            repeats,
            whole,
            len(ratios),
            sum(not _inside(len(p), r, True, limits) for p, r in zip(pieces, ratios, strict=True)),
            _inside(len(raw), whole, False, limits) if raw else False,
        ])
    return rows


def _measured(limits: Limits):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in grams.in_slices(texts):
                columns = zip(*_measure(texts[start:end], limits), strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]
                names = [x.split()[0] for x in MEASURES.split(", ")]
                kept = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *arrays], names=[*batch.schema.names, *names]
                )

    return measured


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, length and ratio of each whole text and each chunk."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for start, end in grams.in_slices([t or "" for t in texts]):
            raws = [t.encode("utf-8") for t in texts[start:end] if t]
            parts = [(False, r) for r in raws] + [(True, p) for r in raws for p in _pieces(r)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk for chunk, _ in parts], pa.bool_()),
                    pa.array([xxhash.xxh3_128_digest(p) for _, p in parts], pa.binary()),
                    pa.array([len(p) for _, p in parts], pa.int64()),
                    pa.array([len(packer.compress(p)) / len(p) for _, p in parts], pa.float64()),
                ],
                names=["chunk", "key", "n_bytes", "ratio"],
            )


def _distances(limits: Limits):
    """Ratios of pieces by how far they lie from the median of their length."""

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
            at, far = np.log2(batch.column("n_bytes").to_numpy()), batch.column("ratio").to_numpy().copy()
            for kind, (places, medians, *_) in limits.items():
                far[chunk == kind] -= np.interp(at[chunk == kind], places, medians)
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("class"), pa.array(np.abs(far))], names=["chunk", "class", "far"]
            )

    return distances


def limits(docs: DataFrame) -> Limits:
    """Median ratio and its spread by length, over all distinct texts and chunks of ``docs``.

    Ratios are counted to four digits, so a class's counts are bounded
    and no order of rows changes a median; what comes back is two rows a class.
    """
    pieces = docs.select("text").mapInArrow(
        grams.tidied(_compressed), "chunk boolean, key binary, n_bytes long, ratio double"
    )
    number = F.floor(F.log2("n_bytes") * CLASSES_PER_DOUBLING).alias("class")
    distinct = pieces.where(F.col("n_bytes") > BANDS[0][0]).groupBy("chunk", "key").agg(
        F.min("n_bytes").alias("n_bytes"), F.min("ratio").alias("ratio")
    )
    stored = Scratch(docs.sparkSession).keep(distinct.select("chunk", number, "n_bytes", "ratio"), "ratios")
    middle = lambda name: F.percentile(F.round(name, 4), 0.5)
    classes = stored.groupBy("chunk", "class").agg(
        F.count("*").alias("n"), F.sum("n_bytes").alias("n_bytes"), middle("ratio").alias("median")
    )
    rows = classes.orderBy("class").collect()
    found: Limits = {}
    shares: dict[bool, np.ndarray] = {}
    for kind in (False, True):
        own = [r for r in rows if r["chunk"] == kind]
        if own:
            shares[kind], trust = _borrowed([r["class"] for r in own], [r["n"] for r in own])
            places = np.log2([r["n_bytes"] / r["n"] for r in own])
            found[kind] = (places, shares[kind] @ [r["median"] for r in own], np.zeros(len(own)), trust)
    if not found:
        return found
    far = stored.mapInArrow(_distances(found), "chunk boolean, class long, far double")
    spread = {(r["chunk"], r["class"]): r["far"] for r in far.groupBy("chunk", "class").agg(middle("far").alias("far")).collect()}
    for kind, (places, medians, _, trust) in found.items():
        own = [spread[kind, r["class"]] for r in rows if r["chunk"] == kind]
        # The neighbours have a say, as near copies may fill one class.
        pooled = shares[kind] @ [np.median(own[max(0, i - 1) : i + 2]) for i in range(len(own))]
        found[kind] = (places, medians, np.maximum(pooled, MIN_SPREAD), trust)
    return found


def _borrowed(classes: list[int], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """How much each class leans on every class, and how far the table is to be trusted there."""
    apart = np.abs(np.subtract.outer(classes, classes))
    weight = BORROW**apart * np.array(counts, float)
    total = weight.sum(1)
    return weight / total[:, None], total / (total + HALF_TRUST)


def measure(docs: DataFrame, bands: Limits | None = None) -> DataFrame:
    """``docs``, which has a column ``text``, with the measures; columns of their names are replaced."""
    names = [x.split()[0] for x in MEASURES.split(", ")]
    docs = docs.drop(*names)
    schema = docs.limit(0).select("*", *(F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in MEASURES.split(", "))).schema
    return docs.mapInArrow(grams.tidied(_measured(bands or {})), schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def in_bands() -> Column:
    """Whether the whole and enough of the chunks compress as prose of their length does."""
    return F.col("whole_inside") & (F.col("n_chunks_outside") <= CHUNK_SHARE * F.col("n_chunks"))


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with measures, ``base_failed`` and ``kept``."""
    return (
        measure(docs, limits(docs))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & in_bands())
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    inner = docs.select(F.struct("*").alias("row"), "text")
    return judge(inner).where("kept").select("row.*")
