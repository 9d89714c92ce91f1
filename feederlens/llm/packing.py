"""Packing of documents into windows by the sum-of-squares rule.

Online, document after document: ``open[h]`` counts the windows filled to
``h`` tokens, and each document goes to the level for which the sum of the
squared counts of partially filled windows becomes smallest. That keeps the
levels varied, so a gap of the right size is nearly always there. Documents
longer than a window give full windows first; the rule places the rest.

Every task packs the documents of its own partition and has windows of its
own; nothing is shuffled and nothing but the level array and the open windows
is held. At the end of a partition the windows still open are closed without
waste: pieces of the emptiest are cut to fill the others, and the very last
window is cut into powers of two, which need no padding.

Null text is empty and gives only the end token. Repeated rows are packed each
for itself. Sequence ids are the partition's number and a count within it; as
a recomputed partition must give the same, pass a stored table (or another
frame whose partitions come again alike).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from feederlens.llm import grams, units

WINDOW = 2048
END_ID = 1
#: Sequence ids of one partition begin at its number times this.
SEQUENCES = 1 << 40
#: Rows of a batch that carries token ids, of which each has up to a window, and bytes of
#: text encoded at once for them: more of either takes memory for little time.
ROWS_WITH_IDS = 250
BYTES_WITH_IDS = 1_000_000

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
IDS = "ids array<int>"


class SumOfSquares:
    """Windows of ``size`` filled online; ``place`` gives the window a piece goes to."""

    def __init__(self, size: int):
        self.size = size
        self.open = np.zeros(size + 1, np.int64)
        self.at: list[list[int]] = [[] for _ in range(size + 1)]
        self.windows = 0

    def _new(self) -> int:
        self.windows += 1
        return self.windows - 1

    def full(self) -> int:
        return self._new()

    def place(self, length: int) -> tuple[int, int]:
        """Window and offset for a piece of ``length`` tokens, under a whole window."""
        counts, top = self.open, self.size - length
        # From level h to h + length: 2 (N[h + length] - N[h]) + 2; nothing is counted for empty and full windows.
        change = 2 * (counts[length : self.size] - counts[:top]) + 2
        change[0] = 2 * counts[length] + 1
        change[1:][counts[1:top] == 0] = np.iinfo(np.int64).max
        level = int(change.argmin())
        if counts[top] and 1 - 2 * counts[top] <= change[level]:
            level = top
        if level:
            window = self.at[level].pop()
            counts[level] -= 1
        else:
            window = self._new()
        if level + length < self.size:
            counts[level + length] += 1
            self.at[level + length].append(window)
        return window, level


def close(open_windows: list[list[tuple]], size: int) -> list[list[tuple]]:
    """Windows without waste from those still open; a piece is (document, start, length)."""
    waiting = sorted(open_windows, key=lambda w: sum(p[2] for p in w))
    closed = []
    while waiting:
        window = waiting.pop()
        room = size - sum(p[2] for p in window)
        while room and waiting:
            doc, start, length = waiting[0].pop()
            taken = min(room, length)
            # The tail of a piece is taken, so what stays is still one piece.
            window.append((doc, start + length - taken, taken))
            if taken < length:
                waiting[0].append((doc, start, length - taken))
            if not waiting[0]:
                waiting.pop(0)
            room -= taken
        closed.append(window)
        if room:
            rest, closed = closed[-1], closed[:-1]
            left = size - room
            while left:
                part, want = [], 1 << (left.bit_length() - 1)
                left -= want
                while want:
                    doc, start, length = rest.pop(0)
                    taken = min(want, length)
                    part.append((doc, start, taken))
                    if taken < length:
                        rest.insert(0, (doc, start + taken, length - taken))
                    want -= taken
                closed.append(part)
    return closed


def pack_partition(lengths: Iterator[tuple[object, int]], size: int = WINDOW) -> Iterator[tuple]:
    """(document, start, length, window, offset) of every piece, for (document, tokens) in order.

    A document's pieces come out as soon as its place is final: with its window
    full, or at the end.
    """
    rule = SumOfSquares(size)
    filled: dict[int, list[tuple]] = {}
    for doc, n in lengths:
        start = 0
        while n - start >= size:
            yield doc, start, size, rule.full(), 0
            start += size
        if start < n:
            window, offset = rule.place(n - start)
            pieces = filled.setdefault(window, [])
            pieces.append((doc, start, n - start))
            if offset + n - start == size:
                yield from _laid(filled.pop(window), window)
    for window in close(list(filled.values()), size):
        yield from _laid(window, rule.full())


def _laid(pieces: list[tuple], window: int) -> Iterator[tuple]:
    offset = 0
    for doc, start, length in pieces:
        yield doc, start, length, window, offset
        offset += length


def _byte_ids(batches: Iterator[pa.RecordBatch], name: str, kept: list, at_once: int) -> Iterator[tuple[int, int]]:
    """(row, tokens) of each document; ``kept`` gets its id and its tokens' bytes."""
    encoder = units.encoder(name)
    end = np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        ids = iter(batch.column(0).to_pylist())
        for texts in units.slices(batch.column(1), at_once):
            flat, offsets = encoder.encode(texts)
            raw, at = memoryview(flat.astype("<u4", copy=False)).cast("B"), (4 * offsets).tolist()
            for a, b in zip(at, at[1:]):
                kept.append([next(ids), bytes(raw[a:b]) + end, 0])
                yield len(kept) - 1, (b - a) // 4 + 1


def pack(docs: DataFrame, size: int = WINDOW, name: str = units.BYTE_BPE, with_ids: bool = False) -> DataFrame:
    """One row for each piece of each document of ``docs`` (``doc_id``, ``text``).

    ``start`` counts the document's tokens before the piece, ``offset`` the
    tokens before it in its sequence. ``with_ids`` adds the token ids. An empty
    table gives an empty result; other columns are not read.
    """
    schema = f"{SCHEMA}, {IDS}" if with_ids else SCHEMA
    most_rows, at_once = (ROWS_WITH_IDS, BYTES_WITH_IDS) if with_ids else (10_000, units.BYTES_AT_ONCE)

    def packed(batches):
        first = TaskContext.get().partitionId() * SEQUENCES
        kept: list = []
        rows = []
        for row, start, length, window, offset in pack_partition(_byte_ids(batches, name, kept, at_once), size):
            doc_id, raw, done = kept[row]
            ids = raw[4 * start : 4 * (start + length)]
            out = (doc_id, start, length, zlib.crc32(ids), len(raw) // 4, first + window, offset)
            rows.append((*out, np.frombuffer(ids, "<u4").astype(np.int32)) if with_ids else out)
            kept[row][2] = done = done + length
            if 4 * done == len(raw):
                kept[row] = None
            if len(rows) >= most_rows:
                yield _batch(rows, with_ids)
                rows = []
        if rows:
            yield _batch(rows, with_ids)

    return docs.select("doc_id", "text").mapInArrow(grams.tidied(packed, uses_kept=True), schema)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids
    types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names
    )
