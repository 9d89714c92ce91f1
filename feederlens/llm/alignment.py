"""Tokens of two vocabularies aligned by the bytes that they cover.

For the distinct words of a block of documents, hand-built CSR matrices tell
which bytes a token covers. The row product A·Bᵀ of token and byte links the
tokens that overlap, with the bytes they share; cutting where tokens of both
end gives groups, and the product of the group matrices links tokens of one
group. A document is the sum of its words, for both vocabularies part text at
single spaces and around line feeds; the vocabulary of pieces is tested for it.

How often two ids are linked is counted over the whole corpus: a block sends
each of its id pairs once, with a count, and gets back the corpus's count and
whether it is the highest of its second id. Blocks are cut by the units they
hold, so neither texts nor links of documents are shuffled, only ids of pairs
by block and, compressed, the word numbers of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from feederlens.llm import grams, units
from feederlens.llm.scratch import Scratch

PIECES = "piece_bpe_32k.model"
SPACE = "▁"

#: A block ends with this many distinct units or, repeated ones too, units.
BLOCK_DISTINCT = 250_000
BLOCK_UNITS = 4_000_000
#: Units whose matrices are held at once.
UNITS_AT_ONCE = 10_000
#: Pairs in a row of the stored blocks.
PAIRS_PER_ROW = 10_000

#: Texts whose parts may not be encoded one by one, with a space before them; special strings are plain text here.
DOUBTS = units._ODD + units._RUNS + r"|\A[ \n]|\A\z"

STORED = (
    "block long, kind string, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
    "groups_sha256 string, data binary, at array<int>, a array<int>, b array<int>, n array<long>"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, n_group_links long"
)
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]


@dataclass
class Csr:
    """Sparse matrix by rows: row i has ``columns[starts[i]:starts[i + 1]]`` with these values."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of_runs(cls, begins: np.ndarray, lengths: np.ndarray, width: int) -> Csr:
        """Row i is one on the columns from ``begins[i]``, ``lengths[i]`` of them."""
        columns = units.spread(begins, lengths)
        return cls(units.ends_of(lengths), columns, np.ones(len(columns), np.int64), width)

    @property
    def rows(self) -> np.ndarray:
        """Row of each value."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        return Csr(units.ends_of(counts), self.rows[order], self.values[order], len(self.starts) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of the rows of ``other`` that row i names."""
        lengths = np.diff(other.starts)[self.columns]
        taken = units.spread(other.starts[self.columns], lengths)
        rows = np.repeat(self.rows, lengths)
        columns, values = other.columns[taken], np.repeat(self.values, lengths) * other.values[taken]
        keys = rows * other.width + columns
        if np.any(keys[1:] < keys[:-1]):
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        sums = np.add.reduceat(values, first) if len(first) else values
        keys = keys[first]
        counts = np.bincount(keys // other.width, minlength=len(self.starts) - 1) if len(keys) else np.zeros(len(self.starts) - 1, int)
        return Csr(units.ends_of(counts), keys % max(other.width, 1), sums, other.width)


class _Vocabulary:
    """Bytes of every id, flat."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = units.ends_of(self.lengths)[:-1]
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.text = [str(i) for i in range(len(entries))]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[units.spread(self.starts[ids], self.lengths[ids])]


def _byte_level() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabularies:
    """Ids of units in both vocabularies, a space before each or a line feed in front."""

    def __init__(self):
        import sentencepiece

        self.first = units.TextEncoder(units.BYTE_BPE)
        self.first.tokenizer.encode_special_tokens = True
        byte = _byte_level()
        entries = sorted(self.first.tokenizer.get_vocab().items(), key=lambda e: e[1])
        self.a = _Vocabulary([bytes(byte[c] for c in token) for token, _ in entries])
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        # No piece goes on behind a space or holds a line feed, so none crosses the border of two units.
        assert not any(SPACE in n.lstrip(SPACE) or "\n" in n for n in names)
        self.space = names.index(SPACE)
        self.b = _Vocabulary([self._piece(i, n) for i, n in enumerate(names)])

    def _piece(self, i: int, name: str) -> bytes:
        if self.pieces.is_byte(i):
            return bytes([int(name[3:5], 16)])
        if self.pieces.is_unknown(i) or self.pieces.is_control(i):
            return b""
        return name.replace(SPACE, " ").encode()

    def of_units(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of units and the number of each, in the first vocabulary and in the second."""
        [(a, n_a)] = self.first._encoded(some)
        found = self.pieces.encode(some, num_threads=1)
        # A line feed is led by the piece of the space that the library puts before each input.
        found = [x[1:] if u[:1] == "\n" and x[0] == self.space else x for u, x in zip(some, found, strict=True)]
        return a, n_a, *_flat(found)

    def of_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, n_a = self.first.whole([" " + t for t in texts])
        return a, n_a, *_flat(self.pieces.encode(texts, num_threads=1))


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((i for one in found for i in one), np.int64, int(lengths.sum())), lengths


@dataclass
class Aligned:
    """Units aligned: measures by unit, texts of the groups, and id pairs (a << 32 | b), flat, with their number by unit."""

    fits: np.ndarray
    measures: np.ndarray
    groups: list[bytes]
    pairs: np.ndarray
    n_pairs: np.ndarray


def align(raw: list[bytes], both: Vocabularies, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> Aligned:
    """Aligns the tokens of units with these bytes. Units whose tokens do not spell their bytes have none."""
    a = a.astype(np.int64)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    spelled = np.frombuffer(b"".join(raw), np.uint8)
    fits = _spells(both.a, a, n_a, sizes, spelled) & _spells(both.b, b, n_b, sizes, spelled)
    a, b = a[np.repeat(fits, n_a)], b[np.repeat(fits, n_b)]
    n_a, n_b, sizes = n_a * fits, n_b * fits, sizes * fits
    total = int(sizes.sum())

    len_a, len_b = both.a.lengths[a], both.b.lengths[b]
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    covers_a = Csr.of_runs(end_a - len_a, len_a, total)
    covers_b = Csr.of_runs(end_b - len_b, len_b, total)
    overlaps = covers_a.times(covers_b.transposed())

    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    grouped = Csr.of_runs(group_a, np.ones_like(group_a), len(cuts)).times(
        Csr.of_runs(group_b, np.ones_like(group_b), len(cuts)).transposed()
    )

    ends_a, ends_b = units.ends_of(n_a), units.ends_of(n_b)
    unit_cuts = np.searchsorted(cuts, np.cumsum(sizes), "right")
    n_links = np.diff(overlaps.starts[ends_a])
    measures = np.stack([n_a, n_b, np.diff(unit_cuts, prepend=0), n_links, np.diff(grouped.starts[ends_a])], axis=1)
    pairs = a[overlaps.rows] << 32 | b[overlaps.columns]

    text_a, text_b = list(map(both.a.text.__getitem__, a.tolist())), list(map(both.b.text.__getitem__, b.tolist()))
    # A token of the second begins a group where the group changes.
    last_a = np.searchsorted(end_a, cuts, "right").tolist()
    last_b = np.searchsorted(end_b, cuts, "right").tolist()
    parts, i, j = [], 0, 0
    for p, q in zip(last_a, last_b, strict=True):
        parts.append(",".join(text_a[i:p]) + "|" + ",".join(text_b[j:q]))
        i, j = p, q
    bounds = [0, *unit_cuts.tolist()]
    groups = [";".join(parts[x:y]).encode() for x, y in zip(bounds, bounds[1:])]
    return Aligned(fits, measures, groups, pairs, n_links)


def _spells(vocabulary: _Vocabulary, ids: np.ndarray, counts: np.ndarray, sizes: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Whether the joined bytes of each unit's tokens are the unit's."""
    ends = units.ends_of(vocabulary.lengths[ids])[units.ends_of(counts)]
    made = np.diff(ends)
    fits = made == sizes
    flat = vocabulary.bytes_of(ids)
    starts = units.ends_of(sizes)[:-1]
    same = flat[units.spread(ends[:-1][fits], sizes[fits])] == raw[units.spread(starts[fits], sizes[fits])]
    wrong = np.repeat(np.flatnonzero(fits), sizes[fits])[~same]
    fits[wrong] = False
    return fits


class _Block:
    """Units of some documents in a row, and those documents' unit numbers."""

    def __init__(self, number: int, both: Vocabularies):
        self.number, self.both = number, both
        self.slot: dict[str, int] = {}
        self.pairs = units.Ragged(np.int64)
        self.measures = units.Ragged(np.int64)
        self.fits: list[np.ndarray] = []
        self.groups: list[bytes] = []
        self.used = 0
        self.documents: list[tuple] = []
        self.numbers: list[np.ndarray] = []
        self.squeeze = zstandard.ZstdCompressor(level=1).compress

    @property
    def full(self) -> bool:
        return len(self.groups) >= BLOCK_DISTINCT or self.used >= BLOCK_UNITS

    def _keep(self, found: Aligned) -> None:
        self.pairs.append(found.pairs, found.n_pairs)
        self.measures.append(found.measures.ravel(), np.full(len(found.groups), len(MEASURES)))
        self.fits.append(found.fits)
        self.groups += found.groups

    def _numbers_of(self, distinct: list[str]) -> np.ndarray:
        numbers = list(map(self.slot.get, distinct))
        missing = [u for u, n in zip(distinct, numbers, strict=True) if n is None]
        for at in range(0, len(missing), UNITS_AT_ONCE):
            some = missing[at : at + UNITS_AT_ONCE]
            raw = [(u if u[:1] == "\n" else " " + u).encode() for u in some]
            self.slot.update(zip(some, range(len(self.groups), len(self.groups) + len(some)), strict=True))
            self._keep(align(raw, self.both, *self.both.of_units(some)))
        if missing:
            numbers = list(map(self.slot.get, distinct))
        return np.array(numbers, np.int64)

    def add(self, doc_ids: list, texts: pa.Array) -> None:
        sure, counts, numbers, distinct = units.sure_units(texts, DOUBTS)
        # Doubted texts stand there as one empty unit.
        known = self._numbers_of([u for u in distinct if u])
        table = np.full(len(distinct), -1, np.int64)
        table[[i for i, u in enumerate(distinct) if u]] = known
        rows = np.split(table[numbers], np.cumsum(counts)[:-1])
        for i in np.flatnonzero(~sure).tolist():
            text = texts[i].as_py()
            rows[i] = np.empty(0, np.int64)
            if text:
                rows[i] = np.array([len(self.groups)])
                self._keep(align([(" " + text).encode()], self.both, *self.both.of_texts([text])))
        fits = np.concatenate(self.fits) if self.fits else np.empty(0, bool)
        self.fits = [fits]
        sums = self.measures.flat[: self.measures.used].reshape(-1, len(MEASURES))
        for doc_id, own in zip(doc_ids, rows, strict=True):
            if not len(own) or not fits[own].all():
                own = own[:0]
            text = hashlib.sha256(b";".join(map(self.groups.__getitem__, own.tolist()))).hexdigest() if len(own) else ""
            self.documents.append((doc_id, *sums[own].sum(axis=0).tolist(), text, self.squeeze(own.astype("<i4").data)))
            self.numbers.append(own)
            self.used += len(own)

    def stored(self) -> Iterator[pa.RecordBatch]:
        """The documents, then the pairs of each unit, then the distinct pairs with their counts."""
        doc_ids, n_a, n_b, n_groups, n_links, n_group_links, texts, data = zip(*self.documents, strict=True)
        yield _rows(
            self.number, "document", len(doc_ids), doc_id=pa.array(doc_ids, pa.int64()), n_a=n_a, n_b=n_b,
            n_groups=n_groups, n_links=n_links, n_group_links=n_group_links, groups_sha256=texts, data=data,
        )
        used = np.bincount(np.concatenate(self.numbers), minlength=self.pairs.n)
        lengths = self.pairs.lengths[: self.pairs.n]
        pairs, which = np.unique(self.pairs.flat[: self.pairs.used], return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, which, np.repeat(used, lengths))
        sent = np.append(lengths, which).astype("<i4")
        yield _rows(self.number, "units", 1, n_a=[self.pairs.n], data=[self.squeeze(sent.data)])
        for i in range(0, len(pairs), PAIRS_PER_ROW):
            some, n = pairs[i : i + PAIRS_PER_ROW], counts[i : i + PAIRS_PER_ROW]
            used_here = np.flatnonzero(n)
            yield _rows(
                self.number, "pairs", 1, at=[(used_here + i).astype(np.int32)], a=[(some[used_here] >> 32).astype(np.int32)],
                b=[(some[used_here] & 0xFFFFFFFF).astype(np.int32)], n=[n[used_here]],
            )


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _rows(block: int, kind: str, count: int, **columns) -> pa.RecordBatch:
    fields = [f.split() for f in STORED.split(", ")]
    columns |= {"block": [block] * count, "kind": [kind] * count}
    arrays = [pa.array(columns[c], _KINDS[k]) if c in columns else pa.nulls(count, _KINDS[k]) for c, k in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[c for c, _ in fields])


_BOTH: list[Vocabularies] = []


def _blocks(docs: DataFrame) -> DataFrame:
    def blocks(batches):
        if not _BOTH:
            _BOTH.append(Vocabularies())
        first = TaskContext.get().partitionId() << 32
        block, done = _Block(first, _BOTH[0]), 0
        for batch in batches:
            at = 0
            for texts in units.slices(batch.column(1), 4_000_000):
                block.add(batch.column(0).slice(at, len(texts)).to_pylist(), texts)
                at += len(texts)
                if block.full:
                    yield from block.stored()
                    done += 1
                    block = _Block(first + done, _BOTH[0])
        if block.documents:
            yield from block.stored()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(grams.tidied(blocks), STORED)


def _documents(stored: pa.Table, counted: pa.Table) -> pa.Table:
    """Documents of a block with what the corpus counted for their pairs."""
    unpack = zstandard.ZstdDecompressor().decompress
    kinds = stored["kind"]
    one = stored.filter(pc.equal(kinds, "units")).slice(0, 1).to_pylist()[0]
    sent = np.frombuffer(unpack(one["data"]), "<i4").astype(np.int64)
    lengths, which = sent[: one["n_a"]], sent[one["n_a"] :]
    n_pairs = int(which.max()) + 1 if len(which) else 0
    count, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
    at = counted["at"].to_numpy()
    count[at], best[at] = counted["n_corpus"].to_numpy(), counted["is_best"].to_numpy()
    ends = units.ends_of(lengths)
    by_unit = [np.diff(units.ends_of(x[which])[ends]) for x in (count, best)]
    documents = stored.filter(pc.equal(kinds, "document"))
    sums = [
        [int(x[own].sum()) for x in by_unit]
        for own in (np.frombuffer(unpack(d), "<i4") for d in documents["data"].to_pylist())
    ]
    return pa.table({
        **{c: documents[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
        "n_best": pa.array([s[1] for s in sums], pa.int64()), "count_sum": pa.array([s[0] for s in sums], pa.int64()),
        "groups_sha256": documents["groups_sha256"], "n_group_links": documents["n_group_links"],
    })


def pair_counts(stored: DataFrame) -> DataFrame:
    """(a, b, n_corpus, is_best): how often two ids are linked, and whether no other first id is linked to ``b`` more often."""
    counted = stored.where("kind = 'pairs'").select(F.inline(F.arrays_zip("a", "b", "n"))).groupBy("a", "b").agg(
        F.sum("n").alias("n_corpus")
    )
    highest = F.max("n_corpus").over(Window.partitionBy("b"))
    return counted.withColumn("is_best", F.col("n_corpus") == highest)


def aligned(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): tokens, groups and links of both vocabularies.

    ``n_best`` counts the links whose count is the highest of their second id,
    ``count_sum`` adds the corpus's counts over links, ``n_group_links`` counts
    the pairs of tokens of one group. Texts that are null, empty, or not
    spelled byte for byte by both have zeros and an empty ``groups_sha256``.
    Repeated rows and ids are each a document and count each time; other
    columns are not read; an empty table gives an empty result. A document and
    a block of distinct words are held at once, no more. Stores the blocks in
    a job of its own.
    """
    stored = Scratch(docs.sparkSession).keep(_blocks(docs), "blocks")
    sent = stored.where("kind = 'pairs'").select(F.col("block").alias("of_block"), F.inline(F.arrays_zip("at", "a", "b")))
    back = sent.join(pair_counts(stored), ["a", "b"]).select("of_block", "at", "n_corpus", "is_best")
    kept = stored.where("kind != 'pairs'").drop("at", "a", "b", "n")
    return (
        kept.groupBy("block").cogroup(back.groupBy("of_block"))
        .applyInArrow(lambda left, right: _documents(left, right), RESULT)
    )
