"""Token ids of many texts at once, from the distinct words of a batch.

Both vocabularies of the tokenizers library split text before a single space
and at line feeds, so a text is its units end to end: words with what leads
them. Arrow splits a batch and numbers its distinct units, the library encodes
those not met before, many in one call, and numpy lays the ids of the texts
out of a flat table. No Python runs for a word met before.

Texts for which the split is not certain (runs of white space, control
characters, white space of other scripts, special strings) are encoded as a
whole by the library.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from feederlens.llm import grams

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

#: Units whose tokens a task holds at once, in two generations.
CACHED_UNITS = 250_000

#: Bytes of text of which the units are told apart at once.
BYTES_AT_ONCE = 8_000_000

#: Leads the first unit of a text, which no space precedes; texts that hold it are encoded as a whole.
HEAD = "\x01"

#: Control characters and white space other than space and line feed.
_ODD = r"[\x00-\x09\x0b-\x1f\x7f-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}]"
#: White space of which one token may hold several signs.
_RUNS = r"|  | \n| \z|\n\n\n|\n\n |\n\n\z"
_SPECIAL = r"|<\|"

#: A word of letters that are one code point each in every case, then one sign: always two pieces for the vocabularies.
_ENDED = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+[.,:;!?]")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def load(name: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(public_tokenizers.path(name))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places ``start .. start + length - 1`` of every run, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def ends_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets of runs of these lengths, from 0 on."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class Ragged:
    """Growing list of number arrays, kept flat."""

    def __init__(self, dtype):
        self.flat, self.used = np.empty(1 << 16, dtype), 0
        self.starts, self.lengths, self.n = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = _room(self.flat, self.used, len(flat))
        self.starts, self.lengths = (_room(x, self.n, len(lengths)) for x in (self.starts, self.lengths))
        self.flat[self.used : self.used + len(flat)] = flat
        here = slice(self.n, self.n + len(lengths))
        self.lengths[here] = lengths
        self.starts[here] = self.used + np.cumsum(lengths) - lengths
        self.used += len(flat)
        self.n += len(lengths)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[rows]
        return self.flat[spread(self.starts[rows], lengths)], lengths


def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(array):
        return array
    grown = np.empty(max(2 * len(array), used + more), array.dtype)
    grown[:used] = array[:used]
    return grown


class UnitTable:
    """Arrays of distinct units, made once; a bounded table in two generations.

    ``make`` gives, for each column, the arrays of some units as flat numbers and lengths.
    """

    def __init__(self, make: Callable[[list[str]], list[tuple[np.ndarray, np.ndarray]]], dtypes: Sequence):
        self.make, self.dtypes = make, dtypes
        self.old: tuple[dict[str, int], list[Ragged]] = ({}, [])
        self._begin()

    def _begin(self) -> None:
        self.slot: dict[str, int] = {}
        self.columns = [Ragged(d) for d in self.dtypes]

    def slots(self, units: list[str]) -> np.ndarray:
        """Row of each unit in ``columns``; rows hold until the next call."""
        if len(self.slot) > CACHED_UNITS:
            self.old = (self.slot, self.columns)
            self._begin()
        rows = list(map(self.slot.get, units))
        missing = [u for u, row in zip(units, rows, strict=True) if row is None]
        if missing:
            self.add(missing)
            rows = list(map(self.slot.get, units))
        return np.array(rows, np.int64)

    def add(self, units: list[str]) -> None:
        """Rows for distinct units that have none."""
        slot, columns = self.old
        known = [u for u in units if u in slot]
        if known:
            rows = np.fromiter(map(slot.__getitem__, known), np.int64, len(known))
            self.put(known, [c.take(rows) for c in columns])
            units = [u for u in units if u not in slot]
        if units:
            self.put(units, self.make(units))

    def put(self, units: list[str], arrays: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.slot.update(zip(units, range(len(self.slot), len(self.slot) + len(units)), strict=True))
        for column, (flat, lengths) in zip(self.columns, arrays, strict=True):
            column.append(flat, lengths)


def sure_units(
    texts: pa.Array, pattern: str, line: str = " \n", head: str = ""
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Which texts ``pattern`` does not doubt, units of each, their numbers, and the distinct units.

    A unit is a word that a space leads, or, where ``line`` keeps them, a line
    feed and a word. ``head`` marks the first of each text. Doubted texts are
    as empty ones; null is empty.
    """
    texts = pc.fill_null(texts, "")
    sure = pc.invert(pc.match_substring_regex(texts, pattern))
    marked = pc.replace_substring(pc.if_else(sure, texts, ""), "\n", line)
    if head:
        marked = pc.binary_join_element_wise(head, marked, "")
    lists = pc.split_pattern(marked, " ")
    distinct = lists.flatten().dictionary_encode()
    return (
        sure.to_numpy(zero_copy_only=False),
        pc.list_value_length(lists).to_numpy(zero_copy_only=False),
        distinct.indices.to_numpy(zero_copy_only=False),
        distinct.dictionary.to_numpy(zero_copy_only=False).tolist(),
    )


class TextEncoder:
    """Ids of whole texts as the tokenizers library gives them."""

    def __init__(self, name: str):
        self.tokenizer = load(name)
        self.mark = "<|endoftext|>"
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        vocabulary = self.tokenizer.get_vocab()
        #: Whether white space and case are dropped and tokens tell where a word ends.
        self.folds = "a</w>" in vocabulary
        self.doubts = _ODD + _SPECIAL + ("" if self.folds else _RUNS)
        self.ends = _flags(vocabulary, lambda t: t.endswith("</w>"))
        self.spaced = _flags(vocabulary, lambda t: t.startswith("\u0120"))
        self.lines = _flags(vocabulary, lambda t: t == "\u010a")
        self.signs = {s: vocabulary.get(s + "</w>") for s in ".,:;!?"}
        self.words = UnitTable(self._encoded, [np.uint32])
        #: Where case is dropped, units share words.
        self.units = UnitTable(self._of_words, [np.uint32]) if self.folds else self.words

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts end to end, each encoded as a whole, and the number of each."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _joined(self, words: list[str], size: int, between: str, before: str, begins: np.ndarray) -> tuple:
        """Words encoded ``size`` at a time, each beginning where a token of ``begins`` does."""
        flat, _ = self.whole([before + between.join(words[i : i + size]) for i in range(0, len(words), size)])
        return _cut(flat, np.flatnonzero(begins[flat]), len(words))

    def _marked(self, words: list[str]) -> tuple:
        """The same with a special string after each word, which any word allows."""
        flat, _ = self.whole(["".join(w + self.mark for w in words[i : i + 200]) for i in range(0, len(words), 200)])
        after = np.flatnonzero(flat == self.mark_id)
        flat, lengths = _cut(flat, np.append(0, after[:-1] + 1), len(words))
        return np.delete(flat, after), lengths - 1

    def _encoded(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Words by the cheapest way that each kind allows: far cheaper than one by one."""
        kinds = defaultdict(list)
        for row, word in enumerate(words):
            kinds[bool(_LETTERS.fullmatch(word)) if self.folds else word[:1] in ("\n", HEAD) and word[:1]].append(row)
        done, order = Ragged(np.uint32), []
        for kind, rows in kinds.items():
            some = [words[row] for row in rows]
            if kind is True:
                flat, _ = self.whole([" ".join(some[i : i + 1000]) for i in range(0, len(some), 1000)])
                last = np.flatnonzero(self.ends[flat])
                done.append(*_cut(flat, np.append(0, last[:-1] + 1), len(some)))
            elif self.folds:
                done.append(*self._marked(some))
            elif kind == HEAD:
                done.append(*self._marked([w[1:] for w in some]))
            elif kind == "\n":
                done.append(*self._joined(some, 20, "", "", self.lines))
            else:
                done.append(*self._joined(some, 20, " ", " ", self.spaced))
            order += rows
        return [done.take(np.argsort(np.array(order)))]

    def _of_words(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A word that ends in a sign is the word and the sign, so only the word is encoded."""
        ended = [bool(_ENDED.fullmatch(u)) for u in units]
        words = [u[:-1] if e else u for u, e in zip(units, ended, strict=True)]
        # Lowering takes some letters of other scripts apart.
        words = [w.lower() if w.isascii() else w for w in words]
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        rows = self.words.slots(list(number))[np.fromiter(map(number.__getitem__, words), np.int64, len(words))]
        flat, lengths = self.words.columns[0].take(rows)
        signed = np.array(ended)
        ends = np.cumsum(lengths + signed)
        out = np.empty(len(flat) + int(signed.sum()), np.uint32)
        out[spread(ends - lengths - signed, lengths)] = flat
        out[ends[signed] - 1] = [self.signs[u[-1]] for u, e in zip(units, ended, strict=True) if e]
        return [(out, lengths + signed)]

    def _rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which texts are sure, where the units of each end, and the table's row of every unit."""
        line, head = (" ", "") if self.folds else (" \n", HEAD)
        sure, counts, numbers, distinct = sure_units(texts, self.doubts, line, head)
        return sure, ends_of(counts), self.units.slots(distinct)[numbers]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and their offsets; null is empty."""
        sure, ends, rows = self._rows(texts)
        flat, lengths = self.units.columns[0].take(rows)
        offsets = ends_of(lengths)[ends]
        doubted = np.flatnonzero(~sure)
        if len(doubted):
            parts = np.split(flat, offsets[1:-1])
            for row in doubted.tolist():
                parts[row] = self.whole([texts[row].as_py()])[0]
            flat, offsets = np.concatenate(parts), ends_of(np.fromiter(map(len, parts), np.int64, len(parts)))
        return flat, offsets

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        sure, ends, rows = self._rows(texts)
        found = np.diff(ends_of(self.units.columns[0].lengths[rows])[ends])
        for row in np.flatnonzero(~sure).tolist():
            found[row] = self.whole([texts[row].as_py()])[1][0]
        return found


def _flags(vocabulary: dict[str, int], wanted: Callable[[str], bool]) -> np.ndarray:
    flags = np.zeros(len(vocabulary), bool)
    flags[[i for token, i in vocabulary.items() if wanted(token)]] = True
    return flags


def _cut(flat: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    assert len(begins) == n and begins[0] == 0, "a word is not one run of tokens"
    return flat, np.diff(np.append(begins, len(flat)))


_ENCODERS: dict[str, TextEncoder] = grams.kept_between_tasks()


def encoder(name: str) -> TextEncoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = TextEncoder(name)
    return _ENCODERS[name]


def slices(texts: pa.Array, most_bytes: int = BYTES_AT_ONCE) -> Iterator[pa.Array]:
    """Consecutive parts of a batch with about ``most_bytes`` of text; one text is never cut."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // most_bytes
    begins = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(begins, np.append(begins[1:], len(part)), strict=True):
        yield texts.slice(a, b - a)
