"""Words and word n-grams as 64-bit numbers, many texts at once."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash

#: Words whose hash a task holds at once; the table is emptied when it is full.
CACHED_WORDS = 400_000

#: Odd multipliers of the polynomial hashes; two of them make a 128-bit key.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

MASK = (1 << 64) - 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


_HASHES = _WordHashes()

#: What the tasks of one kind keep in a worker for those after them.
_KEPT: list[dict] = []


def kept_between_tasks() -> dict:
    """A table that a worker keeps until a task comes that does not use such tables."""
    _KEPT.append({})
    return _KEPT[-1]


def let_go() -> None:
    """Empties the tables kept between tasks."""
    if any(_KEPT):
        for table in _KEPT:
            table.clear()
        gc.collect()
        release()


def release() -> None:
    """Gives what this process holds beyond need back to the system."""
    _HASHES.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(function: Callable, uses_kept: bool = False) -> Callable:
    """``function`` of a task's batches, after which an idle worker holds no memory that the next stage needs.

    Tables kept between tasks stay only where it ``uses_kept`` ones.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not uses_kept:
            let_go()
        yield from function(batches)
        release()

    return tidy


def split_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; bytes.split() knows exactly these six separators."""
    return text.encode("utf-8").split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def word_hashes(words: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of many texts end to end, and the number of words of each."""
    if len(_HASHES) >= CACHED_WORDS:
        _HASHES.clear()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    get = _HASHES.__getitem__
    flat = np.empty(int(lengths.sum()), np.uint64)
    at = 0
    for one in words:
        flat[at : at + len(one)] = np.fromiter(map(get, one), np.uint64, len(one))
        at += len(one)
    return flat, lengths


def gram_hashes(flat: np.ndarray, n: int, multiplier: int = MULTIPLIERS[0]) -> np.ndarray:
    """Polynomial hash of the n numbers from each place on, over the whole of ``flat``.

    Doubling: the hash of 2k numbers comes from two of k. The result is n - 1
    shorter than ``flat``; places whose gram crosses into the next text are the
    caller's to leave out.
    """
    if len(flat) < n:
        return np.empty(0, np.uint64)
    done, part, covered = None, flat, 1
    power, left, total = multiplier & MASK, n, 0
    while left:
        if left & 1:
            if done is None:
                done, total = part, covered
            else:
                size = len(flat) - total - covered + 1
                shift = np.uint64(pow(multiplier, covered, 1 << 64))
                done = done[:size] * shift + part[total : total + size]
                total += covered
        left >>= 1
        if left:
            size = len(part) - covered
            part = part[:size] * np.uint64(power) + part[covered:]
            power = power * power & MASK
            covered *= 2
    return mix(done)


def gram_starts(lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the flat words where a gram lies in one text, and the text of each."""
    counts = np.maximum(lengths - n + 1, 0)
    texts = np.repeat(np.arange(len(lengths)), counts)
    firsts = np.cumsum(lengths) - lengths
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return firsts[texts] + inside, texts


def in_slices(texts: Sequence[str | None], most_bytes: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of a batch with about ``most_bytes`` of text; one text is never cut."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= most_bytes:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
