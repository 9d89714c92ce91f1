"""Token counts of whole texts by the public vocabulary files.

The tokenizers library does all encoding: of ordinary texts unit by unit (see
``units``), of huge documents in overlapping chunks, with offsets, which
``spliced_count`` joins at token boundaries that both chunks have and that are
proven stable.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from feederlens.llm import units
from feederlens.llm.units import BYTE_BPE, WORD_BPE, load  # noqa: F401

#: Documents with more characters are counted in chunks of this many.
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256

MAX_TOKENS = 2048

_STABLE = " \t\n\r"


def _boundaries(tokenizer, text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of tokens, and where each begins and ends in ``text``."""
    offsets = tokenizer.encode(text, add_special_tokens=False).offsets
    flat = np.array(offsets, np.int64).reshape(-1, 2)
    return len(flat), flat[:, 0], flat[:, 1]


def _stable(text: str, starts: np.ndarray, ends: np.ndarray, low: int, high: int) -> dict[int, int]:
    """Places from ``low`` to below ``high`` where a token may be cut off, and the tokens before each.

    A place is proven stable if white space stands just before it and no token
    spans it: normalising, splitting and merging never reach across white
    space, so the tokens on either side do not depend on the other.
    """
    first, last = np.searchsorted(starts, [low, high])
    return {
        int(starts[i]): int(i)
        for i in range(int(first), int(last))
        if starts[i] > 0 and text[starts[i] - 1] in _STABLE and (i == 0 or ends[i - 1] <= starts[i])
    }


def spliced_count(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text``, encoded in chunks whose ends overlap.

    Chunk after chunk is encoded from the last splice on. The next chunk begins
    ``overlap`` before the end of this one; a stable boundary that both have is
    the splice. With none, the overlap is doubled and tried again; if it reaches
    back to the last splice, the chunk itself is doubled, at last to the rest of
    the text. Special strings hold no white space, so no splice cuts one.
    """
    total = begin = 0
    size = chunk
    while begin < len(text):
        end = min(len(text), begin + size)
        n, starts, ends = _boundaries(tokenizer, text[begin:end])
        if end == len(text):
            return total + n
        wide, splice = overlap, None
        while splice is None and wide < end - begin:
            again = end - wide
            ahead = text[again : min(len(text), end + wide)]
            here = _stable(text[begin:end], starts, ends, again - begin, end - begin)
            _, starts_2, ends_2 = _boundaries(tokenizer, ahead)
            there = _stable(ahead, starts_2, ends_2, 1, wide)
            common = [p for p in here if p + begin - again in there]
            if common:
                splice = max(common)
            wide *= 2
        if splice is None:
            size *= 2
            continue
        total += here[splice]
        begin += splice
        size = chunk
    return total


def count_texts(texts: pa.Array, name: str = WORD_BPE) -> np.ndarray:
    """Tokens of each text; null counts as empty."""
    encoder = units.encoder(name)
    # Huge documents are spliced from overlapping chunks.
    huge = pc.fill_null(pc.greater(pc.utf8_length(texts), CHUNK_CHARS), False)
    counts = encoder.counts(pc.if_else(huge, "", texts))
    for row in np.flatnonzero(huge.to_numpy(zero_copy_only=False)).tolist():
        counts[row] = spliced_count(encoder.tokenizer, texts[row].as_py())
    return counts


def count_tokens(docs: DataFrame, name: str = WORD_BPE) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Null text is empty: no bytes, no tokens. Columns of these names are
    replaced. Each row stands for itself, so repeated rows repeat their counts.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    schema = docs.withColumn("n_tokens", F.lit(0).cast("long")).schema

    def counted(batches):
        for batch in batches:
            counts = [pa.array(count_texts(some, name), pa.int64()) for some in units.slices(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.concat_arrays(counts or [pa.array([], pa.int64())])], names=schema.names
            )

    return (
        docs.mapInArrow(counted, schema)
        .withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
        .withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)
    )
