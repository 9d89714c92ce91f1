"""Language identification by a string kernel.

Two texts are alike by the character n-grams that both have: the blended
spectrum kernel over presence, ``|A and B| / sqrt(|A| |B|)`` for the sets of
all n-grams of 1 to 4 characters, hashed into ``BUCKETS``. The Nyström method
maps a text to its kernel values against landmark texts; one ridge regression
per language, against all others, is solved in that space. As the kernel is a
product of presence vectors, landmarks and regression fold into one matrix, and
a batch of texts is scored by one matrix product.

The model is fitted on at most ``TRAIN_PER_LANG`` labelled rows of each of at
most ``MAX_LANGS`` languages, drawn by a hash of doc_id; ``LANDMARKS_PER_LANG`` of them are
landmarks. Every text is scored, as a whole.

``und`` with score 0 is the answer for null text, text without a letter, and
if nothing was learnt (an empty table, no labels). Rows stand for themselves,
so repeated rows repeat the answer. A null doc_id is never learnt from and not
held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 15
TRAIN_PER_LANG = 400
#: Languages that are learnt, those of the most labelled rows; it bounds what the fit gathers, with the two numbers beside it.
MAX_LANGS = 200
LANDMARKS_PER_LANG = 60
RIDGE = 1e-2
#: Sharpness of the score: the winner's share of exp(SHARP * output).
SHARP = 6.0
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_SPACE = re.compile(r"\s+")


def presence(texts: list[str]) -> np.ndarray:
    """One row of 0 and 1 for each text: the buckets of its n-grams."""
    rows = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(rows, texts, strict=True):
        plain = f" {_SPACE.sub(' ', text.lower()).strip()} "
        points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)
        gram = np.zeros(len(points), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(points) < n:
                break
            gram = (gram[: len(points) - n + 1] * np.uint32(0x01000193)) ^ (points[n - 1 :] * np.uint32(0x9E3779B1))
            if n in ORDERS:
                mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA77 + 2 * n)
                row[mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)] = 1
    return rows


def fit(rows: np.ndarray, labels: list[str], landmarks: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the matrix that a normalised presence vector is multiplied with, and the constants."""
    langs = sorted(set(labels))
    unit = rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
    marks = unit[landmarks]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    mapped = (unit @ marks.T).astype(np.float64) @ root
    mapped = np.hstack([mapped, np.ones((len(mapped), 1))])
    targets = np.where(np.array(labels)[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    # Every language weighs the same, however many rows it has.
    weight = 1.0 / np.array([labels.count(x) for x in labels])[:, None]
    gram = mapped.T @ (mapped * weight) + RIDGE * np.eye(mapped.shape[1]) * weight.sum() / len(labels)
    beta = np.linalg.solve(gram, mapped.T @ (targets * weight))
    return langs, (marks.T @ (root @ beta[:-1])).astype(np.float32), beta[-1].astype(np.float32)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        bits = [np.packbits(presence([t])[0] > 0).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("lang"), pa.array(bits, pa.binary())], names=["doc_id", "lang", "bits"]
        )


def train(labelled: DataFrame) -> tuple | None:
    """The model from rows with ``doc_id``, ``text`` and ``lang``; None if there are none to learn from."""
    rows = labelled.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).withColumn("draw", F.xxhash64(F.lit("draw"), "doc_id"))
    # The rows of smallest draws: first by a bound that leaves few more than wanted, then exactly.
    shares = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
    share = F.least(F.lit(1.0), F.lit(2.0 * TRAIN_PER_LANG) / F.col("n") + F.lit(1e-9))
    near = rows.join(F.broadcast(shares), "lang").where(
        (F.col("draw") / F.lit(2.0**64) + 0.5) <= F.greatest(share, F.lit(64.0) / F.col("n"))
    ).drop("n")
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    chosen = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TRAIN_PER_LANG)
    found = chosen.select("doc_id", "text", "lang").mapInArrow(_sampled, "doc_id long, lang string, bits binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.lang, r.doc_id, bytes(r.bits)))
    bits = np.unpackbits(np.frombuffer(b"".join(bytes(r.bits) for r in found), np.uint8).reshape(len(found), -1), axis=1)
    labels = [r.lang for r in found]
    marks = [i for lang in sorted(set(labels)) for i in [j for j, x in enumerate(labels) if x == lang][:LANDMARKS_PER_LANG]]
    return fit(bits.astype(np.float32), labels, np.array(marks))


def predict(docs: DataFrame, model: tuple | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            spoken = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if sent.value else []
            for i in range(0, len(spoken), 128):
                part = spoken[i : i + 128]
                names, matrix, constants = sent.value
                rows = presence([texts[j] for j in part])
                out = (rows @ matrix) / np.sqrt(rows.sum(1, keepdims=True)) + constants
                best = out.argmax(1)
                share = np.exp(SHARP * (out - out.max(1, keepdims=True)))
                for j, b, s in zip(part, best.tolist(), (1 / share.sum(1)).tolist(), strict=True):
                    langs[j], scores[j] = names[b], min(1.0, s)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names
            )

    return docs.mapInArrow(scored, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``, learnt from the rows not held out."""
    marked = docs.withColumn("held_out", held_out(F.col("doc_id")))
    learnt = train(marked.where(~F.col("held_out")))
    return predict(marked, learnt)
