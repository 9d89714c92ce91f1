"""Token ids of documents in binary files under one shared zstandard dictionary.

The dictionary is trained on serialized id arrays of a bounded sample. Every
document is a frame of its own, compressed with it, so a short document costs
one seek and a few hundred bytes. A file is, in little-endian numbers::

    header   magic, bytes of an id (2 or 4), SHA-256 of the dictionary
    frames   one for each document, end to end
    index    null flag, document id, offset of the frame, ids: four columns
    footer   documents, offset of the index, ids in all, CRC-32 of the index, magic

Beside the files lie the dictionary, named by its hash, and ``manifest``, a
Parquet table of the files in order. Documents are in ascending order of their
id through all files, null ids first.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feederlens.llm import grams, units
from feederlens.llm.scratch import Scratch

END_ID = 2
LEVEL = 3

#: The dictionary is fitted on this many documents, those of the smallest hashes, and so many characters of each.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 4096
DICTIONARY_BYTES = 64 << 10

#: Compressed bytes a file should hold; bytes read at once.
FILE_BYTES = 64 << 20
READ_BYTES = 8 << 20

MAGIC = b"idfile01"
HEADER = struct.Struct("<8sI32s")
FOOTER = struct.Struct("<QQQI8s")
#: The index has these columns, one after the other.
INDEX = (("null", "<u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("n_tokens", "<u8"))


def train(docs: DataFrame, name: str = units.WORD_BPE) -> bytes:
    """Dictionary fitted on a bounded sample; empty if the sample is too small for one."""
    text = F.substring(F.coalesce("text", F.lit("")), 1, SAMPLE_CHARS).alias("text")
    drawn = docs.select(F.xxhash64("doc_id", "text").alias("h"), text)
    # Twice as many hashes as wanted lie below a bound by the number of rows; without it every task would send its smallest.
    bound = min(1.0, 2 * SAMPLE_DOCS / max(1, docs.count())) * 2.0**64 - 2.0**63
    sample = drawn.where(F.col("h") <= F.lit(bound)).distinct().orderBy("h", "text").limit(SAMPLE_DOCS)
    texts = pa.array([r.text for r in sample.collect()], pa.string())
    arrays = [x.tobytes() for x in _arrays(units.encoder(name), texts, id_type(name))] if len(texts) else []
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays, d=8, k=256).as_bytes()
    except zstandard.ZstdError:
        return b""


def id_type(name: str) -> np.dtype:
    size = units.encoder(name).tokenizer.get_vocab_size()
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def _arrays(encoder: units.TextEncoder, texts: pa.Array, dtype: np.dtype) -> Iterator[np.ndarray]:
    """Ids of each text with the end id."""
    flat, offsets = encoder.encode(texts)
    flat = np.insert(flat, offsets[1:], END_ID).astype(dtype)
    offsets += np.arange(len(offsets))
    yield from np.split(flat, offsets[1:-1])


def _codec(make, dictionary: bytes, **options):
    return make(dict_data=zstandard.ZstdCompressionDict(dictionary), **options) if dictionary else make(**options)


def _encoded(docs: DataFrame, dictionary: bytes, name: str) -> DataFrame:
    """(doc_id, n_tokens, frame) of every document."""
    schema = "doc_id long, n_tokens long, frame binary"

    def encode(batches):
        encoder, dtype = units.encoder(name), id_type(name)
        pack = _codec(zstandard.ZstdCompressor, dictionary, level=LEVEL).compress
        for batch in batches:
            at = 0
            for texts in units.slices(batch.column(1)):
                arrays = list(_arrays(encoder, texts, dtype))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)).cast(pa.int64()),
                    pa.array([len(x) for x in arrays], pa.int64()),
                    pa.array([pack(x.data) for x in arrays], pa.binary()),
                ], names=["doc_id", "n_tokens", "frame"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(grams.tidied(encode, uses_kept=True), schema)


class FileWriter:
    """One file, written under a name of its own and moved into place when it is whole."""

    def __init__(self, folder: str, file: str, attempt: str, width: int, dictionary_hash: bytes):
        self.fs, root = fs.FileSystem.from_uri(folder)
        self.path, self.part = f"{root}/{file}", f"{root}/_{attempt}-{file}"
        self.out = self.fs.open_output_stream(self.part)
        self.out.write(HEADER.pack(MAGIC, width, dictionary_hash))
        self.at, self.columns = HEADER.size, [[] for _ in INDEX]

    def add(self, nulls: np.ndarray, doc_ids: np.ndarray, n_tokens: np.ndarray, frames: pa.Array) -> None:
        lengths = np.array([len(f) for f in frames.to_pylist()], np.int64)
        offsets = self.at + np.cumsum(lengths) - lengths
        self.out.write(b"".join(frames.to_pylist()))
        self.at += int(lengths.sum())
        for column, values, (_, kind) in zip(self.columns, (nulls, doc_ids, offsets, n_tokens), INDEX, strict=True):
            column.append(values.astype(kind))

    def close(self) -> tuple[int, int]:
        """Documents and ids of the file."""
        columns = [np.concatenate(c) for c in self.columns]
        index = b"".join(c.tobytes() for c in columns)
        n, ids = len(columns[0]), int(columns[3].sum())
        self.out.write(index)
        self.out.write(FOOTER.pack(n, self.at, ids, zlib.crc32(index), MAGIC))
        self.out.close()
        if self.fs.get_file_info(self.path).type != fs.FileType.NotFound:
            # Of an earlier attempt of this task, with the same content.
            self.fs.delete_file(self.path)
        self.fs.move(self.part, self.path)
        return n, ids


class TokenFile:
    """Reads one file: any document by one seek, or all in order."""

    def __init__(self, folder: str, file: str):
        self.fs, root = fs.FileSystem.from_uri(folder)
        self.source = self.fs.open_input_file(f"{root}/{file}")
        size = self.source.size()
        magic, width, digest = HEADER.unpack(self.source.read_at(HEADER.size, 0))
        self.n, self.end, self.ids, check, tail = FOOTER.unpack(self.source.read_at(FOOTER.size, size - FOOTER.size))
        index = self.source.read_at(size - FOOTER.size - self.end, self.end)
        if (magic, tail) != (MAGIC, MAGIC) or zlib.crc32(index) != check:
            raise ValueError(f"{file} is no whole file of token ids")
        at, self.index = 0, {}
        for name, kind in INDEX:
            self.index[name] = np.frombuffer(index, kind, self.n, at)
            at += self.index[name].nbytes
        self.type = np.dtype(f"<u{width}")
        dictionary = read_dictionary(folder, digest)
        self.unpack = _codec(zstandard.ZstdDecompressor, dictionary).decompress
        self.bounds = np.append(self.index["offset"], np.uint64(self.end)).astype(np.int64)

    def __getitem__(self, row: int) -> np.ndarray:
        """Ids of the document in this row of the index."""
        frame = self.source.read_at(int(self.bounds[row + 1] - self.bounds[row]), int(self.bounds[row]))
        return np.frombuffer(self.unpack(frame), self.type)

    def rows_of(self, doc_id: int) -> range:
        """Rows of the index that hold this id."""
        nulls = int(self.index["null"].sum())
        first, last = (nulls + int(np.searchsorted(self.index["doc_id"][nulls:], doc_id, side)) for side in ("left", "right"))
        return range(first, last)

    def __iter__(self) -> Iterator[np.ndarray]:
        """Ids of all documents in order, read some at a time."""
        row = 0
        while row < self.n:
            last = max(row + 1, int(np.searchsorted(self.bounds, self.bounds[row] + READ_BYTES, "right")) - 1)
            raw = memoryview(self.source.read_at(int(self.bounds[last] - self.bounds[row]), int(self.bounds[row])))
            cuts = (self.bounds[row : last + 1] - self.bounds[row]).tolist()
            for a, b in zip(cuts, cuts[1:]):
                yield np.frombuffer(self.unpack(raw[a:b]), self.type)
            row = last


def dictionary_file(digest: bytes) -> str:
    return f"dictionary-{digest.hex()}"


def read_dictionary(folder: str, digest: bytes) -> bytes:
    """The dictionary of this hash; what it holds is checked."""
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{dictionary_file(digest)}") as source:
        found = source.read()
    if hashlib.sha256(found).digest() != digest:
        raise ValueError("the dictionary is not the one that the file was written with")
    return found


def write_files(docs: DataFrame, folder: str, scratch: Scratch, name: str = units.WORD_BPE) -> None:
    """Encodes ``docs`` (``doc_id``, ``text``) and writes them into an empty ``folder`` that all executors share.

    Null text is empty and has the end id alone. Null ids come first; rows of
    one id, repeated ones too, are each a document, in any order among
    themselves, and a much repeated id is dealt over files. An empty table
    gives a manifest without files. Other columns are not read. Runs jobs:
    the sample, the encoding (stored), the ranges, and the files.
    """
    dictionary = train(docs, name)
    digest = hashlib.sha256(dictionary).digest()
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root)
    with store.open_output_stream(f"{root}/{dictionary_file(digest)}") as out:
        out.write(dictionary)

    encoded = scratch.keep(
        _encoded(docs, dictionary, name).withColumn("size", F.octet_length("frame").cast("long")), "frames"
    )
    total = encoded.agg(F.sum("size")).first()[0] or 0
    files = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // FILE_BYTES))
    width = id_type(name).itemsize

    def write(batches):
        task = TaskContext.get()
        slot, out = task.partitionId(), None
        file = f"part-{slot:06d}.ids"
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = FileWriter(folder, file, str(task.taskAttemptId()), width, digest)
            doc_ids = batch.column(0)
            out.add(
                doc_ids.is_null().to_numpy(zero_copy_only=False),
                doc_ids.fill_null(0).to_numpy(zero_copy_only=False),
                batch.column(1).to_numpy(zero_copy_only=False),
                batch.column(2),
            )
        if out is not None:
            n, ids = out.close()
            yield pa.RecordBatch.from_pydict({"slot": [slot], "file": [file], "n_docs": [n], "n_ids": [ids]})

    # The place in the stored table parts rows of one id, so that a much repeated one does not fill a file alone.
    order = [F.col("doc_id").asc_nulls_first(), F.col("place").asc()]
    (
        encoded.drop("size").withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "n_tokens", "frame")
        .mapInArrow(grams.tidied(write), "slot long, file string, n_docs long, n_ids long")
        .write.parquet(f"{folder}/manifest")
    )
    scratch.free("frames")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids of all documents before it, in this file and the
    files ahead. One task reads a file. The manifest has one row for each
    file, which alone goes through an ordered window.
    """
    files = spark.read.schema("slot long, file string, n_docs long, n_ids long").parquet(f"{folder}/manifest")
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    n = files.count()
    tasks = (
        files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        .withColumn("task", F.row_number().over(Window.orderBy("slot")) - 1)
        .select("file", "base", "task")
        .repartitionById(max(n, 1), F.col("task"))
    )

    def read(batches):
        for batch in batches:
            for task in batch.to_pylist():
                one = TokenFile(folder, task["file"])
                counts = one.index["n_tokens"].astype(np.int64)
                starts = task["base"] + np.cumsum(counts) - counts
                crcs = np.fromiter((zlib.crc32(ids.astype("<u4").tobytes()) for ids in one), np.int64, one.n)
                for a in range(0, one.n, 10_000):
                    part = slice(a, a + 10_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(one.index["doc_id"][part], pa.int64(), mask=one.index["null"][part].astype(bool)),
                        pa.array(starts[part]), pa.array(counts[part]), pa.array(crcs[part]),
                    ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tasks.mapInArrow(grams.tidied(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def through_files(docs: DataFrame, name: str = units.WORD_BPE) -> DataFrame:
    """``docs`` written in this format and read back; the files stay in the scratch folder."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    folder = f"{scratch.folder}/ids"
    write_files(docs, folder, scratch, name)
    return read_files(spark, folder)
