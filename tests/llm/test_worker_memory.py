"""What a Python worker holds during a task and after it."""

import numpy as np
import pyarrow as pa
import pytest

from feederlens.llm import grams, minhash, packing, units


class _Docs:
    """Catches the function that a frame's tasks would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return function


class _Task:
    @staticmethod
    def get():
        return _Task

    @staticmethod
    def partitionId():
        return 2


@pytest.mark.parametrize("n_texts", [1, 90])
def test_pieces_with_ids_are_made_from_little_text_at_once(monkeypatch, n_texts):
    monkeypatch.setattr(packing, "TaskContext", _Task)
    sizes, encode = [], units.TextEncoder.encode

    def noted(self, texts):
        sizes.append(sum(len(t) for t in texts.to_pylist()))
        return encode(self, texts)

    monkeypatch.setattr(units.TextEncoder, "encode", noted)
    texts = [" ".join(f"w{i * 7 + k}" for k in range(12_000)) for i in range(n_texts)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n_texts)), "text": texts})
    out = list(packing.pack(_Docs(), with_ids=True)(iter([batch])))
    longest = max(map(len, texts))
    assert sum(sizes) == sum(map(len, texts)) and max(sizes) < 1_000_000 + longest
    assert max(b.num_rows for b in out) <= 250
    found = {}
    for row in sorted(pa.Table.from_batches(out).to_pylist(), key=lambda r: (r["doc_id"], r["start"])):
        assert row["start"] == len(found.setdefault(row["doc_id"], [])) and row["length"] == len(row["ids"])
        found[row["doc_id"]] += row["ids"]
    plain = units.load(units.BYTE_BPE)
    for i, text in enumerate(texts):
        assert found[i] == [*plain.encode(text, add_special_tokens=False).ids, packing.END_ID]


def test_encoders_stay_for_tasks_that_use_them_only():
    units.encoder(units.WORD_BPE)
    assert list(grams.tidied(lambda batches: batches, uses_kept=True)(iter([1, 2]))) == [1, 2]
    assert units.WORD_BPE in units._ENCODERS
    assert list(grams.tidied(lambda batches: batches)(iter([1, 2]))) == [1, 2]
    assert not units._ENCODERS


def test_encoders_go_inside_a_worker(spark):
    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(units._ENCODERS)] * batch.num_rows, pa.int64())})

    stay, go = grams.tidied(held, uses_kept=True), grams.tidied(held)

    def twice(batches):
        batches = list(batches)
        units.encoder(units.WORD_BPE)
        yield from stay(iter(batches))
        yield from go(iter(batches))

    found = spark.range(0, 1, 1, 1).mapInArrow(twice, "n long").collect()
    assert found[0].n >= 1 and found[1].n == 0


def test_a_large_block_is_given_back(monkeypatch):
    calls = []
    monkeypatch.setattr(grams, "release", lambda: calls.append(1))

    def block(n, size):
        sets = [np.arange(size, dtype=np.uint64) + np.uint64(i) for i in range(n)]
        minima = [(m >> np.uint64(32)).astype("<u4").tobytes() for m in minhash.signatures(sets)]
        return pa.table({"id": pa.array(range(n), pa.int64()), "signature": minima, "members": [s.tobytes() for s in sets]})

    settled = minhash._settled(80)
    assert settled(block(4, 50)).num_rows == 3 and not calls
    assert settled(block(300, 1000)).num_rows == 299 and calls
