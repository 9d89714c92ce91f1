"""Token files, the prefix trie and aligned vocabularies, against plain brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feederlens.llm import alignment, idfiles, trie, units
from feederlens.llm.scratch import Scratch

PARTS = [
    "a", "The", "word", "don't", "'s", "é", "É", "é", "J̌", "İ", "Σ", "ΟΣ", "漢字", "123", "!", "...", ".", ",",
    " ", "  ", "\n", "\n\n", "\n\n\n", "\t", "\r", " ", "<|endoftext|>", "<|", "<s>", "|>", "###", "a.", "b,c", "ß",
    "ﬁ", "​", "▁", "▁▁", "_", "K", "Ω", "\x01", "\x00", " a", " the", "😀", "\u0085", "<0x0A>",
]


def _odd_texts(n, seed=1):
    draw = random.Random(seed)
    return [None, "", " ", "\n", "one", "x" * 5000, "word " * 3000, "ab\n" * 700] + [
        "".join(draw.choice(PARTS) for _ in range(draw.randrange(1, 14))) for _ in range(n)
    ]


def _prose(n, seed=2):
    draw = random.Random(seed)
    words = ["".join(draw.choice(["on", "er", "ti", "the", "Qu", "é", "z"]) for _ in range(draw.randrange(1, 5))) for _ in range(300)]
    return ["\n".join(" ".join(draw.choices(words, k=9)) for _ in range(draw.randrange(1, 6))) for _ in range(n)]


def _docs(spark, texts):
    ids = list(range(len(texts)))
    random.Random(4).shuffle(ids)
    data = [(i, t, "x", "x", "x") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(data, "doc_id long, text string, block string, place string, kind string")


@pytest.mark.parametrize("name", [units.BYTE_BPE, units.WORD_BPE])
def test_units_give_the_librarys_ids(name):
    plain, encoder = units.load(name), units.TextEncoder(name)
    for texts in (_odd_texts(600), _odd_texts(600, 7), _prose(60), []):
        array = pa.array(texts, pa.string())
        flat, offsets = encoder.encode(array)
        counts = encoder.counts(array)
        for text, a, b, n in zip(texts, offsets, offsets[1:], counts, strict=False):
            assert flat[a:b].tolist() == plain.encode(text or "", add_special_tokens=False).ids and n == b - a


def test_units_are_kept_in_two_generations(monkeypatch):
    monkeypatch.setattr(units, "CACHED_UNITS", 50)
    plain, encoder = units.load(units.WORD_BPE), units.TextEncoder(units.WORD_BPE)
    for text in _prose(40):
        flat, _ = encoder.encode(pa.array([text]))
        assert flat.tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder.units.slot) < 50 + len(set(text.split()))


def _file_rows(rows):
    plain, out, start = units.load(units.WORD_BPE), Counter(), 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        out[doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    return out


def test_token_files_give_back_what_went_in(spark):
    docs = _docs(spark, _odd_texts(200) + _prose(300))
    found = Counter(tuple(r) for r in idfiles.through_files(docs.repartition(3)).collect())
    assert found == _file_rows([(r.doc_id, r.text) for r in docs.collect()])


def test_token_files_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert idfiles.through_files(none).isEmpty()
    # A hot id, null ids and repeated rows: every row is a document, ids in order, starts without a gap.
    rows = [(7, "same text")] * 300 + [(None, "no id")] * 100 + [(i, f"text {i}") for i in range(50)]
    found = idfiles.through_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    found.sort(key=lambda r: r.start)
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    ids = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert ids == sorted(ids)
    # The hot id is dealt over files.
    assert spark.createDataFrame([(1, None)], "doc_id long, text string").transform(idfiles.through_files).first().n_tokens == 1


def test_short_documents_are_read_alone(spark):
    scratch = Scratch(spark)
    folder = f"{scratch.folder}/ids"
    texts = _prose(400)
    docs = spark.createDataFrame(list(enumerate(texts)) + [(3, "another of this id")], "doc_id long, text string")
    idfiles.write_files(docs, folder, scratch)
    manifest = spark.read.parquet(f"{folder}/manifest").orderBy("slot").collect()
    assert sum(f.n_docs for f in manifest) == 401
    plain, seen = units.load(units.WORD_BPE), 0
    for file in manifest:
        one = idfiles.TokenFile(folder, file.file)
        assert (one.n, one.ids) == (file.n_docs, file.n_ids)
        for doc_id in set(one.index["doc_id"].tolist()):
            found = sorted(one[row].tolist() for row in one.rows_of(doc_id))
            wanted = [texts[doc_id]] + ["another of this id"] * (doc_id == 3)
            assert found == sorted([*plain.encode(t, add_special_tokens=False).ids, 2] for t in wanted)
            seen += len(found)
        assert not one.rows_of(10**9)
        assert [x.tolist() for x in one] == [one[i].tolist() for i in range(one.n)]
    assert seen == 401
    # Files and dictionary are checked.
    path = f"{folder.removeprefix('file:')}/{manifest[0].file}"
    whole = open(path, "rb").read()
    with open(path, "wb") as out:
        out.write(whole[:-60] + b"x" + whole[-59:])
    with pytest.raises(ValueError, match="no whole file"):
        idfiles.TokenFile(folder, manifest[0].file)


def test_a_shared_dictionary_makes_short_documents_small(spark):
    import zstandard

    docs = spark.createDataFrame(list(enumerate(_prose(600))), "doc_id long, text string")
    dictionary = idfiles.train(docs)
    assert dictionary and dictionary == idfiles.train(docs.repartition(5))
    frames = idfiles._encoded(docs, dictionary, units.WORD_BPE).collect()
    alone = zstandard.ZstdCompressor(level=idfiles.LEVEL)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress
    assert sum(len(r.frame) for r in frames) < 0.8 * sum(len(alone.compress(unpack(r.frame))) for r in frames)


def test_perfect_hash_is_minimal_and_verified():
    draw = np.random.default_rng(1)
    keys = draw.integers(0, 1 << 63, (50_000, 2)).astype("<u8").view([("a", "<u8"), ("b", "<u8")]).ravel()
    built, others = keys[:30_000], keys[30_000:]
    table = trie.PerfectHash(built)
    assert sorted(table.slots(built).tolist()) == list(range(30_000))
    assert (table.slots(others) == -1).all()
    assert (table.slots(built[:0]) == []).all() and (trie.PerfectHash(built[:0]).slots(others[:5]) == -1).all()


def _trie(rows):
    """Nodes by plain dictionaries of whole prefixes."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0))] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, ends = defaultdict(set), defaultdict(list)
    for c, path in rebuilt.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def _conversations(draw):
    said = ["hello", "é" * 9, "", None, "yes", "no " * 50]
    rows = []
    for c in [*range(60), *range(100, 400, 7), 10**12, 10**12 + 1]:
        copy = draw.random() < 0.4
        for t in range(draw.choice([1, 2, 3, 8, 12, 30])):
            text = said[t % 6] if copy or draw.random() < 0.5 else draw.choice(said)
            rows.append((c, t, ["user", "assistant", None][t % 3], text))
    # One conversation copied often, and others with null turns and null ids.
    rows += [(c, t, "user", f"copied {t}") for c in range(5000, 5300, 5) for t in range(20)]
    rows += [(None, 1, "user", "nobody"), (71, None, "user", "first"), (71, 3, "x", "last"), (72, None, None, None)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("members", [None, 1, 5, 10**9])
def test_prefix_trie(spark, members):
    rows = _conversations(random.Random(8))
    table = spark.createDataFrame(
        [(*r, "x", "x") for r in rows], "conv_id long, turn long, role string, text string, digest string, block string"
    ).repartition(3)
    found = trie.prefix_trie(table, members)
    assert found.columns == trie.RESULT
    assert Counter(tuple(r) for r in found.collect()) == _trie(rows)


def test_prefix_trie_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.prefix_trie(spark.createDataFrame([], schema)).isEmpty()
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).isEmpty()
    # A turnless rebuilt conversation: its base is absent and all its turns are replaced.
    alone = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(alone, 1, "user", "gone"), (alone, 2, "user", "gone too")]
    assert Counter(tuple(r) for r in trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()) == _trie(rows)
    # Repeated rows and equal turns; a very long conversation; negative ids.
    rows = [(5, 1, "a", "b")] * 3 + [(5, 2, "a", "c")] + [(6, t, "a", "b") for t in range(150)] + [(-3, t, "a", "b") for t in range(9)]
    assert Counter(tuple(r) for r in trie.prefix_trie(spark.createDataFrame(rows, schema), 1).collect()) == _trie(rows)


def test_gustavson_is_the_matrix_product():
    draw = np.random.default_rng(3)
    for n, k, m in ((7, 5, 6), (1, 1, 1), (20, 30, 4)):
        x, y = ((draw.random(s) < 0.3) * draw.integers(1, 5, s) for s in ((n, k), (k, m)))
        a, b = (alignment.Csr(units.ends_of((z != 0).sum(1)), np.nonzero(z)[1], z[np.nonzero(z)], z.shape[1]) for z in (x, y))
        out = a.times(b)
        dense = np.zeros((n, m), int)
        dense[out.rows, out.columns] = out.values
        assert (dense == x @ y).all() and (out.values != 0).all()
        back = a.transposed()
        dense = np.zeros((k, n), int)
        dense[back.rows, back.columns] = back.values
        assert (dense == x.T).all()


def _aligned(rows):
    """Tokens with byte ranges, all pairs compared."""
    import sentencepiece

    plain = units.load(units.BYTE_BPE)
    plain.encode_special_tokens = True
    names = {i: t for t, i in plain.get_vocab().items()}
    byte = alignment._byte_level()
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))
    done, counts = [], Counter()
    for doc_id, text in rows:
        a = b = []
        if text:
            a = [(i, bytes(byte[c] for c in names[i])) for i in plain.encode(" " + text, add_special_tokens=False).ids]
            b = [
                (i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
                for i, p in ((i, pieces.id_to_piece(i)) for i in pieces.encode(text))
            ]
            if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                a = b = []
        ranges = [list(zip((i for i, _ in t), np.cumsum([0] + [len(x) for _, x in t]).tolist(), np.cumsum([len(x) for _, x in t]).tolist())) for t in (a, b)]
        links = [(i, j) for i, s, e in ranges[0] for j, u, v in ranges[1] if s < v and u < e]
        counts.update(links)
        cuts = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
        groups, low = [], 0
        for high in cuts:
            groups.append([[i for i, s, e in r if low < e <= high] for r in ranges])
            low = high
        done.append((doc_id, a, b, links, groups))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return Counter(
        (doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join("|".join(",".join(map(str, s)) for s in g) for g in groups).encode()).hexdigest() if a else "",
         sum(len(g[0]) * len(g[1]) for g in groups))
        for doc_id, a, b, links, groups in done
    )


@pytest.mark.parametrize("distinct", [alignment.BLOCK_DISTINCT, 100])
def test_alignment(spark, monkeypatch, distinct):
    monkeypatch.setattr(alignment, "BLOCK_DISTINCT", distinct)
    monkeypatch.setattr(alignment, "PAIRS_PER_ROW", 70)
    texts = [t for t in _odd_texts(250) if not t or len(t) < 400] + _prose(60)
    docs = _docs(spark, texts).union(_docs(spark, _prose(3)))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = Counter(tuple(r) for r in alignment.aligned(docs.repartition(3)).collect())
    assert found == _aligned(rows)


def test_alignment_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert alignment.aligned(spark.createDataFrame([], schema)).isEmpty()
    rows = [(None, None), (None, "a b"), (1, ""), (2, "a b"), (2, "a b"), (3, "with ▁ inside"), (4, None)]
    found = alignment.aligned(spark.createDataFrame(rows, schema)).collect()
    assert Counter(tuple(r) for r in found) == _aligned(rows)
    assert all(r.groups_sha256 == "" and r.n_a == r.n_b == r.n_links == 0 for r in found if r.doc_id in (1, 3, 4))
    long = spark.createDataFrame([(1, "many words in one text " * 20_000)], schema)
    row = alignment.aligned(long.select("doc_id", F.col("text"))).first()
    assert row.n_best == row.n_links > 100_000
