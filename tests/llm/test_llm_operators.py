"""The operators on small hard tables, against plain brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from feederlens.llm import (
    contamination, extraction, langid, line_dedup, minhash, packing, phrases, quality, sharding, tokens,
)
from feederlens.llm.components import connected
from feederlens.llm.cuckoo import CuckooFilter
from feederlens.llm.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, n_lines string, kept string, id string, bucket string, size string"


def _texts():
    """Nulls, empty and long texts, copies, near copies, shared lines and passages."""
    draw = random.Random(3)
    words = [f"w{draw.randrange(400)}{draw.choice(['', ',', '.', 'é'])}" for _ in range(4000)]
    passage = " ".join(words[:70])
    texts = [None, "", " \n\t ", "one", "one two", "Line of more than twenty signs\nx", passage]
    for i in range(40):
        at = draw.randrange(3000)
        own = words[at : at + draw.choice([5, 30, 90, 300])]
        texts.append(" ".join(own))
        if i % 3 == 0:
            texts.append("  LINE of more than twenty signs\t\n" + " ".join(own) + "\n" + passage)
        if i % 4 == 0:
            near = list(own)
            near[len(near) // 2] = "changed"
            texts += [" ".join(near), " ".join(own)]
    texts += ["long " * 20_000, "ünïcödé 漢字 text  with   gaps   and <|endoftext|> inside " * 30, "a\n" * 500]
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    ids = list(range(len(texts)))
    random.Random(9).shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns whose names the operators use inside."""
    data = [(i, t, "en", "x", "x", "x", "x", "x") for i, t in rows]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="module")
def odd(spark, rows):
    """The same with repeated rows, null ids and one id with two texts."""
    data = [*rows, rows[8], rows[8], (None, rows[8][1]), (None, None), (rows[9][0], "another text of this id")]
    return spark.createDataFrame(data, "doc_id long, text string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def _ids(text):
    return [*tokens.load(tokens.BYTE_BPE).encode(text or "", add_special_tokens=False).ids, 1]


def test_packing_lays_every_token_once(docs, rows, none):
    pieces = packing.pack(docs, size=256, with_ids=True).collect()
    found, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        found[p.doc_id].append(p)
        windows[p.sequence_id].append(p)
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    for doc_id, text in rows:
        parts = sorted(found[doc_id], key=lambda p: p.start)
        assert [x for p in parts for x in p.ids] == _ids(text)
        assert {p.doc_tokens for p in parts} == {len(_ids(text))}
    for parts in windows.values():
        end = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        # Full, or a power of two.
        assert end <= 256 and end & (end - 1) == 0
    assert packing.pack(none).isEmpty()


def test_sum_of_squares_places_by_brute_force():
    draw, rule, levels = random.Random(1), packing.SumOfSquares(50), Counter()
    for _ in range(400):
        size = draw.randint(1, 49)
        costs = {}
        for level in [0, *levels]:
            if level + size <= 50 and (level == 0 or levels[level]):
                after = Counter(levels)
                after[level] -= level > 0
                after[level + size] += level + size < 50
                costs[level] = sum(v * v for v in after.values())
        _, level = rule.place(size)
        assert costs[level] == min(costs.values())
        levels[level] -= level > 0
        levels[level + size] += level + size < 50


def _cleaned(rows):
    up = {c: c + 32 for c in range(65, 91)}
    key = lambda line: line.strip(" \t\n\v\f\r").translate(up)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= 3 and max(holders[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup(docs, rows, odd, none):
    found = _by_id(line_dedup.dedup_lines(docs))
    assert {i: (r["n_lines"], r["n_dropped"], r["text"] or "") for i, r in found.items()} == _cleaned(rows)
    assert any(r["n_dropped"] for r in found.values()) and found[rows[0][0]]["text"] is None
    assert line_dedup.dedup_lines(odd).count() == odd.count()
    assert line_dedup.dedup_lines(none).isEmpty()


def test_line_index_is_reversible_and_needs_no_filter(spark, docs, rows):
    index = line_dedup.LineIndex(spark, shards=4)
    index.insert(docs.where("doc_id % 2 = 0"))
    index.insert(docs.where("doc_id % 2 = 1"))
    index.delete(docs.where("doc_id % 3 = 0"))
    left = docs.where("doc_id % 3 != 0")
    want = {i: v[2] for i, v in _cleaned([r for r in rows if r[0] % 3]).items()}
    assert {i: r["text"] or "" for i, r in _by_id(index.clean(left)).items()} == want
    sent = {tuple(sorted(r["keys"])) for r in index.dropped(left).collect()}
    assert sent == {tuple(sorted(r["keys"])) for r in index.dropped(left, max_filter_bytes=-1).collect()}


def test_cuckoo_filter():
    keys = np.arange(1, 20_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    held = CuckooFilter.load(CuckooFilter.of(keys).dump())
    assert held.contains(keys).all()
    held.remove(keys[:10_000])
    assert held.contains(keys[10_000:]).all() and held.contains(keys[:10_000]).mean() < 0.01
    assert held.add(keys[:5_000]) and held.contains(keys[:5_000]).all()


def test_token_counts(docs, rows, odd, none):
    plain = tokens.load(tokens.WORD_BPE)
    for row in tokens.count_tokens(odd).collect():
        assert row.n_tokens == len(plain.encode(row.text or "", add_special_tokens=False).ids)
        assert row.n_bytes == len((row.text or "").encode()) and row.over_limit == (row.n_tokens > 2048)
    assert tokens.count_tokens(none).isEmpty()


@pytest.mark.parametrize("text", [
    "ab cd " * 400, "x" * 3000 + " y " * 200, "漢字" * 900, "don't <|endoftext|> stop\n" * 120, "z" * 2500,
])
def test_spliced_count_is_the_whole_count(text):
    plain = tokens.load(tokens.WORD_BPE)
    whole = len(plain.encode(text, add_special_tokens=False).ids)
    assert tokens.spliced_count(plain, text, chunk=300, overlap=8) == whole


def _contained(rows, items):
    def grams(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    sets = {i: grams(t) for i, t in items}
    found = set()
    for d, text in rows:
        own = grams(text)
        found |= {(d, i, len(own & s), len(s)) for i, s in sets.items() if s and 100 * len(own & s) >= 80 * len(s)}
    return found


def test_contamination(spark, docs, rows, odd, none):
    words = rows[6][1].split()
    items = [(1, " ".join(words[10:60])), (2, " ".join(words[:30] + ["never", "seen"])), (3, "not in there at all, not one"),
             (4, None), (5, ""), (6, " ".join(words[10:60])), (7, "one two"), (8, " ".join(words[5:12]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {tuple(r) for r in contamination.contained(docs, bench).collect()}
    assert found == _contained(rows, items) and len(found) > 20
    clean = contamination.keep_clean(docs, bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {f[0] for f in found}
    assert clean.columns == docs.columns
    assert contamination.contained(odd, bench).count() >= len(found)
    assert contamination.contained(none, bench).isEmpty()
    assert contamination.contained(docs, none.selectExpr("doc_id item_id", "text")).isEmpty()


def _components(rows, n, percent):
    sets = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
    part = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = {k: low if v == high else v for k, v in part.items()}
    return {i: (len(sets[i]), part[i], part[i] == i) for i in ids}


@pytest.mark.parametrize("work", [minhash.MAX_WORK, 0])
def test_near_duplicates(docs, rows, monkeypatch, work):
    """In tasks, and in rounds over all tasks."""
    monkeypatch.setattr(minhash, "MAX_WORK", work)
    found = _by_id(minhash.near_duplicates(docs, 3, 85))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in found.items()} == _components(rows, 3, 85)


def test_near_duplicates_of_odd_rows(odd, none, docs):
    found = minhash.near_duplicates(odd).collect()
    assert len(found) == odd.count() and all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert minhash.near_duplicates(none).isEmpty()
    assert minhash.keep_one(docs).columns == docs.columns


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(9)] + [(7, 7), (200, 201), (201, 200)]
    stars = connected(spark.createDataFrame(links, "a long, b long"), Scratch(spark))
    want = {(i, 0) for i in range(1, 31)} | {(100 + i, 100) for i in range(1, 9)} | {(201, 200)}
    assert {tuple(r) for r in stars.collect()} == want


def test_repeated_passages(docs, rows, odd, none):
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k : k + 50]), i)
    found = _by_id(phrases.remove_repeats(docs))
    for i, own in words.items():
        gone = [False] * len(own)
        for k in range(len(own) - 49):
            if first[tuple(own[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        want = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone, strict=True) if not g))
        assert (found[i]["n_words"], found[i]["n_removed"], found[i]["kept_text"]) == want
    assert sum(r["n_removed"] for r in found.values()) > 1000
    assert phrases.remove_repeats(odd).count() == odd.count()
    assert phrases.remove_repeats(none).isEmpty()


def test_sharding(docs, rows, odd, none):
    found = sharding.shard(odd).collect()
    assert len(found) == odd.count()
    slots, place = defaultdict(list), defaultdict(set)
    texts = dict(rows)
    for r in found:
        slots[r.shard].append(r.slot)
        if r.doc_id is not None and r.doc_id != rows[9][0]:
            place[texts[r.doc_id]].add(r.shard)
            assert r.size == len((texts[r.doc_id] or "").encode()) + 1
            assert r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in place.values())
    assert sharding.shard(none).isEmpty()


def test_differencing_balances():
    draw = random.Random(2)
    sizes = [draw.randint(1, 10_000) for _ in range(3000)]
    sums = Counter()
    for size, part in zip(sizes, sharding.difference(sizes, 16), strict=True):
        sums[part] += size
    assert max(sums.values()) - min(sums.values()) <= 3
    assert sharding.difference([5, 5, 5, 5], 2) in ([0, 1, 0, 1], [1, 0, 1, 0], [0, 1, 1, 0], [1, 0, 0, 1], [0, 0, 1, 1], [1, 1, 0, 0])


def test_quality(docs, rows, odd, none):
    packer = zstandard.ZstdCompressor(level=3)
    for r in quality.judge(odd).collect():
        text = r.text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
        seen, copies = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                copies += line in seen
                seen.add(line)
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), copies, len(covered), failed)
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert not (failed and r.kept)
        if text:
            assert r.whole_ratio == len(packer.compress(text.encode())) / len(text.encode())
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.judge(none).isEmpty()


def test_quality_rejects_noise_and_keeps_prose(spark):
    draw = random.Random(4)
    noise = " ".join("".join(chr(draw.randrange(33, 123)) for _ in range(9)) for _ in range(900))
    syllables = ["".join(draw.choice("etaoinshrdlu") for _ in range(k)) for k in (1, 2, 2, 3, 3, 4) for _ in range(12)]
    prose = " ".join(draw.choice(syllables) + draw.choice(syllables) for _ in range(900))
    found = _by_id(quality.judge(spark.createDataFrame([(1, noise), (2, prose)], "doc_id long, text string")))
    assert not found[1]["kept"] and found[2]["kept"]


def test_language_identification(spark, none):
    draw = random.Random(6)
    letters = {"aa": "abcdefgh", "bb": "hijklmno", "cc": "opqrstuv"}
    data = []
    for i in range(600):
        lang = draw.choice(list(letters))
        text = " ".join("".join(draw.choice(letters[lang]) for _ in range(5)) for _ in range(draw.randint(2, 30)))
        data.append((i, text, lang if i % 50 else None))
    data += [(700, None, "aa"), (701, "12 !?", "bb"), (702, "", None), (None, "abc dab", "aa")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    right = 0
    for r in langid.identify(df).collect():
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif r.held_out and r.lang:
            right += r.lang_pred == r.lang
    assert right >= 0.97 * sum(1 for i, _, x in data if x and i and i < 700 and zlib.crc32(str(i).encode()) % 4 == 2)
    assert langid.identify(none).isEmpty()
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


PAGE = (
    '<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/">Home</a></ul></nav>'
    "<!-- c --><div class='cookie-banner'><p>We use cookies, accept all of them.</p></div>"
    "<article><h1>A &amp; B</h1><p>First   text,\nwith <b>bold<br>and more words in it, so it is long.<p>Second one is also a sentence of words.</p></article>"
    "<section class=comments><p>Nice article, I liked it a lot.</p></section><footer>&copy; me</footer></body></html>"
)


def test_extraction(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, "u", "<p"), (5, None, PAGE), (1, "u", PAGE)],
        "page_id long, url string, html string",
    )
    want = "A & B\nFirst text, with bold and more words in it, so it is long.\nSecond one is also a sentence of words."
    for r in extraction.extract(pages).collect():
        assert r.text == (want if r.html == PAGE else "") and r.n_chars == len(r.text)
    assert extraction.extract(pages.limit(0)).isEmpty()


def test_marginals_are_those_of_all_assignments():
    """Sum-product against enumeration, on a small tree."""
    from itertools import product
    from math import exp

    from feederlens.llm.html_tree import Tree, features

    model = extraction.model()
    nodes = Tree("<body><div><p>some words, and more.</p><ul><li><a href=x>l</a></ul></div><footer>f</footer></body>").nodes
    seen = features(nodes)
    place = {id(n): i for i, n in enumerate(nodes)}
    sums = [[0.0, 0.0] for _ in nodes]
    for states in product((0, 1), repeat=len(nodes)):
        total = model.root[states[0]]
        for i, node in enumerate(nodes):
            total += sum(model.seen.get(v, [0, 0])[states[i]] for v in seen[i][1:])
            if i:
                at = states[place[id(node.parent)]]
                total += (model.moves.get((at, seen[i][0])) or model.moves[at, None])[states[i]]
        for i, s in enumerate(states):
            sums[i][s] += exp(total)
    want = [one / (zero + one) for zero, one in sums]
    assert model.marginals(nodes) == pytest.approx(want, abs=1e-9)


def test_held_out_labelled_pages():
    from feederlens.llm.html_labels import labelled_pages
    from feederlens.llm.html_tree import Tree

    right = total = 0
    for page in labelled_pages(60, seed=99):
        tree = Tree(page)
        chance = dict(zip(map(id, tree.nodes), extraction.model().marginals(tree.nodes), strict=True))
        label = {}
        for node in tree.nodes:
            label[id(node)] = node.label if node.label is not None else label[id(node.parent)] if node.parent else 0
        for node, _ in tree.texts():
            total += 1
            right += (chance[id(node)] > 0.5) == label[id(node)]
    assert right > 0.97 * total


def test_pipeline_keeps_what_the_stages_keep(spark, tmp_path, docs, rows):
    import corpus_pipeline

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    table = docs.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(rows[6][1].split()[10:60]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = {r.doc_id for r in quality.judge(docs.select("doc_id", "text")).where("kept").collect()}
    lines = _cleaned([r for r in rows if r[0] in good])
    kept = [(i, v[2]) for i, v in lines.items()]
    one = [(i, t) for i, t in kept if _components(kept, 5, 80)[i][2]]
    dirty = {f[0] for f in _contained(one, items)}
    want = {i: len(_ids(t)) for i, t in one if i not in dirty}
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id: r.doc_tokens for r in found.collect()} == want
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table, str(tmp_path)).columns == columns
