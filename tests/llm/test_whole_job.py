"""Cases in which an operator once did less than its whole job."""

import random

import numpy as np

from feederlens.llm import contamination, html_tree, minhash, quality, tokens


def _sentences(draw, syllables, size):
    text = ""
    while len(text) < size:
        words = ["".join(draw.choice(syllables) for _ in range(draw.choice((1, 2, 2, 3)))) for _ in range(draw.randrange(5, 14))]
        text += " ".join(words).capitalize() + ". "
    return text


def test_quality_limits_come_from_the_table(spark):
    draw = random.Random(5)
    syllables = ["".join(draw.choice("etaoinshrdlucm") for _ in range(k)) for k in (1, 2, 2, 3, 3) for _ in range(14)]
    prose = [_sentences(draw, syllables, draw.randrange(2500, 7000)) for _ in range(400)]
    held_out, symbols, tables = [], [], []
    for i in range(20):
        held_out.append(_sentences(draw, syllables, 3000 + 200 * i))
        words = _sentences(draw, syllables, 3000 + 200 * i).split()
        symbols.append(" ".join(w + draw.choice("%#$&") * 3 for w in words))
        tables.append(" | ".join(words))
    data = list(enumerate(prose + held_out + symbols + tables)) + [(9000 + i, prose[0]) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    texts = dict(data)
    assert len(kept & set(range(400))) >= 398
    assert kept >= set(range(400, 420)), sorted(set(range(400, 420)) - kept)
    assert not kept & set(range(420, 440)), [len(texts[i]) for i in kept if 420 <= i < 440]
    assert len(kept & set(range(440, 460))) <= 2
    bands = quality.limits(docs)
    assert bands.keys() == {False, True} and all((spreads >= quality.MIN_SPREAD).all() for _, _, spreads, _ in bands.values())


def _plain_bands(texts):
    """Median, spread and trust by class of length, worked out in plain loops."""
    import zstandard

    pack, out = zstandard.ZstdCompressor(level=quality.LEVEL).compress, {}
    raws = {t.encode() for t in texts if t}
    pieces = {p for r in raws for p in quality._pieces(r)}
    for kind, parts in ((False, raws), (True, pieces)):
        classes = {}
        for p in parts:
            if len(p) > quality.BANDS[0][0]:
                classes.setdefault(int(np.floor(np.log2(len(p)) * quality.CLASSES_PER_DOUBLING)), []).append((len(p), len(pack(p)) / len(p)))
        if not classes:
            continue
        keys = sorted(classes)
        median = {c: float(np.median([round(r, 4) for _, r in classes[c]])) for c in keys}
        weigh = {c: {d: quality.BORROW ** abs(c - d) * len(classes[d]) for d in keys} for c in keys}
        mean = lambda x, c: sum(weigh[c][d] * x[d] for d in keys) / sum(weigh[c].values())
        places = [np.log2(np.mean([n for n, _ in classes[c]])) for c in keys]
        medians = [mean(median, c) for c in keys]
        far = {c: float(np.median([round(abs(r - np.interp(np.log2(n), places, medians)), 4) for n, r in classes[c]])) for c in keys}
        near = {c: float(np.median([far[d] for d in keys[max(0, i - 1) : i + 2]])) for i, c in enumerate(keys)}
        spreads = [max(mean(near, c), quality.MIN_SPREAD) for c in keys]
        trust = [sum(weigh[c].values()) / (sum(weigh[c].values()) + quality.HALF_TRUST) for c in keys]
        out[kind] = (places, medians, spreads, trust)
    return out


def _prose(draw, n):
    syllables = ["".join(draw.choice("etaoinshrdlucm") for _ in range(k)) for k in (1, 2, 2, 3, 3) for _ in range(14)]
    return [_sentences(draw, syllables, draw.randrange(100, 9000)) for _ in range(n)]


def test_quality_bands_by_brute_force(spark):
    import zstandard

    draw = random.Random(6)
    texts = _prose(draw, 120) + ["#" * 3000, "".join(draw.choice("0123456789abcdef") for _ in range(5000)), "one two " * 400, "", None]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0], texts[0]])), "doc_id long, text string")
    found, want = quality.limits(docs.repartition(3)), _plain_bands(texts)
    assert found.keys() == want.keys()
    for kind in want:
        for a, b in zip(found[kind], want[kind], strict=True):
            # Ratios are counted to four digits; halves are rounded differently here.
            assert np.allclose(a, b, atol=3e-4)
    pack = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    for r in quality.judge(docs).collect():
        raw = (r.text or "").encode()

        def inside(p, chunk):
            low, high = quality.band(len(p), chunk, found)
            assert np.allclose((low, high), quality.band(len(p), chunk, want), atol=5e-3)
            return low <= len(pack(p)) / len(p) <= high

        outside = sum(not inside(p, True) for p in quality._pieces(raw))
        kept = bool(raw) and not r.base_failed and inside(raw, False) and outside <= quality.CHUNK_SHARE * len(quality._pieces(raw))
        assert r.kept == kept, r.doc_id


def test_quality_bands_do_not_jump_with_the_number_of_texts(spark):
    """From none to many texts the band moves from the fixed one to the table's in small steps."""
    texts = [t for t in _prose(random.Random(7), 1200) if 2048 <= len(t) < 2400]
    lows = []
    for n in (0, 1, 5, 24, 49, 50, 51, len(texts)):
        docs = spark.createDataFrame(list(enumerate(texts[:n])), "doc_id long, text string")
        lows.append(quality.band(2200, False, quality.limits(docs))[0])
    assert lows[0] == quality._fixed(2200, False)[0] and len(texts) > 52
    assert abs(lows[5] - lows[4]) < 0.01 and abs(lows[6] - lows[5]) < 0.01
    assert max(abs(np.diff(lows))) < 0.5 * (max(lows) - min(lows)) + 0.01


def test_pipeline_gives_token_ids(spark, tmp_path):
    import corpus_pipeline

    texts = {i: f"text number {i} goes on " * (1 + 40 * i) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pieces = sorted(corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect(), key=lambda p: (p.doc_id, p.start))
    plain = tokens.load(tokens.BYTE_BPE)
    for doc_id, text in texts.items():
        laid = [x for p in pieces if p.doc_id == doc_id for x in p.ids]
        assert laid == [*plain.encode(text, add_special_tokens=False).ids, 1]


def test_short_items_are_found_inside_documents(spark):
    docs = spark.createDataFrame(
        [(1, "we say that the Blue whale is large indeed"), (2, "blue whale"), (3, "the whale is blue and large"), (4, "blue"),
         (5, None), (6, "nobody knows the answer to all of this, they say")], "doc_id long, text string")
    items = spark.createDataFrame(
        [(1, "blue whale"), (2, "Large"), (3, "whale is blue and"), (4, "knows the answer to all of this"), (5, "")],
        "item_id long, text string")
    found = {tuple(r) for r in contamination.contained(docs, items).collect()}
    assert found == {(1, 1, 1, 1), (2, 1, 1, 1), (1, 2, 1, 1), (3, 2, 1, 1), (3, 3, 1, 1), (6, 4, 3, 3)}


def test_rows_of_one_document_tie_their_classes(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    near = " ".join(b.split()[:-1])
    data = [(3, a), (5, a), (5, b), (9, b), (5, ""), (12, near), (20, c), (21, d), (21, d), (30, None), (None, a)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect() if r.doc_id)
    assert found == sorted([
        (3, 3, True), *[(5, 3, False)] * 3, (9, 3, False), (12, 3, False), (20, 20, True), *[(21, 21, True)] * 2, (30, 30, True),
    ])


def test_hints_are_read_from_the_whole_attribute():
    assert html_tree.hints_of([("class", "xq " * 300 + "sidebar")]) == {"frame"}
    assert html_tree.hints_of([("class", "post has-sidebar")]) == {"content", "frame"}


def _near(sets, percent):
    """The component of each set, by comparing all pairs."""
    part = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            common = len(sets[a] & sets[b])
            if part[a] != part[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((part[a], part[b]))
                part = [low if p == high else p for p in part]
    return part


def test_large_block_of_many_components_needs_no_rounds(spark, monkeypatch):
    """Changed copies of a text, many of them linked with nothing, and short texts with one line in common."""
    draw = random.Random(8)
    origin, texts = [f"w{i}" for i in range(120)], []
    for k in range(480):
        words = list(origin)
        # Of four or five changes, those at the ends and side by side still leave it linked.
        for place in draw.sample(range(120), (0, 1, 2, 4, 4, 4, 5, 5)[k % 8]):
            words[place] = draw.choice(("the", f"n{draw.randrange(900)}", f"n{k}"))
        texts.append(" ".join(words[: draw.choice((116, 120, 120))]))
    line = " ".join(f"l{i}" for i in range(14))
    texts += [f"{line} m{k} m{k % 7} m{k + 1}" for k in range(60)]
    draw.shuffle(texts)
    data = [(i, t) for i, t in enumerate(texts)]
    stored = []
    keep = minhash.Scratch.keep
    monkeypatch.setattr(minhash.Scratch, "keep", lambda self, df, name: stored.append(name) or keep(self, df, name))
    monkeypatch.setattr(minhash, "MAX_WORK", 0)
    monkeypatch.setattr(minhash, "PIECE_SETS", 50, raising=False)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 85).collect()}
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    part = _near(sets, 85)
    assert found == dict(enumerate(part)) and 100 < len(set(part)) < 450, len(set(part))
    assert len(stored) < 45, len(stored)
