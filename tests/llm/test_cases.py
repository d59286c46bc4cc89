"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; and each operator's parts."""

import gzip
import io
import os
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeferry.llm import binary, chat, decontam, groups, huffman, langid, mixing, separators, shingles, simhash, tokens, topk, toxicity, warc
from lakeferry.llm.common import work_dir
from lakeferry.llm.queries import tokenizer

N = 12


# -- 1

def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int, id int")


def test_topk_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(50, [1.0, 0.5]), (100, [0.1, 0.2]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0]), (None, [1.0, 0.5]), (9, [-3.0, 0.0]), (9, [-3.0, 0.0]), (150, [2.0])]
    df = _vectors(spark, [(*r, 0, 0) for r in rows])
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), 3).collect()
    of = lambda q: [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]
    assert of(50) == [(1, 1, 81920), (2, 2, 81920), (3, None, 81920)] and of(150) == [(1, 8, 131072)] and len(of(100)) == 3
    assert topk.top_k(df.limit(0), df.limit(0), 3).count() == 0 and topk.top_k(df, df.limit(0), 3).count() == 0


def test_topk_of_huge_components(spark):
    """Finite components whose products no float holds: what a bigint can't hold becomes its nearest end."""
    end = 2**63 - 1
    rows = [(50, [1e307, 1.0]), (1, [1e307, 0.0]), (2, [-1e307, 0.0]), (3, [0.0, 2.0]), (4, [0.0, 1.0]), (5, [1.0, None]), (6, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id = 50"), 5).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1, end), (2, 3, 2 * 65536), (3, 4, 65536), (4, 2, -end - 1)]


@pytest.mark.parametrize("scale", [1.0, 3e6, 1e9])
def test_topk_is_exact(spark, scale, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    r = random.Random(1)
    rows = [(i, [r.choice([-1, 0, 0.25, 1]) * scale + r.random() for _ in range(4)], 0, 0) for i in range(400)]
    df = _vectors(spark, rows)
    exact = {x.vec_id: [int(np.floor(np.float64(v) * 256)) for v in x.embedding] for x in df.collect()}
    got = {(x.query_id, x.rank): (x.vec_id, x.score) for x in topk.top_k(df, df.where("vec_id % 50 = 0")).collect()}
    fit = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    for q in range(0, 400, 50):
        best = sorted((-fit(sum(a * b for a, b in zip(exact[q], v, strict=True))), k) for k, v in exact.items() if k != q)[:5]
        assert [got[q, i + 1] for i in range(5)] == [(k, -s) for s, k in best]


# -- 2

def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    item = "fox jumps over the LAZY dog again and again today"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "quick brown"), (4, "word"), (5, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet")], "item_id bigint, text string")
    rows = decontam.scan(odd_docs, bench).collect()
    assert len(rows) == N
    got = {(r.doc_id, r.n_words): r for r in rows}
    assert (got[1, 13].n_hit, got[1, 13].items) == (12, ["", "1"]) and got[6, 1].items == ["4"]
    assert got[7, 200_000].n_hit == 200_000 and got[3, 0].n_hit == 0 and not got[3, 0].contaminated
    kept = decontam.clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and sorted(r.score or 0 for r in kept.collect()) == [0, 4, 5, 8, 9, 10, 11]
    assert decontam.scan(no_docs, bench).count() == 0 and decontam.scan(odd_docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_against_search(spark, monkeypatch):
    r = random.Random(3)
    vocab = ["a", "b", "c", "d", "É", "x1"]
    docs = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(0, 60))).replace(" ", r.choice([" ", ", ", "\n"]))) for i in range(60)]
    bench = [(i, " ".join(r.choice(vocab).upper() for _ in range(r.randint(0, 7)))) for i in range(25)]
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(low))
    want = []
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for k, b in bench:
            ws = words(b)
            n = min(4, len(ws))
            for s in range(len(ws) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == ws[s : s + n]:
                        hit |= set(range(at, at + n))
                        items.add(str(k))
        want.append((d, len(w), len(hit), sorted(items)))
    for rows in (10**6, 0):  # broadcast, and shuffled
        monkeypatch.setattr(decontam, "BROADCAST_ROWS", rows)
        out = decontam.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string"), 4)
        assert sorted((x.doc_id, x.n_words, x.n_hit, x.items) for x in out.collect()) == want


@pytest.mark.parametrize("rows", [10**6, 0])
def test_decontamination_of_a_long_item(spark, monkeypatch, rows):
    """An item of 100,000 words takes seconds, as its windows are made in one pass."""
    import time

    monkeypatch.setattr(decontam, "BROADCAST_ROWS", rows)
    r = random.Random(8)
    item = [f"w{r.randrange(30_000)}" for _ in range(100_000)]
    docs = [(1, " ".join(item)), (2, " ".join(item[500:600])), (3, " ".join(item[::-1][:300])), (4, " ".join(["z", *item[-10:]]))]
    t = time.time()
    out = decontam.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(5, " ".join(item))], "item_id bigint, text string"))
    assert sorted((x.doc_id, x.n_hit, x.items) for x in out.collect()) == [(1, 100_000, ["5"]), (2, 100, ["5"]), (3, 0, []), (4, 10, ["5"])]
    assert time.time() - t < 60


# -- 3

def test_language_odd_rows(spark, odd_docs, no_docs):
    model = langid.train(odd_docs)
    got = langid.predict(odd_docs, model).collect()
    assert len(got) == N and [r.lang_pred for r in got if r.doc_id in (3, 4, 5, 8)] == ["und"] * 4
    assert langid.train(no_docs).classes == ["und"] and langid.predict(no_docs, model).count() == 0


def test_language_gradients():
    """Backpropagation through time against finite differences of the loss."""
    r = np.random.default_rng(0)
    m = langid.Model(["a", "b"], 1)
    steps = [r.integers(0, 256, 3) for _ in range(4)]
    target = [r.standard_normal((langid.HIDDEN, 3)).astype(np.float32) for _ in steps]
    loss = lambda: sum(float((s.astype(np.float64) * t).sum()) for s, t in zip(langid._gru(m.tf, m.uf, m.bf, steps), target, strict=True))
    g = [np.zeros_like(x) for x in (m.tf, m.uf, m.bf)]
    langid._step_back(m.tf, m.uf, m.bf, steps, langid._gru(m.tf, m.uf, m.bf, steps), target, g)
    for w, d in zip((m.tf, m.uf, m.bf), g, strict=True):
        for i in np.argsort(-np.abs(d).ravel())[:5]:
            at, e = np.unravel_index(i, w.shape), 1e-2
            old = w[at]
            w[at] = old + e
            up = loss()
            w[at] = old - e
            assert (up - loss()) / (2 * e) == pytest.approx(float(d[at]), rel=0.03, abs=2e-3)
            w[at] = old


def test_language_is_learned():
    r = random.Random(5)
    make = lambda syl: " ".join("".join(r.choice(syl) for _ in range(r.randint(1, 3))) for _ in range(40))
    kinds = {"x": ["ka", "to", "mi"], "y": ["ße", "rö", "lü"], "z": ["ing", "the", "ow"]}
    data = [(k, make(s).encode()) for _ in range(60) for k, s in kinds.items()]
    blocks = [(b, k) for k, t in data for b in langid.cut_blocks([t])[0]]
    m = langid.fit(np.stack([b for b, _ in blocks]), np.array([sorted(kinds).index(k) for _, k in blocks]), sorted(kinds), steps=200, lanes=32)
    held = [(k, make(s).encode()) for _ in range(20) for k, s in kinds.items()]
    right = [m.classes[int(m.blocks(langid.cut_blocks([t])[0])[0].sum(0).argmax())] == k for k, t in held]
    assert np.mean(right) > 0.97


# -- 4

def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (7, 0), (99, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(odd_docs, labels)
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == N and all(0 <= r.score <= 1 for r in got) and all(r.score == 0 for r in got if r.doc_id in (3, 4, 5))
    kept = toxicity.accepted(odd_docs, labels.limit(0))
    assert kept.columns == odd_docs.columns and kept.count() >= N - 1
    assert toxicity.accepted(no_docs, labels).count() == 0


def test_toxicity_finds_the_sentence():
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    sentence = lambda bad: " ".join([word() for _ in range(6)] + (["vile" + r.choice(["", "ness", "ly"])] if bad else [])) + ". "
    texts, y = [], []
    for i in range(300):
        bad = i % 5 == 0
        at = r.randrange(8)
        texts.append("".join(sentence(bad and j == at) for j in range(8)).encode())
        y.append(int(bad))
    w, b = toxicity.fit(texts, y)
    words = toxicity.Words()
    for t, label in zip(texts, y, strict=True):
        s, first, last = toxicity.sentence_logits(words, w, t)
        assert (toxicity.noisy_or(s + b) >= 0.3) == bool(label)
        if label:
            i = int(np.argmax(s))
            assert b"vile" in t[first[i] : last[i]]


def test_toxicity_pieces_join(monkeypatch):
    r = random.Random(4)
    text = "".join(r.choice("ab .!\nÄ") for _ in range(3000)).encode()
    w = np.random.default_rng(1).standard_normal(1 << toxicity.BITS)
    whole = toxicity.sentence_logits(toxicity.Words(), w, text)
    monkeypatch.setattr(toxicity, "_SLICE", 50)
    parts = toxicity.sentence_logits(toxicity.Words(), w, text)
    for a, b in zip(whole, parts, strict=True):
        assert np.allclose(a, b)


def test_toxicity_by_length(spark, monkeypatch):
    """Long documents train too, and no number of sentences without a telling word makes a text toxic."""
    r = random.Random(22)
    neutral = lambda n: " ".join(" ".join(r.choice(["sun", "rain", "road", "tree", "lake"]) for _ in range(6)) + "." for _ in range(n))
    rows = [(i, neutral(6) + (" vile thing." if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(80)] + [(100, neutral(1500), 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    seen, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: seen.extend(texts) or fit(texts, y))
    w, b = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert len(seen) == len(rows) and max(map(len, seen)) > 20_000
    p = lambda t: toxicity.noisy_or(toxicity.sentence_logits(toxicity.Words(), w, t.encode())[0] + b)
    assert p(neutral(20_000)) < 0.3 <= p(neutral(20) + " vile thing.")


# -- 5, 10

def test_encoder_is_the_tokenizer(monkeypatch):
    monkeypatch.setattr(tokens, "_SLICE", 200)
    r = random.Random(6)
    chars = "aB, .'s!1é İΣßḰ 漢 \t\n<|endoftext|>x"
    texts = ["".join(r.choice(chars) for _ in range(r.randint(0, 300))) for _ in range(150)] + ["it's we'LL don't", "Σας ΣΑΣ.", "<|ENDOFTEXT|> <|endoftext|>", "é e ́", ""]
    for special in (False, True):
        e = tokens.Encoder(tokenizer(), special)
        flat, n = e.encode(texts)
        at = 0
        for t, k in zip(texts, n, strict=True):
            assert flat[at : at + k].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t
            at += k


def test_words_are_learnt_once():
    """Whatever stops and case a word comes with, the tokenizer gets its letters once, many words to a call."""
    e = tokens.Encoder(tokenizer())
    r = random.Random(7)
    words = ["".join(r.choice("abcdeéñößøÿž") for _ in range(9)) for _ in range(300)]
    stops = ["", ".", ",", "!!", ".***", ",'", "$$$", ")", "<|"]
    texts = [" ".join(w + s for w in words) for s in stops] + [" ".join(w.upper().replace("SS", "ß") + s for w in words) for s in stops]
    held, calls, ids = len(e.words), [], e._ids
    e._ids = lambda texts, *tokenizer: calls.extend(texts) or ids(texts, *tokenizer)
    flat, n = e.encode(texts)
    assert flat.tolist() == [i for t in texts for i in e.tokenizer.encode(t, add_special_tokens=False).ids] and n.sum() == len(flat)
    assert len(e.words) <= held + len(words) + len(stops) and len(calls) <= len(words) / 100 + len(stops)


def test_letters_and_stops():
    """Every letter below U+0250 and some beyond, alone and before each ASCII stop and a few runs, as the tokenizer has them."""
    e = tokens.Encoder(tokenizer())
    letters = [c for c in map(chr, [*range(0x41, 0x260), 0x2C65, 0x3A3, 0x1E9E, 0x6F22]) if c.isalpha()]
    stops = [*string.punctuation, "", "...", ".'", "'s", "'S", "`~^", "\u0301", ".\u0301", "\u00d7", "\u0338", "1.", ".a."]
    texts = [f"{c}{s}" for c in letters for s in stops] + [f"x{c}y{s} {s}{c}" for c in letters for s in stops] + [".".join(letters), "".join(letters) + "."]
    texts += ["<|".join(texts[:900]), "x<|endoftext|> A. <|ENDOFTEXT|>. É, <|endoftext|>,"]
    flat, n = e.encode(texts)
    want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == list(map(len, want)) and flat.tolist() == [i for ids in want for i in ids]


@pytest.mark.parametrize("block", [2, 6, 1 << 20])
def test_separator_scan(spark, tmp_path, block):
    files = {"a": [9, 9, 1, 2, 3, 9, 4], "b": [], "c": [1] * 20 + [9] + [2] * 3 + [9], "d": [5, 5]}
    for k, ids in files.items():
        (tmp_path / f"{k}.ids").write_bytes(np.array(ids, "<u2").tobytes() + (b"\0" if k == "d" else b""))
    want = []
    for k, ids in files.items():
        at, no = 0, 0
        for i, x in enumerate(ids):
            if x == 9:
                want.append((f"{k}.ids", no, at, i - at, True))
                at, no = i + 1, no + 1
        if at < len(ids):
            want.append((f"{k}.ids", no, at, len(ids) - at, False))
    got = separators.scan(spark, f"file://{tmp_path}", 9, 2, block)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_separator_odd_rows(spark, odd_docs, no_docs):
    for docs, n in ((odd_docs, N), (no_docs, 0)):
        folder = work_dir(spark, "flat")
        wrote, width = separators.write_flat(docs, tokenizer(), folder, 49407)
        found = separators.scan(spark, folder, 49407, width, 1 << 16)
        assert wrote.count() == found.count() == n
        if n:
            counts = sorted((r.doc_id or -1, r.n_tokens) for r in found.join(wrote, ["file", "doc_no"]).collect())
            assert counts[0] == (-1, 0) and (4, 0) in counts and counts.count((1, 13)) == 2


def test_huffman():
    r = np.random.default_rng(0)
    for size, n, limit in ((1, 10, 20), (2, 5, 20), (300, 5000, 9), (5000, 40_000, 20), (70, 1, 20)):
        ids = (r.pareto(0.7, n) * 3).astype(np.int64) % size
        counts = np.bincount(ids, minlength=size)
        length = huffman.lengths(counts, limit)
        assert (length[counts > 0] > 0).all() and length.max() <= limit and (2.0 ** -length[length > 0].astype(float)).sum() <= 1
        code = huffman.codes(length)
        payload, checks = huffman.encode(ids, length, code)
        assert (huffman.decode(payload, n, checks, huffman.table(length, code)) == ids).all()
    assert huffman.decode(b"", 0, np.zeros(0), huffman.table(length, code)).tolist() == []
    with pytest.raises(ValueError):
        huffman.lengths(np.ones(9), 3)


def test_huffman_is_optimal():
    import heapq

    r = random.Random(1)
    for _ in range(30):
        counts = [r.randint(1, 50) for _ in range(r.randint(2, 40))]
        heap, cost = list(counts), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            x = heapq.heappop(heap) + heapq.heappop(heap)
            cost += x
            heapq.heappush(heap, x)
        assert int((huffman.lengths(np.array(counts)).astype(int) * counts).sum()) == cost


def test_binary_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(binary, "BLOCK", 5000)
    for docs, n in ((odd_docs, N), (no_docs, 0)):
        folder = work_dir(spark, "binary")
        binary.write(docs, folder, tokenizer())
        got = sorted(binary.read(spark, folder, ids=True).collect(), key=lambda r: r.start)
        assert len(got) == n
        assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x))
        assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False)) and all(r.ids[-1] == 2 and len(r.ids) == r.n_tokens for r in got)
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got) and (not n or max(r.n_tokens for r in got) > 20 * 5000)


# -- 6

def test_mixing_is_the_same_again(spark):
    """Rows that repeat id, source and text but not the rest get the same takes every time, and a null source isn't an empty one."""
    rows = [(1, "a b c", "x", i) for i in range(40)] + [(1, "a b c", None, 100 + i) for i in range(3)] + [(1, "a b c", "", 200 + i) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    seen = [sorted(map(str, mixing.mixed(df.repartition(n)).collect())) for n in (1, 3, 7)]
    assert seen[0] == seen[1] == seen[2]
    plan = mixing.plan(df).collect()
    for source, n in (("x", 40), (None, 3), ("", 5)):
        mine = [r for r in plan if r.source == source]
        assert len(mine) == n and {r.source_size for r in mine} == {3 * n}
        taken = sum(len(t.split()) for t in re.findall(r"text='([^']*)', source=" + ("None" if source is None else f"'{source}'"), " ".join(seen[0])))
        assert taken == sum(r.taken for r in mine)


def test_tokenizers_are_probed():
    import public_tokenizers

    with pytest.raises(ValueError):
        tokens.Encoder(public_tokenizers.path([n for n in os.listdir(os.path.dirname(tokenizer())) if n.endswith(".json") and n != os.path.basename(tokenizer())][0]))


def test_long_pieces_are_not_kept():
    e = tokens.Encoder(tokenizer())
    held = len(e.words)
    text = " ".join("漢字" * 40 + str(i) for i in range(50)) + " " + "QWERTY" * 30 + "."
    ids, _ = e.encode([text])
    assert ids.tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids and len(e.words) <= held + 3


def test_mixing_odd_rows(odd_docs, no_docs):
    rows = mixing.plan(odd_docs).collect()
    assert len(rows) == N and sum(r.size for r in rows) == 13 * 3 + 1 + 200_000 + 5 + 4 + 8
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in out.collect()) == sum(r.taken for r in rows)
    assert mixing.plan(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def test_mixing_of_many_sources(spark, monkeypatch):
    sizes = spark.range(500).select(F.when(F.col("id") > 0, F.concat(F.lit("s"), F.col("id"))).alias("source"), (F.col("id") * 37 % 101).alias("source_size"))
    a = sorted(mixing.targets(sizes).collect(), key=str)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert a == sorted(mixing.targets(sizes.repartition(5)).collect(), key=str)
    assert abs(sum(r.target for r in a) - 1.5 * sum(r.source_size for r in a)) < 1e-6 and all(r.target <= 2 * r.source_size for r in a)
    # by hand: raise one level until the words are shared out
    names = sorted((r.source for r in a if r.source is not None)) + [None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    level = max(r.target / weight[r.source] for r in a)
    assert all(abs(r.target - min(2 * r.source_size, level * weight[r.source])) < 1e-6 for r in a)


def test_mixing_ranges_don_t_matter(spark, monkeypatch):
    docs = spark.range(500).select("id", F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text")).withColumnRenamed("id", "doc_id")
    a = sorted(mixing.plan(docs).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert a == sorted(mixing.plan(docs).collect())


# -- 7

def test_warc_odd_rows(spark):
    big = "x" * 3_000_000
    rows = [(1, "http://a/ b\n", big), (2, None, big), (2, None, big), (None, "u", big), (3, "u", None), (4, "u", ""), (5, "u", "é" * 50), (6, "u", "é" * 50), (7, "u", "é" * 49), (8, "u", "é" * 49), (None, "u", "n" * 200), (None, "u", "n" * 200), (9, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 9)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, first int")
    got = warc.archive(spark, pages, work_dir(spark, "warc")).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    said = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got)
    assert said == sorted([(1, 3_000_000, "response", 0), (2, 3_000_000, "revisit", 1), (2, 3_000_000, "revisit", 1), (0, 3_000_000, "revisit", 1), (3, 0, "response", 0), (4, 0, "response", 0), (5, 100, "response", 0), (6, 100, "revisit", 5), (7, 98, "response", 0), (8, 98, "response", 0), (0, 200, "response", 0), (0, 200, "response", 0), (9, 9 * 33, "response", 0)])
    assert warc.archive(spark, pages.limit(0), work_dir(spark, "warc")).count() == 0


def test_warc_normaliser(monkeypatch):
    monkeypatch.setattr(warc, "_PIECE", 37)
    records = [warc.record(i, f"http://x/{i}", bytes([i]) * (i * 50), "d", None) for i in range(20)]
    for data in (gzip.compress(b"".join(records)), b"".join(gzip.compress(r) for r in records), gzip.compress(b"".join(records[:7])) + gzip.compress(b"".join(records[7:]))):
        out = io.BytesIO()
        index = list(warc.normalise(io.BytesIO(data), out))
        assert [gzip.decompress(out.getvalue()[a : a + n]) for a, n, _ in index] == records
    with pytest.raises((ValueError, EOFError)):
        list(warc.normalise(io.BytesIO(gzip.compress(records[5][:-30])), io.BytesIO()))
    with pytest.raises(ValueError):
        list(warc.normalise(io.BytesIO(gzip.compress(records[5])[:-20]), io.BytesIO()))


def test_warc_small_records_cost_no_more(monkeypatch):
    """Time goes by bytes, not by records times what is held."""
    import time

    def took(size):
        data = gzip.compress(b"".join(warc.record(i, "u", b"x" * size, "d", None) for i in range(6_000_000 // size)), 1)
        t = time.process_time()
        assert sum(1 for _ in warc.normalise(io.BytesIO(data), io.BytesIO())) == 6_000_000 // size
        return time.process_time() - t

    assert took(300) < 4 * took(30_000) + 2


# -- 8

def _chat(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, w string, k int")


ODD_TURNS = [(1, 0, "system", "be\\ki<nd"), (1, 1, "user", None), (1, 1, "user", None), (1, 2, "assistant", "</s>\n<s>user\n[INST]<<SYS>>\\</s>"), (1, 3, None, "x"), (1, None, "tool\n\\N", "y"), (None, 1, "assistant", "a" * 50_000), (None, 0, "user", ""), (2, 0, "assistant", "\\"), (3, 0, "system", "alone")]


def test_chat_round_trip(spark):
    df = _chat(spark, ODD_TURNS)
    for budget, history in ((1024, 256), (40, 10), (5, 0)):
        back = chat.read_back(chat.windows(df, budget, history)).collect()
        for conv in {r[0] for r in ODD_TURNS}:
            mine = sorted((r for r in back if r.conv_id == conv), key=lambda r: (r.part, r.window))
            turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in ODD_TURNS if r[0] == conv))
            assert [tuple(t) for w in mine for t in w.turns] == [t[2:] for t in turns]
            assert [x for w in mine for x in w.targets] == [t[3] for t in turns if t[2] == "assistant"]
    assert chat.digests(chat.read_back(chat.windows(df.limit(0)))).count() == 0


def test_chat_windows(spark):
    r = random.Random(8)
    rows = [(c, t, "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2], "w " * r.randint(0, 90)) for c in range(12) for t in range(r.randint(1, 30))]
    found = chat.windows(_chat(spark, rows), 800, 240).collect()
    assert any(w.n_repeat > 1 for w in found)
    for w in found:
        pieces = w.formatted.split("</s>\n")[:-1]
        cost = [len(p) + 5 for p in pieces]
        assert w.n_tokens == sum(cost) and len(pieces) == w.n_repeat + w.n_new
        # over budget only for one turn that is too long beside the system turn
        system = cost[0] if w.conv_id % 2 else 0
        assert w.n_tokens <= 800 or w.n_new == 1 and w.n_repeat <= (w.conv_id % 2) or max(cost[w.n_repeat :]) + system > 800
        if w.conv_id % 2:
            assert pieces[0].startswith("<s>system\n")
        repeated = sum(cost[: w.n_repeat]) - (cost[0] if w.conv_id % 2 and w.n_repeat else 0)
        assert repeated <= 240


def test_chat_parts(spark, monkeypatch):
    """A conversation of many parts loses no turn, keeps its system turn in every window, and goes on from the part before."""
    r = random.Random(18)
    rows = [(c, t, "system" if t in (-3, 4) and c % 2 else ("user", "assistant")[t % 2], f"{t} " * r.randint(1, 60)) for c in range(6) for t in range(-3, r.randint(1, 25))]
    rows += [(2, None, "system", "no turn"), (3, 2**62, "assistant", "last"), (3, 2**62, "assistant", "last"), (None, 1, "user", "x"), (None, 300, "user", "y")]
    opening = {1: "-3", 3: "-3", 5: "-3", 2: "no turn"}
    seen = []
    for bits in (62, 2, 0):
        monkeypatch.setattr(chat, "PART_BITS", bits)
        found = chat.windows(_chat(spark, rows), 480, 160)
        seen.append(sorted(map(str, chat.digests(chat.read_back(found)).drop("formatted_chars").collect())))
        repeats = 0
        for w in found.collect():
            pieces = w.formatted.split("</s>\n")[:-1]
            cost = [len(p.encode()) + 5 for p in pieces]
            assert w.n_tokens == sum(cost) and len(pieces) == w.n_repeat + w.n_new and (w.n_tokens <= 480 or w.n_new == 1 or bits == 62 and w.window == 0)
            if w.conv_id in opening:
                assert pieces[0].startswith(f"<s>system\n{opening[w.conv_id]}")
                assert not any(p.startswith(f"<s>system\n{opening[w.conv_id]}") for p in pieces[1:])
            repeats += w.n_repeat - (w.conv_id in opening)
        assert repeats > 5
    assert seen[0] == seen[1] == seen[2]


def test_chat_counts_of_a_column(spark):
    df = _chat(spark, [(1, t, "user", "w " * 50) for t in range(8)]).withColumn("k", F.lit(30))
    assert [w.n_tokens for w in chat.windows(df, 90, 0, "k").collect()] == [90, 90, 60]


def test_chat_uses_no_python(spark):
    plan = chat.digests(chat.read_back(chat.windows(_chat(spark, ODD_TURNS))))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- 9

def test_simhash_odd_rows(odd_docs, no_docs):
    got = simhash.classes(odd_docs).collect()
    assert len(got) == N
    empty = {r.component_id for r in got if r.fp == 0}
    assert empty == {3} and {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert simhash.classes(no_docs).count() == 0


def test_simhash_links_are_all(spark, monkeypatch):
    """Every pair within 3 bits and no other, also where many share a key."""
    r = random.Random(9)
    seeds = [r.getrandbits(64) for _ in range(6)]
    near = lambda x, n: x ^ sum(1 << b for b in r.sample(range(64), n))
    fps = {near(x, r.randint(0, 4)) for x in seeds for _ in range(60)} | {r.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp bigint")
    want = {(a, b) for a in fps for b in fps if simhash._signed(a) < simhash._signed(b) and (a ^ b).bit_count() <= 3}
    for direct in (64, 2):
        monkeypatch.setattr(simhash, "DIRECT", direct)
        got = [(r.u % 2**64, r.v % 2**64) for r in simhash.links(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_simhash_crowds(spark, monkeypatch):
    """Where keys are too crowded for pairs, links are true and connect what all pairs connect."""
    from .test_queries import slow_classes

    monkeypatch.setattr(simhash, "DIRECT", 3)
    monkeypatch.setattr(simhash, "CROWD", 5)
    r = random.Random(19)
    near = lambda x, n: x ^ sum(1 << b for b in r.sample(range(64), n))
    fps = sorted({near(x, r.randint(0, 5)) for x in (0, r.getrandbits(64), r.getrandbits(64)) for _ in range(50)} | {r.getrandbits(64) for _ in range(20)})
    called = []
    real = simhash._stars
    monkeypatch.setattr(simhash, "_stars", lambda *a: called.append(1) or real(*a))
    edges = simhash.links(spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp bigint")).collect()
    assert called and all(e.u < e.v and ((e.u ^ e.v) % 2**64).bit_count() <= 3 for e in edges) and len(set(edges)) == len(edges)
    root = {x: x for x in fps}
    find = lambda x: x if root[x] == x else find(root[x])
    for e in edges:
        a, b = find(e.u % 2**64), find(e.v % 2**64)
        root[max(a, b)] = min(a, b)
    want = slow_classes({x: x for x in fps})
    assert {x: find(x) for x in fps} == want and len(set(want.values())) < len(fps)


def test_components(spark):
    r = random.Random(10)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in groups.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    touched = {x for e in edges for x in e if e[0] != e[1]}
    assert {k: got.get(k, k) for k in touched} == {k: find(k) for k in touched}
    assert groups.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_components_of_few_and_many(spark, monkeypatch):
    """Few edges take no rounds of shuffles; more than may be broadcast do, and give the same."""
    r = random.Random(11)
    ids = [r.getrandbits(64) - 2**63 for _ in range(300)] + [-(2**63), 2**63 - 1, 0]
    edges = [(r.choice(ids), r.choice(ids)) for _ in range(200)] + list(zip(ids[:60], ids[1:61], strict=True))
    df = spark.createDataFrame([*edges, *edges[:9], (5, 5)], "u bigint, v bigint")
    shuffles = spark.sparkContext._jsc.sc().newShuffleId
    before = shuffles()
    few = sorted(map(tuple, groups.components(df).collect()))
    assert shuffles() - before <= 3
    monkeypatch.setattr(groups, "BROADCAST_ROWS", 0)
    many = sorted(map(tuple, groups.components(df).collect()))
    assert few == many and len({x for x, _ in few}) == len(few)
    assert groups.components(df.limit(0)).columns == ["node", "root"] and groups.components(df.limit(0)).count() == 0


def test_simhash_repeated_ids(spark):
    """Rows of one doc_id are told apart by their texts: none goes that is a near copy of nothing."""
    a, b = "the quick brown fox jumps over it", "an entirely different set of words is here"
    for rows in ([(7, a), (7, b)], [(3, a), (7, a), (7, b)], [(3, a), (7, a), (7, b), (7, b)]):
        kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert sorted(map(tuple, kept)) == sorted([rows[0], (7, b)])
    for rows in ([(None, a), (None, a), (None, b), (None, b + " too")], [(3, a), (None, a), (None, a.upper()), (None, b)]):
        kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert sorted(r.text for r in kept) == [b, a]


def test_near_copies_are_all(spark, monkeypatch):
    """Classes of every pair of 5-word Jaccard 0.8 or more, SimHash bits however many, also where many share a shingle."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    line = " ".join(word() for _ in range(9))
    rows, texts = [], []
    for size, copies in ((400, 12), (60, 8), (200, 40), (5, 3), (3, 3), (0, 2)):
        base = [word() for _ in range(size)]
        for i in range(copies):
            ws = list(base)
            for _ in range(r.randint(0, max(1, size // 25)) if size else 0):
                ws[r.randrange(size)] = word()
            texts.append(" ".join(ws[: size - i // 3] + ([line] if i % 2 and size > 100 else [])))
    texts += [" ".join([word() for _ in range(30)] + [line]) for _ in range(30)] + [texts[0], texts[0].upper()]
    rows = list(enumerate(texts))
    r.shuffle(rows)

    def shingle_set(t):
        ws = t.lower().split()
        return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()

    sets = {k: shingle_set(t) for k, t in rows}
    near = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    root = {k: k for k in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for a in sets:
        for b in sets:
            if a < b and near(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = sorted(k for k in sets if find(k) == k)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for direct in (64, 3):
        monkeypatch.setattr(shingles, "DIRECT", direct)
        got = sorted(map(tuple, simhash.one_of_each(df).collect()))
        assert got == [(k, texts[k]) for k in want]


def test_pivot_tables_bound_the_distance():
    r = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 400, 3000):
        a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        for share in (0.0, 0.5, 0.9, 1.0):
            b = np.unique(np.concatenate((a[r.random(len(a)) < share], r.integers(0, 1 << 63, int(n * (1 - share)) + 1, dtype=np.uint64) * np.uint64(2))))
            real = len(np.setxor1d(a, b))
            bound = shingles.apart(shingles.pivot_table(a), shingles.pivot_table(b))
            assert bound <= real and (share or n < 400 or 9 * bound > len(a) + len(b))
    same = np.zeros(300, np.uint64)  # more of one run than a byte counts: no table, nothing is discarded
    assert shingles.pivot_table(same) == b"" and shingles.apart(b"", shingles.pivot_table(a)) == 0


def test_near_copies_odd_rows(odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 8, 9]
    assert simhash.one_of_each(no_docs).count() == 0


def test_near_copies_by_fingerprint(spark, monkeypatch):
    """Fingerprints link first, by their pivots' rule and the exact similarity; what they can't tell is found as well."""
    r = random.Random(7)
    word = lambda: f"w{r.randrange(10**6)}"
    docs = []
    for _ in range(6):
        base = [word() for _ in range(900)]
        docs += [" ".join([*base[:i], word(), *base[i + 1 :]]) for i in (3, 300, 600)] + [" ".join(w if i % 90 else word() for i, w in enumerate(base))]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    sets = [set(shingles.shingles(t).tolist()) for t in docs]
    fps = [simhash.digest(shingles.shingles(t)) for t in docs]
    assert simhash.digest(shingles.shingles(None)) == 0
    alike = {(a, b) for a in range(len(docs)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    close = {(a, b) for a in range(len(docs)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3}
    assert close & alike and alike - close
    seen, real = [], shingles.classes
    monkeypatch.setattr(shingles, "classes", lambda d, rows, reps, near: seen.append((reps.collect(), near.collect())) or real(d, rows, reps, near))
    kept = simhash.one_of_each(df).collect()
    of = {x.g: x.doc_id for x in seen[0][0]}
    near = {tuple(sorted((of[x.u], of[x.v]), reverse=True)) for x in seen[0][1]}

    def first(pairs):
        root = list(range(len(docs)))
        for a, b in sorted(pairs) * len(docs):
            root[a] = root[b] = min(root[a], root[b])
        return root

    assert near <= close & alike and first(near) == first(close & alike)
    assert sorted(x.doc_id for x in kept) == [a for a in range(len(docs)) if not any(x == a for x, _ in alike)]
    # equal fingerprints of different sets reach each other, and the exact similarity still decides
    pairs = simhash.reached(spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 4), (9, -1)], "g bigint, fp bigint")).collect()
    assert sorted(map(tuple, pairs)) == [(1, 2), (1, 3), (1, 4)]
