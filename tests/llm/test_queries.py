"""Each registered query against its SQL, or against a plain version in Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lakeferry.llm import langid, mixing, queries, toxicity
from lakeferry.llm.common import held_out
from lakeferry.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(name, spark, sf, same):
    same(QUERIES[name](spark, sf), ORACLES[name])


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 11))


def slow_gru(model, names, data):
    """States after each byte, by the equations."""
    table, u, bias = (getattr(model, n).astype(np.float64) for n in names)
    n, h, out = u.shape[1], np.zeros(u.shape[1]), []
    squash = lambda x: 1 / (1 + np.exp(-x))
    for b in data:
        x, a = table[:, b], u @ h
        z, r = squash(x[:n] + a[:n]), squash(x[n : 2 * n] + a[n : 2 * n])
        new = np.tanh(x[2 * n :] + r * (a[2 * n :] + bias[:, 0]))
        h = z * h + (1 - z) * new
        out.append(h)
    return out


def slow_language(model, text):
    """Mean class probabilities of the letter positions, one position after the other."""
    data, sums, n = text.encode(), np.zeros(len(model.classes)), 0
    for at in range(0, len(data), langid.BLOCK):
        block = data[at : at + langid.BLOCK].ljust(langid.BLOCK, b"\0")
        fore, back = slow_gru(model, ("tf", "uf", "bf"), block), slow_gru(model, ("tb", "ub", "bb"), block[::-1])[::-1]
        for b, f, g in zip(block, fore, back, strict=True):
            if b > 127 or chr(b).isalpha():
                s = model.w @ np.concatenate((f, g)) + model.c[:, 0]
                p = np.exp(s - s.max())
                sums, n = sums + p / p.sum(), n + 1
    return sums / n


def test_op3(spark, sf_mid):
    """Held-out accuracy, and the probabilities of the same weights by a plain network."""
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet")
    got = {r.doc_id: r for r in queries.op3_language(spark, sf_mid).collect()}
    held = right = 0
    rows = docs.collect()
    assert len(got) == len(rows)
    for d in rows:
        r = got[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in d.text or ""))
        if r.held_out and d.lang and r.lang_pred != "und":
            held, right = held + 1, right + (d.lang == r.lang_pred)
    assert held > 200 and right / held > 0.97
    model = langid.train(docs, ~held_out("doc_id", 3, 1))
    for d in sorted(rows, key=lambda d: len(d.text or ""))[50:400:50]:
        if got[d.doc_id].lang_pred != "und":
            p = slow_language(model, d.text)
            assert model.classes[int(p.argmax())] == got[d.doc_id].lang_pred and abs(p.max() - got[d.doc_id].score) < 1e-3


def slow_toxicity(model, text):
    """Noisy-or of the sentences that hold a word of weight, word by word."""
    weights, bias = model
    words, none = toxicity.Words(), 1.0
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()
    for sentence in re.split(rb"[.!?\n\r]", low):
        logit, some = bias, False
        for w in re.findall(rb"[0-9a-z'\x80-\xff]+", sentence):
            for x in words.of(w)[0][:, 0]:
                logit, some = logit + weights[x], some or weights[x] != 0
        none *= 1 - 1 / (1 + np.exp(-logit)) if some else 1.0
    return 1 - none


def test_op4(spark, sf_mid):
    """Held-out ranking and recall, and the scores of the same weights by a plain scorer."""
    docs, labels = (spark.read.parquet(f"{sf_mid}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, sf_mid).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for d in rows:
        r = got[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    w, b = toxicity.train(docs, labels, toxicity.usable_for_training())
    for d in sorted(rows, key=lambda d: len(d.text or ""))[::25]:
        assert abs(slow_toxicity((w.astype(np.float32), b), d.text) - got[d.doc_id].score) < 1e-5
    held = [(got[r.doc_id].score, r.toxic) for r in labels.where("toxic is not null").collect() if r.doc_id in got and got[r.doc_id].held_out]
    bad, good = ([s for s, t in held if bool(t) == x] for x in (True, False))
    auc = np.mean([(a > g) + 0.5 * (a == g) for a in bad for g in good])
    assert len(bad) > 5 and auc > 0.75 and np.mean(np.array(good) >= 0.3) < 0.02 and np.mean(np.array(bad) >= 0.3) > 0.5


def test_op4_learns(spark):
    """With enough labelled rows, toxic documents are told from clean ones."""
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, sf).collect()}
    held = [(got[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic is not None and got[r.doc_id].held_out]
    bad, good = ([s for s, t in held if bool(t) == x] for x in (True, False))
    assert np.mean([(a > g) + 0.5 * (a == g) for a in bad for g in good]) > 0.95
    assert np.mean(np.array(bad) >= 0.3) > 0.85 and np.mean(np.array(good) >= 0.3) < 0.01


def _ids(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer())
    return {d.doc_id: t.encode(d.text or "", add_special_tokens=False).ids for d in docs}


def test_op5(spark, sf, docs):
    rows = queries.op5_token_counts(spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {k: len(v) for k, v in _ids(docs).items()}
    at = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.file, r.doc_no)):
        assert r.start == at[r.file] and r.ended
        at[r.file] += r.n_tokens + 1


def test_op10(spark, sf, docs):
    got, at = {r.doc_id: r for r in queries.op10_token_ids(spark, sf).collect()}, 0
    for k, ids in sorted(_ids(docs).items()):
        ids = [*ids, 2]
        assert tuple(got[k])[1:] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op8(spark, sf):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.op8_chat(spark, sf).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(turns)
    for k, ts in turns.items():
        ts.sort()
        loss = "".join(t for _, r, t in ts if r == "assistant")
        r = got[k]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(ts), sha("".join(f"{a}\n{b}\n" for _, a, b in ts)), len(loss), sha(loss))
        assert r.formatted_chars >= sum(len(a) + len(b) for _, a, b in ts)


def slow_fingerprint(text):
    import xxhash

    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(words)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def slow_classes(fps):
    """Smallest reachable id of every id, by trying all pairs."""
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in ids}


def test_op9(spark, sf, docs):
    fps = {d.doc_id: slow_fingerprint(d.text) for d in docs}
    want = slow_classes(fps)
    got = queries.op9_simhash(spark, sf).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == [(k, f"{v:016x}", want[k]) for k, v in sorted(fps.items())]


def slow_targets(sizes):
    """Shares handed out, and what is too much handed out again, until nothing is."""
    total, target, open_ = 1.5 * sum(n for _, n in sizes), {}, {}
    order = sorted((s for s, _ in sizes), key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    open_ = dict(sizes)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * open_[s]]
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * open_.pop(s)
    return target


def test_op6_targets(spark):
    import random

    for seed in range(6):
        r = random.Random(seed)
        sizes = [(None if i == 0 else f"s{i}", r.choice([0, 1, 5, 100, 10_000])) for i in range(r.randint(1, 9))]
        got = {x.source: x.target for x in mixing.targets(spark.createDataFrame(sizes, "source string, source_size bigint")).collect()}
        assert got == pytest.approx(slow_targets(sizes))


def test_op6_takes(spark, sf):
    rows = queries.op6_mixing(spark, sf).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.target].append(r)
        assert 0 <= r.taken <= 2 * r.size
    for t, rs in by.items():
        assert abs(sum(r.taken for r in rs) - t) <= 1 or len({r.source_size for r in rs}) > 1
    assert sorted(rows) == sorted(queries.op6_mixing(spark, sf).collect())
