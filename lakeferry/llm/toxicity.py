"""Toxicity by multiple-instance learning.

A document is a bag of sentences (cut at . ! ? and line ends). A sentence's logit is a bias
plus the weights of its words (runs of ASCII letters, digits, apostrophe and anything beyond ASCII, A-Z
lower-cased) and of their first 4, 5 and 6 bytes (stems of inflected words), hashed into 2**BITS buckets; the document's probability is the noisy-or of
its sentences': 1 - prod(1 - p), where a sentence without any word of weight counts nothing, so that length alone offends nobody. Only documents have labels; training pushes them down to the sentences,
and the sentences above `threshold` are where the document offends.

A bucket
gets a weight if at least RARE documents of the sample hold it, and toxic ones exceed their share among
these by Z standard deviations. The classifier is fitted on the driver on at most SAMPLE labelled documents, the first by hash of the id and the text, as many as
SAMPLE_BYTES hold, long ones included (only a text that alone is larger is left out). Scoring runs over whole texts in Arrow batches with
numpy alone: word hashes are differences of one running polynomial sum. A text of more than
_SLICE bytes is taken in pieces cut between words; its sentence logits carry over.

Cases: null text = empty: score 0. Rows without label (or a null one) train nothing. Null doc_id: never held out, no label.
Repeated rows are scored each, and train once; a text of both labels trains as both. No label
at all, or an empty table: weights stay 0. Other columns are kept by `accepted` and left out by `score`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, prepare, sampled, trim

BITS = 18
SAMPLE = 4000
SAMPLE_BYTES = 16 << 20
RARE = 5
Z = 5.0
STEMS = (4, 5, 6)
THRESHOLD = 0.3
_SLICE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_BIAS = -6.0


def _tables():
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    word = np.zeros(256, bool)
    word[[*range(48, 58), *range(97, 123), 39, *range(128, 256)]] = True
    stop = np.zeros(256, bool)
    stop[[10, 13, 33, 46, 63]] = True
    return low, word, stop


_LOW, _WORD, _STOP = _tables()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse, modulo 2**64."""
    def run(b):
        out = np.full(n, b, np.uint64)
        out[0] = 1
        return np.cumprod(out)
    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


class Words:
    """Word buckets and sentence numbers of byte strings."""

    def __init__(self):
        self.up, self.down = _powers(1 << 16)

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For every word: buckets (word and stems, one under the other; 0: the word is no longer than the stem), start, end, sentence (from 0)."""
        b = _LOW[np.frombuffer(data, np.uint8)]
        if len(b) + 1 > len(self.up):
            self.up, self.down = _powers(max(len(b) + 1, 2 * len(self.up)))
        w = _WORD[b]
        edge = np.diff(w.astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            run = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[: len(b)], dtype=np.uint64)))
            buckets = np.empty((1 + len(STEMS), len(start)), np.int64)
            for i, k in enumerate((0, *STEMS)):
                to = np.minimum(start + k, end) if k else end
                h = (run[to] - run[start]) * self.down[start] + np.uint64(i)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                buckets[i] = np.where((to < end) | (k == 0), np.maximum(h >> np.uint64(64 - BITS), np.uint64(1)), np.uint64(0))
        sentence = np.concatenate(([0], np.cumsum(_STOP[b])))[start]
        return buckets, start, end, sentence


def _pieces(data: bytes):
    """Parts of at most about _SLICE bytes, cut after a byte that is no part of a word where there is one."""
    at = 0
    while len(data) - at > _SLICE:
        part = np.frombuffer(data[at : at + _SLICE], np.uint8)
        gaps = np.flatnonzero(~_WORD[_LOW[part]])
        n = int(gaps[-1]) + 1 if len(gaps) else _SLICE
        yield data[at : at + n]
        at += n
    yield data[at:]


def sentence_logits(words: Words, weights: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logit (minus infinity: no word of weight), first and last byte of every sentence that has words."""
    logit, telling, first, last = [], [], [], []
    at, open_ = 0, False
    for part in _pieces(data):
        bucket, start, end, sentence = words.of(part)
        if len(start):
            new = np.flatnonzero(np.diff(sentence, prepend=-1))
            w = weights[bucket]
            s, some = np.add.reduceat(w.sum(0), new), np.logical_or.reduceat((w != 0).any(0), new)
            f, l = start[new] + at, np.append(end[new[1:] - 1], end[-1]) + at
            if open_ and sentence[0] == 0:  # the last piece ended within this sentence
                logit[-1][-1] += s[0]
                telling[-1][-1] |= some[0]
                last[-1][-1] = l[0]
                s, some, f, l = s[1:], some[1:], f[1:], l[1:]
            if len(s):
                logit.append(s)
                telling.append(some)
                first.append(f)
                last.append(l)
        stops = np.flatnonzero(_STOP[np.frombuffer(part, np.uint8)])
        tail = stops[-1] if len(stops) else -1
        open_ = bool(len(start) and start[-1] > tail) or (open_ and not len(stops) and not len(start))
        at += len(part)
    if not logit:
        return np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.where(np.concatenate(telling), np.concatenate(logit), -np.inf), np.concatenate(first), np.concatenate(last)


def noisy_or(logits: np.ndarray) -> float:
    """1 - prod(1 - p)."""
    return float(-np.expm1(-np.logaddexp(0, logits).sum())) if len(logits) else 0.0


def fit(texts: list[bytes], labels: list[int], epochs: int = 80, rate: float = 0.2, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights by bucket and the bias: full-batch Adam on the noisy-or's log loss, with weight decay."""
    words, y = Words(), np.asarray(labels, np.float64)
    features, docs, sents = [], [], 0
    held, toxic = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for i, t in enumerate(texts):
        b, _, _, s = words.of(t)
        if not b.size:
            continue
        new = np.diff(s, prepend=-1) != 0
        at = np.cumsum(new) - 1 + sents
        sents += int(new.sum())
        # each bucket counts once a sentence here, that repeated words don't drown the rest
        features.append(np.unique((b + (at << BITS)).ravel()))
        docs.append(np.full(int(new.sum()), i))
        here = np.unique(b)
        held[here] += 1
        toxic[here] += y[i]
    w, bias = np.zeros(1 << BITS), _BIAS
    held[0] = 0
    if not features or y.min() == y.max():
        return w, bias
    feature, doc = np.concatenate(features), np.concatenate(docs)
    bucket, sent = feature & ((1 << BITS) - 1), feature >> BITS
    share = y.mean()
    telling = (held >= RARE) & (toxic - held * share >= Z * np.sqrt(held * share * (1 - share)))
    keep = telling[bucket]
    used, inside = np.unique(bucket[keep], return_inverse=True)
    # sentences without telling features say nothing, and don't fit the bias
    active, sent = np.unique(sent[keep], return_inverse=True)
    doc, sents = doc[active], len(active)
    x, m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    x[-1] = bias
    for t in range(1, epochs + 1):
        s = np.bincount(sent, x[inside], sents) + x[-1]
        p = np.exp(-np.logaddexp(0, -s))
        none = np.exp(-np.bincount(doc, np.logaddexp(0, s), len(y)))  # that no sentence is toxic
        pull = np.where(y > 0, -none / np.maximum(1 - none, 1e-6), 1.0)
        g = pull[doc] * p / len(y)
        grad = np.append(np.bincount(inside, g[sent], len(used)) + decay * x[:-1], g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    w[used] = x[:-1]
    return w, float(x[-1])


def train(docs: DataFrame, labels: DataFrame, usable=None) -> tuple[np.ndarray, float]:
    """fit() on a bounded sample of the labelled documents that `usable` (a column) admits."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("label")).where("label is not null")
    if usable is not None:
        known = known.where(usable)
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = sampled(text, SAMPLE, SAMPLE_BYTES, known)
    return fit([r[1].encode("utf-8", "replace") for r in rows], [r[2] for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, h (the text's hash), score, spans of offending sentences (array of first and last byte, score)."""
    weights, bias = model
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    floor = float(np.log(threshold / (1 - threshold)))

    def run(batches):
        import pyarrow as pa

        words, w = Words(), shared.value.astype(np.float64)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            scores, spans = [], []
            for t in batch.column(2):
                s, f, l = sentence_logits(words, w, (t.as_py() or "").encode("utf-8", "replace"))
                s = s + bias
                scores.append(noisy_or(s))
                bad = np.flatnonzero(s >= floor)
                spans.append([{"first": int(f[i]), "last": int(l[i]), "score": float(1 / (1 + np.exp(-s[i])))} for i in bad])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "h", "score", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, h bigint, score double, spans array<struct<first:bigint,last:bigint,score:double>>")


def usable_for_training():
    return ~held_out("doc_id", 4, 2)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that score below threshold: one pass, without a join."""
    weights, bias = train(docs, labels, usable_for_training())
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        words, w = Words(), shared.value.astype(np.float64)
        for batch in batches:
            texts = (str(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(at))
            keep = [noisy_or(sentence_logits(words, w, t)[0] + bias) < threshold for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))
        trim()

    prepare(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
