"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into blocks of BLOCK bytes, each a sequence of its own (about ten words), so
thousands of sequences step through the network at once. Both directions are GRUs of
HIDDEN units whose input weights are a table by byte; every position gets class probabilities
from both states. A document's probabilities are the mean over its positions that hold
a letter's byte (a-z, A-Z, beyond ASCII). Training is numpy backpropagation through time on
the cross-entropy of all such positions, by Adam, on the driver.

Training samples rows: at most SAMPLE of those with a language, the first by hash of id and text, as many as SAMPLE_BYTES
hold (only a text that alone is larger is left out), and takes all blocks of their whole texts in random order, again and again
for STEPS steps of LANES blocks. Prediction reads every byte of every text.

Cases: null text, or a text without letters: `und`, score 0. Rows with null lang train nothing. Null doc_id: never held out.
Repeated rows get a prediction each. No rows to learn from: all `und`. A tie goes to the label first by code point.
Other columns are left out.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, sampled

BLOCK = 64
HIDDEN = 12
SAMPLE = 4000
SAMPLE_BYTES = 8 << 20
STEPS = 300
LANES = 256
RATE = 0.02
_LANES = 2048
_LETTER = re.compile(r"[^\W\d_]")
_COUNTS = np.zeros(256, bool)
_COUNTS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _sigmoid(x):
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _gru(table, u, bias, steps):
    """States, HIDDEN by lane, after each of the steps (arrays of bytes by lane)."""
    n = u.shape[1]
    h = np.zeros((n, len(steps[0])), np.float32)
    out = []
    for b in steps:
        x = table.take(b, axis=1)
        a = u @ h
        a[2 * n :] += bias
        gate = _sigmoid(x[: 2 * n] + a[: 2 * n])
        new = gate[n:] * a[2 * n :]
        new += x[2 * n :]
        new *= 2
        new = _sigmoid(new)
        new *= 2
        new -= 1
        h = new + gate[:n] * (h - new)
        out.append(h)
    return out


class Model:
    """Weights: input tables (3H, 256), recurrent (3H, H), candidate bias (H, 1) of both directions; output (K, 2H) and its bias."""

    names = ("tf", "uf", "bf", "tb", "ub", "bb", "w", "c")

    def __init__(self, classes: list[str], seed: int = 42):
        r, h, k = np.random.default_rng(seed), HIDDEN, len(classes)
        self.classes = classes
        shapes = {"tf": (3 * h, 256), "uf": (3 * h, h), "bf": (h, 1), "tb": (3 * h, 256), "ub": (3 * h, h), "bb": (h, 1), "w": (k, 2 * h), "c": (k, 1)}
        for n, s in shapes.items():
            setattr(self, n, (r.standard_normal(s) * (0.3 if len(n) > 1 and s[1] > 1 else 0.1)).astype(np.float32))

    def positions(self, blocks: np.ndarray):
        """Class by lane probabilities of each position in turn, for blocks (lane by position)."""
        steps = list(np.ascontiguousarray(blocks.T))
        fore = _gru(self.tf, self.uf, self.bf, steps)
        back = _gru(self.tb, self.ub, self.bb, steps[::-1])[::-1]
        n = self.uf.shape[1]
        for f, b in zip(fore, back, strict=True):
            p = self.w[:, :n] @ f
            p += self.w[:, n:] @ b
            p += self.c
            p -= p.max(0)
            np.exp(p, out=p)
            p /= p.sum(0)
            yield p

    def blocks(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each block: the sum of its letter positions' probabilities (block by class), and their number."""
        held = _COUNTS[blocks]
        total = np.zeros((len(blocks), len(self.classes)), np.float64)
        for at in range(0, len(blocks), _LANES):
            part, ok = blocks[at : at + _LANES], held[at : at + _LANES].T.astype(np.float32)
            sums = np.zeros((len(self.classes), len(part)), np.float32)
            for p, m in zip(self.positions(part), ok, strict=True):
                p *= m
                sums += p
            total[at : at + _LANES] = sums.T
        return total, held.sum(1)


def cut_blocks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of all texts, the last of each padded by zeros, and the number of each text's blocks."""
    n = np.array([-(-len(t) // BLOCK) for t in texts], np.int64)
    data = b"".join(t + bytes(-len(t) % BLOCK) for t in texts)
    return np.frombuffer(data, np.uint8).reshape(-1, BLOCK), n


def _step_back(table, u, bias, steps, states, grads, back):
    """Adds to back = (table, u, bias) what the gradients by state amount to."""
    n, lanes = u.shape[1], len(steps[0])
    d_table, d_u, d_bias = back
    dh = np.zeros((n, lanes), np.float32)
    zero = np.zeros((n, lanes), np.float32)
    by_input = []
    for t in range(len(steps) - 1, -1, -1):
        h = states[t - 1] if t else zero
        x, a = table.take(steps[t], axis=1), u @ h
        a[2 * n :] += bias
        gate = _sigmoid(x[: 2 * n] + a[: 2 * n])
        z, r = gate[:n], gate[n:]
        new = np.tanh(x[2 * n :] + r * a[2 * n :])
        dh = dh + grads[t]
        dnew = dh * (1 - z) * (1 - new * new)
        dz = dh * (h - new) * z * (1 - z)
        dr = dnew * a[2 * n :] * r * (1 - r)
        by_input.append(np.concatenate((dz, dr, dnew)))
        da = np.concatenate((dz, dr, dnew * r))
        d_u += da @ h.T
        d_bias += da[2 * n :].sum(1, keepdims=True)
        dh = dh * z + u.T @ da
    seen = np.concatenate(steps[::-1])
    for i, row in enumerate(np.concatenate(by_input, axis=1)):
        d_table[i] += np.bincount(seen, row, 256)


def gradients(model: Model, blocks: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of the letter positions of blocks, each of one label, and its gradient by every weight."""
    n, steps = model.uf.shape[1], list(np.ascontiguousarray(blocks.T))
    want = (np.arange(len(model.classes))[:, None] == labels[None, :]).astype(np.float32)
    held = _COUNTS[blocks].T.astype(np.float32)
    scale = 1 / max(1.0, float(held.sum()))
    fore = _gru(model.tf, model.uf, model.bf, steps)
    back = _gru(model.tb, model.ub, model.bb, steps[::-1])[::-1]
    g = {k: np.zeros_like(getattr(model, k)) for k in model.names}
    gf, gb, loss = [], [], 0.0
    for f, b, ok in zip(fore, back, held, strict=True):
        s = model.w[:, :n] @ f + model.w[:, n:] @ b + model.c
        p = np.exp(s - s.max(0))
        p /= p.sum(0)
        loss -= float((np.log(np.maximum((p * want).sum(0), 1e-30)) * ok).sum()) * scale
        d = (p - want) * ok * scale
        g["w"][:, :n] += d @ f.T
        g["w"][:, n:] += d @ b.T
        g["c"] += d.sum(1, keepdims=True)
        gf.append(model.w[:, :n].T @ d)
        gb.append(model.w[:, n:].T @ d)
    _step_back(model.tf, model.uf, model.bf, steps, fore, gf, (g["tf"], g["uf"], g["bf"]))
    _step_back(model.tb, model.ub, model.bb, steps[::-1], back[::-1], gb[::-1], (g["tb"], g["ub"], g["bb"]))
    return loss, g


def fit(blocks: np.ndarray, labels: np.ndarray, classes: list[str], steps: int = STEPS, lanes: int = LANES, rate: float = RATE) -> Model:
    """Adam for so many steps of so many blocks, all blocks once before any again."""
    model, r = Model(classes), np.random.default_rng(7)
    m = {k: np.zeros_like(getattr(model, k)) for k in model.names}
    v = {k: np.zeros_like(getattr(model, k)) for k in model.names}
    order = np.concatenate([r.permutation(len(blocks)) for _ in range(-(-steps * lanes // len(blocks)))])
    for t in range(1, steps + 1):
        pick = order[(t - 1) * lanes : t * lanes]
        _, g = gradients(model, blocks[pick], labels[pick])
        for k in model.names:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            step = m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
            setattr(model, k, (getattr(model, k) - rate * (1 - 0.95 * t / steps) * step).astype(np.float32))
    return model


def train(docs: DataFrame, usable=None) -> Model:
    """fit() on a bounded sample of the documents with a language that `usable` (a column) admits."""
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("label"))
    known = known.where("label is not null and text is not null")
    rows = sampled(known if usable is None else known.where(usable), SAMPLE, SAMPLE_BYTES)
    classes = sorted({r[2] for r in rows})
    blocks, n = cut_blocks([r[1].encode("utf-8", "replace") for r in rows])
    if not len(blocks):
        return Model(classes or ["und"])
    return fit(blocks, np.repeat([classes.index(r[2]) for r in rows], n), classes)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score: one row for every row of docs."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            at = 0
            while at < len(texts):  # about _LANES blocks or one text at a time
                group, size = [], 0
                while at < len(texts) and (not group or size < _LANES * BLOCK):
                    if _LETTER.search(texts[at]):
                        group.append(at)
                        size += len(texts[at])
                    at += 1
                if not group:
                    continue
                blocks, n = cut_blocks([texts[i].encode("utf-8", "replace") for i in group])
                p, held = model.blocks(blocks)
                first = np.cumsum(n) - n
                p = np.add.reduceat(p, first) / np.maximum(np.add.reduceat(held, first), 1)[:, None]
                for i, row in zip(group, p, strict=True):
                    pred[i], score[i] = model.classes[int(row.argmax())], float(min(1.0, row.max()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, lang_pred string, score double")
