"""Canonical length-limited Huffman coding of token ids, in numpy.

Code lengths come from package-merge; codes of one length are consecutive, by id. Bits are packed most
significant first. An independent block is a payload and the bit offsets of every CHECK-th id; decoding looks
up LIMIT bits at a time in a table, all checkpoints of a block in step.
"""

from __future__ import annotations

import numpy as np

LIMIT = 20
CHECK = 256


def lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each id (0: never used) of least total size, at most limit (uint8)."""
    counts = np.asarray(counts, np.int64)
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts > 0)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order]
    packs, levels = np.zeros(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate((leaf, packs))
        at = np.argsort(both, kind="stable")
        levels.append(at < len(leaf))
        both = both[at]
        packs = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(leaf) - 2
    n = np.zeros(len(leaf), np.int64)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        n[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = n
    return out


def codes(length: np.ndarray) -> np.ndarray:
    """Canonical code of each id (uint64)."""
    order = np.lexsort((np.arange(len(length)), length))
    order = order[length[order] > 0]
    out = np.zeros(len(length), np.uint64)
    if len(order):
        n = length[order].astype(np.int64)
        # Kraft sums, at the longest length, of all codes before
        step = np.int64(1) << (n[-1] - n)
        out[order] = ((np.cumsum(step) - step) >> (n[-1] - n)).astype(np.uint64)
    return out


def encode(ids: np.ndarray, length: np.ndarray, code: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Payload, and bit offset of every CHECK-th id (int64)."""
    n = length[ids].astype(np.int64)
    if len(n) and not n.min():
        raise ValueError("an id has no code")
    off = np.cumsum(n) - n
    if not len(n):
        return b"", off
    words = np.zeros(int(off[-1] + n[-1]) // 64 + 2, np.uint64)
    word, room = off >> 6, 64 - (off & 63) - n
    c = code[ids]
    up = c << np.maximum(room, 0).astype(np.uint64) >> np.maximum(-room, 0).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[first]] = np.bitwise_or.reduceat(up, first)
    over = np.flatnonzero(room < 0)
    words[word[over] + 1] |= c[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: (int(off[-1] + n[-1]) + 7) // 8], off[::CHECK]


def table(length: np.ndarray, code: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """id << 8 | length, by the next `limit` bits."""
    out = np.zeros(1 << limit, np.uint32)
    used = np.flatnonzero(length)
    used = used[np.lexsort((used, length[used]))]
    if len(used):
        span = np.int64(1) << (limit - length[used].astype(np.int64))
        filled = np.repeat(used.astype(np.uint32) << 8 | length[used], span)
        out[: len(filled)] = filled
    return out


def decode(payload: bytes, n: int, checks: np.ndarray, lookup: np.ndarray) -> np.ndarray:
    """The n ids of a block (uint32)."""
    if not n:
        return np.zeros(0, np.uint32)
    bits = (len(lookup) - 1).bit_length()
    words = np.frombuffer(payload + bytes(16 + -len(payload) % 8), ">u8").astype(np.uint64)
    at = np.array(checks, np.int64)
    out = np.empty((len(at), CHECK), np.uint32)
    for step in range(CHECK):
        if step == n - (len(at) - 1) * CHECK:
            at = at[:-1]  # the last stretch may be shorter
            if not len(at):
                break
        w, k = at >> 6, (at & 63).astype(np.uint64)
        seen = words[w] << k | words[w + 1] >> np.uint64(1) >> (np.uint64(63) - k)
        hit = lookup[(seen >> np.uint64(64 - bits)).astype(np.int64)]
        out[: len(at), step] = hit >> 8
        at = at + (hit & 255)
    return out.reshape(-1)[:n]
