"""SimHash near-duplicates by pivot distance tables.

A text's A-Z are lower-cased; its words are runs of anything but space and
\\x09-\\x0D; its shingles are all runs of `width` words joined by a space (all of
its words, if fewer). Bit b of the fingerprint is set if it is set in more than
half of the shingles' XXH64 (seed 42). No words: fingerprint 0, which links like any
other. Two fingerprints link at `max_bits` differing bits or fewer; classes are
connected components, named by their smallest doc_id.

Scale. Rows of equal fingerprint become one first (partial aggregation), so a
group of copies of any size counts once. Each remaining fingerprint gets its
Hamming distances to PIVOTS random references: by the triangle inequality a pair
whose distances to some pivot differ by more than `max_bits` can't link. Which
pairs are compared at all comes from bands: of BANDS blocks of bits, `max_bits`
differences leave BANDS - max_bits blocks equal, so every link shares a key made
of that many blocks (pivot coordinates of random fingerprints lie too close
together to serve as keys: a window of 3 on one coordinate holds half of all).
Keys that many fingerprints share are joined by a longer key: the same rule
once more within the bits that the key leaves open. Where even that key is shared by more than CROWD,
links are drawn without pairs: a pair within `max_bits` has some code within half of them (rounded down) of the one and the rest of the
other, so all around a code link to the smallest that is within that half; a fingerprint costs as many rows as there are
codes around it, however many are near. Components are found by
alternating large and small stars, each written to the shared folder.

Cases: null text = empty. Null doc_id: the row is kept and linked; the class's name is
its smallest non-null doc_id, null if it has none. Repeated rows come out repeated.
An empty table gives an empty result. Other columns are left out (by `fingerprints`,
`classes`) or kept (by `one_of_each`).
"""

from __future__ import annotations

import random
from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import cut, prepare
from .groups import components, keep_first

PIVOTS = 16
BANDS = 5
#: Fingerprints under one key that are still joined directly.
DIRECT = 64
#: Fingerprints under one longer key that are still paired.
CROWD = 256
_SEED = 42
_SLICE = 1 << 16


def _ones(hashes):
    """How many of some 64-bit hashes set each bit."""
    import numpy as np

    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _majority(ones, n: int) -> int:
    import numpy as np

    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def digest(hashes) -> int:
    """Unsigned 64-bit fingerprint of an array of shingles' hashes. None: 0."""
    return _majority(sum(_ones(hashes[i : i + _SLICE]) for i in range(0, len(hashes), _SLICE)), len(hashes)) if len(hashes) else 0


def fingerprint(text: str | None, width: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    buf = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    last = end[min(width, len(words)) - 1 :]
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _SLICE):
        s, e = start[i : min(n, i + _SLICE)].tolist(), last[i : min(n, i + _SLICE)].tolist()
        ones += _ones(np.fromiter((h(buf[a:b], _SEED) for a, b in zip(s, e, strict=True)), "<u8", len(s)))
    return _majority(ones, n)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fp (bigint: the 64 bits) of every row."""
    prepare(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = pa.array(np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], "<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, fp bigint")


def _blocks(bits: list[int], n: int) -> list[int]:
    """Masks of n runs of bits, as even as they go."""
    at = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(at, at[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(mask_free: list[int], n: int, same: int) -> list[int]:
    """Masks of every `same` of n blocks over the given bits."""
    return [sum(c) for c in combinations(_blocks(mask_free, n), same)]


def pivots(n: int = PIVOTS) -> list[int]:
    r = random.Random(_SEED)
    return [_signed(r.getrandbits(64)) for _ in range(n)]


def _pivot_table(fp: Column) -> Column:
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("tinyint") for p in pivots()])


def _near(max_bits: int) -> Column:
    """Of a joined pair: no pivot tells the two apart, and they do differ by few bits."""
    apart = F.greatest(*[F.abs(F.col("a.pd")[i] - F.col("b.pd")[i]) for i in range(PIVOTS)])
    return (apart <= max_bits) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (u, v), u < v, of the distinct column fp that differ by max_bits or fewer, each once.

    Of crowds, not all pairs, but enough of them to connect the same fingerprints.
    """
    level1 = _keys(list(range(64)), BANDS, BANDS - max_bits)
    fps = distinct.select("fp", _pivot_table(F.col("fp")).alias("pd"))
    key = lambda masks: F.explode(F.array(*[F.struct(F.lit(i).cast("smallint").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)]))
    keyed = fps.select("fp", "pd", key(level1).alias("key")).select("fp", "pd", "key.*")
    crowd = cut(keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    shared = keyed.join(crowd, ["t", "k"])
    few = shared.where(F.col("n") <= DIRECT)
    found = [_pairs(few, ["t", "k"], max_bits)]
    if not crowd.where(F.col("n") > DIRECT).isEmpty():
        # within a key, split what it leaves open: of 2 * max_bits blocks, half at least are equal
        many, parts = shared.where(F.col("n") > DIRECT), []
        for i, m in enumerate(level1):
            free = [b for b in range(64) if not m >> b & 1]
            sub = _keys(free, 2 * max_bits, max_bits)
            parts.append(F.when(F.col("t") == i, F.array(*[F.struct(F.lit(j).cast("smallint").alias("s"), F.col("fp").bitwiseAND(F.lit(_signed(m | x))).alias("q")) for j, x in enumerate(sub)])))
        finer = many.select("fp", "pd", "t", F.explode(F.coalesce(*parts)).alias("key")).select("fp", "pd", "t", "key.*")
        by = ["t", "s", "q"]
        dense = cut(finer.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > CROWD).drop("n"))
        if not dense.isEmpty():
            found.append(_stars(finer.join(dense, by, "left_semi").select("fp").distinct(), max_bits))
            finer = finer.join(dense, by, "left_anti")
        found.append(_pairs(finer, by, max_bits))
    return reduce(DataFrame.union, found).distinct()


def _pairs(keyed: DataFrame, by: list[str], max_bits: int) -> DataFrame:
    a, b = keyed.alias("a"), keyed.alias("b")
    same = reduce(Column.__and__, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in by])
    return a.join(b, same & (F.col("a.fp") < F.col("b.fp")) & _near(max_bits)).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def _stars(fps: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (u, v) of distinct fps within max_bits that connect all such pairs: around each code, all with one."""
    half = max_bits // 2
    flips = [_signed(sum(1 << b for b in c)) for n in range(max_bits - half + 1) for c in combinations(range(64), n)]
    close = sum(comb(64, n) for n in range(half + 1))  # the first of the flips change at most half
    masks = F.split(F.lit(",".join(map(str, flips))), ",").cast("array<bigint>")
    around = fps.select("fp", F.posexplode(masks).alias("i", "mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("code"), (F.col("i") < close).alias("close"))
    hubs = around.where("close").groupBy("code").agg(F.min("fp").alias("hub"))
    return around.join(hubs, "code").where("fp <> hub").select(F.least("fp", "hub").alias("u"), F.greatest("fp", "hub").alias("v")).distinct()


def classes(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp (bigint), component_id: one row for every row of docs."""
    fps = cut(fingerprints(docs, width))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = components(links(distinct, max_bits))
    rooted = distinct.join(comp, distinct["fp"] == comp["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(named, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def reached(sets: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (u, v), u < v, of the g of sets (g, fp): all with the first of their fingerprint's, and the firsts of linked fingerprints."""
    firsts = cut(sets.groupBy("fp").agg(F.min("g").alias("first")))
    same = sets.join(firsts, "fp").where("g <> first").select(F.col("first").alias("u"), F.col("g").alias("v"))
    of = [firsts.select(F.col("fp").alias(x), F.col("first").alias(f"g{x}")) for x in ("u", "v")]
    near = links(firsts.select("fp"), max_bits).join(of[0], "u").join(of[1], "v")
    return same.union(near.select(F.least("gu", "gv").alias("u"), F.greatest("gu", "gv").alias("v")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that come first in their class of near copies: see groups.keep_first.

    Fingerprints of five-word shingles bring up pairs as in `classes`: bands, pivot tables, the exact number of bits. The exact similarity
    decides on these. 3 of 64 bits reach few texts of a similarity of 0.8 and many more bits no band does, so `shingles` looks
    across the classes found so far for what the fingerprints can't tell: the result is that of all pairs' exact similarity.
    """
    prepare(docs.sparkSession)
    rows = cut(shingles.hashes(docs, digest))
    sets = shingles.distinct(rows)
    near = shingles.linked(docs, sets, reached(sets))
    return keep_first(docs, shingles.classes(docs, rows, sets, near))
