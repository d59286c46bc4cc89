"""Near copies by the Jaccard similarity of word shingles, without approximation.

A text's words are simhash's; its shingles are all runs of WIDTH words (all of its words, if fewer), as a set of 64-bit hashes. Two sets
link if they share SIMILAR of their union at least; classes are connected components. Texts without words are copies of each other.

Seen as bits, one for every hash there could be, sets differ by a Hamming distance, and 0.8 of the union bounds it by a ninth of both
sizes. That is what the stages below discard by:

* keys: in one order of all shingles, two sets that link share one among their first n - ceil(0.8 n) + 1. Only such prefixes (a fifth of the
  shingles) are shuffled, as numbers; sizes, and what is left after the first shingle shared, discard pairs. The order is by hash, but shingles that
  more than DIRECT prefixes hold come last (at most COMMON of them; any order is complete), so that a line in many documents is in few prefixes;
* pivot tables: a set's distances to reference vectors, each the run of all hashes with the same first bits. References don't overlap, so the
  distances' differences may be added up and still bound the distance from below. A table is an eighth of its set or less, and a pair with too
  great a sum goes;
* the exact similarity decides on the survivors, the only ones whose whole sets are moved.

Equal sets become one first. The sets of a shingle in more than DIRECT prefixes even so, as in crowds of near copies, get prefixes of their own, in
the order of how many of them hold a shingle: what an edited copy has alone comes first, and the place of the first shingle shared discards most
pairs that don't link. Crowds that are left are compared with HUBS of their sets (the one with the least of its own, and others); what this connects
needs no more pairs, so the rest is compared only across components, all but the largest with all. That last step grows with the square of a
crowd only if most of its sets nearly link, and to no common one.

What simhash's fingerprints have found comes first, as `near`: no pair within a class of these is looked at again.

Cases: as groups.keep_first. Null text = empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small, trim
from .groups import components

WIDTH = 5
#: Numerator and denominator of the least similarity.
SIMILAR = (4, 5)
#: Sets under one shingle that are still paired directly.
DIRECT = 64
HUBS = 4
COMMON = 1_000_000
_MIX = 0x9E3779B97F4A7C15


def shingles(text: str | None, width: int = WIDTH):
    """Distinct hashes of one text's shingles, in order."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    of_word = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(width, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ of_word[i : i + n]) * np.uint64(_MIX)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def hashes(docs: DataFrame, digest) -> DataFrame:
    """doc_id, h (the text's hash), g (the set's), fp (its fingerprint by digest) of every row."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            g, fp = [], []
            for t in batch.column(2):
                s = shingles(t.as_py())
                g.append(xxhash.xxh64_intdigest(s.tobytes()))
                fp.append(digest(s))
            g, fp = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in (g, fp))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), g, fp], ["doc_id", "h", "g", "fp"])
        trim()

    return _texts(docs).mapInArrow(run, "doc_id bigint, h bigint, g bigint, fp bigint")


def distinct(rows: DataFrame) -> DataFrame:
    """Of `hashes`, one row of each set: g, doc_id, h, fp."""
    return cut(rows.groupBy("g").agg(F.min(F.struct("doc_id", "h", "fp")).alias("r")).select("g", "r.*"))


def prefixes(texts: DataFrame, common=None) -> DataFrame:
    """g, n (the set's size), keys (its first shingles; last come those whose upper half is common) of every row of texts."""
    last = texts.sparkSession.sparkContext.broadcast(common)
    num, den = SIMILAR

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        late = last.value
        for batch in batches:
            g, n, keys = [], [], []
            for t in batch.column(2):
                s = shingles(t.as_py())
                g.append(xxhash.xxh64_intdigest(s.tobytes()))
                n.append(len(s))
                if late is not None and len(s):
                    top = s >> np.uint64(32)
                    is_late = late[np.minimum(np.searchsorted(late, top), len(late) - 1)] == top
                    s = np.concatenate((s[~is_late], s[is_late]))
                keys.append(s[: len(s) - -(-num * len(s) // den) + 1].view(np.int64) if len(s) else s.view(np.int64))
            at = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(g, np.uint64).view(np.int64)), pa.array(n, pa.int32()), lists], ["g", "n", "keys"])
        trim()

    return texts.mapInArrow(run, "g bigint, n int, keys array<bigint>")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def pivot_table(s) -> bytes:
    """How many of a set's hashes begin with each run of bits; about as many runs as half the hashes."""
    import numpy as np

    bits = max(0, (len(s) - 1).bit_length() - 1)
    held = np.bincount((s >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64), minlength=1 << bits)
    return b"" if held.max(initial=0) > 255 else held.astype(np.uint8).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """A lower bound, by their pivot tables, of how many hashes are in one of two sets alone."""
    import numpy as np

    if not a or not b:
        return 0
    x, y = np.frombuffer(a, np.uint8).astype(np.int32), np.frombuffer(b, np.uint8).astype(np.int32)
    while len(x) > len(y):
        x = x.reshape(-1, 2).sum(1)
    while len(y) > len(x):
        y = y.reshape(-1, 2).sum(1)
    return int(np.abs(x - y).sum())


def _of(docs: DataFrame, wanted: DataFrame, kind: str) -> DataFrame:
    """g, n (the set's size), s (bigints: the whole set, binary: its pivot table) of the rows (doc_id, h, g) wanted."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            s = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())) if kind != "binary" else pa.array([pivot_table(x) for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int32()), s], ["g", "n", "s"])
        trim()

    w = small(wanted.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "g"))
    rows = _texts(docs).join(w, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")))
    return cut(rows.select("g", "text").mapInArrow(run, f"g bigint, n int, s {kind}").dropDuplicates(["g"]))


def _ends(docs: DataFrame, reps: DataFrame, pairs: DataFrame, kind: str) -> DataFrame:
    """The pairs (u, v) with n and s of both: nu, nv, a, b."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("g")).distinct()
    sets = _of(docs, reps.join(ends, "g", "left_semi"), kind)
    left, right = (sets.select(F.col("g").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(y)) for x, y in (("u", "a"), ("v", "b")))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "nu", "nv", "a", "b")


def linked(docs: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets link."""
    num, den = SIMILAR

    def near(batches):
        import pyarrow as pa

        for batch in batches:
            _, _, nu, nv, a, b = (c.to_pylist() for c in batch.columns)
            keep = [(num + den) * apart(x, y) <= (den - num) * (i + j) for i, j, x, y in zip(nu, nv, a, b, strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    pairs = cut(pairs.distinct())
    close = cut(_ends(docs, reps, pairs, "binary").mapInArrow(near, "u bigint, v bigint"))
    both = _ends(docs, reps, close, "array<bigint>")
    shared = F.size(F.array_intersect("a", "b"))
    return cut(both.where((num + den) * shared >= num * (F.col("nu") + F.col("nv"))).select("u", "v"))


def _pairs(left: DataFrame, right: DataFrame, also) -> DataFrame:
    """(u, v) of sets that share a key, are in no class together yet and may link, by their sizes and what follows the key in both."""
    num, den = SIMILAR
    a, b = left.alias("a"), right.alias("b")
    size = den * F.least("a.n", "b.n") >= num * F.greatest("a.n", "b.n")
    rest = (num + den) * F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) >= num * (F.col("a.n") + F.col("b.n"))
    return a.join(b, (F.col("a.key") == F.col("b.key")) & also & (F.col("a.root") != F.col("b.root")) & size & rest).select(F.least("a.g", "b.g").alias("u"), F.greatest("a.g", "b.g").alias("v"))


def _rooted(keyed: DataFrame, roots: DataFrame) -> DataFrame:
    """keyed with root, the class of g as far as it is known."""
    return keyed.join(roots.withColumnRenamed("node", "g"), "g", "left").withColumn("root", F.coalesce("root", "g"))


def links(docs: DataFrame, rows: DataFrame, reps: DataFrame, near: DataFrame) -> DataFrame:
    """Pairs (u, v) of g that link, those of near among them: not all, but enough to connect the same."""
    import numpy as np

    copies = rows.join(reps.select("g", F.struct("doc_id", "h").alias("r")), "g").where(~F.struct("doc_id", "h").eqNullSafe(F.col("r")))
    copies = small(copies.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).distinct())
    texts = _texts(docs).join(copies, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left_anti")
    # half a shingle's hash tells enough of what is common: any order that depends on the shingle alone is complete
    tops = prefixes(texts).select(F.explode("keys").alias("key")).select(F.shiftright("key", 32).cast("int").alias("top"))
    often = tops.groupBy("top").agg(F.count("*").alias("c")).where(F.col("c") > DIRECT).orderBy(F.desc("c"), "top").limit(COMMON).toArrow()
    common = np.sort(np.asarray(often["top"]).view(np.uint32).astype(np.uint64)) if often.num_rows else None
    keyed = prefixes(texts, common).select("g", "n", F.posexplode("keys").alias("pos", "key"))
    roots = small(components(near))
    keyed = cut(_rooted(keyed.withColumn("c", F.count("*").over(Window.partitionBy("key"))).where("c > 1"), roots))
    few = keyed.where(F.col("c") <= DIRECT)
    direct = _pairs(few, few, F.col("a.g") < F.col("b.g"))
    crowded = cut(keyed.where(F.col("c") > DIRECT).select("g").distinct())
    if crowded.isEmpty():
        return near.union(linked(docs, reps, direct))
    return _crowds(docs, reps, direct, _of(docs, reps.join(crowded, "g", "left_semi"), "array<bigint>"), near, roots)


def _crowds(docs: DataFrame, reps: DataFrame, direct: DataFrame, sets: DataFrame, near: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) of near (their classes: roots), those of direct that link, and of the sets (g, n, s) as many as connect them."""
    again = _by_rarity(sets)
    counts = cut(again.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    again = cut(_rooted(again.join(small(counts), "key"), roots))
    few, packed = again.where(F.col("c") <= DIRECT), again.where(F.col("c") > DIRECT).drop("c")
    # the fewer rarer shingles a set has before the key, the more sets are like it
    firsts = [F.min_by(F.struct("g", "n", "pos", "root"), x) for x in (F.struct("pos", "g"), *[F.xxhash64("g", F.lit(i)) for i in range(1, HUBS)])]
    hubs = packed.groupBy("key").agg(F.array_distinct(F.array(*firsts)).alias("hubs")).select("key", F.explode("hubs").alias("hub")).select("key", "hub.*")
    pairs = direct.union(_pairs(few, few, F.col("a.g") < F.col("b.g"))).union(_pairs(packed, small(hubs), F.col("a.g") != F.col("b.g")))
    found = near.union(linked(docs, reps, pairs))
    of = cut(_rooted(packed.drop("root"), components(found)))
    sizes = of.groupBy("key", "root").agg(F.count("*").alias("k"))
    most = cut(sizes.groupBy("key").agg(F.max_by("root", F.struct("k", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1"))
    outside = of.join(small(most), "key").where("root <> most").select(*of.columns)
    rest = _pairs(outside, of, F.col("a.root") != F.col("b.root"))
    return found.union(linked(docs, reps, rest))


def _by_rarity(sets: DataFrame) -> DataFrame:
    """g, n, pos, key: prefixes of the sets (g, n, s) in the order of how many of them hold a shingle, as far as COMMON counts go."""
    import numpy as np

    num, den = SIMILAR
    often = sets.select(F.explode("s").alias("key")).groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > DIRECT)
    often = often.orderBy(F.desc("c"), "key").limit(COMMON).toArrow()
    common = np.asarray(often["key"], np.int64) if often.num_rows else np.zeros(1, np.int64)
    order = np.argsort(common)
    listed = sets.sparkSession.sparkContext.broadcast((common[order], (len(common) - order) * bool(often.num_rows)))

    def run(batches):
        import pyarrow as pa

        common, rank = listed.value
        for batch in batches:
            keys = []
            for s in batch.column(2):
                s = np.asarray(s.values, np.int64)
                at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                s = s[np.lexsort((s, np.where(common[at] == s, rank[at], 0)))]
                keys.append(s[: len(s) - -(-num * len(s) // den) + 1] if len(s) else s)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], ["g", "n", "keys"])

    return sets.select("g", "n", "s").mapInArrow(run, "g bigint, n int, keys array<bigint>").select("g", "n", F.posexplode("keys").alias("pos", "key"))


def classes(docs: DataFrame, rows: DataFrame, reps: DataFrame, near: DataFrame) -> DataFrame:
    """doc_id, h (the text's hash), root (the class) of every row; rows, reps: `hashes` of docs and their `distinct` sets; near: pairs known to link."""
    edges = links(docs, rows, reps, near)
    of = rows.select("doc_id", "h", "g").join(components(edges), F.col("g") == F.col("node"), "left")
    return of.select("doc_id", "h", F.coalesce("root", "g").alias("root"))
