"""Classes of rows: connected components of links, and the row of each class that stays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, small


def _of_few(edges: DataFrame) -> DataFrame:
    """`components` of as many edges as may go to the driver, by union and find: no round of shuffles, whose files outlast it."""
    import numpy as np
    import pyarrow as pa

    u, v = (np.asarray(c, np.int64) for c in edges.select("u", "v").toArrow().columns)
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    up = list(range(len(nodes)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in zip(ends[: len(u)].tolist(), ends[len(u) :].tolist(), strict=True):
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    roots = nodes[np.array([top(x) for x in range(len(nodes))], np.int64)]
    other = nodes != roots
    found = pa.table({"node": nodes[other], "root": roots[other]})
    return edges.sparkSession.createDataFrame(found, "node bigint, root bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node of the edges (u, v) but the roots themselves."""
    sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now, was = cut(sides), None
    if now.count() <= BROADCAST_ROWS:
        return _of_few(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = cut(small.where("u <> v").distinct())
        is_ = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if is_ == was:
            break
        was = is_
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def keep_first(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Of each root of rows (doc_id, h: the text's hash, root), docs' row that is first by doc_id (null last) and h, with all its columns.

    Of rows that repeat both doc_id and text, one stays: the least by text and the other columns.
    """
    known = cut(rows.groupBy("root", "doc_id", "h").agg(F.count("*").alias("n")))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = known.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("k"), F.max("n").alias("most"))
    first = small(first.where("k > 1 OR most > 1").select("root", "first"))
    ids = known.join(first, "root").withColumn("stays", place.eqNullSafe(F.col("first"))).where("n > 1 OR NOT stays")
    ids = cut(ids.select("stays", "n", F.col("doc_id").alias("_keep"), F.col("h").alias("_keep_h")))
    h = F.xxhash64(F.col("text").cast("string"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_keep")) & (h == F.col("_keep_h"))
    left = docs.join(small(ids.where("NOT stays").select("_keep", "_keep_h")), same, "left_anti")
    again = small(ids.where("stays AND n > 1").select("_keep", "_keep_h"))
    if again.isEmpty():
        return left
    twice, once = left.join(again, same, "left_semi"), left.join(again, same, "left_anti")
    row = F.struct(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    one = twice.groupBy(F.col("doc_id").cast("bigint"), h).agg(F.min(row).alias("_r"))
    return once.union(one.select(*[F.col("_r")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)]))
