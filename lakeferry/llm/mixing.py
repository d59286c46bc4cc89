"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets.

A document's size is its number of words (runs of anything but space and \\x09-\\x0D). Sources in code-point order,
null last, weigh by `weights` in rotation and share `total` times all words; a target
stops at `most` times its source's size and what it leaves is shared again by
weight. That fixed point is target = min(most * size, level * weight) for one level, which
prefix sums over the sources, in the order in which they are full, give at once. More than RANGE_ROWS sources are
cut into ranges for that; so no task holds all of them.

Each source's documents get a hash-random key. Keys are cut into ranges small enough for one
task each (a source with a third of all rows has a third of all ranges); sums
by range, themselves summed by groups of ranges, then a window inside each range, give every document the words before it in its
source. A budget of b words takes each document b div size-of-source times and, of one further
epoch, what lies before the remainder; the document at the cut counts in part.

Cases: null text = size 0, taken 0. A null source is a source. Null or repeated
doc_ids: every row is mixed on its own; rows that repeat wholly are interchangeable. Empty table: empty
result. Other columns are left out (`plan`) or kept (`mixed`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST = 2
#: Documents in a range of keys.
RANGE_ROWS = 20_000
KEY_BITS = 60
_WORD = r"[^\x20\x09-\x0D]+"


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(_WORD)), F.lit(0)).cast("bigint")


def _key(docs: DataFrame) -> Column:
    """A hash of KEY_BITS bits of the row's id, source and text; a null source isn't an empty one."""
    some = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    source = F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit(""))
    whole = F.concat_ws("/", some("doc_id"), source, F.md5(some("text").cast("binary")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def _before(rows: DataFrame, by: list[Column], **sums: Column) -> DataFrame:
    """rows with the sum of each of `sums` over the rows that come before, in the order of `by`; many rows are cut into ranges first."""
    part = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    here = {c: F.coalesce(F.sum(v).over(part), F.lit(0)) for c, v in sums.items()}
    if rows.count() <= RANGE_ROWS:
        return rows.withColumn("_part", F.lit(0)).withColumns(here).drop("_part")
    rows = cut(rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))
    until = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ahead = rows.groupBy("_part").agg(*[F.sum(v).alias(f"_{c}") for c, v in sums.items()])
    ahead = ahead.select("_part", *[F.coalesce(F.sum(f"_{c}").over(until), F.lit(0)).alias(f"_{c}") for c in sums])
    rows = rows.withColumns(here).join(F.broadcast(ahead), "_part")
    return rows.withColumns({c: F.col(c) + F.col(f"_{c}") for c in sums}).drop("_part", *[f"_{c}" for c in sums])


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """source, source_size, target of (source, source_size): one row for each source."""
    by_name = F.col("source").asc_nulls_last()
    s = _before(sizes, [by_name], nth=F.lit(1))
    w = F.array(*map(F.lit, weights))[(F.col("nth") % len(weights)).cast("int")].cast("double")
    s = cut(s.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    words, weight = s.agg(F.sum("source_size"), F.sum("w")).first()
    if words is None:
        return s.select("source", "source_size", F.col("cap").alias("target"))
    # sources by how soon they are full; the level is that of the first which it leaves room in, the greatest such
    s = _before(s, [F.col("cap") / F.col("w"), by_name], full=F.col("cap"), passed=F.col("w"))
    s = cut(s.withColumn("level", (F.lit(float(words * total)) - F.col("full")) / (F.lit(weight) - F.col("passed"))))
    level = s.agg(F.max(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level")))).first()[0]
    target = F.col("cap") if level is None else F.least("cap", F.lit(level) * F.col("w"))
    return s.select("source", "source_size", target.alias("target"))


def _ranges_before(sums: DataFrame, bits: int) -> DataFrame:
    """source, range, range_before (words of the source's ranges before it) of (source, range, words): sums of sums, as a source may have millions of ranges."""
    sums = sums.withColumn("far", F.shiftright("range", bits // 2))
    until = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    ahead = lambda *by: F.coalesce(F.sum("words").over(until(*by)), F.lit(0))
    fars = sums.groupBy("source", "far").agg(F.sum("words").alias("words")).select(F.col("source").alias("_s"), F.col("far").alias("_f"), ahead("source", "far").alias("far_before"))
    near = sums.withColumn("near_before", ahead("source", "far", "range"))
    near = near.join(small(fars), near["source"].eqNullSafe(F.col("_s")) & (F.col("far") == F.col("_f")))
    return near.select("source", "range", (F.col("far_before") + F.col("near_before")).alias("range_before"))


def plan(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """doc_id, source, key, size, source_size, target, taken: one row for every row of docs."""
    base = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"), _key(docs).alias("key"), size(docs["text"]).alias("size")))
    ranges = base.count() // RANGE_ROWS + 1
    bits = min(40, (ranges - 1).bit_length() + 6)  # ranges of even a lone source come out small
    base = base.withColumn("range", F.shiftright("key", KEY_BITS - bits))
    sums = cut(base.groupBy("source", "range").agg(F.sum("size").alias("words")))
    sources = small(targets(cut(sums.groupBy("source").agg(F.sum("words").alias("source_size"))), weights, total, most))
    sums = _ranges_before(sums, bits)
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    rows = base.where("size > 0").withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(small(sums), same(rows, sums) & (rows["range"] == sums["range"])).select("doc_id", rows["source"], "key", "size", (F.col("before") + F.col("range_before")).alias("before"))
    # rows without words take nothing, and need no place among the others, however often they repeat
    rows = rows.union(base.where("size = 0").select("doc_id", "source", "key", "size", F.lit(0).cast("bigint")))
    rows = rows.join(sources, same(rows, sources)).select("doc_id", rows["source"], "key", "size", "before", "source_size", "target")
    budget, whole = F.floor("target").cast("bigint"), F.greatest("source_size", F.lit(1))
    epochs = F.floor(budget / whole).cast("bigint")
    rest = F.least(F.col("size"), F.greatest(F.lit(0), budget - epochs * whole - F.col("before")))
    return rows.select("doc_id", "source", "key", "size", "source_size", "target", (epochs * F.col("size") + rest).alias("taken"))


def mixed(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """The mix itself, with the columns of docs: each row as often as it is taken, the one at the cut up to it.

    Rows of size 0 have no words to take, and stay out.
    """
    takes = small(plan(docs, weights, total, most).where("taken > 0").select(F.col("key").alias("_k"), F.col("size").alias("_n"), F.col("taken").alias("_t")))
    # rows that repeat id, source and text share a key: number them, by all their columns, that each gets a take of its own
    left = docs.withColumn("_key", _key(docs))
    if takes.groupBy("_k").count().where("count > 1").isEmpty():
        rows = left.join(takes, F.col("_key") == F.col("_k"))
    else:
        left = left.withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(*docs.columns))))
        right = takes.withColumn("_m", F.row_number().over(Window.partitionBy("_k").orderBy(F.desc("_t"))))
        rows = left.join(right, (F.col("_key") == F.col("_k")) & (F.col("_nth") == F.col("_m")))
    copies = F.sequence(F.lit(1), F.ceil(F.col("_t") / F.col("_n")).cast("int"))
    rows = rows.withColumn("_copy", F.explode(copies)).withColumn("_left", F.col("_t") - (F.col("_copy") - 1) * F.col("_n"))
    text = F.when(F.col("_left") >= F.col("_n"), F.col("text")).otherwise(_first_words(F.col("text"), F.col("_left")))
    return rows.withColumn("text", text).select(*docs.columns)


def _first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its nth word; n is at least 1."""
    parts = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{_WORD}"), F.lit(0))
    return F.array_join(F.slice(parts, 1, n.cast("int")), "")
