"""Benchmark decontamination: prefix-filtered set join of item windows with documents.

Words are runs of digits, a-z and anything beyond ASCII, after A-Z are lower-cased. A window is
`width` consecutive words of an item (all of them, if fewer). The join asks where a
window occurs in a document as it stands, word for word:

* order: an item's words are ranked by how often the whole corpus has them;
* prefix: containment of a whole window needs every word of it, so one word is prefix
  enough; a window's rarest word is its anchor. Neighbouring windows mostly share
  an anchor, so an item has about one for every few words;
* length and position: an anchor at word d of a document can only belong to windows
  that begin at 0 or later and end within the document, and a word next to the
  anchor has to agree with the item's;
* verification compares the document's words at the window's place with the window.

Only DataFrame functions are used. The benchmark side is broadcast if Spark's own
count of it (made here, not an estimate) is at most BROADCAST_ROWS rows and BROADCAST_BYTES bytes, and
joined by a shuffle otherwise.

Cases: a null text has no words (n_words 0, not contaminated); item rows with
null text or no words have no windows. Items with a null id mark words and count as one
item, listed as an empty string; rows that repeat an item_id are one item. Repeated or null doc_ids: each row
gets its own text's result. Empty tables work. Other columns are left out (`scan`) or kept (`clean`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut, small

WIDTH = 10
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
#: Between words, in a text whose A-Z may still be upper case.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _split(text: Column) -> Column:
    """Words, with an empty one before or after if the text begins or ends with a gap."""
    return F.split(F.coalesce(text, F.lit("")), _GAP)


def _count(parts: Column) -> Column:
    n = F.size(parts)
    ends = (parts[0] == "").cast("int") + ((n > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return (n - ends).cast("bigint")


def _fits(df: DataFrame, size: Column) -> bool:
    n, b = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= BROADCAST_ROWS and b + 64 * n <= BROADCAST_BYTES


def anchors(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, bool]:
    """(word, before, after, item, wins) of each anchor of each item, and whether that may be broadcast.

    wins: the anchor's windows as (off: the anchor's place in the window from 0, n, txt).
    """
    words = F.filter(_split(ascii_lower(F.col("text").cast("string"))), lambda w: w != "")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("ws")).where(F.size("ws") > 0).distinct()
    items = cut(items.withColumn("item_row", F.xxhash64("item", "ws")))
    vocabulary = items.select(F.explode("ws").alias("w")).select(F.lower("w").alias("word")).distinct()
    known = _fits(vocabulary, F.octet_length("word"))
    # outer: a plain explode makes Spark split every text a second time, in a filter of its own
    held = docs.select(F.explode_outer(_split(F.col("text").cast("string"))).alias("w")).select(F.lower("w").alias("word"))
    if known:
        counts = held.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))
    else:  # words are counted where they are before any is moved
        counts = held.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word")
    place = items.select("item_row", "item", F.size("ws").alias("size"), F.posexplode("ws").alias("at", "w")).withColumn("word", F.lower("w"))
    # a word that no document has rules all its windows out, and is the rarest of all
    place = place.join(cut(counts), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    along = Window.partitionBy("item_row").orderBy("at")
    side = lambda f: F.coalesce(f("word").over(along), F.lit(""))
    place = place.withColumn("before", side(F.lag)).withColumn("after", side(F.lead))
    # each row begins a window: `width` words on, or all of a shorter item
    window = along.rowsBetween(0, width - 1)
    place = place.withColumn("rare", F.min(F.struct("n", "word", "at", "before", "after")).over(window)).withColumn("txt", F.array_join(F.collect_list("w").over(window), " "))
    n = F.least(F.col("size"), F.lit(width))
    windows = place.where((F.col("at") <= F.col("size") - n) & (F.col("rare.n") > 0))
    win = F.struct((F.col("rare.at") - F.col("at")).alias("off"), n.alias("n"), "txt")
    key = [F.col(f"rare.{c}").alias(c) for c in ("word", "before", "after", "at")]
    found = windows.select("item_row", "item", *key, win.alias("win")).groupBy("item_row", "item", "word", "before", "after", "at").agg(F.collect_set("win").alias("wins"))
    found = found.withColumn("alone", F.exists("wins", lambda x: x["n"] == 1))
    found = cut(found.drop("item_row", "at"))
    return found, _fits(found, F.octet_length(F.col("wins").cast("string")))


def occurrences(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, h (its text's hash), item, start, n of each place of a document where a window of an item occurs."""
    found, fits = anchors(docs, benchmark, width)
    text = F.col("text").cast("string")
    ws = docs.select(F.col("doc_id"), F.xxhash64(text).alias("h"), _split(text).alias("ws"))
    at = ws.select("doc_id", "h", "ws", F.posexplode_outer("ws").alias("d", "w"))
    next_to = lambda k: F.lower(F.get(F.col("ws"), F.col("d") + k))
    # nothing but what codegen covers may stand between here and the join: rows that carry `ws` must not be copied
    cols = ["doc_id", "h", "d", F.lower("w").alias("word"), next_to(-1).alias("left"), next_to(1).alias("right")]
    beside = F.col("alone") | (F.col("before") == F.col("left")) | (F.col("after") == F.col("right"))
    meets = (F.col("word") == F.col("anchor")) & beside
    if fits:
        near = at.select(*cols, "ws").join(F.broadcast(found).withColumnRenamed("word", "anchor"), meets)
    else:  # places are moved without texts, and texts only to the places where an anchor is
        words = found.select(F.col("word").alias("anchor")).distinct()
        places = at.select(*cols)
        if _fits(words, F.octet_length("anchor")):
            places = places.join(F.broadcast(words), F.col("word") == F.col("anchor"), "left_semi")
        near = places.join(found.withColumnRenamed("word", "anchor"), meets).select("doc_id", "h", "d", "item", "wins")
        near, same = cut(near), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h"))
        wanted = small(near.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).distinct())
        texts = ws.join(wanted, same, "left_semi").dropDuplicates(["doc_id", "h"]).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "ws")
        near = near.join(texts, same)
    # the words that a window around d can hold, and the place of the first of them
    first = F.greatest(F.col("d") - (width - 1), F.lit(0))
    near = near.select("doc_id", "h", "d", "item", "wins", F.slice("ws", first + 1, 2 * width - 1).alias("near"), first.alias("first"))
    each = near.select("doc_id", "h", "d", "item", "near", "first", F.explode("wins").alias("win"))
    each = each.withColumn("start", F.col("d") - F.col("win.off")).withColumn("from", F.col("start") - F.col("first"))
    inside = (F.col("from") >= 0) & (F.col("from") + F.col("win.n") <= F.size("near"))
    same = ascii_lower(F.array_join(F.slice("near", F.when(inside, F.col("from") + 1).otherwise(1), F.col("win.n")), " ")) == F.col("win.txt")
    return each.where(inside & same).select("doc_id", "h", "item", F.col("start").cast("bigint").alias("start"), F.col("win.n").cast("bigint").alias("n"))


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (array), contaminated: one row for every row of docs."""
    places = cut(occurrences(docs, benchmark, width).distinct())
    key = ["doc_id", "h"]
    until = Window.partitionBy(*key).orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    spans = places.select(*key, "start", "n").distinct().withColumn("done", F.coalesce(F.max(F.col("start") + F.col("n")).over(until), F.lit(0)))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("n") - F.greatest("start", "done"))
    hit = spans.groupBy(*key).agg(F.sum(fresh).alias("n_hit"))
    items = places.select(*key, "item").distinct().groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items"))
    both = hit.join(items, (hit["doc_id"].eqNullSafe(items["doc_id"])) & (hit["h"] == items["h"])).select(hit["doc_id"].alias("_d"), hit["h"].alias("_h"), "n_hit", "items")
    text = F.col("text").cast("string")
    all_ = docs.select("doc_id", F.xxhash64(text).alias("h"), _count(_split(text)).alias("n_words"))
    out = all_.join(both, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), items.alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of docs, with all their columns, in which no window occurs."""
    dirty = small(occurrences(docs, benchmark, width).select(F.col("doc_id").alias("_dirty"), F.col("h").alias("_dirty_h")).distinct())
    return docs.join(dirty, docs["doc_id"].eqNullSafe(dirty["_dirty"]) & (F.xxhash64(docs["text"].cast("string")) == dirty["_dirty_h"]), "left_anti")
