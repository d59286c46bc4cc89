r"""Chat formatting in budgeted windows, in DataFrame functions only.

Template: a turn is `<s>`, its role, a line end, its text, `</s>`, a line end. Inside roles and texts a backslash is
doubled and one is put behind the first character of each control string (`<s>`, `</s>`, `[INST]`, `[/INST]`,
`<<SYS>>`, `<</SYS>>`); in roles a line end becomes `\N`. So no text can open or close a turn, and dropping the backslashes
gives it back.

Windows: prefix sums of turn tokens cut a conversation into spans of `budget` less the system turn less `history`. A turn
that begins in a span and ends beyond it has a window of its own, so only a turn that is too long by itself exceeds the budget. Each window
opens with the system turn (the first turn, if its role is system), repeats the last turns of the window before as far as `history` and the
budget allow, and then has its own turns. Loss is on the texts of its own assistant turns: repeated ones are masked, so each counts once.

Tokens of a formatted turn are its UTF-8 bytes unless `count` names a column of a tokenizer's own counts, which fill windows better: no byte-level
tokenizer makes more tokens than bytes, so a window never holds more than `budget` of them.

Scale. A conversation is dealt out by parts of 2**PART_BITS consecutive turn numbers, in the one shuffle that moves texts: prefix sums, windows and
history are made within a part, to which the last TAIL turn numbers of the part before are sent as well, and its conversation's system turn. So
windows end where parts end. What parts and system turns there are is found from numbers alone. `digests` hashes conversations of one part where they are;
only longer ones come together in one row, as a hash of all of their text is one value.

Cases: null role or text = empty. Null conv_id: one conversation. Turns are ordered by turn (nulls first), role, text; rows that repeat are
turns each. Rows that share a turn number (or have none) are in one part, however many. Empty table: no windows. Other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small

BUDGET = 4096
HISTORY = 1024
TARGET = "assistant"
#: A part of a conversation holds turns that agree but for so many low bits of their number.
PART_BITS = 7
#: Turn numbers at the end of a part that the next part may repeat.
TAIL = 8
_CONTROL = r"([<\[])(?=/?s>|/?INST\]|</?SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\N"))


def unescape_role(role: Column) -> Column:
    plain = lambda p: F.replace(F.replace(p, F.lit("\\N"), F.lit("\n")), F.lit("\\"), F.lit(""))
    return F.array_join(F.transform(F.split(role, r"\\\\"), plain), "\\")


def _some(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _marks(turns: DataFrame) -> DataFrame | None:
    """conv_id, part, first (is it the conversation's?), turn (of its first turn), text and n (of the system turn) of every part of conversations of several parts; None: there are none."""
    parts = turns.groupBy("conv_id", "part").agg(F.min(F.struct("turn", "role")).alias("head"))
    firsts = parts.groupBy("conv_id").agg(F.min(F.struct("part", "head")).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = small(firsts.select(F.col("conv_id").alias("_c"), F.col("first.part").alias("_p"), F.col("first.head").alias("_h")))
    if firsts.isEmpty():
        return None
    same = F.col("conv_id").eqNullSafe(F.col("_c"))
    opening = same & (F.col("part") == F.col("_p")) & F.col("turn").eqNullSafe(F.col("_h.turn")) & (F.col("_h.role") == "system")
    system = turns.where(F.col("role") == "system").join(firsts, opening).groupBy("conv_id").agg(F.min(F.struct("text", "n")).alias("t"))
    system = small(system.select(F.col("conv_id").alias("_s"), "t.*"))
    held = parts.select("conv_id", "part").join(firsts, same).join(system, F.col("conv_id").eqNullSafe(F.col("_s")), "left")
    return held.select("conv_id", "part", (F.col("part") == F.col("_p")).alias("first"), F.col("_h.turn").alias("turn"), "text", "n")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, count: str | None = None) -> DataFrame:
    """conv_id, part, window, lone (has its conversation this part alone?), formatted, n_repeat (leading turns that repeat), n_new, loss (spans from, length in formatted, from 0), n_tokens."""
    counted = F.lit(None) if count is None else F.col(count)
    turns = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), _some("role").alias("role"), _some("text").alias("text"), counted.cast("bigint").alias("n"))
    turns = turns.withColumn("part", F.coalesce(F.shiftright("turn", PART_BITS), F.lit(-(1 << 63))))
    marks = _marks(turns)
    size = 1 << PART_BITS
    to = lambda part, kind: F.struct(part.alias("part"), F.lit(kind).alias("kind"))
    late = F.col("turn").bitwiseAND(F.lit(size - 1)) >= size - TAIL
    targets = F.when(late, F.array(to(F.col("part"), 2), to(F.col("part") + 1, 1))).otherwise(F.array(to(F.col("part"), 2)))
    rows = turns.withColumn("to", F.explode(targets)).withColumns({"part": F.col("to.part"), "kind": F.col("to.kind"), "first": F.lit(None).cast("boolean")})
    rows = rows.select("conv_id", "part", "kind", "first", "turn", "role", "text", "n")
    if marks is not None:
        rows = rows.unionByName(marks.withColumns({"kind": F.lit(0), "role": F.lit("system")}))
    # from here on all is done within (conv_id, part)
    here = Window.partitionBy("conv_id", "part")
    order = here.orderBy("kind", F.col("turn").asc_nulls_first(), "role", "text")
    all_, until = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("marked", F.first("kind").over(all_) == 0)
    if marks is not None:  # the system turn is in every window as such, and not again among the turns of the part before
        opens = F.col("turn").eqNullSafe(F.first("turn").over(all_)) & F.col("text").eqNullSafe(F.first("text").over(all_))
        rows = rows.withColumn("again", F.col("marked") & (F.col("kind") == 1) & (F.col("role") == "system") & opens).where("NOT again")
    rows = rows.withColumn("nth", F.row_number().over(order))
    rows = rows.withColumn("start", F.concat(F.lit("<s>"), escape_role(F.col("role")), F.lit("\n"))).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("piece", F.concat("start", "body", F.lit("</s>\n"))).withColumn("n", F.coalesce("n", F.octet_length("piece"), F.lit(0)).cast("bigint"))
    # a mark comes first; the opening system turn is behind it, or comes first itself; a first part gets no other part's turns
    head_row = F.when(F.col("marked"), F.first("first").over(all_) & (F.col("nth") == 2)).otherwise(F.col("nth") == 1)
    rows = rows.withColumn("system", (F.col("kind") == 2) & (F.col("role") == "system") & head_row)
    rows = rows.withColumn("own", F.when((F.col("kind") == 2) & ~F.col("system"), F.col("n")).otherwise(0)).withColumn("ghost", F.when(F.col("kind") == 1, F.col("n")).otherwise(0))
    rows = rows.withColumn("sys", F.max(F.when(F.col("system") | (F.col("kind") == 0), F.col("n")).otherwise(0)).over(all_))
    rows = rows.withColumn("after", F.sum("own").over(until)).withColumn("before", F.col("after") - F.col("own") + F.sum("ghost").over(until) - F.sum("ghost").over(all_) - F.col("ghost"))
    stride = F.greatest(F.lit(1), F.lit(budget - history) - F.col("sys"))
    span = F.floor(F.col("before") / stride)
    w = F.when(F.col("kind") < 2, F.col("kind") - 2).otherwise(2 * span + (F.col("after") > (span + 1) * stride).cast("bigint")).cast("bigint")
    turn = F.struct("kind", "nth", "system", "before", "piece", (F.col("role") == TARGET).alias("target"), F.length("start").alias("from"), F.length("body").alias("len"), "n")
    each = rows.withColumn("w", w).groupBy("conv_id", "part", "w").agg(
        F.sort_array(F.collect_list(turn)).alias("ts"),
        F.sum("own").alias("own"),
        F.max("sys").alias("sys"),
        F.min(F.when(F.col("system"), 0).otherwise(F.col("before"))).alias("opens"),
        F.bool_and(~F.col("marked")).alias("lone"),
    )
    along = here.orderBy("w")
    each = each.withColumn("past", F.lag("ts").over(along)).withColumn("head", F.first(F.get("ts", F.lit(0))).over(along)).where("w >= 0")
    room = F.greatest(F.lit(0), F.least(F.lit(history), F.lit(budget) - F.col("sys") - F.col("own")))
    each = each.withColumn("reach", F.col("opens") - room)
    none = F.filter("ts", lambda t: F.lit(False))
    opening = F.when(((F.col("head.kind") == 0) & F.col("head.piece").isNotNull() & ~F.get("ts", F.lit(0))["system"]) | (F.col("head.system") & (F.col("w") > 0)), F.array("head")).otherwise(none)
    back = F.coalesce(F.filter("past", lambda t: (t["kind"] > 0) & ~t["system"] & (t["before"] >= F.col("reach"))), none)
    again = lambda ts: F.transform(ts, lambda t: t.withField("kind", F.lit(0)))
    each = each.withColumn("ts", F.concat(again(opening), again(back), F.col("ts")))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<from:bigint,len:bigint>>").alias("spans"))

    def mark(acc, t):
        here = F.array(F.struct((acc["at"] + t["from"]).cast("bigint").alias("from"), t["len"].cast("bigint").alias("len")))
        spans = F.when((t["kind"] == 2) & t["target"], F.concat(acc["spans"], here)).otherwise(acc["spans"])
        return F.struct((acc["at"] + F.length(t["piece"])).cast("bigint").alias("at"), spans.alias("spans"))

    return each.select(
        "conv_id",
        "part",
        F.col("w").alias("window"),
        "lone",
        F.array_join(F.col("ts.piece"), "").alias("formatted"),
        F.size(F.filter("ts", lambda t: t["kind"] < 2)).alias("n_repeat"),
        F.size(F.filter("ts", lambda t: t["kind"] == 2)).alias("n_new"),
        F.aggregate("ts", zero, mark)["spans"].alias("loss"),
        F.aggregate("ts", F.lit(0).cast("bigint"), lambda a, t: a + t["n"]).alias("n_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, part, window, lone, turns (array of role, text: the window's own), targets (texts under the loss mask), n_chars: from formatted, n_repeat and loss alone."""
    pieces = F.split("formatted", "</s>\n")
    own = F.slice(pieces, F.col("n_repeat") + 1, F.greatest(F.lit(0), F.size(pieces) - 1 - F.col("n_repeat")))

    def turn(p):
        role = F.substring_index(p, "\n", 1)
        return F.struct(unescape_role(F.substr(role, F.lit(4))).alias("role"), unescape(F.substr(p, F.length(role) + 2)).alias("text"))

    target = lambda s: unescape(F.substr(F.col("formatted"), (s["from"] + 1).cast("int"), s["len"].cast("int")))
    return formatted.select("conv_id", "part", "window", "lone", F.transform(own, turn).alias("turns"), F.transform("loss", target).alias("targets"), F.length("formatted").cast("bigint").alias("n_chars"))


def digests(back: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of read_back()'s rows."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = back.select("conv_id", "part", "window", "lone", F.size("turns").cast("bigint").alias("n"), said.alias("said"), F.array_join("targets", "").alias("loss"), "n_chars")
    ws = F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("ws")
    parts = rows.groupBy("conv_id", "part").agg(F.bool_and("lone").alias("lone"), F.sum("n").alias("n"), F.sum("n_chars").alias("n_chars"), ws)
    parts = parts.withColumn("said", F.array_join(F.col("ws.said"), "")).withColumn("loss", F.array_join(F.col("ws.loss"), ""))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    # one part: hashed here; several: their texts meet
    last = lambda c: F.when(F.col("lone"), sha(F.col(c))).otherwise(F.col(c)).alias(c)
    parts = parts.select("conv_id", "lone", "n", "n_chars", F.length("loss").cast("bigint").alias("loss_chars"), F.struct("part", last("said"), last("loss")).alias("p"))
    out = parts.groupBy("conv_id").agg(F.bool_and("lone").alias("lone"), F.sum("n").alias("n_turns"), F.sum("loss_chars").alias("loss_chars"), F.sum("n_chars").alias("formatted_chars"), F.sort_array(F.collect_list("p")).alias("ps"))
    whole = lambda c: F.when(F.col("lone"), F.get(F.col(f"ps.{c}"), F.lit(0))).otherwise(sha(F.array_join(F.col(f"ps.{c}"), "")))
    return out.select("conv_id", "n_turns", whole("said").alias("turns_sha256"), "loss_chars", whole("loss").alias("loss_sha256"), "formatted_chars")
