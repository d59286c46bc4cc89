"""Predicates as remote SQL text, and the rest that has to stay local.

A predicate is a small tree; `encode` gives a WHERE text for what the remote server can evaluate with the same result, and the
conjuncts that it can't. Both together are the predicate: `column()` of the rest goes on top of the scan, so a
conjunct counts once, and none is lost.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.literals import like_escape, literal, quote

#: Nesting beyond which nothing is encoded.
DEPTH = 100
COMPARE = {"=": lambda a, b: a == b, "<>": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b}
#: Functions with a remote counterpart, as template and local function. Lengths, division, date arithmetic and weekdays mean something else over there.
FUNCTIONS = {
    "lower": ("LOWER({0})", F.lower),
    "upper": ("UPPER({0})", F.upper),
    "trim": ("LTRIM(RTRIM({0}))", F.trim),
    "ltrim": ("LTRIM({0})", F.ltrim),
    "rtrim": ("RTRIM({0})", F.rtrim),
    "year": ("YEAR({0})", F.year),
    "month": ("MONTH({0})", F.month),
    "day": ("DAY({0})", F.dayofmonth),
    "hour": ("DATEPART(HOUR, {0})", F.hour),
    "minute": ("DATEPART(MINUTE, {0})", F.minute),
    "second": ("DATEPART(SECOND, {0})", F.second),
    "+": ("({0} + {1})", lambda a, b: a + b),
    "-": ("({0} - {1})", lambda a, b: a - b),
    "*": ("({0} * {1})", lambda a, b: a * b),
    "%": ("({0} % {1})", lambda a, b: a % b),
    "negate": ("(-{0})", lambda a: -a),
}
DATE_PARTS = ("year", "month", "day", "hour", "minute", "second")
LOCAL = {"length": F.length, "/": lambda a, b: a / b, "dayofweek": F.dayofweek, "weekofyear": F.weekofyear, "to_date": F.to_date}


@dataclass(frozen=True)
class Node:
    """op and arguments: ("col", name), ("lit", value), ("=", a, b), ("and", *p), ("or", *p), ("not", p), ("null", a), ("notnull", a),
    ("in", a, *literals), ("between", a, low, high, closed_low, closed_high), ("case", (when, then)..., else), ("like", kind, a, text, ignore_case), ("fn", name, *args), ("cast", a, source, target)."""

    op: str
    args: tuple = ()
    float_: bool = field(default=False, compare=False)


def col(name: str, kind: str = "") -> Node:
    """kind: the column's remote type; a bit is no predicate by itself, and floats have no %."""
    return Node("col", (name, kind.lower()), kind.lower() in ("real", "float"))


def lit(value) -> Node:
    return Node("lit", (value,), isinstance(value, float))


def node(op: str, *args) -> Node:
    return Node(op, args, any(isinstance(a, Node) and a.float_ for a in args))


def fn(name: str, *args) -> Node:
    return node("fn", name, *args)


class _Local(Exception):
    pass


def text(p: Node, predicate: bool = False, depth: int = 0, part: bool = False) -> str:
    """Remote SQL of a tree; raises _Local where it has no exact counterpart. predicate: a truth value is asked for; part: a date part is taken of it."""
    if depth > DEPTH:
        raise _Local
    sub = lambda x, truth=False: text(x, truth, depth + 1)
    match p.op, p.args:
        case "col", (name, kind):
            return f"({quote(name)} = 1)" if predicate else quote(name)
        case "lit", (value,):
            if predicate:
                return "(1 = 1)" if value else "(1 = 0)"
            return literal(value)
        case ("and" | "or"), parts:
            return "(" + f" {p.op.upper()} ".join(sub(x, True) for x in parts) + ")"
        case "not", (x,):
            return f"(NOT {sub(x, True)})"
        case "null", (x,):
            return f"({sub(x)} IS NULL)"
        case "notnull", (x,):
            return f"({sub(x)} IS NOT NULL)"
        case "in", (x, *values):
            if not values or any(v is None for v in values):
                raise _Local
            return f"({sub(x)} IN ({', '.join(map(literal, values))}))"
        case "between", (x, low, high, left, right):
            a, b, c = sub(x), sub(low), sub(high)
            return f"({a} BETWEEN {b} AND {c})" if left and right else f"({a} {'>=' if left else '>'} {b} AND {a} {'<=' if right else '<'} {c})"
        case "case", (*pairs, other):
            whens = "".join(f" WHEN {sub(w, True)} THEN {sub(t)}" for w, t in pairs)
            out = f"(CASE{whens} ELSE {sub(other)} END)"
            return f"({out} = 1)" if predicate else out
        case "like", (kind, x, pattern, ignore):
            if pattern is None:
                raise _Local
            pattern = ("" if kind == "prefix" else "%") + like_escape(pattern) + ("" if kind == "suffix" else "%")
            a, b = sub(x), literal(pattern)
            return f"(LOWER({a}) LIKE LOWER({b}))" if ignore else f"({a} LIKE {b})"
        case "cast", (x, source, target):
            # text to text is nothing; timestamps without zone, only where a date part is taken of them
            if predicate or source != target or not (source == "string" or (source == "timestamp_ntz" and part)):
                raise _Local
            return sub(x)
        case "fn", (name, *args):
            if name in DATE_PARTS and not predicate:
                return FUNCTIONS[name][0].format(*[text(x, False, depth + 1, part=True) for x in args])
            if name not in FUNCTIONS or (name == "%" and p.float_) or predicate:
                raise _Local
            return FUNCTIONS[name][0].format(*map(sub, args))
        case op, (a, b) if op in COMPARE:
            return f"({sub(a)} {op} {sub(b)})"
    raise _Local


def names(p: Node) -> list[str]:
    """Columns a tree refers to."""
    if p.op == "col":
        return [p.args[0]]
    parts = [y for x in p.args for y in (x if isinstance(x, tuple) else (x,))]
    return [n for x in parts if isinstance(x, Node) for n in names(x)]


def cast(x: Node, source: str, target: str) -> Node:
    """A cast; source and target: Spark's names of the types."""
    return node("cast", x, source, target)


def conjuncts(p: Node) -> list[Node]:
    return [y for x in p.args for y in conjuncts(x)] if p.op == "and" else [p]


def encode(p: Node | None) -> tuple[str, list[Node]]:
    """WHERE text (empty: nothing to say) and the conjuncts that stay local."""
    said, rest = [], []
    for x in conjuncts(p) if p else []:
        try:
            said.append(text(x, True))
        except _Local:
            rest.append(x)
    return " AND ".join(said), rest


def column(p: Node) -> Column:
    """The same predicate, or value, as a Spark column."""
    match p.op, p.args:
        case "col", (name, _):
            return F.col("`" + name.replace("`", "``") + "`")
        case "lit", (value,):
            return F.lit(value)
        case "and", parts:
            return reduce(Column.__and__, map(column, parts))
        case "or", parts:
            return reduce(Column.__or__, map(column, parts))
        case "not", (x,):
            return ~column(x)
        case "null", (x,):
            return column(x).isNull()
        case "notnull", (x,):
            return column(x).isNotNull()
        case "in", (x, *values):
            return column(x).isin(*values)
        case "between", (x, low, high, left, right):
            a, b, c = column(x), column(low), column(high)
            return ((a >= b) if left else (a > b)) & ((a <= c) if right else (a < c))
        case "case", (*pairs, other):
            out = F
            for w, t in pairs:
                out = out.when(column(w), column(t))
            return out.otherwise(column(other))
        case "like", (kind, x, pattern, ignore):
            a, b = column(x), F.lit(pattern)
            a, b = (F.lower(a), F.lower(b)) if ignore else (a, b)
            return {"prefix": a.startswith, "suffix": a.endswith, "contains": a.contains}[kind](b)
        case "cast", (x, _, target):
            return column(x).cast(target)
        case "fn", (name, *args):
            f = FUNCTIONS[name][1] if name in FUNCTIONS else LOCAL[name]
            return f(*map(column, args))
        case op, (a, b):
            return COMPARE[op](column(a), column(b))


def rowid_equals(key: list[str], value) -> Node:
    """rowid = value as comparisons of the primary key's columns; value: a scalar, or a dict or tuple for several."""
    if len(key) == 1 and not isinstance(value, (dict, tuple)):
        return node("=", col(key[0]), lit(value))
    values = [value[k] for k in key] if isinstance(value, dict) else list(value)
    return node("and", *(node("=", col(k), lit(v)) for k, v in zip(key, values, strict=True)))
