"""T-SQL text as Spark's: one pass over tokens, so that nothing inside literals, quoted names or comments is touched.

What differs: [x] and "x" quote names (a bracket right behind a name or a closing bracket is an index, as in a[0]); strings know no
backslashes; LIKE has [classes]; TOP n, with PERCENT or WITH TIES, stands behind any SELECT; types, binary literals and a few functions
have other names. Table positions, and only these, are offered to a resolver, which says by what name Spark knows the table.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from ..errors import Refused
from ..functions.types import spark_type

_TOKEN = re.compile(
    r"(?P<space>\s+|--[^\n]*|/\*.*?\*/)|(?P<string>[Nn]?'(?:[^']|'')*')|(?P<name>\"(?:[^\"]|\"\")*\"|`(?:[^`]|``)*`)"
    r"|(?P<binary>0[xX][0-9A-Fa-f]*)|(?P<number>\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?)|(?P<word>[A-Za-z_#@$\u0080-\U0010FFFF][\w#@$]*)|(?P<op><=|>=|<>|!=|\|\||::|.)",
    re.S,
)
#: Words that can't name a table's alias, or a thing that is indexed.
RESERVED = frozenset(
    "SELECT FROM WHERE GROUP ORDER BY HAVING JOIN INNER LEFT RIGHT FULL OUTER CROSS ON USING UNION EXCEPT INTERSECT LIMIT OFFSET FETCH SEMI ANTI NATURAL LATERAL AS AND OR NOT IN IS LIKE RLIKE BETWEEN CASE WHEN THEN ELSE END "
    "DISTINCT ALL TOP WITH VALUES SET WINDOW TABLESAMPLE PIVOT UNPIVOT EXISTS INTO ASC DESC NULLS ESCAPE".split()
)
_ENDS_FROM = frozenset("WHERE GROUP ORDER HAVING LIMIT OFFSET FETCH WINDOW UNION EXCEPT INTERSECT".split())
_SETS = frozenset(("UNION", "EXCEPT", "INTERSECT"))
#: Functions by another name here; date parts that are given as bare words.
FUNCTIONS = {"GETDATE": "localtimestamp", "SYSDATETIME": "localtimestamp", "ISNULL": "coalesce", "NEWID": "uuid", "DATALENGTH": "octet_length", "CEILING": "ceil", "LEN": "length"}
PARTS = frozenset("YEAR QUARTER MONTH DAY WEEK HOUR MINUTE SECOND".split())
TYPES = frozenset("DATETIME2 DATETIME SMALLDATETIME DATETIMEOFFSET BIT NVARCHAR VARCHAR NCHAR CHAR NTEXT TEXT UNIQUEIDENTIFIER VARBINARY IMAGE MONEY SMALLMONEY REAL FLOAT TINYINT NUMERIC XML".split())


@dataclass
class Token:
    kind: str  # space, string, name (quoted), binary, number, word, op
    text: str

    @property
    def upper(self) -> str:
        return self.text.upper() if self.kind == "word" else self.text if self.kind == "op" else ""

    @property
    def value(self) -> str:
        """A name without its quotes."""
        if self.kind != "name":
            return self.text
        q = self.text[-1]
        return self.text[1:-1].replace(q + q, q)


def tokens(sql: str) -> list[Token]:
    out: list[Token] = []
    last: Token | None = None  # but for space; adjacent: no space in between
    adjacent, at = False, 0
    while at < len(sql):
        m = _TOKEN.match(sql, at)
        t = Token(m.lastgroup, m[0])
        if t.text == "[":
            index = adjacent and last is not None and (last.kind == "name" or last.upper in (")", "]") or (last.kind == "word" and last.upper not in RESERVED))
            if not index:
                m = re.compile(r"\[(?:[^\]]|\]\])*\]").match(sql, at)
                if not m:
                    raise Refused("a [ without its ]")
                t = Token("name", m[0])
        elif t.kind == "op" and t.text in "'\"`":
            raise Refused(f"a {t.text} without its end")
        out.append(t)
        at = m.end()
        adjacent = t.kind != "space"
        last = last if t.kind == "space" else t
    return out


def split(sql: str) -> list[str]:
    """Statements at semicolons; comments become spaces."""
    out, held = [], ""
    for t in tokens(sql):
        if t.upper == ";":
            out.append(held)
            held = ""
        else:
            held += " " if t.kind == "space" and t.text[0] in "-/" else t.text
    return [x.strip() for x in [*out, held] if x.strip()]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def string(text: str) -> str:
    """A text as a Spark literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text_of(t: Token) -> str:
    body = t.text[1:] if t.text[0] in "Nn" else t.text
    return body[1:-1].replace("''", "'")


def like(pattern: str) -> tuple[str, str]:
    """(LIKE or RLIKE, pattern) that means the same as a T-SQL LIKE pattern."""
    parts = re.findall(r"\[\^?\]?[^\]]*\]|.", pattern, re.S)
    plain = lambda p: len(p) == 3 and p[0] == "["
    if all(len(p) == 1 or plain(p) for p in parts):
        return "LIKE", "".join("\\" + p[1] if plain(p) and p[1] in "%_" else p[1] if plain(p) else "\\\\" if p == "\\" else p for p in parts)
    of = {"%": "(?s:.*)", "_": "(?s:.)"}
    return "RLIKE", r"\A" + "".join(p.replace("\\", "\\\\") if len(p) > 1 else of.get(p) or re.escape(p) for p in parts) + r"\z"


def _solid(ts: list[Token]) -> list[int]:
    return [i for i, t in enumerate(ts) if t.kind != "space"]


def _pairs(ts: list[Token]) -> dict[int, int]:
    """Places of round brackets, each with that of its other half."""
    out, open_ = {}, []
    for i, t in enumerate(ts):
        if t.upper == "(":
            open_.append(i)
        elif t.upper == ")" and open_:
            j = open_.pop()
            out[i], out[j] = j, i
    return out


def _tops(ts: list[Token]) -> list[Token]:
    """TOP of every SELECT as LIMIT, or as a rank where ties or a share are asked for."""
    word = lambda x: Token("word", x)
    while True:
        solid = _solid(ts)
        pairs = _pairs(ts)
        found = None
        for n in range(len(solid) - 2, -1, -1):  # inner ones first
            if ts[solid[n]].upper == "SELECT":
                k = n + 1 + (ts[solid[n + 1]].upper in ("DISTINCT", "ALL"))
                if k + 1 < len(solid) and ts[solid[k]].upper == "TOP" and (ts[solid[k + 1]].kind == "number" or ts[solid[k + 1]].upper == "("):
                    found = n, k
                    break
        if not found:
            return ts
        n, k = found
        a = solid[k + 1]
        if ts[a].upper == "(":
            count, last = ts[a + 1 : pairs[a]], solid.index(pairs[a])
        else:
            count, last = [ts[a]], k + 1
        amount = "".join(t.text for t in count).strip()
        percent = last + 1 < len(solid) and ts[solid[last + 1]].upper == "PERCENT"
        last += percent
        ties = last + 2 < len(solid) and [ts[solid[last + 1]].upper, ts[solid[last + 2]].upper] == ["WITH", "TIES"]
        last += 2 * ties
        # the end of this SELECT, and its ORDER BY
        end, order, combined, i = len(ts), None, n > 0 and ts[solid[n - 1]].upper in (*_SETS, "ALL"), solid[last] + 1
        while i < len(ts):
            u = ts[i].upper
            if u == "(":
                i = pairs[i]
            elif u == ")" or u == ";":
                end = i
                break
            elif u in _SETS:
                end, combined = i, True
                break
            elif u == "ORDER":
                order = i
            i += 1
        if combined and order is not None and (n > 0 and ts[solid[n - 1]].upper in (*_SETS, "ALL")):
            end = order  # it orders the combination
            order = None
        head, body = ts[: solid[n]], ts[solid[last] + 1 : order if order is not None else end]
        keys = ts[order:end] if order is not None else []
        chosen = ts[solid[n] : solid[k]]
        if ties or percent:
            if ties and not keys:
                raise Refused("TOP WITH TIES needs ORDER BY")
            depth, at = 0, None
            for j, t in enumerate(body):
                depth += {"(": 1, ")": -1}.get(t.upper, 0)
                if t.upper == "FROM" and not depth:
                    at = j
                    break
            if at is None:
                raise Refused("TOP WITH TIES or PERCENT needs FROM")
            over = "".join(t.text for t in keys) or "ORDER BY 1"
            rank = f"{'rank' if ties else 'row_number'}() OVER ({over})"
            bound = f"ceil(count(*) OVER () * {amount} / 100)" if percent else amount
            inner = [*chosen, *body[:at], Token("op", f", {rank} AS `_rank`, {bound} AS `_bound` "), *body[at:]]
            made = [Token("op", "SELECT * EXCEPT (`_rank`, `_bound`) FROM ("), *inner, Token("op", ") WHERE `_rank` <= `_bound`")]
        else:
            made = [*chosen, *body, *keys, Token("space", " "), word("LIMIT"), Token("space", " "), Token("number", amount)]
        if combined or ties or percent:
            made = [Token("op", "("), *made, Token("op", ") ")] if combined else made
        # brackets that this has made are single tokens, so that pairs still match
        ts = tokens_again([*head, *made, Token("space", " "), *ts[end:]])


def tokens_again(ts: list[Token]) -> list[Token]:
    """Tokens of several signs taken apart, the others as they are."""
    return [x for t in ts for x in (tokens(t.text) if t.kind == "op" and len(t.text) > 2 else [Token("op", "(")] if t.text == "(" else [Token("op", ")"), Token("space", " ")] if t.text == ") " else [t])]


def names(sql: str) -> str:
    """The text with its names in backquotes, and nothing else changed."""
    return "".join(quoted(t.value) if t.kind == "name" else t.text for t in tokens(sql))


def spark_sql(sql: str, resolve: Callable[[list[str]], str | None] = lambda parts: None, booleans: Callable[[], set[str]] = set) -> str:
    """Spark's text. resolve(parts of a name) names the view that stands for a table, or None to leave it; booleans() are columns that a bit is compared with."""
    ts = _tops(tokens(sql))
    ts = _tables(ts, resolve)
    flags = {x.lower() for x in booleans()}
    solid, pairs = _solid(ts), _pairs(ts)
    out = [t.text for t in ts]
    for n, i in enumerate(solid):
        t = ts[i]
        after = [ts[j] for j in solid[n + 1 : n + 4]]
        before = ts[solid[n - 1]] if n else Token("op", ";")
        if t.kind == "name":
            out[i] = quoted(t.value)
        elif t.kind == "binary":
            out[i] = f"X'{t.text[2:]}'"
        elif t.kind == "string":
            out[i] = string(_text_of(t))
        if t.kind in ("name", "word") and after and after[0].upper in ("=", "<>", "!=") and len(after) > 1 and after[1].text in ("0", "1") and t.value.lower() in flags:
            out[solid[n + 2]] = "true" if after[1].text == "1" else "false"
        if t.kind != "word":
            continue
        if t.upper in FUNCTIONS and after and after[0].upper == "(":
            out[i] = FUNCTIONS[t.upper]
        elif t.upper in PARTS and before.upper == "(" and after and after[0].upper == "," and n > 1 and ts[solid[n - 2]].upper == "DATEPART":
            out[i] = f"'{t.text}'"
        elif t.upper in TYPES and (before.upper == "AS" or before.upper == "::"):
            stop = solid.index(pairs[solid[n + 1]]) if after and after[0].upper == "(" and solid[n + 1] in pairs else n
            for j in solid[n + 1 : stop + 1]:
                out[j] = ""
            out[i] = spark_type("".join(ts[j].text for j in solid[n : stop + 1])).simpleString()
        elif t.upper == "LIKE":
            for k, x in enumerate(after):
                if x.kind == "string":
                    kind, pattern = like(_text_of(x))
                    out[i], ts[solid[n + 1 + k]] = kind, Token("string", "'" + pattern.replace("'", "''") + "'")
                    break
                if x.upper not in ("LOWER", "UPPER", "("):
                    break
    return "".join(out)


def _tables(ts: list[Token], resolve) -> list[Token]:
    """Names in table positions as resolve has them, with the table's own name as alias where none is given; hints go."""
    solid, pairs = _solid(ts), _pairs(ts)
    ctes = {ts[solid[n]].value.lower() for n in range(1, len(solid) - 2) if ts[solid[n]].kind in ("word", "name") and ts[solid[n + 1]].upper in ("AS", "(") and ts[solid[n - 1]].upper in ("WITH", ",", "RECURSIVE") and _is_cte(ts, solid, pairs, n)}
    gone: set[int] = set()
    put: dict[int, str] = {}
    # by depth: is this a SELECT's FROM clause (and not a function's), and is a table's name due?
    stack = [{"select": False, "from": False, "due": False}]
    n = 0
    while n < len(solid):
        i, here = solid[n], stack[-1]
        t, u = ts[i], ts[i].upper
        if u == "(":
            stack.append({"select": False, "from": False, "due": False} | ({"select": True, "from": True, "due": True} if here["due"] else {}))
            here["due"] = False
        elif u == ")":
            if len(stack) > 1:
                stack.pop()
        elif u == "SELECT":
            here.update(select=True, due=False, **{"from": False})
        elif u == "FROM" and (here["select"] or len(stack) == 1):
            here.update(due=True, **{"from": True})
        elif u == "JOIN" and here["from"]:
            here["due"] = True
        elif u == "," and here["from"]:
            here["due"] = True
        elif u in _ENDS_FROM:
            here.update(due=False, **{"from": False})
        elif here["due"] and u not in ("LATERAL",) and t.kind in ("word", "name"):
            here["due"] = False
            parts, last = [t.value], n
            while last + 2 < len(solid) and ts[solid[last + 1]].upper == "." and ts[solid[last + 2]].kind in ("word", "name"):
                parts.append(ts[solid[last + 2]].value)
                last += 2
            follows = ts[solid[last + 1]] if last + 1 < len(solid) else Token("op", "")
            if not (u in ("VALUES", "UNNEST") or follows.upper == "(" or (len(parts) == 1 and parts[0].lower() in ctes)):
                known = resolve(parts)
                if known is not None:
                    for j in range(i, solid[last] + 1):
                        gone.add(j)
                    named = follows.upper == "AS" or follows.kind == "name" or (follows.kind == "word" and follows.upper not in RESERVED)
                    put[i] = quoted(known) + ("" if named else f" AS {quoted(parts[-1])}")
                    hint = last + 1 + (1 + (follows.upper == "AS") if named else 0)
                    if hint + 1 < len(solid) and ts[solid[hint]].upper == "WITH" and ts[solid[hint + 1]].upper == "(":
                        for j in range(solid[hint], pairs[solid[hint + 1]] + 1):
                            gone.add(j)
            n = last
        n += 1
    # made text is Spark's already: an op, which nothing further changes
    return [Token("op", put[i]) if i in put else t for i, t in enumerate(ts) if i in put or i not in gone]


def _is_cte(ts: list[Token], solid: list[int], pairs: dict[int, int], n: int) -> bool:
    """`name AS (` or `name (columns) AS (`."""
    k = n + 1
    if ts[solid[k]].upper == "(":
        if solid[k] not in pairs:
            return False
        k = solid.index(pairs[solid[k]]) + 1
    return k + 1 < len(solid) and ts[solid[k]].upper == "AS" and ts[solid[k + 1]].upper == "("
