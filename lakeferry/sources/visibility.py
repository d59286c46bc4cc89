"""Which schemas and tables of a catalog are visible, by regular expression; and as LIKE or IN for a server to filter by."""

from __future__ import annotations

import re

from ..errors import EngineError
from ..functions.literals import like_escape, literal, quote


class Filter:
    """Case-insensitive search in schema and table names."""

    def __init__(self, schema: str | None = None, table: str | None = None):
        self.schema, self.table = self._compile("schema_filter", schema), self._compile("table_filter", table)

    @staticmethod
    def _compile(what: str, pattern: str | None):
        try:
            return re.compile(pattern, re.I) if pattern else None
        except re.error as e:
            raise EngineError(f"{what} is not a regular expression: {pattern} ({e})") from e

    def sees_schema(self, name: str) -> bool:
        return not self.schema or bool(self.schema.search(name))

    def sees(self, schema: str, table: str) -> bool:
        return self.sees_schema(schema) and (not self.table or bool(self.table.search(table)))


def _plain(text: str) -> str | None:
    """What a pattern without operators stands for; None if it has any."""
    out, escaped = "", False
    for c in text:
        if escaped:
            if c.isalnum():
                return None
            out, escaped = out + c, False
        elif c == "\\":
            escaped = True
        elif c in ".^$*+?()[]{}|":
            return None
        else:
            out += c
    return None if escaped else out


def to_sql(pattern: str, column: str) -> str | None:
    """A condition on `column` that holds wherever the pattern matches and nowhere else; None if there is none."""
    name = quote(column)
    alternatives = re.fullmatch(r"\^\(([^()]*)\)\$", pattern)
    if alternatives:
        words = [_plain(x) for x in alternatives[1].split("|")]
        return None if None in words else f"LOWER({name}) IN ({', '.join(literal(w.lower()) for w in words)})"
    if "|" in pattern:
        parts = [to_sql(x, column) for x in pattern.split("|")] if "(" not in pattern else [None]
        return None if None in parts else "(" + " OR ".join(parts) + ")"
    start, end = pattern.startswith("^"), pattern.endswith("$") and not pattern.endswith("\\$")
    body = pattern[start : len(pattern) - end]
    like = "".join("%" if x == ".*" else "_" if x == "." else "\0" if (w := _plain(x)) is None else like_escape(w) for x in re.findall(r"\.\*|\.|(?:\\.|[^.\\])+", body))
    if "\0" in like:
        return None
    if start and end and _plain(body) is not None:
        return f"LOWER({name}) = {literal(_plain(body).lower())}"
    like = ("" if start else "%") + like + ("" if end else "%")
    return f"LOWER({name}) LIKE {literal(like.lower())}"
