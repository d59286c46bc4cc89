"""Which part of an ORDER BY a remote server may do, and what its statement says then."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.literals import quote
from .predicates import FUNCTIONS, LOCAL


@dataclass(frozen=True)
class Key:
    """A column, or a function of one argument of it; nullable: whether the column can be null."""

    column: str
    descending: bool = False
    nulls_first: bool | None = None
    function: str | None = None
    nullable: bool = True

    def column_of(self) -> Column:
        """The key as Spark sorts by it; nulls where the remote puts them, if nothing is said."""
        c = F.col("`" + self.column.replace("`", "``") + "`")
        c = FUNCTIONS[self.function][1](c) if self.function in FUNCTIONS else LOCAL[self.function](c) if self.function else c
        first = not self.descending if self.nulls_first is None else self.nulls_first
        return getattr(c, f"{'desc' if self.descending else 'asc'}_nulls_{'first' if first else 'last'}")()


def pushable(k: Key) -> bool:
    """Remote nulls come first ascending and last descending; another order counts only if there are none."""
    if k.function and (k.function not in FUNCTIONS or "{1}" in FUNCTIONS[k.function][0]):
        return False
    return not k.nullable or k.nulls_first is None or k.nulls_first != k.descending


@dataclass(frozen=True)
class Push:
    order_by: str  # "" if nothing is pushed
    top: int | None
    local_sort: bool


def plan(keys: list[Key], limit: int | None = None, offset: int = 0, enabled: bool = True) -> Push:
    """All keys pushable: the local sort goes. A prefix: it is pushed, and the whole sort stays. TOP needs all keys and no offset."""
    held = []
    for k in keys if enabled else []:
        if not pushable(k):
            break
        text = FUNCTIONS[k.function][0].format(quote(k.column)) if k.function else quote(k.column)
        held.append(f"{text} {'DESC' if k.descending else 'ASC'}")
    whole = bool(keys) and len(held) == len(keys)
    top = limit if whole and limit is not None and not offset else None
    return Push(", ".join(held), top, not whole)


def enabled(setting: bool, attach_option: bool) -> bool:
    return setting or attach_option


def statement(schema: str, table: str, items: list[str], where: str = "", push: Push | None = None) -> str:
    """The SELECT a scan sends; items: its select list, as text."""
    top = f"TOP {push.top} " if push and push.top is not None else ""
    out = f"SELECT {top}{', '.join(items)} FROM {quote(schema)}.{quote(table)}"
    out += f" WHERE {where}" if where else ""
    return out + (f" ORDER BY {push.order_by}" if push and push.order_by else "")
