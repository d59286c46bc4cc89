"""Statements for a live server: select lists that a client can read, and batched inserts, updates and deletes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from ..errors import EngineError, Refused
from ..functions.collation import flags
from ..functions.literals import literal, quote
from ..functions.types import BINARY, FIXED, TEXT, parse
from ..settings import settings

_KNOWN = {*FIXED, *TEXT, *BINARY, "decimal", "numeric", "time"}
XML_BYTES = 4096


def select_item(name: str, remote: str, collation: str | None = None) -> str:
    """A column as a scan selects it: what the client can't read is turned into what it can."""
    kind, args = parse(remote)
    q = quote(name)
    if kind in ("geometry", "geography"):
        return f"{q}.STAsBinary() AS {q}"
    if kind == "ntext" or kind not in _KNOWN:
        return f"CAST({q} AS NVARCHAR(MAX)) AS {q}"
    if kind == "image":
        return f"CAST({q} AS VARBINARY(MAX)) AS {q}"
    if kind in ("char", "varchar", "text") and not (collation and flags(collation).utf8):
        n = args[0] if args else "max"
        if n == "max" and not settings["convert_varchar_max"] and kind == "varchar":
            return q
        return f"CAST({q} AS NVARCHAR({n if n.isdigit() and int(n) <= 4000 else 'MAX'})) AS {q}"
    return q


def text_type(collation: str | None = None, length: int = 0) -> str:
    """The type of new string columns under ctas_text_type; VARCHAR needs a UTF-8 collation, or characters would turn into `?`."""
    n = length or settings["default_string_length"] or "MAX"
    if settings["ctas_text_type"].lower() == "nvarchar":
        return f"NVARCHAR({n})"
    collation = collation or settings["utf8_collation"]
    if not settings["utf8_support"] or not flags(collation).utf8:
        raise Refused(f"VARCHAR columns need a UTF-8 collation, which {collation} is not")
    return f"VARCHAR({n}) COLLATE {collation}"


def insert_statements(table: str, columns: list[str], rows: Iterable[tuple], returning: bool = False) -> Iterator[str]:
    """INSERT statements of at most so many rows and bytes; a row that is too long alone is an error."""
    most = min(settings["insert_batch_size"], settings["insert_max_rows_per_statement"])
    limit = settings["insert_max_sql_bytes"]
    head = f"INSERT INTO {table} ({', '.join(map(quote, columns))})" + (" OUTPUT INSERTED.*" if returning else "") + " VALUES "
    held, size = [], 0
    for row in rows:
        text = "(" + ", ".join(map(literal, row)) + ")"
        n = len(text.encode()) + 2
        if len(head.encode()) + n > limit:
            raise EngineError(f"a row takes {n} bytes of SQL; a statement holds {limit}")
        if held and (len(held) == most or len(head.encode()) + size + n > limit):
            yield head + ", ".join(held)
            held, size = [], 0
        held.append(text)
        size += n
    if held:
        yield head + ", ".join(held)


def batch_rows(values_per_row: int) -> int:
    """Rows of an update or delete statement, by the parameters a statement may have."""
    return max(1, min(settings["dml_batch_size"], settings["dml_max_parameters"] // max(1, values_per_row)))


def _batches(rows: Iterable[tuple], n: int) -> Iterator[list[tuple]]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == n:
            yield held
            held = []
    if held:
        yield held


def _values(rows: list[tuple], columns: list[str]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") AS v({', '.join(map(quote, columns))})"


def update_statements(table: str, key: list[str], columns: list[str], rows: Iterable[tuple], xml: tuple[str, ...] = ()) -> Iterator[str]:
    """Set-based updates; a row is its key's values, then the new ones."""
    if not key:
        raise Refused("UPDATE needs a primary key")
    if set(key) & set(columns):
        raise Refused("UPDATE doesn't change the primary key")
    names = [f"k{i}" for i in range(len(key))] + [f"c{i}" for i in range(len(columns))]
    sets = ", ".join(f"t.{quote(c)} = v.{quote(f'c{i}')}" for i, c in enumerate(columns))
    on = " AND ".join(f"t.{quote(k)} = v.{quote(f'k{i}')}" for i, k in enumerate(key))
    at = [len(key) + columns.index(c) for c in xml]
    for some in _batches(rows, batch_rows(len(names))):
        if any(r[i] is not None and len(str(r[i]).encode()) > XML_BYTES for r in some for i in at):
            raise Refused(f"XML of more than {XML_BYTES} bytes: use bulk load")
        yield f"UPDATE t SET {sets} FROM {table} AS t JOIN {_values(some, names)} ON {on}"


def delete_statements(table: str, key: list[str], rows: Iterable[tuple]) -> Iterator[str]:
    if not key:
        raise Refused("DELETE needs a primary key")
    names = [f"k{i}" for i in range(len(key))]
    on = " AND ".join(f"t.{quote(k)} = v.{quote(f'k{i}')}" for i, k in enumerate(key))
    for some in _batches(rows, batch_rows(len(key))):
        yield f"DELETE t FROM {table} AS t JOIN {_values(some, names)} ON {on}"
