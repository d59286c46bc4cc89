"""Schemas and tables: create, alter, drop. Column changes but ALTER TYPE touch metadata alone."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import EngineError, Exists, NotFound, Refused
from ..functions.types import remote_type, spark_type
from ..sources.catalog import Catalog
from ..sources.store import Col, Meta, columns_of

KINDS = ("heap", "columnstore", "cci", "clustered")
COMPRESSION = ("page", "row", "none")
REFUSED = ("index", "view", "function", "sequence", "type", "collation", "pragma", "trigger", "macro")


def table_options(options: dict | None) -> dict:
    """table_kind (heap, columnstore or cci, clustered), clustered_index (columns), data_compression (page, row, none); checked."""
    out = {}
    for k, v in (options or {}).items():
        k = k.lower()
        if k == "table_kind":
            if v.lower() not in KINDS:
                raise Refused(f"table_kind is one of {', '.join(KINDS)}, not {v}")
            out[k] = {"cci": "columnstore"}.get(v.lower(), v.lower())
        elif k == "clustered_index":
            out[k] = [v] if isinstance(v, str) else list(v)
            out.setdefault("table_kind", "clustered")
        elif k == "data_compression":
            if v.lower() not in COMPRESSION:
                raise Refused(f"data_compression is one of {', '.join(COMPRESSION)}, not {v}")
            out[k] = v.lower()
        else:
            raise Refused(f"unknown table option {k}")
    if out.get("table_kind") == "clustered" and not out.get("clustered_index"):
        raise Refused("a clustered table needs clustered_index")
    if out.get("table_kind") in ("heap", "columnstore") and out.get("clustered_index"):
        raise Refused("clustered_index belongs to clustered tables")
    return out


def create_schema(c: Catalog, name: str, if_not_exists: bool = False) -> None:
    store = c.writable("CREATE SCHEMA")
    if name in c.schema_names():
        if if_not_exists:
            return
        raise Exists(f"schema {name} exists already")
    if c.txn is not None:
        c.txn.schemas[name] = True
    store.create_schema(name)


def drop_schema(c: Catalog, name: str, if_exists: bool = False, cascade: bool = False) -> None:
    store = c.writable("DROP SCHEMA")
    if name not in c.schema_names():
        if if_exists:
            return
        raise NotFound(f"no schema {name}")
    tables = c.stored_tables(name)
    if tables and not cascade:
        raise EngineError(f"schema {name} has tables")
    for t in tables:
        drop_table(c, f"{_bracketed(name)}.{_bracketed(t)}")
    if c.txn is not None:
        c.txn.schemas[name] = False
    else:
        store.drop(name)
    c.invalidate(name)


def _bracketed(name: str) -> str:
    return "[" + name.replace("]", "]]") + "]"


def create_table(c: Catalog, name: str, schema: T.StructType | str, key: list[str] | None = None, if_not_exists: bool = False, or_replace: bool = False, options: dict | None = None, partitioned_by=None, sorted_by=None) -> bool:
    """Makes an empty table; whether it was made. Constraints but the primary key aren't kept."""
    c.writable("CREATE TABLE")
    if partitioned_by or sorted_by:
        raise Refused("PARTITIONED BY and SORTED BY are not supported")
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    store_, table = c.resolve(name)
    old = c.meta(store_, table)
    if old is not None:
        if if_not_exists:
            return False
        if not or_replace:
            raise Exists(f"table {name} exists already")
    options = table_options(options)
    text = "nvarchar"
    cols = columns_of(schema, lambda f: remote_type(f, text, int(options.get("string_length", 0))))
    names = [x.name.lower() for x in cols]
    if len(set(names)) < len(names):
        raise Refused("two columns have one name")
    for k in [*(key or []), *options.get("clustered_index", [])]:
        if k.lower() not in names:
            raise NotFound(f"no column {k} for the key")
    seeds = [x.identity[0] for x in cols if x.identity]
    stage(c, store_, table, Meta(cols, list(key or []), options=options, next_identity=seeds[0] if seeds else None), c.version(store_, table))
    return True


def stage(c: Catalog, schema: str, table: str, meta: Meta, after: int) -> Meta:
    """Publishes a version, or keeps it for the open transaction to."""
    if c.txn is not None:
        return c.txn.put(schema, table, meta, after)
    out = c.store.publish(schema, table, meta, after)
    c.invalidate(schema, table)
    return out


def existing(c: Catalog, name: str, what: str) -> tuple[str, str, Meta]:
    c.writable(what)
    schema, table = c.resolve(name)
    if table in c.views:
        raise Refused(f"{what}: {name} is a view")
    m = c.meta(schema, table)
    if m is None:
        raise NotFound(f"no table {name} in catalog {c.name}")
    if m.sql:
        raise Refused(f"{what}: {name} is a view")
    return schema, table, m


def drop_table(c: Catalog, name: str, if_exists: bool = False) -> None:
    """A last version that says so; the data goes with a vacuum."""
    if c.drop_temporary(name):
        return
    try:
        schema, table, m = existing(c, name, "DROP TABLE")
    except NotFound:
        if if_exists:
            return
        raise
    stage(c, schema, table, Meta([], dropped=True), m.version)


def rename_table(c: Catalog, name: str, to: str) -> None:
    """The same version under another name; its segments stay where they are."""
    schema, table, m = existing(c, name, "ALTER TABLE")
    if c.meta(schema, to) is not None:
        raise Exists(f"table {to} exists already")
    if c.txn is not None:
        c.txn.put(schema, table, Meta([], dropped=True), m.version)
        c.txn.put(schema, to, m, c.version(schema, to))
        return
    c.store.publish_all({(schema, to): (m, c.version(schema, to)), (schema, table): (Meta([], dropped=True), m.version)})
    c.invalidate(schema)


def _change(c: Catalog, name: str, change) -> None:
    schema, table, m = existing(c, name, "ALTER TABLE")
    stage(c, schema, table, change(m), m.version)


def add_column(c: Catalog, name: str, column: str, kind: str, if_not_exists: bool = False) -> None:
    def change(m: Meta) -> Meta:
        if any(x.name.lower() == column.lower() for x in m.columns):
            if if_not_exists:
                return m
            raise Exists(f"column {column} exists already")
        t = T._parse_datatype_string(kind)
        new = Col(column, t.simpleString(), remote_type(T.StructField(column, t)), True, f"c{len(m.columns)}_{uuid.uuid4().hex[:8]}")
        return replace(m, columns=[*m.columns, new])

    _change(c, name, change)


def drop_column(c: Catalog, name: str, column: str) -> None:
    def change(m: Meta) -> Meta:
        gone = m.col(column)
        if gone.name in m.key:
            raise Refused(f"column {column} belongs to the primary key")
        if len(m.columns) == 1:
            raise Refused("a table keeps one column at least")
        return replace(m, columns=[x for x in m.columns if x is not gone])

    _change(c, name, change)


def rename_column(c: Catalog, name: str, column: str, to: str) -> None:
    def change(m: Meta) -> Meta:
        old = m.col(column)
        if any(x is not old and x.name.lower() == to.lower() for x in m.columns):
            raise Exists(f"column {to} exists already")
        return replace(m, columns=[replace(x, name=to) if x is old else x for x in m.columns], key=[to if k == old.name else k for k in m.key])

    _change(c, name, change)


def set_nullable(c: Catalog, name: str, column: str, nullable: bool) -> None:
    schema, table, m = existing(c, name, "ALTER TABLE")
    old = m.col(column)
    if not nullable and not c.table(name).where(F.col(f"`{old.name}`").isNull()).isEmpty():
        raise EngineError(f"column {column} holds NULL")
    stage(c, schema, table, replace(m, columns=[replace(x, nullable=nullable) if x is old else x for x in m.columns]), m.version)


def alter_type(c: Catalog, name: str, column: str, kind: str) -> None:
    """A column's new type; its values are cast (what doesn't fit raises) and the column becomes nullable. Rewrites the table."""
    schema, table, m = existing(c, name, "ALTER TABLE")
    old, t = m.col(column), T._parse_datatype_string(kind)
    new = replace(old, type=t.simpleString(), remote=remote_type(T.StructField(column, t)), nullable=True, phys=f"c_{uuid.uuid4().hex[:8]}")
    cols = [new if x is old else x for x in m.columns]
    df = c.store.read(m).select(*[F.col(f"`{x.name}`").cast(t) if x is old else F.col(f"`{x.name}`") for x in m.columns])
    segment, rows = c.store.write(schema, table, cols, df, options=m.options)
    stage(c, schema, table, replace(m, columns=cols, segments=[segment], gone={}, rows=rows), m.version)


def refuse(kind: str) -> None:
    if kind.lower() in REFUSED:
        raise Refused(f"CREATE {kind.upper()} is not supported on an attached catalog")


def remote_schema(columns: list[tuple[str, str]]) -> T.StructType:
    """Fields of (name, remote type) pairs, as an attached server lists them."""
    return T.StructType([T.StructField(n, spark_type(t), True, {"remote_type": t}) for n, t in columns])
