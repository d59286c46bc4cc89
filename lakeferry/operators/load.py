"""Bulk load: targets, options, mapping by name, type compatibility; and CREATE TABLE AS."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import Exists, NotFound, Refused
from ..functions.convert import narrow, round_timestamp, truncate_utf8, truncate_utf16
from ..functions.types import accepts, parse, refusal, remote_type, spark_type
from ..settings import settings
from ..sources.catalog import DEFAULT_SCHEMA, Catalog
from ..sources.store import Col, Meta, columns_of
from . import ddl


@dataclass(frozen=True)
class Target:
    catalog: str
    schema: str
    table: str

    @property
    def session(self) -> bool:
        return self.table.startswith("#") and not self.shared

    @property
    def shared(self) -> bool:
        return self.table.startswith("##")


def target(text: str) -> Target:
    """`scheme://catalog[/schema]/table`, `catalog[.schema].table` or `catalog..#t`."""
    if m := re.fullmatch(r"\w+://([^/]+)/(?:([^/]*)/)?([^/]+)", text):
        parts = [unquote(m[1]), None if m[2] is None else unquote(m[2]), unquote(m[3])]
    else:
        names, at = [], 0
        while at <= len(text):
            m = re.compile(r"\[((?:[^\]]|\]\])+)\](?=\.|$)|\"((?:[^\"]|\"\")+)\"(?=\.|$)|([^.]*)").match(text, at)
            names.append(m[1].replace("]]", "]") if m[1] else m[2].replace('""', '"') if m[2] else m[3])
            at = m.end() + 1
        if len(names) == 3:
            parts = names
        elif len(names) == 2:
            parts = [names[0], None, names[1]]
        else:
            raise Refused(f"not a target: {text}")
    catalog, schema, table = parts
    if not catalog or not table:
        raise Refused(f"not a target: {text}")
    if schema == "" and not table.startswith("#"):
        raise Refused("an empty schema is for temporary tables only")
    return Target(catalog, schema or DEFAULT_SCHEMA, table)


def table_lock(setting: str, kind: str) -> bool:
    """auto: a heap is locked whole, tables with an order aren't."""
    return {"true": True, "false": False}.get(setting, kind == "heap")


def fit(value: Column, col: Col) -> Column:
    """A value as a column's type: decimals round half away from zero, integers must fit, timestamps round, strings are cut to the bound."""
    name, args = parse(col.remote)
    t = T._parse_datatype_string(col.type)
    if name in ("tinyint", "smallint", "int", "bigint") and isinstance(t, T.IntegralType):
        return narrow(value, name).cast(t)
    if isinstance(t, T.StringType) and args and args[0].isdigit():
        cut = truncate_utf16 if name.startswith("n") else truncate_utf8
        return cut(value.cast("string"), int(args[0]))
    if isinstance(t, T.TimestampNTZType) and name == "datetime2" and args and int(args[0]) < 6:
        return round_timestamp(value.cast(t), int(args[0]))
    if isinstance(t, T.TimestampNTZType) and name == "smalldatetime":
        rounded = F.timestamp_micros(F.floor((F.unix_micros(value.cast("timestamp")) + 30_000_000) / 60_000_000).cast("bigint") * 60_000_000)
        return rounded.cast(t)
    return value.cast(t)


def mapping(source: DataFrame, cols: list[Col]) -> list[tuple[Col, str | None]]:
    """For each column of the table, the source's column of that name, whatever the case; at least one must be found."""
    low: dict[str, str] = {}
    for x in source.columns:
        low.setdefault(x.lower(), x)
    out = [(c, low.get(c.name.lower())) for c in cols]
    if not any(x for _, x in out):
        raise Refused("no column of the source has the name of one in the table")
    return out


def _compatible(source: DataFrame, pairs: list[tuple[Col, str | None]]) -> set[str]:
    """Names of source columns that can't go into their target, but hold nothing but NULL; others that can't raise."""
    odd = [(c, x) for c, x in pairs if x and not accepts(source.schema[x].dataType, c.remote)]
    if not odd:
        return set()
    held = source.agg(*[F.max(F.col(f"`{x}`").isNotNull()).alias(f"h{i}") for i, (_, x) in enumerate(odd)]).first()
    for i, (c, x) in enumerate(odd):
        if held[i]:
            raise Refused(f"column {x}: type {source.schema[x].dataType.simpleString().upper()} can't go into {c.remote}")
    return {x for _, x in odd}


def copy_to(c: Catalog, df: DataFrame, name: str, *, create_table: bool = True, replace_table: bool = False, truncate: bool = False, flush_rows: int | None = None, tablock: str | None = None, string_length: int | None = None, table_kind: str | None = None, parallel: int | None = None) -> int:
    """Loads df into a table; rows loaded.

    create_table: makes the table if there is none. replace_table: drops it first. truncate: empties it first and keeps its
    definition. flush_rows: rows of a file (0: no limit). string_length: bound of the strings of a new table.
    parallel: tasks that write (0: one for each partition of df, without a shuffle). What isn't given is as the settings say.
    """
    or_ = lambda x, name: settings[name] if x is None else x
    flush_rows, tablock, string_length = or_(flush_rows, "copy_flush_rows"), or_(tablock, "copy_tablock"), or_(string_length, "default_string_length")
    table_kind, parallel = or_(table_kind, "default_table_kind"), or_(parallel, "copy_parallel_writers")
    t = target(f"{c.name}.{name}" if not name.lower().startswith(f"{c.name.lower()}.") and "://" not in name else name)
    if t.table.startswith("#"):
        return _temporary(c, df, t, replace_table, truncate)
    if c.server is not None and not c.read_only:
        return _to_server(c, df, t, create_table, replace_table, truncate, flush_rows)
    store = c.writable("COPY")
    if t.table in c.views:
        raise Refused(f"COPY: {name} is a view")
    m = c.meta(t.schema, t.table)
    if m is not None and m.sql:
        raise Refused(f"COPY: {name} is a view")
    if m is None and not create_table:
        raise NotFound(f"no table {name}, and create_table is false")
    if m is None or replace_table:
        options = ddl.table_options({"table_kind": table_kind})
        cols = columns_of(df.schema, lambda f: remote_type(f, default_length=string_length))
        rows = df.select(*[fit(F.col(f"`{x.name}`"), x).alias(x.name) for x in cols])
        after, old = c.version(t.schema, t.table), []
        base = Meta(cols, options=options | {"tablock": table_lock(tablock, options["table_kind"])})
    else:
        pairs = mapping(df, m.columns)
        empty = _compatible(df, pairs)
        value = lambda x, s: F.lit(None) if s in empty else F.col(f"`{s}`") if s else F.expr(x.default) if x.default else F.lit(None)
        rows = df.select(*[fit(value(x, s), x).alias(x.name) for x, s in pairs])
        cols, after, old, base = m.columns, m.version, [] if truncate else m.segments, m
    segment, k = store.write(t.schema, t.table, cols, rows, writers=parallel, flush_rows=flush_rows, options=base.options)
    ddl.stage(c, t.schema, t.table, replace(base, segments=[*old, segment], gone=base.gone if old else {}, rows=(base.rows if old else 0) + k), after)
    c.counters["statements"] += 1
    c.counters["rows_loaded"] += k
    return k


def _to_server(c: Catalog, df: DataFrame, t: Target, create_table: bool, replace_table: bool, truncate: bool, flush_rows: int) -> int:
    """The load as batches over JDBC; columns go by name."""
    kinds = c.server.tables(t.schema)
    if kinds.get(t.table) == "view":
        raise Refused(f"COPY: {t.table} is a view")
    if t.table not in kinds and not create_table:
        raise NotFound(f"no table {t.table}, and create_table is false")
    if t.table in kinds and not replace_table:
        cols = [Col(n, spark_type(k).simpleString(), k) for n, k, _ in c.server.columns(t.schema, t.table)]
        pairs = mapping(df, cols)
        empty = _compatible(df, pairs)
        df = df.select(*[fit(F.lit(None) if x in empty else F.col(f"`{x}`"), col).alias(col.name) for col, x in pairs if x])
    mode = "overwrite" if (replace_table or truncate) and t.table in kinds else "append"
    c.server.write(df, t.schema, t.table, mode, flush_rows, truncate)
    n = df.count()  # the writer says nothing of it
    c.counters["rows_loaded"] += n
    c.invalidate(t.schema, t.table)
    return n


def _temporary(c: Catalog, df: DataFrame, t: Target, replace_table: bool, truncate: bool) -> int:
    """`#t` is the session's, `##t` everyone's: a view over a table of its own in the store's folder, which goes when it is dropped or the catalog is detached."""
    store, held = c.writable("COPY"), c.temporary.get(t.table)
    if held is None or replace_table:
        if held is not None:
            c.drop_temporary(t.table)
        cols = columns_of(df.schema, remote_type)
        rows, old, n = df, [], 0
    else:
        cols, pairs = held.columns, mapping(df, held.columns)
        empty = _compatible(df, pairs)
        rows = df.select(*[fit(F.lit(None) if s is None or s in empty else F.col(f"`{s}`"), x).alias(x.name) for x, s in pairs])
        old, n = ([], 0) if truncate else (held.segments, held.rows)
    segment, k = store.write("_temp", uuid.uuid4().hex, cols, rows)
    c.temporary[t.table] = m = Meta(cols, segments=[*old, segment], rows=n + k)
    kept = store.read(m)
    (kept.createOrReplaceGlobalTempView if t.shared else kept.createOrReplaceTempView)(t.table.strip("#"))
    c.add_view(t.table, lambda _, kept=kept: kept)
    return k


def create_table_as(c: Catalog, name: str, df: DataFrame, *, or_replace: bool = False, if_not_exists: bool = False, drop_on_failure: bool | None = None, options: dict | None = None, string_length: int | None = None) -> int:
    """A table with df's columns, all nullable, and rows; rows loaded (0 if it exists and if_not_exists). Never part of a transaction."""
    store = c.writable("CREATE TABLE AS")
    schema, table = c.resolve(name)
    if schema not in store.schemas():
        raise NotFound(f"no schema {schema}")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            raise refusal(f.name, f.dataType)
    m = store.current(schema, table)
    if m is not None:
        if if_not_exists:
            return 0
        if not or_replace:
            raise Exists(f"table {name} exists already")
    options = ddl.table_options(options or {"table_kind": settings["default_table_kind"]})
    length = settings["default_string_length"] if string_length is None else string_length
    cols = columns_of(df.schema, lambda f: remote_type(f, settings["ctas_text_type"].lower(), length))
    rows = df.select(*[fit(F.col(f"`{x.name}`"), x).alias(x.name) for x in cols])
    after = store.head(schema, table)
    after = after.version if after else 0
    if not settings["ctas_use_bcp"] and m is None:
        return _by_insert(c, schema, table, Meta(cols, options=options), rows, after, settings["ctas_drop_on_failure"] if drop_on_failure is None else drop_on_failure)
    # the old version serves readers until this one is published; a failed write publishes nothing
    segment, n = store.write(schema, table, cols, rows, options=options)
    store.publish(schema, table, Meta(cols, segments=[segment], rows=n, options=options), after)
    c.invalidate(schema, table)
    return n


def _by_insert(c: Catalog, schema: str, table: str, meta: Meta, rows: DataFrame, after: int, drop_on_failure: bool) -> int:
    """CREATE TABLE, then INSERT: the table is there before its rows are, and stays empty if they fail unless drop_on_failure."""
    made = c.store.publish(schema, table, meta, after)
    try:
        segment, n = c.store.write(schema, table, made.columns, rows, options=made.options)
    except Exception:
        if drop_on_failure:
            c.store.publish(schema, table, Meta([], dropped=True), made.version)
        c.invalidate(schema, table)
        raise
    c.store.publish(schema, table, replace(made, segments=[segment], rows=n), made.version)
    c.invalidate(schema, table)
    return n
