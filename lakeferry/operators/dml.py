"""INSERT, UPDATE and DELETE, set-based.

An update or delete finds its rows by a filter, or by an equi-join on the primary key, notes which files hold any, and
rewrites these alone; other files stay as they are, be they of the same load or not.
"""

from __future__ import annotations

import re
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import EngineError, NotFound, Refused
from ..functions.literals import quote
from ..functions.types import parse, string_type
from ..plans import remote
from ..session import fresh_dir
from ..settings import settings
from ..sources.catalog import Catalog
from ..sources.store import Col, Meta
from .ddl import existing, stage
from .load import fit

#: Text of XML values in an UPDATE, in bytes; longer ones are for bulk load.
XML_BYTES = 4096


def _kept(df: DataFrame) -> DataFrame:
    """df as a table of its own for the time of a statement, so that lost executors don't change what it holds."""
    at = fresh_dir(df.sparkSession, "rows")
    schema = df.schema
    df.write.parquet(at)
    return df.sparkSession.read.schema(schema).parquet(at)


def _filled(c: Catalog, m: Meta, df: DataFrame, columns: list[str] | None) -> tuple[DataFrame, Meta, int]:
    """df with all columns of the table, the rest by default, identity or null; and the metadata with the next identity."""
    given = [m.col(x) for x in columns] if columns is not None else [x for x in m.columns if not x.identity] if len(df.columns) < len(m.columns) else m.columns
    if len(given) != len(df.columns):
        raise EngineError(f"{len(df.columns)} values for {len(given)} columns")
    for g in given:
        if g.identity:
            raise EngineError(f"column {g.name} is an identity and takes no explicit value")
    df = df.toDF(*[f"g{i}" for i in range(len(given))])
    of = {g.name: F.col(f"g{i}") for i, g in enumerate(given)}
    rows, ident = None, next((x for x in m.columns if x.identity), None)
    if ident:
        # numbers in partition order: counts by partition first, then offsets; kept, as the rows must be the same ones both times
        df = df.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
        df = _kept(df)
        sizes = df.groupBy("_p").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        rows = sizes.agg(F.sum("count")).first()[0] or 0
        nth = F.col("_before") + F.row_number().over(Window.partitionBy("_p").orderBy("_i")) - 1
        df = df.join(F.broadcast(sizes), "_p").withColumn("_n", nth)
        of[ident.name] = F.lit(m.next_identity) + F.col("_n") * ident.identity[1]
    cols = [fit(of.get(x.name, F.expr(x.default) if x.default else F.lit(None)), x).alias(x.name) for x in m.columns]
    if ident:
        m = replace(m, next_identity=m.next_identity + rows * ident.identity[1])
    return df.select(*cols), m, rows


def _on_server(c: Catalog, name: str, what: str) -> tuple[str, str] | None:
    """(schema, table) where a live server runs the statement, None for a store."""
    if c.server is None or c.read_only:
        return None
    schema, table = c.resolve(name)
    if c.server.tables(schema).get(table) != "table":
        raise Refused(f"{what}: {name} is no table")
    return schema, table


def _run(c: Catalog, statements) -> int:
    n = sum(c.server.execute(x) for x in statements)
    c.counters["statements"] += 1
    return n


def insert(c: Catalog, name: str, df: DataFrame, columns: list[str] | None = None, returning: bool = False) -> int | DataFrame:
    """Appends df; columns: which of the table's its columns stand for, in order. The number of rows, or with returning, the rows as stored."""
    if at := _on_server(c, name, "INSERT"):
        df = df.toDF(*(columns or [x[0] for x in c.server.columns(*at)]))
        c.server.write(df, *at, batch=settings["insert_batch_size"])
        return df.count()
    schema, table, m = existing(c, name, "INSERT")
    rows, meta, _ = _filled(c, m, df, columns)
    for x in m.columns:
        if not x.nullable:
            bad = F.raise_error(F.lit(f"column {x.name} takes no NULL")).cast(x.type)
            rows = rows.withColumn(x.name, F.coalesce(F.col(f"`{x.name}`"), bad))
    segment, n = c.store.write(schema, table, m.columns, rows, options=m.options)
    new = stage(c, schema, table, replace(meta, segments=[*m.segments, segment], rows=m.rows + n), m.version)
    if not returning:
        return n
    if settings["insert_use_returning_output"]:
        return c.store.read(new, [segment])
    return c.table(name).join(c.store.read(new, [segment]).select(*[f"`{k}`" for k in _keyed(m, "INSERT that returns rows by key")]), m.key, "left_semi")


def _rewrite(c: Catalog, schema: str, table: str, m: Meta, touched: DataFrame, change) -> tuple[int, Meta]:
    """Replaces the files that hold rows of touched (column _file) by change(their rows); rows touched."""
    named = {s.rsplit("/", 1)[1]: s for s in m.segments}
    files: dict[str, list[str]] = {}
    n = 0
    for r in touched.groupBy("_file.segment", "_file.file").count().collect():
        files.setdefault(named[r.segment], []).append(r.file)
        n += r["count"]
    if not n:
        return 0, m
    before = c.store.read(m, only=files)
    segment, rows = c.store.write(schema, table, m.columns, change(before), options=m.options)
    gone = {s: [*m.gone.get(s, ()), *files.get(s, ())] for s in m.segments if s in m.gone or s in files}
    empty = {s for s in files if len(gone[s]) == len(c.store.data_files(s))}
    keep = [s for s in m.segments if s not in empty]
    # counting whole files reads footers alone
    return n, replace(m, segments=[*keep, segment], gone={s: sorted(f) for s, f in gone.items() if s not in empty}, rows=m.rows - before.count() + rows)


def _keyed(m: Meta, what: str) -> list[str]:
    if not m.key:
        raise Refused(f"{what} needs a primary key")
    return m.key


def _expr(x: Column | str) -> Column:
    return F.expr(x) if isinstance(x, str) else x


def update(c: Catalog, name: str, values: dict[str, Column | str], where: Column | str | None = None) -> int:
    """Sets columns by expressions over the old row, where the condition is true; rows changed."""
    schema, table, m = existing(c, name, "UPDATE")
    key = {k.lower() for k in _keyed(m, "UPDATE")}
    new = {m.col(k).name: _expr(v) for k, v in values.items()}
    for k in new:
        if k.lower() in key:
            raise Refused(f"column {k} belongs to the primary key, which UPDATE doesn't change")
        if parse(m.col(k).remote)[0] == "xml":
            new[k] = F.when(F.octet_length(new[k].cast("string")) > XML_BYTES, F.raise_error(F.lit("XML of more than 4096 bytes: use bulk load"))).otherwise(new[k])
    cond = F.coalesce(_expr(where), F.lit(False)) if where is not None else F.lit(True)
    touched = c.store.read(m, tagged=True).where(cond)

    def change(df: DataFrame) -> DataFrame:
        return df.select(*[F.when(cond, fit(new[x.name], x)).otherwise(F.col(f"`{x.name}`")).alias(x.name) if x.name in new else F.col(f"`{x.name}`") for x in m.columns])

    n, meta = _rewrite(c, schema, table, m, touched, change)
    if n:
        stage(c, schema, table, meta, m.version)
    return n


def _match(m: Meta, changes: DataFrame) -> tuple[list[str], DataFrame]:
    low = {x.lower(): x for x in changes.columns}
    key = _keyed(m, "a join on the primary key")
    for k in key:
        if k.lower() not in low:
            raise NotFound(f"no column {k} to match rows by")
    named = changes.select(*[F.col(f"`{low[k.lower()]}`").alias(f"_k{i}") for i, k in enumerate(key)], *[F.col(f"`{x}`").alias(f"_v_{x}") for x in changes.columns if x.lower() not in {k.lower() for k in key}])
    if not named.groupBy(*[f"_k{i}" for i in range(len(key))]).count().where("count > 1").isEmpty():
        raise EngineError("two rows of the changes have one key")
    return key, named


def _on(key: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"`{k}`") == F.col(f"_k{i}") for i, k in enumerate(key)])


def update_from(c: Catalog, name: str, changes: DataFrame) -> int:
    """Sets, in the rows whose primary key changes has, the other columns of changes; rows changed."""
    if at := _on_server(c, name, "UPDATE"):
        key = c.key(name)
        cols = [x for x in changes.columns if x.lower() not in {k.lower() for k in key}]
        xml = tuple(n for n, kind, _ in c.server.columns(*at) if kind == "xml" and n in cols)
        return _run(c, remote.update_statements(".".join(map(quote, at)), key, cols, map(tuple, changes.select(*key, *cols).toLocalIterator()), xml))
    schema, table, m = existing(c, name, "UPDATE")
    key, changes = _match(m, changes)
    cols = {m.col(x[3:]).name: x for x in changes.columns if x.startswith("_v_")}
    touched = c.store.read(m, tagged=True).join(changes, _on(key), "left_semi")

    def change(df: DataFrame) -> DataFrame:
        both = df.join(changes.withColumn("_hit", F.lit(True)), _on(key), "left")
        return both.select(*[F.when(F.col("_hit"), fit(F.col(f"`{cols[x.name]}`"), x)).otherwise(F.col(f"`{x.name}`")).alias(x.name) if x.name in cols else F.col(f"`{x.name}`") for x in m.columns])

    n, meta = _rewrite(c, schema, table, m, touched, change)
    if n:
        stage(c, schema, table, meta, m.version)
    return n


def delete(c: Catalog, name: str, where: Column | str | None = None) -> int:
    """Removes the rows for which the condition is true (all without one); rows removed."""
    schema, table, m = existing(c, name, "DELETE")
    _keyed(m, "DELETE")
    cond = F.coalesce(_expr(where), F.lit(False)) if where is not None else F.lit(True)
    n, meta = _rewrite(c, schema, table, m, c.store.read(m, tagged=True).where(cond), lambda df: df.where(~cond))
    if n:
        stage(c, schema, table, meta, m.version)
    return n


def delete_from(c: Catalog, name: str, keys: DataFrame) -> int:
    """Removes the rows whose primary key keys has; rows removed."""
    if at := _on_server(c, name, "DELETE"):
        key = c.key(name)
        return _run(c, remote.delete_statements(".".join(map(quote, at)), key, map(tuple, keys.select(*key).toLocalIterator())))
    schema, table, m = existing(c, name, "DELETE")
    key, keys = _match(m, keys)
    touched = c.store.read(m, tagged=True).join(keys, _on(key), "left_semi")
    n, meta = _rewrite(c, schema, table, m, touched, lambda df: df.join(keys, _on(key), "left_anti"))
    if n:
        stage(c, schema, table, meta, m.version)
    return n


def column_for(name: str, kind: str, *, identity: tuple[int, int] | None = None, default: str | None = None, remote: str | None = None, collation: str | None = None) -> T.StructField:
    """A field for create_table with what a plain type can't say."""
    said = {"identity": list(identity) if identity else None, "default": default, "remote_type": remote, "collation": collation}
    if remote and (bounded := re.fullmatch(r"(n?varchar)\((\d+)\)", remote, re.I)):
        said |= string_type(bounded[1].lower(), int(bounded[2]), collation)
    return T.StructField(name, T._parse_datatype_string(kind), True, {k: v for k, v in said.items() if v is not None})


__all__ = ["Col", "column_for", "delete", "delete_from", "insert", "update", "update_from"]
