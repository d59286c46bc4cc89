"""Attached catalogs: names, tables, views, primary keys, rowid, statistics, caches.

A catalog is one of: a folder of `<table>.parquet` (read-only), a store of versioned tables, or a live server behind JDBC. Everything
that reads returns a lazy DataFrame; joins, aggregates and the rest are Spark's own on top.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EngineError, Exists, NotFound, ReadOnly, Refused
from ..functions.collation import spark_name
from ..functions.types import spark_type
from ..functions.literals import quote
from ..plans import dialect, ordering, predicates, remote
from ..settings import settings
from . import connection
from .server import Server
from .store import Meta, Store
from .visibility import Filter

VERSION = "0.1.0"
DEFAULT_SCHEMA = "dbo"
_attached: dict[str, Catalog] = {}


@dataclass
class Entry:
    """What is known of a table: None as meta says that there is none. stale: to be read again before use."""

    meta: Meta | None
    read_at: float
    stale: bool = False


class Catalog:
    def __init__(
        self, spark: SparkSession, name: str, source: str = "", *, store: bool = False, read_only: bool | None = None, schema_filter: str | None = None, table_filter: str | None = None, order_pushdown: bool = False, catalog: bool = True,
        lazy_validation: bool = False, keys: dict[str, list[str]] | None = None, collations: dict[str, dict[str, str]] | None = None, ttl: float | None = None, secret: dict | None = None, url: str | None = None, **fields,
    ):
        """source: a folder, or for a server a connection string or URI (with `secret`, fields and `url` as connection.merge and Server take them)."""
        self.spark, self.name, self.source = spark, name, source.rstrip("/")
        remote = bool(url or secret or fields.get("host") or "=" in source or re.match(r"(mssql|sqlserver)://", source))
        if remote:
            said = {"schema_filter": schema_filter, "table_filter": table_filter, **fields}
            fields = connection.merge(said, secret, source or None)
            schema_filter, table_filter = fields.get("schema_filter"), fields.get("table_filter")
            order_pushdown = order_pushdown or str(fields.get("order_pushdown", "")).lower() == "true"
            catalog = catalog and str(fields.get("catalog", "true")).lower() != "false"
            lazy_validation = lazy_validation or str(fields.get("lazy_validation", "")).lower() == "true"
        self.server = Server(spark, fields, url) if remote else None
        self.read_only = (not store and not remote) if read_only is None else read_only
        self.visible = Filter(schema_filter, table_filter)
        self.order_pushdown, self.discovers, self.ttl = order_pushdown, catalog, settings["catalog_cache_ttl"] if ttl is None else ttl
        self.keys, self.collations = keys or {}, collations or {}
        self.store = Store(spark, self.source) if store else None
        self.cache: dict[tuple[str, str], Entry] = {}
        self.names: dict[str, tuple[float, list[str]]] = {}
        self.counts: dict[tuple[str, str], tuple[float, int]] = {}
        self.views: dict[str, Callable[[Catalog], DataFrame]] = {}
        self.temporary: dict[str, Meta] = {}
        self.counters = {"scans": 0, "queries": 0, "statements": 0, "metadata_reads": 0, "cache_hits": 0, "refreshes": 0, "rows_loaded": 0, "conflicts": 0, "timeouts": 0}
        self.txn = None
        if not lazy_validation:
            self._check()
        if store and not self.read_only:
            self.store.create_schema(DEFAULT_SCHEMA)

    def _check(self) -> None:
        """What an attach finds out at once: whether there is something at the other end."""
        if self.server:
            self.server.ping()
        elif not self.store and not Store(self.spark, self.source).files.exists(self.source):
            raise NotFound(f"catalog {self.name}: there is nothing at {self.source}")

    # -- names

    def resolve(self, name: str) -> tuple[str, str]:
        """(schema, table) of `table`, `schema.table` or `catalog.schema.table`, with [x], "x" or `x` around parts."""
        parts = [next(x for x in p if x) for p in re.findall(r"\[((?:[^\]]|\]\])+)\]|\"((?:[^\"]|\"\")+)\"|`((?:[^`]|``)+)`|([^.\[\]\"`]+)", name)]
        parts = [p.replace("]]", "]").replace('""', '"').replace("``", "`") for p in parts]
        if len(parts) == 3 and parts[0].lower() == self.name.lower():
            parts = parts[1:]
        if len(parts) == 1:
            parts = [DEFAULT_SCHEMA, *parts]
        if len(parts) != 2:
            raise NotFound(f"{name} is no table name of catalog {self.name}")
        return parts[0], parts[1]

    def writable(self, operation: str) -> Store:
        if self.read_only or self.store is None:
            raise ReadOnly(operation, self.name)
        return self.store

    def schema_names(self) -> list[str]:
        """All schemas there are, an open transaction's view of them."""
        names = self.server.schemas() if self.server else self.store.schemas() if self.store else [DEFAULT_SCHEMA]
        return [x for x in names if self.txn is None or self.txn.schemas.get(x, True)]

    def schemas(self) -> list[str]:
        self._needs_discovery()
        return [x for x in self.schema_names() if self.visible.sees_schema(x)]

    def stored_tables(self, schema: str) -> list[str]:
        staged = self.txn.staged if self.txn is not None else {}
        here = {t: not m.dropped for (s, t), m in staged.items() if s == schema}
        return sorted({t for t in self.store.tables(schema) if here.get(t, True)} | {t for t, there in here.items() if there})

    def table_names(self, schema: str = DEFAULT_SCHEMA) -> list[str]:
        self._needs_discovery()
        held = self.names.get(schema)
        if held and self.ttl and self.txn is None and time.monotonic() - held[0] < self.ttl:
            self.counters["cache_hits"] += 1
            return sorted(x for x in [*held[1], *self.views] if self.visible.sees(schema, x))
        self.counters["metadata_reads"] += 1
        if self.server:
            names = list(self.server.tables(schema, self.visible.table and self.visible.table.pattern))
        elif self.store:
            names = self.stored_tables(schema)
        else:
            files = Store(self.spark, self.source).files
            names = [x.removesuffix(".parquet") for x in files.names(self.source) if x.endswith(".parquet")]
        self.names[schema] = (time.monotonic(), names)
        return sorted(x for x in [*names, *self.views] if self.visible.sees(schema, x))

    def tables(self) -> DataFrame:
        """catalog, schema, name, kind, key, rows (null if unknown): one row for every visible table or view."""
        rows = []
        for s in self.schemas():
            for t in self.table_names(s):
                m = self.meta(s, t)
                kind = "view" if t in self.views or (m and m.sql) else "table"
                rows.append((self.name, s, t, kind, ",".join(self.key(f"{quote(s)}.{quote(t)}")), m.rows if m else None))
        return self.spark.createDataFrame(rows, "catalog string, schema string, name string, kind string, key string, rows bigint")

    def columns(self, name: str) -> DataFrame:
        """name, ordinal (from 1), type, remote_type, nullable, collation."""
        if self.server:
            known = [(n, k, null, None) for n, k, null in self.server.columns(*self.resolve(name))]
            types = [spark_type(k).simpleString() for _, k, _, _ in known]
        else:
            fields = self.table(name).schema.fields
            known = [(f.name, f.metadata.get("remote_type"), f.nullable, f.metadata.get("collation")) for f in fields]
            types = [f.dataType.simpleString() for f in fields]
        if settings["catalog_native_types"]:
            types = [k or t for (_, k, _, _), t in zip(known, types, strict=True)]
        rows = [(n, i, t, k, null, c) for i, ((n, k, null, c), t) in enumerate(zip(known, types, strict=True), 1)]
        return self.spark.createDataFrame(rows, "name string, ordinal int, type string, remote_type string, nullable boolean, collation string")

    def _needs_discovery(self) -> None:
        if not self.discovers:
            raise Refused(f"catalog {self.name} is attached for raw queries only")

    # -- metadata and its cache

    def meta(self, schema: str, table: str) -> Meta | None:
        """The table's current version, that of the open transaction first; None for what has none."""
        if self.txn is not None and (schema, table) in self.txn.staged:
            m = self.txn.staged[schema, table]
            return None if m.dropped else m
        if self.store is None:
            return None
        at = (schema.lower(), table.lower())
        held = self.cache.get(at)
        if held and not held.stale and self.ttl and time.monotonic() - held.read_at < self.ttl:
            self.counters["cache_hits"] += 1
            return held.meta
        self.counters["metadata_reads"] += 1
        meta = self.store.current(schema, table)
        self.cache[at] = Entry(meta, time.monotonic())
        return meta

    def version(self, schema: str, table: str) -> int:
        """The number that a new version comes after; 0: there has been no table of that name."""
        if self.txn is not None and (schema, table) in self.txn.after:
            return self.txn.after[schema, table]
        m = self.store.head(schema, table)
        return m.version if m else 0

    def state(self, name: str) -> str:
        """Of a table's metadata: NOT_LOADED, LOADED or STALE."""
        held = self.cache.get(tuple(x.lower() for x in self.resolve(name)))
        if held is None:
            return "NOT_LOADED"
        return "STALE" if held.stale or not self.ttl or time.monotonic() - held.read_at >= self.ttl else "LOADED"

    def refresh(self) -> int:
        """Forgets all metadata and reads it anew; the number of tables."""
        self.invalidate()
        self.counters["refreshes"] += 1
        return self.preload()

    def invalidate(self, schema: str | None = None, table: str | None = None) -> None:
        """Marks as stale what is known of one table, of a schema's, or of all; lists of names go as well."""
        for k, entry in self.cache.items():
            if (schema is None or k[0] == schema.lower()) and (table is None or k[1] == table.lower()):
                entry.stale = True
        for k in [k for k in self.names if schema is None or k.lower() == schema.lower()]:
            del self.names[k]
        self.counts = {k: v for k, v in self.counts.items() if (schema is not None and k[0].lower() != schema.lower()) or (table is not None and k[1].lower() != table.lower())}

    def preload(self, schema: str | None = None) -> int:
        n = 0
        for s in [schema] if schema else self.schemas():
            for t in self.table_names(s):
                self.meta(s, t)
                n += 1
        return n

    def key(self, name: str) -> list[str]:
        schema, table = self.resolve(name)
        if self.server:
            return self.server.key(schema, table)
        m = self.meta(schema, table)
        return list(m.key) if m else list(self.keys.get(table, []))

    def rows(self, name: str) -> int | None:
        """Row count: of the metadata, of the files' footers, or of the server; None with enable_statistics off. Counts are kept for statistics_cache_ttl_seconds."""
        if not settings["enable_statistics"]:
            return None
        schema, table = self.resolve(name)
        m = self.meta(schema, table)
        if m and not m.sql:
            return m.rows
        held = self.counts.get((schema, table))
        if held and time.monotonic() - held[0] < settings["statistics_cache_ttl_seconds"]:
            self.counters["cache_hits"] += 1
            return held[1]
        n = self.server.rows(schema, table) if self.server else self.table(name).count()
        self.counts[schema, table] = (time.monotonic(), n)
        return n

    def checksum(self, name: str) -> DataFrame:
        """column, sum (of 64-bit hashes of its values, as decimal; nulls count as one value): tells whether two tables hold the same."""
        df = self.table(name)
        sums = df.agg(*[F.sum(F.xxhash64(F.col(f"`{c}`")).cast("decimal(38,0)")).alias(f"s{i}") for i, c in enumerate(df.columns)])
        return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sum")) for i, c in enumerate(df.columns)])).alias("x")).select("x.*")

    def stats(self) -> DataFrame:
        """catalog, counter, value."""
        return self.spark.createDataFrame([(self.name, k, v) for k, v in self.counters.items()], "catalog string, counter string, value bigint")

    # -- reading

    def add_view(self, name: str, build: Callable[[Catalog], DataFrame]) -> None:
        """A view of this session."""
        self.views[name] = build

    def table(self, name: str, rowid: bool = False) -> DataFrame:
        """A table or view; rowid: with its primary key as a column `rowid`, a struct if it has several columns."""
        df, live = self._lazy(name, rowid)
        return self.server.here(df) if live else df

    def _lazy(self, name: str, rowid: bool = False) -> tuple[DataFrame, bool]:
        """table(), and whether it reads a server's table, whose rows may have to come by way of the driver."""
        schema, table = self.resolve(name)
        self.counters["scans"] += 1
        if self.discovers and not self.visible.sees(schema, table):
            raise NotFound(f"no table {name} in catalog {self.name}")
        if table in self.views or ((m := self.meta(schema, table)) and m.sql):
            if rowid:
                raise Refused(f"{name} is a view and has no rowid")
            return (self.views[table](self) if table in self.views else self.query(m.sql)), False
        if self.server:
            if table not in self.server.tables(schema):
                raise NotFound(f"no table {name} in catalog {self.name}")
            df = self.server.table(schema, table)
        elif self.store:
            if m is None:
                raise NotFound(f"no table {name} in catalog {self.name}")
            df = self.store.read(m)
        else:
            path = f"{self.source}/{table}.parquet"
            try:
                df = self.spark.read.parquet(path)
            except Exception as e:
                raise NotFound(f"no table {name} in catalog {self.name}") from e
        for c, collation in self.collations.get(table, {}).items():
            df = df.withColumn(c, F.collate(c, spark_name(collation)))
        for f in df.schema.fields:
            if (collation := f.metadata.get("collation")) and spark_name(collation) != "UTF8_BINARY":
                df = df.withColumn(f.name, F.collate(F.col(f"`{f.name}`"), spark_name(collation)).alias(f.name, metadata=f.metadata))
        return (df.withColumn("rowid", self.rowid(name)) if rowid else df), self.server is not None

    def rowid(self, name: str) -> Column:
        key = self.key(name)
        if not key:
            raise Refused(f"{name} has no primary key, so no rowid")
        return F.col(f"`{key[0]}`") if len(key) == 1 else F.struct(*[F.col(f"`{k}`") for k in key])

    def scan(self, name: str, columns: list[str] | None = None, where: predicates.Node | None = None, order: list[ordering.Key] | None = None, limit: int | None = None) -> DataFrame:
        """A scan as a server would be asked for it, and what that leaves to do here: `statement`'s text is run, then the rest of the filter, the sort and the limit."""
        df, live = self._lazy(name)
        columns = columns or df.columns
        _, rest = predicates.encode(where)
        push = self._push(order, limit, rest)
        needed = dict.fromkeys(columns)
        for p in rest:
            needed |= dict.fromkeys(predicates.names(p))
        if push.local_sort:
            needed |= dict.fromkeys(k.column for k in order or [])
        if self.server:  # a live one gets what Spark's own pushdown sends
            out = df.where(predicates.column(where)) if where is not None else df
            if live:
                out = self.server.here(out if order else out.select(*[f"`{c}`" for c in columns]))
        else:
            out = self.query(self.statement(name, list(needed), where, order, limit))
            for p in rest:
                out = out.where(predicates.column(p))
        if order and (push.local_sort or self.server):
            out = out.orderBy(*[k.column_of() for k in order])
        if limit is not None and (push.top is None or self.server):
            out = out.limit(limit)
        return out.select(*[f"`{c}`" for c in columns])

    def _push(self, order: list[ordering.Key] | None, limit: int | None, rest: list) -> ordering.Push:
        on = ordering.enabled(settings["order_pushdown"], self.order_pushdown)
        return ordering.plan(order or [], None if rest else limit, enabled=on)

    def statement(self, name: str, columns: list[str], where: predicates.Node | None = None, order: list[ordering.Key] | None = None, limit: int | None = None) -> str:
        """The SELECT that a live server would get for a scan."""
        schema, table = self.resolve(name)
        said, rest = predicates.encode(where)
        kinds = {n: k for n, k, _ in self.server.columns(schema, table)} if self.server else {}
        items = [remote.select_item(c, kinds[c]) if c in kinds else quote(c) for c in columns]
        return ordering.statement(schema, table, items, said, self._push(order, limit, rest))

    def physical(self, name: str) -> DataFrame:
        """kind (heap, columnstore, clustered), segments, rows of a stored table."""
        schema, table = self.resolve(name)
        m = self.meta(schema, table)
        rows = [(m.options.get("table_kind", "heap"), len(m.segments), m.rows)] if m and not m.sql else []
        return self.spark.createDataFrame(rows, "kind string, segments int, rows bigint")

    def by_rowid(self, name: str, value) -> DataFrame:
        return self.table(name).where(predicates.column(predicates.rowid_equals(self.key(name), value)))

    def query(self, sql: str) -> DataFrame:
        """Runs a statement, or several with one result set, over this catalog's tables; T-SQL forms are Spark's, see plans.dialect."""
        self.counters["queries"] += 1
        if self.server:
            return self.server.query(sql)
        results = []
        for part in dialect.split(sql):
            if re.match(r"\s*(SELECT|WITH|VALUES|FROM|\()", part, re.I):
                results.append(self._select(part))
            else:
                from ..operators.statements import execute

                execute(self, part)
        if len(results) > 1:
            raise Refused("the batch has more than one result set")
        if not results:
            raise Refused("the batch has no result set")
        return results[0]

    def _select(self, sql: str) -> DataFrame:
        """Tables are views for the time it takes Spark to look them up."""
        used: dict[str, DataFrame] = {}

        def view(parts: list[str]) -> str | None:
            try:
                schema, table = self.resolve(".".join("[" + p.replace("]", "]]") + "]" for p in parts))
                df = self.table(f"[{schema.replace(']', ']]')}].[{table.replace(']', ']]')}]")
            except EngineError:
                return None
            used[key := f"_t{uuid.uuid4().hex}"] = df
            return key

        bits = lambda: {f.name for df in used.values() for f in df.schema.fields if f.dataType.typeName() == "boolean"}
        text = dialect.spark_sql(sql, view, bits)
        for key, df in used.items():
            df.createTempView(key)
        try:
            return self.spark.sql(text)
        finally:
            for key in used:
                self.spark.catalog.dropTempView(key)

    def execute(self, sql: str) -> int:
        """Runs statements that return no rows; how many rows the last has changed. What runs longer than query_timeout seconds is cancelled."""
        from ..operators.statements import execute

        if self.read_only:
            raise ReadOnly("exec", self.name)
        self.counters["statements"] += 1
        n = 0
        for part in dialect.split(sql):
            n = self.server.execute(part) if self.server else self._timed(lambda part=part: execute(self, part))
            if settings["exec_invalidate_cache"] and re.match(r"\s*(CREATE|DROP|ALTER|TRUNCATE|RENAME|EXEC)\b", part, re.I):
                self.invalidate()
        return n

    def _timed(self, f):
        limit = settings["query_timeout"]
        if not limit:
            return f()
        tag, late = f"exec-{uuid.uuid4().hex}", []
        timer = threading.Timer(limit, lambda: late.append(1) or self.spark.sparkContext.cancelJobsWithTag(tag))
        self.spark.sparkContext.addJobTag(tag)
        timer.start()
        try:
            return f()
        except Exception as e:
            if late and not isinstance(e, EngineError):
                self.counters["timeouts"] += 1
                raise EngineError(f"the statement took more than query_timeout, {limit} s") from e
            raise
        finally:
            timer.cancel()
            self.spark.sparkContext.removeJobTag(tag)

    def drop_temporary(self, name: str) -> bool:
        """Drops `#t` or `##t`, with its data; whether there was one."""
        name = name.split(".")[-1].strip("[]`\"")
        m = self.temporary.pop(name, None)
        if m is None:
            return False
        self.views.pop(name, None)
        (self.spark.catalog.dropGlobalTempView if name.startswith("##") else self.spark.catalog.dropTempView)(name.strip("#"))
        for s in m.segments:
            self.store.drop_segment(s)
        return True

    def vacuum(self, keep_versions: int = 1, older_than: float = 3600) -> int:
        """Deletes data and versions that nothing refers to any more; how many things went."""
        if self.txn is not None:
            raise Refused("VACUUM in a transaction")
        n = self.writable("VACUUM").vacuum(keep_versions, older_than)
        self.invalidate()
        return n


def attach(spark: SparkSession, name: str, source: str = "", **options) -> Catalog:
    if name.lower() in _attached:
        raise Exists(f"catalog {name} is attached already")
    _attached[name.lower()] = c = Catalog(spark, name, source, **options)
    return c


def detach(name: str) -> None:
    """Forgets a catalog, its views and its cache; an open transaction is rolled back."""
    c = _attached.pop(name.lower(), None)
    if c is None:
        raise NotFound(f"catalog {name} is not attached")
    if c.txn is not None:
        c.txn.rollback()
    for t in list(c.temporary):
        c.drop_temporary(t)
    c.views.clear()
    c.cache.clear()


def attached() -> list[str]:
    return sorted(_attached)


def get(name: str) -> Catalog:
    if name.lower() not in _attached:
        raise NotFound(f"catalog {name} is not attached")
    return _attached[name.lower()]


def version() -> str:
    return VERSION
