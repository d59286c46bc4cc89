"""A live server behind JDBC: its metadata, scans that Spark pushes filters, projections and top-n into, statements and their messages.

Any JDBC driver on the session's class path will do; `url` is its form of an address (fields in braces), by default that of the T-SQL server.

An embedded database lives in the driver's process, and executors elsewhere can't reach it. There, rows go by way of the driver, CHUNK at a time:
a read is done when it is asked for, with the filters and columns that Spark pushes, and is a copy from then on; a load is computed by
the executors into the shared folder, and written from there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from ..errors import EngineError
from ..functions.literals import literal
from ..session import Files, fresh_dir
from ..settings import settings
from . import connection
from .visibility import to_sql

#: Other names of types in JDBC's metadata.
_TYPES = {"integer": "int", "double": "float", "double precision": "float", "boolean": "bit", "character": "char", "timestamp": "datetime2", "clob": "ntext", "blob": "image", "long varchar": "ntext"}
_SYSTEM = ("sys", "information_schema", "guest")
#: Databases in the process that opens them, as their addresses tell.
_EMBEDDED = re.compile(r"jdbc:(derby:(?!//)|h2:(?!tcp:|ssl:)|hsqldb:(?!hsqls?:|https?:)|sqlite:|duckdb:)", re.I)
#: Rows that the driver holds at once on their way from or to such a database.
CHUNK = 10_000


class Server:
    def __init__(self, spark: SparkSession, fields: dict, url: str | None = None):
        self.spark, self.fields = spark, fields
        self.url, self.props = connection.jdbc(fields, url) if url else connection.jdbc(fields)
        #: Texts that statements have printed, and warnings; kept, never shown.
        self.messages: list[str] = []
        #: Whether rows must go by way of the driver.
        self.inside = bool(_EMBEDDED.match(self.url)) and spark.sparkContext.master.split("[")[0] != "local"
        #: Plan of the last read done that way.
        self.scanned = ""

    def _connect(self):
        props = self.spark._jvm.java.util.Properties()
        for k, v in self.props.items():
            props.setProperty(k, v)
        manager = self.spark._jvm.java.sql.DriverManager
        manager.setLoginTimeout(settings["connection_timeout"])
        return self._told(lambda: manager.getConnection(self.url, props))

    def _told(self, f):
        """f(); what the server complains of as an EngineError with the server's number."""
        try:
            return f()
        except Exception as e:
            cause = getattr(e, "java_exception", None)
            if cause is None:
                raise
            number = cause.getErrorCode() if hasattr(cause, "getErrorCode") and "SQL" in cause.getClass().getName() else 0
            severity = 20 if str(getattr(cause, "getSQLState", lambda: "")() or "").startswith("08") else 16
            raise EngineError(str(cause.getMessage()), number, severity) from e

    def _rows(self, ask, *names: str) -> list[tuple]:
        """Columns `names` of what ask(java.sql.DatabaseMetaData) finds."""
        con = self._connect()
        try:
            found, out = ask(con.getMetaData()), []
            while found.next():
                out.append(tuple(found.getString(n) for n in names))
            return out
        finally:
            con.close()

    def ping(self) -> bool:
        con = self._connect()
        try:
            return con.isValid(settings["attach_validation_timeout"] or settings["connection_timeout"])
        finally:
            con.close()

    def schemas(self) -> list[str]:
        return sorted(x for (x,) in self._rows(lambda m: m.getSchemas(), "TABLE_SCHEM") if x.lower() not in _SYSTEM and not x.lower().startswith(("db_", "sys")))

    def tables(self, schema: str, pattern: str | None = None) -> dict[str, str]:
        """Name -> table or view; pattern: a filter that a T-SQL server applies itself where it can say it."""
        if "sqlserver" in self.url:
            where = f"TABLE_SCHEMA = {literal(schema)}" + (f" AND {said}" if pattern and (said := to_sql(pattern, "TABLE_NAME")) else "")
            found = self.query(f"SELECT TABLE_NAME, TABLE_TYPE FROM INFORMATION_SCHEMA.TABLES WHERE {where}").collect()
            return {r[0]: "view" if r[1] == "VIEW" else "table" for r in found}
        kinds = self.spark.sparkContext._gateway.new_array(self.spark._jvm.java.lang.String, 2)
        kinds[0], kinds[1] = "TABLE", "VIEW"
        return {n: k.lower() for n, k in self._rows(lambda m: m.getTables(None, schema, "%", kinds), "TABLE_NAME", "TABLE_TYPE")}

    def columns(self, schema: str, table: str) -> list[tuple[str, str, bool]]:
        """(name, remote type, nullable) in order."""
        found = self._rows(lambda m: m.getColumns(None, schema, table, "%"), "COLUMN_NAME", "TYPE_NAME", "COLUMN_SIZE", "DECIMAL_DIGITS", "IS_NULLABLE")
        out = []
        for name, kind, size, digits, null in found:
            kind = _TYPES.get(kind.lower(), kind.lower())
            if kind in ("decimal", "numeric"):
                kind += f"({size},{digits})"
            elif kind in ("char", "varchar", "nchar", "nvarchar", "binary", "varbinary"):
                kind += f"({size})" if int(size) <= 8000 else "(max)"
            out.append((name, kind, null != "NO"))
        return out

    def key(self, schema: str, table: str) -> list[str]:
        found = self._rows(lambda m: m.getPrimaryKeys(None, schema, table), "KEY_SEQ", "COLUMN_NAME")
        return [n for _, n in sorted((int(i), n) for i, n in found)]

    def rows(self, schema: str, table: str) -> int:
        return self.query(f'SELECT count(*) AS "n" FROM {self.named(schema, table)}').first()[0]

    def named(self, schema: str, table: str) -> str:
        q = lambda x: '"' + x.replace('"', '""') + '"'
        return f"{q(schema)}.{q(table)}"

    def _reader(self):
        reader = self.spark.read.format("jdbc").options(**self.props).option("url", self.url).option("queryTimeout", settings["query_timeout"])
        return reader.option("pushDownLimit", "true").option("pushDownOffset", "true").option("pushDownAggregate", "true")

    def table(self, schema: str, name: str, split_by: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16) -> DataFrame:
        """Lazy, so for `here`. split_by: a numeric column whose range `bounds` is read by `parts` tasks at once, connection_limit at most."""
        reader = self._reader().option("dbtable", self.named(schema, name))
        if split_by and bounds:
            parts = min(parts, settings["connection_limit"] or parts)
            reader = reader.option("partitionColumn", f'"{split_by}"').option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
        return reader.load()

    def query(self, sql: str) -> DataFrame:
        """A statement run as it stands; its columns come from the server's description of the result."""
        return self.here(self._told(lambda: self._reader().option("query", sql).load()))

    def here(self, df: DataFrame) -> DataFrame:
        """df, of this server's tables and without a shuffle; where executors can't compute it, a copy: in the plan, or if it is long, in the shared folder."""
        if not self.inside:
            return df
        execution, schema = df._jdf.queryExecution(), df._jdf.schema()
        self.scanned = execution.executedPlan().toString()
        local = lambda rows: DataFrame(self.spark._jsparkSession.createDataFrame(rows, schema), self.spark)
        chunks = self._computed(execution.toRdd(), schema)
        first, more = next(chunks, self.spark._jvm.java.util.ArrayList()), next(chunks, None)
        if more is None:
            return local(first)
        folder = fresh_dir(self.spark, "scan")
        names = [f"c{i}" for i in range(len(df.columns))]  # whatever the columns' names are
        for rows in (first, more):
            local(rows).toDF(*names).write.mode("append").parquet(folder)
        for rows in chunks:
            local(rows).toDF(*names).write.mode("append").parquet(folder)
        copy = self.spark.read.schema(local(first).toDF(*names).schema).parquet(folder)
        return copy.toDF(*df.columns)

    def _computed(self, rdd, schema) -> Iterator:
        """Lists of an RDD's rows, computed in this process."""
        jvm = self.spark._jvm
        context_of = getattr(getattr(jvm.org.apache.spark, "TaskContext$"), "MODULE$")
        as_row = jvm.org.apache.spark.sql.catalyst.CatalystTypeConverters.createToScalaConverter(schema)
        for part in rdd.partitions():
            context = context_of.empty()
            try:
                groups = self._told(lambda part=part, context=context: rdd.iterator(part, context)).map(as_row).grouped(CHUNK)
                while self._told(groups.hasNext):
                    yield jvm.scala.jdk.javaapi.CollectionConverters.asJava(groups.next())
            finally:
                context.markTaskCompleted(jvm.scala.Option.empty())  # closes the connection

    def execute(self, sql: str) -> int:
        """Rows changed; what the server prints goes to `messages`."""
        con = self._connect()
        try:
            st = con.createStatement()
            st.setQueryTimeout(settings["query_timeout"])
            self._told(lambda: st.execute(sql))
            n, said = st.getUpdateCount(), st.getWarnings()
            while said is not None:
                self.messages.append(str(said.getMessage()))
                said = said.getNextWarning()
            return max(0, n)
        finally:
            con.close()

    def write(self, df: DataFrame, schema: str, name: str, mode: str = "append", batch: int = 102_400, truncate: bool = False) -> None:
        """Each partition by a connection of its own, connection_limit at once."""
        options = self.props | {"url": self.url, "dbtable": self.named(schema, name), "batchsize": str(batch or 102_400)}
        options |= {"numPartitions": str(settings["connection_limit"] or 64), "truncate": str(truncate).lower()}
        save = lambda rows: rows.write.format("jdbc").options(**options).mode(mode).save()
        if not self.inside:
            return save(df)
        folder, names = fresh_dir(self.spark, "load"), [f"c{i}" for i in range(len(df.columns))]
        files = Files(self.spark)
        try:
            df.toDF(*names).write.option("maxRecordsPerFile", CHUNK).parquet(folder)
            save(df.limit(0))  # makes, empties or drops the table as mode says
            staged = self.spark.read.schema(df.toDF(*names).schema)
            for file in files.names(folder):
                if file.endswith(".parquet"):
                    self._insert(staged.parquet(f"{folder}/{file}"), df, options)
        finally:
            files.delete(folder)

    def _insert(self, rows: DataFrame, like: DataFrame, options: dict[str, str]) -> None:
        """A few rows, written by this process as Spark's tasks would; like: their names and types."""
        jvm = self.spark._jvm
        utils = jvm.org.apache.spark.sql.execution.datasources.jdbc
        said = utils.JdbcOptionsInWrite(jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(options))
        dialect, types = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url), like._jdf.schema()
        con = self._connect()
        try:
            there = utils.JdbcUtils.getSchemaOption(con, said)
        finally:
            con.close()
        cases = self.spark.conf.get("spark.sql.caseSensitive") == "true"
        insert = utils.JdbcUtils.getInsertStatement(options["dbtable"], types, there, cases, dialect)
        held = jvm.scala.jdk.javaapi.CollectionConverters.asScala(rows._jdf.collectAsList().iterator())
        context_of = getattr(getattr(jvm.org.apache.spark, "TaskContext$"), "MODULE$")
        context_of.setTaskContext(context_of.empty())  # where the writer counts its rows
        try:
            self._told(lambda: utils.JdbcUtils.savePartition(options["dbtable"], held, types, insert, int(options["batchsize"]), dialect, said.isolationLevel(), said))
        finally:
            context_of.unset()
