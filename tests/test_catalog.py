import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.errors import Conflict, EngineError, Exists, NotFound, ReadOnly, Refused
from lakeferry.operators import ddl, dml, load, txn
from lakeferry.queries import attached, new_store
from lakeferry.sources import catalog, connection
from lakeferry.sources.visibility import Filter, to_sql
from lakeferry.streaming.cursor import Cursor


def test_attach_and_detach(spark, sf):
    c = catalog.attach(spark, "one", sf)
    with pytest.raises(Exists):
        catalog.attach(spark, "ONE", sf)
    assert catalog.get("one") is c and "one" in catalog.attached()
    catalog.detach("one")
    for f in (lambda: catalog.get("one"), lambda: catalog.detach("one"), lambda: catalog.attach(spark, "two", "/nowhere/at/all")):
        with pytest.raises(NotFound):
            f()


def test_names(spark, sf):
    c = attached(spark, sf)
    assert c.resolve("t") == ("dbo", "t") and c.resolve("[a.b].[c]]d]") == ("a.b", "c]d") and c.resolve('db."x y".z') == ("x y", "z")
    with pytest.raises(NotFound):
        c.table("nothing")
    with pytest.raises(NotFound):
        attached(spark, sf, table_filter="^nation$").table("region")
    with pytest.raises(Refused):
        attached(spark, sf, catalog=False).tables()
    assert attached(spark, sf, catalog=False).query("SELECT count(*) AS n FROM dbo.nation").first().n == 25


def test_filters_as_sql(duck):
    names = ["orders", "order_items", "Customer", "a_b", "axb", "x.y", "tmp1"]
    duck.execute("CREATE OR REPLACE TABLE names(name VARCHAR)")
    duck.executemany("INSERT INTO names VALUES (?)", [(n,) for n in names])
    for p in ("^order", "s$", "^(orders|customer)$", "a_b", "^a_b$", "^a.b$", "x\\.y", "or.*ms", "^tmp|mer$"):
        sql = to_sql(p, "name")
        sql = re.sub(r"\[(name)\]", r"\1", sql).replace("N'", "'")
        sql = re.sub(r"LIKE '([^']*)'", lambda m: "LIKE '" + re.sub(r"\[(.)\]", r"\\\1", m[1]) + "' ESCAPE '\\'", sql)
        assert {r[0] for r in duck.sql(f"SELECT name FROM names WHERE {sql}").fetchall()} == {n for n in names if re.search(p, n, re.I)}, p
    assert to_sql("[ab]c+", "name") is None
    with pytest.raises(EngineError):
        Filter("(")


def test_connection_strings():
    got = connection.parse("Server=tcp.host,1444;Initial Catalog=d;UID=u;Pwd='p;q';Encrypt=yes;Unknown=1")
    assert got == {"host": "tcp.host", "port": "1444", "database": "d", "user": "u", "password": "p;q", "use_encrypt": "yes"}
    assert connection.parse("x://a%40b:p%3A@h:1/d?schema_filter=^x")["user"] == "a@b"
    f = connection.merge({"user": "attach"}, {"user": "secret", "host": "s", "password": "p"}, "Server=text;Database=d")
    assert (f["user"], f["host"], f["password"]) == ("attach", "text", "p")
    assert connection.jdbc(f)[0] == "jdbc:sqlserver://text:1433;databaseName=d"
    for bad in ({}, {"host": "h"}, {"host": "h", "database": "d"}):
        with pytest.raises(EngineError):
            connection.jdbc(bad)


def test_targets_and_policies():
    assert load.target("c.s.t") == load.Target("c", "s", "t") and load.target("c.[a.b]") == load.Target("c", "dbo", "a.b")
    assert load.target("x://c/s/t") == load.Target("c", "s", "t") and load.target("c..#t").session and load.target("c..##t").shared
    for bad in ("t", "c..t", "x://c//t", ""):
        with pytest.raises(Refused):
            load.target(bad)
    assert load.table_lock("auto", "heap") and not load.table_lock("auto", "clustered") and load.table_lock("true", "columnstore")


def test_ddl(spark):
    c = new_store(spark)
    ddl.create_schema(c, "s")
    with pytest.raises(Exists):
        ddl.create_schema(c, "s")
    ddl.create_schema(c, "s", if_not_exists=True)
    assert ddl.create_table(c, "s.t", "a int, b string", ["a"]) and not ddl.create_table(c, "s.t", "x int", if_not_exists=True)
    with pytest.raises(Exists):
        ddl.create_table(c, "s.t", "x int")
    with pytest.raises(EngineError):
        ddl.drop_schema(c, "s")
    with pytest.raises(Refused):
        ddl.drop_column(c, "s.t", "a")
    ddl.rename_column(c, "s.t", "A", "k")
    assert c.key("s.t") == ["k"] and c.rows("s.t") == 0
    dml.insert(c, "s.t", spark.sql("SELECT 1, 'x' UNION ALL SELECT 2, NULL"))
    with pytest.raises(EngineError):
        ddl.set_nullable(c, "s.t", "b", False)
    ddl.set_nullable(c, "s.t", "k", False)
    with pytest.raises(Exception, match="no NULL"):
        dml.insert(c, "s.t", spark.sql("SELECT CAST(NULL AS INT), 'y'"))
    assert c.rows("s.t") == 2
    ddl.drop_table(c, "s.t")
    ddl.drop_table(c, "s.t", if_exists=True)
    with pytest.raises(NotFound):
        ddl.drop_table(c, "s.t")
    ddl.drop_schema(c, "s")
    for bad in ({"table_kind": "pile"}, {"data_compression": "zip"}, {"x": "y"}, {"table_kind": "clustered"}):
        with pytest.raises(Refused):
            ddl.table_options(bad)
    with pytest.raises(Refused):
        ddl.create_table(c, "p", "a int", partitioned_by=["a"])


def test_writes_touch_only_their_segments(spark):
    c = new_store(spark)
    ddl.create_table(c, "t", "k int, v string", ["k"])
    for lo in (0, 10, 20):
        dml.insert(c, "t", spark.range(lo, lo + 10).select(F.col("id").cast("int"), F.lit("a")))
    files = lambda: {f for m in [c.meta("dbo", "t")] for s in m.segments for f in c.store.data_files(s) if f not in m.gone.get(s, ())}
    before = files()
    assert dml.update(c, "t", {"v": F.lit("b")}, "k = 15") == 1
    assert len(before - files()) == 1 and c.rows("t") == 30
    assert dml.delete(c, "t", "k >= 25") == 5 and c.table("t").count() == c.rows("t") == 25
    assert dml.delete(c, "t", "k > 1000") == 0 and dml.update(c, "t", {"v": "upper(v)"}, "k IS NULL") == 0
    with pytest.raises(EngineError):
        dml.update_from(c, "t", spark.sql("SELECT 1 AS k, 'x' AS v UNION ALL SELECT 1, 'y'"))


def test_identity_and_defaults(spark):
    c = new_store(spark)
    c.execute("CREATE TABLE t (id INT IDENTITY(5, 5) PRIMARY KEY, a NVARCHAR(3), d INT DEFAULT 7)")
    assert c.execute("INSERT INTO t (a) VALUES ('abcdef'), ('x')") == 2
    c.execute("INSERT INTO t (a, d) VALUES (NULL, 1)")
    assert sorted(map(tuple, c.table("t").collect()), key=str) == [(10, "x", 7), (15, None, 1), (5, "abc", 7)]
    with pytest.raises(EngineError):
        c.execute("INSERT INTO t (id, a) VALUES (1, 'y')")


def test_load_rules(spark):
    c = new_store(spark)
    c.execute("CREATE TABLE t (i TINYINT, d DECIMAL(5,1), s VARCHAR(4), ts DATETIME2(0))")
    row = spark.sql("SELECT CAST(200 AS BIGINT) AS I, CAST(2.55 AS DECIMAL(9,2)) AS D, 'ééé' AS S, TIMESTAMP_NTZ'2024-12-31 23:59:59.5' AS TS, 1 AS extra")
    assert load.copy_to(c, row, "t", create_table=False) == 1
    got = c.table("t").first()
    assert (got.i, float(got.d), got.s, str(got.ts)) == (200, 2.6, "éé", "2025-01-01 00:00:00")
    with pytest.raises(Exception, match="range|OVERFLOW"):
        load.copy_to(c, spark.sql("SELECT 300 AS i"), "t")
    for bad in ("SELECT 'x' AS i", "SELECT INTERVAL 1 DAY AS s", "SELECT 1 AS other"):
        with pytest.raises(Refused):
            load.copy_to(c, spark.sql(bad), "t")
    with pytest.raises(NotFound):
        load.copy_to(c, row, "missing", create_table=False)
    assert c.rows("t") == 1
    with pytest.raises(NotFound):
        load.create_table_as(c, "nowhere.t", row)
    with pytest.raises(Exists):
        load.create_table_as(c, "t", row)


def test_transactions(spark):
    c = new_store(spark)
    ddl.create_table(c, "t", "k int", ["k"])
    with pytest.raises(ValueError), txn.begin(c):
        dml.insert(c, "t", spark.sql("SELECT 1"))
        assert c.table("t").count() == 1
        raise ValueError
    assert c.table("t").count() == 0
    with txn.begin(c):
        with pytest.raises(EngineError):
            txn.begin(c)
        load.copy_to(c, spark.sql("SELECT 1 AS k"), "t")
        load.create_table_as(c, "outside", spark.sql("SELECT 1 AS a"))
        dml.insert(c, "t", spark.sql("SELECT 2"))
    assert c.table("t").count() == 2
    t = txn.begin(c)
    dml.insert(c, "t", spark.sql("SELECT 3"))
    other = catalog.Catalog(spark, "other", c.source, store=True)
    dml.insert(other, "t", spark.sql("SELECT 4"))
    with pytest.raises(Conflict):
        t.commit()
    assert c.table("t").count() == 3


def test_several_tables_commit_at_once(spark):
    """Of two tables, a conflict in one leaves both; a reader sees neither before the commit."""
    c = new_store(spark)
    c.execute("CREATE TABLE a (k INT); CREATE TABLE b (k INT)")
    other = catalog.Catalog(spark, "other", c.source, store=True)
    t = txn.begin(c)
    c.execute("INSERT INTO a VALUES (1); INSERT INTO b VALUES (1)")
    other.execute("INSERT INTO b VALUES (2)")
    with pytest.raises(Conflict):
        t.commit()
    assert (other.table("a").count(), other.table("b").count(), c.rows("a"), c.rows("b")) == (0, 1, 0, 1)
    with txn.begin(c):
        c.execute("INSERT INTO a VALUES (1); INSERT INTO b VALUES (1); CREATE SCHEMA s; CREATE TABLE s.t (x INT)")
        assert other.table("a").count() == 0
    assert (other.table("a").count(), other.table("b").count(), other.schemas()) == (1, 2, ["dbo", "s"])
    with pytest.raises(ValueError), txn.begin(c):
        c.execute("CREATE SCHEMA u; DROP SCHEMA s CASCADE")
        assert c.schemas() == ["dbo", "u"]
        raise ValueError
    assert c.schemas() == ["dbo", "s"] and c.table("s.t").count() == 0
    # what a writer that broke off has left behind doesn't count
    m = c.store.current("dbo", "a")
    c.store.publish("dbo", "a", type(m)(**vars(m) | {"rows": 99, "txn": "never"}), m.version)
    assert catalog.Catalog(spark, "third", c.source, store=True).rows("a") == 1


def test_drop_and_make_again(spark):
    c = new_store(spark)
    c.execute("CREATE TABLE t (a INT); INSERT INTO t VALUES (1); DROP TABLE t; CREATE TABLE t (b INT, c INT)")
    assert c.table("t").columns == ["b", "c"] and c.table("t").count() == 0
    load.copy_to(c, spark.sql("SELECT 1 AS x"), "t", replace_table=True)
    load.create_table_as(c, "u", spark.sql("SELECT 2 AS y"))
    c.execute("DROP TABLE u; ALTER TABLE t RENAME TO u; INSERT INTO u VALUES (3)")
    assert sorted(r.x for r in c.table("u").collect()) == [1, 3] and c.table_names() == ["u"]
    c.execute("UPDATE u SET x = 1") if c.key("u") else None
    assert c.vacuum(older_than=0) > 0 and sorted(r.x for r in c.table("u").collect()) == [1, 3]


def test_temporary_tables(spark):
    c = new_store(spark)
    name = "#t" + c.source[-8:]
    assert load.copy_to(c, spark.sql("SELECT 1 AS a, 'x' AS b"), f"wh..{name}") == 1
    assert load.copy_to(c, spark.sql("SELECT 'y' AS B, 2 AS A"), f"wh..{name}") == 1
    assert sorted(map(tuple, c.table(f"[{name}]").collect())) == [(1, "x"), (2, "y")]
    assert load.copy_to(c, spark.sql("SELECT 3 AS a"), f"wh..{name}", truncate=True) == 1 and c.table(f"[{name}]").count() == 1
    ddl.drop_table(c, f"[{name}]")
    assert not c.temporary and not c.views


def test_settings_act(spark, sf):
    from lakeferry.settings import settings

    c = new_store(spark)
    c.ttl = 600
    c.execute("CREATE TABLE t (k INT PRIMARY KEY, v NVARCHAR(5))")
    try:
        c.refresh()
        settings["exec_invalidate_cache"] = True
        c.execute("CREATE TABLE u (k INT)")
        assert c.state("t") == "STALE"
        settings["enable_statistics"] = False
        assert attached(spark, sf).rows("nation") is None
        settings["catalog_native_types"] = False
        assert [r.type for r in c.columns("t").orderBy("ordinal").collect()] == ["int", "string"]
        settings["insert_use_returning_output"] = False
        c.execute("INSERT INTO t VALUES (1, 'a')")
        assert [tuple(r) for r in dml.insert(c, "t", spark.sql("SELECT 2, 'b'"), returning=True).collect()] == [(2, "b")]
        settings["query_timeout"] = 1
        slow = "SELECT 3, CAST(reflect('java.lang.Thread', 'sleep', CAST(4000 AS BIGINT)) AS STRING) FROM range(1)"
        with pytest.raises(EngineError, match="query_timeout"):
            c.execute(f"INSERT INTO t {slow}")
        assert c.counters["timeouts"] == 1
        settings["ctas_use_bcp"] = False
        settings["ctas_drop_on_failure"] = True
        with pytest.raises(Exception, match="no"):
            load.create_table_as(c, "bad", spark.sql("SELECT raise_error('no') AS x"))
        assert "bad" not in c.table_names()
    finally:
        for k in ("exec_invalidate_cache", "enable_statistics", "catalog_native_types", "insert_use_returning_output", "query_timeout", "ctas_use_bcp", "ctas_drop_on_failure"):
            settings.reset(k)


def test_a_live_server(spark):
    """An embedded database stands for the server: attach, metadata, messages, errors with numbers, refusals."""
    url = "jdbc:derby:memory:t1"
    with pytest.raises(EngineError):
        catalog.attach(spark, "nolive", url=url)
    c = catalog.attach(spark, "live", url=url + ";create=true", user="u", password="p")
    c.execute('CREATE TABLE APP.T (A INT NOT NULL, B VARCHAR(5) NOT NULL, C DECIMAL(9,2), PRIMARY KEY (B, A))')
    assert c.execute("INSERT INTO APP.T VALUES (1, 'x', 2.5), (2, 'y', NULL)") == 2 and c.rows("APP.T") == 2
    assert c.key("APP.T") == ["B", "A"] and c.query("SELECT A FROM APP.T WHERE C > 1").first()[0] == 1
    assert [(r.name, r.remote_type, r.nullable) for r in c.columns("APP.T").orderBy("ordinal").collect()] == [("A", "int", False), ("B", "varchar(5)", False), ("C", "decimal(9,2)", True)]
    assert c.table("APP.T", rowid=True).where("C is null").first().rowid == ("y", 2)
    assert dml.insert(c, "APP.T", spark.sql("SELECT 3, 'z', CAST(1 AS DECIMAL(9,2))")) == 1 and load.copy_to(c, spark.sql("SELECT 4 AS a, 'w' AS b"), "APP.T") == 1
    assert c.table("APP.T").count() == 4
    c.execute("CREATE VIEW APP.V AS SELECT A FROM APP.T")
    for f in (lambda: load.copy_to(c, spark.sql("SELECT 1 AS A"), "APP.V"), lambda: dml.insert(c, "APP.V", spark.sql("SELECT 1"))):
        with pytest.raises(Refused):
            f()
    with pytest.raises(EngineError) as e:
        c.execute("INSERT INTO APP.NOTHING VALUES (1)")
    assert e.value.number and not e.value.fatal
    c.execute("DELETE FROM APP.T WHERE A > 100")
    assert any("No row" in m for m in c.server.messages)
    assert c.statement("APP.T", ["A"]) == "SELECT [A] FROM [APP].[T]"
    catalog.detach("live")


def test_read_only_and_cache(spark, sf):
    ro = attached(spark, sf)
    for f in (lambda: ddl.create_schema(ro, "x"), lambda: ro.execute("DELETE FROM nation"), lambda: load.copy_to(ro, spark.range(1), "t")):
        with pytest.raises(ReadOnly, match="db"):
            f()
    c = new_store(spark)
    c.ttl = 1000
    ddl.create_table(c, "t", "a int")
    c.refresh()
    n = c.counters["cache_hits"]
    c.table("t")
    assert c.counters["cache_hits"] == n + 1
    c.invalidate("dbo", "t")
    assert c.state("t") == "STALE" and c.preload() == 1 and c.state("t") == "LOADED" and c.stats().count() == len(c.counters) == 9


def test_statistics_view_and_cursor(spark, sf):
    c = attached(spark, sf)
    assert c.rows("nation") == 25
    with Cursor(c.table("lineitem").select("l_orderkey"), 1000) as cur:
        sizes = [len(x) for x in cur]
    assert sum(sizes) == c.rows("lineitem") and max(sizes) == 1000
    first = next(iter(Cursor(c.table("customer"))))
    assert isinstance(first[0].c_custkey, int)


def test_composite_key_and_remote_columns(spark):
    c = new_store(spark)
    ddl.create_table(c, "[odd name]", T.StructType([T.StructField("a b", T.IntegerType()), T.StructField("c]d", T.StringType())]), ["a b", "c]d"])
    dml.insert(c, "[odd name]", spark.sql("SELECT 1, 'x'"))
    assert c.table("[odd name]", rowid=True).first().rowid == (1, "x")
    assert c.by_rowid("[odd name]", (1, "x")).count() == 1
    assert ddl.remote_schema([("a", "money"), ("b", "bit")]).simpleString() == "struct<a:decimal(19,4),b:boolean>"
    assert [r.remote_type for r in c.columns("[odd name]").orderBy("ordinal").collect()] == ["int", "nvarchar(max)"]
