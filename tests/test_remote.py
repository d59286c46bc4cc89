import pytest

from lakeferry.errors import EngineError, Refused
from lakeferry.plans import remote
from lakeferry.plans.ordering import Key
from lakeferry.plans.predicates import col, lit, node
from lakeferry.settings import DEFAULTS, Settings, settings


@pytest.fixture
def free():
    yield settings
    for k in DEFAULTS:
        settings.reset(k)


def test_settings():
    s = Settings()
    assert len(DEFAULTS) == 40 and s["copy_flush_rows"] == 102400
    s["order_pushdown"] = "true"
    s["copy_tablock"] = "FALSE"
    assert s["order_pushdown"] is True
    for k, v in (("nothing", 1), ("copy_flush_rows", -1), ("copy_flush_rows", "x"), ("default_table_kind", "pile"), ("utf8_support", 1)):
        with pytest.raises(EngineError):
            s[k] = v


def test_select_list(free):
    assert remote.select_item("g", "geometry") == "[g].STAsBinary() AS [g]"
    assert remote.select_item("a", "int") == "[a]" and remote.select_item("a", "nvarchar(10)") == "[a]"
    assert remote.select_item("a", "ntext") == "CAST([a] AS NVARCHAR(MAX)) AS [a]" == remote.select_item("a", "hierarchyid")
    assert remote.select_item("a", "image") == "CAST([a] AS VARBINARY(MAX)) AS [a]"
    assert remote.select_item("a", "varchar(4000)") == "CAST([a] AS NVARCHAR(4000)) AS [a]" and remote.select_item("a", "char(5000)") == "CAST([a] AS NVARCHAR(MAX)) AS [a]"
    assert remote.select_item("a", "varchar(10)", "Latin1_General_100_CI_AS_SC_UTF8") == "[a]"
    free["convert_varchar_max"] = False
    assert remote.select_item("a", "varchar(max)") == "[a]"


def test_text_policy(free):
    assert remote.text_type() == "NVARCHAR(MAX)" and remote.text_type(length=9) == "NVARCHAR(9)"
    free["ctas_text_type"] = "VARCHAR"
    assert remote.text_type() == "VARCHAR(MAX) COLLATE Latin1_General_100_BIN2_UTF8"
    with pytest.raises(Refused):
        remote.text_type("Latin1_General_CI_AS")


def test_inserts(free):
    free["insert_batch_size"] = 2
    got = list(remote.insert_statements("[t]", ["a", "b]"], [(1, "x"), (2, None), (3, "y'")], returning=True))
    assert got == ["INSERT INTO [t] ([a], [b]]]) OUTPUT INSERTED.* VALUES (1, N'x'), (2, NULL)", "INSERT INTO [t] ([a], [b]]]) OUTPUT INSERTED.* VALUES (3, N'y''')"]
    free["insert_batch_size"] = 1000
    free["insert_max_sql_bytes"] = 60
    assert len(list(remote.insert_statements("[t]", ["a"], [("x" * 20,)] * 3))) == 3
    with pytest.raises(EngineError):
        list(remote.insert_statements("[t]", ["a"], [("x" * 60,)]))


def test_updates_and_deletes(free):
    assert list(remote.update_statements("[t]", ["k"], ["c"], [(1, "x")])) == ["UPDATE t SET t.[c] = v.[c0] FROM [t] AS t JOIN (VALUES (1, N'x')) AS v([k0], [c0]) ON t.[k] = v.[k0]"]
    assert list(remote.delete_statements("[t]", ["k", "l"], [(1, 2)])) == ["DELETE t FROM [t] AS t JOIN (VALUES (1, 2)) AS v([k0], [k1]) ON t.[k] = v.[k0] AND t.[l] = v.[k1]"]
    assert remote.batch_rows(3) == 500 and remote.batch_rows(10) == 200 and remote.batch_rows(9999) == 1
    assert len(list(remote.delete_statements("[t]", ["k"], [(i,) for i in range(1001)]))) == 3
    for f in (lambda: remote.update_statements("[t]", [], ["c"], []), lambda: remote.update_statements("[t]", ["k"], ["k"], []), lambda: remote.delete_statements("[t]", [], []), lambda: remote.update_statements("[t]", ["k"], ["x"], [(1, "<" * 5000)], xml=("x",))):
        with pytest.raises(Refused):
            list(f())


def test_scan_statement(spark, sf):
    from lakeferry.queries import attached

    c = attached(spark, sf, order_pushdown=True)
    where = node("and", node(">", col("a"), lit(1)), node("=", node("fn", "length", col("s")), lit(2)))
    assert c.statement("t", ["a"], where, [Key("a", nullable=False)], 5) == "SELECT [a] FROM [dbo].[t] WHERE ([a] > 1) ORDER BY [a] ASC"  # a limit before the rest of the filter would lose rows
    assert c.statement("t", ["a"], where.args[0], [Key("a", nullable=False)], 5) == "SELECT TOP 5 [a] FROM [dbo].[t] WHERE ([a] > 1) ORDER BY [a] ASC"
    assert "ORDER" not in attached(spark, sf).statement("t", ["a"], order=[Key("a")], limit=5)


def test_physical_and_timeout(spark):
    from lakeferry.operators import ddl, dml
    from lakeferry.queries import new_store
    from lakeferry.streaming.cursor import Cursor

    c = new_store(spark)
    ddl.create_table(c, "t", "a int", options={"clustered_index": "a"})
    dml.insert(c, "t", spark.sql("SELECT 1"))
    assert tuple(c.physical("t").first()) == ("clustered", 1, 1)
    cursor = Cursor(spark.range(5), timeout=100)
    assert sum(map(len, cursor)) == 5
    cursor.cancel()
    assert list(Cursor(spark.range(0))) == []
    slow = spark.range(1).selectExpr("reflect('java.lang.Thread', 'sleep', CAST(5000 AS BIGINT)) AS x")
    with pytest.raises(Exception, match="cancel"):
        list(Cursor(slow, timeout=1))
