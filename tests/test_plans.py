import datetime as dt

import pytest

from lakeferry.plans.ordering import Key, Push, enabled, plan, statement
from lakeferry.plans.predicates import DEPTH, col, column, encode, fn, lit, node, rowid_equals


def test_text_of_each_form():
    said = lambda p: encode(p)[0]
    assert said(node("=", col("a]b"), lit("x'y"))) == "([a]]b] = N'x''y')"
    assert said(node("and", node("null", col("a")), node("not", node("notnull", col("b"))))) == "([a] IS NULL) AND (NOT ([b] IS NOT NULL))"
    assert said(node("or", col("f", "bit"), node("in", col("a"), 1, 2))) == "(([f] = 1) OR ([a] IN (1, 2)))"
    assert said(node("between", col("a"), lit(1), lit(2), True, False)) == "([a] >= 1 AND [a] < 2)"
    assert said(node("between", col("a"), lit(1), lit(2), True, True)) == "([a] BETWEEN 1 AND 2)"
    assert said(node("=", node("case", (col("f", "bit"), lit(1)), lit(0)), lit(1))) == "((CASE WHEN ([f] = 1) THEN 1 ELSE 0 END) = 1)"
    assert said(node("like", "contains", col("a"), "10%_[x", False)) == "([a] LIKE N'%10[%][_][[]x%')"
    assert said(node("like", "prefix", col("a"), "Ab", True)) == "(LOWER([a]) LIKE LOWER(N'Ab%'))"
    assert said(node(">", fn("year", col("d")), lit(1990))) == "(YEAR([d]) > 1990)"
    assert said(node("=", col("d"), lit(dt.date(2024, 2, 29)))) == "([d] = '2024-02-29')"


@pytest.mark.parametrize("p", [node("=", fn("length", col("s")), lit(3)), node(">", fn("/", col("n"), lit(2)), lit(1)), node("=", fn("%", col("x", "float"), lit(2)), lit(1)), node("in", col("a")), node("like", "prefix", col("a"), None, False)])
def test_what_stays_local(p):
    assert encode(node("and", node("=", col("a"), lit(1)), p)) == ("([a] = 1)", [p])
    assert encode(node("or", node("=", col("a"), lit(1)), p))[0] == ""


def test_depth_has_a_limit():
    p = node("=", col("a"), lit(1))
    for _ in range(DEPTH + 1):
        p = node("not", p)
    assert encode(p) == ("", [p])


def test_rowid():
    assert encode(rowid_equals(["a"], 5))[0] == "([a] = 5)"
    assert encode(rowid_equals(["a", "b"], {"a": 1, "b": "x"}))[0] == "([a] = 1) AND ([b] = N'x')"


def test_text_and_column_agree(spark, duck):
    """The remote text, run elsewhere, keeps the rows that the column keeps."""
    rows = [(i, ["Apple", "apple", "a%b", None, "x_y", "[z"][i % 6], float(i) / 2 if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "n int, s string, x double")
    duck.execute("CREATE OR REPLACE TABLE mine(n INTEGER, s VARCHAR, x DOUBLE)")
    duck.executemany("INSERT INTO mine VALUES (?, ?, ?)", rows)
    cases = [node("or", node(">", col("n"), lit(50)), node("=", col("s"), lit("Apple"))), node("not", node("between", col("n"), lit(3), lit(55), False, True)), node("in", fn("lower", col("s")), "apple"), node("=", fn("%", fn("*", col("n"), lit(3)), lit(7)), lit(2)), node("null", col("x"))]
    for p in cases:
        sql = encode(p)[0].replace("[", '"').replace("]", '"').replace("N'", "'")
        assert sorted(r[0] for r in duck.sql(f"SELECT n FROM mine WHERE {sql}").fetchall()) == sorted(r.n for r in df.where(column(p)).collect())


def test_order_gates():
    a, b = Key("a", nullable=False), Key("b", descending=True, nulls_first=True)
    assert plan([a], 10) == Push("[a] ASC", 10, False)
    assert plan([a], 10, offset=2) == Push("[a] ASC", None, False)
    assert plan([a, b], 10) == Push("[a] ASC", None, True)  # DESC NULLS FIRST isn't the remote's order
    assert plan([Key("b", True, False)], 3).top == 3 and plan([Key("b", False, True)], 3).top == 3
    assert plan([Key("d", function="year", nullable=False)], 1).order_by == "YEAR([d]) ASC"
    assert plan([Key("d", function="length")]).order_by == "" and plan([a], 1, enabled=False) == Push("", None, True)
    assert enabled(True, False) and enabled(False, True) and not enabled(False, False)
    assert statement("dbo", "t", ["[a]"], "([a] > 1)", plan([a], 5)) == "SELECT TOP 5 [a] FROM [dbo].[t] WHERE ([a] > 1) ORDER BY [a] ASC"


def test_scans_push_filters_and_prune_columns(spark, sf):
    from lakeferry.queries import attached

    df = attached(spark, sf).scan("lineitem", ["l_orderkey"], node(">", col("l_quantity"), lit(49.0)))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,49.0)" in text and "l_extendedprice" not in text


def test_text_that_nothing_may_touch():
    """Tables are renamed in table positions alone."""
    from lakeferry.errors import Refused
    from lakeferry.plans.dialect import spark_sql, split

    said = lambda q: " ".join(spark_sql(q, lambda p: "v_" + "_".join(p)).split())
    assert said("SELECT 'from a, b' FROM a") == "SELECT 'from a, b' FROM `v_a` AS `a`"
    assert said("SELECT x FROM [a b].[c]]d] AS q -- FROM z") == "SELECT x FROM `v_a b_c]d` AS q -- FROM z"
    assert said("SELECT a[0], b['k'], [c], (d)[1] FROM t") == "SELECT a[0], b['k'], `c`, (d)[1] FROM `v_t` AS `t`"
    assert said("WITH t AS (SELECT 1 AS x) SELECT * FROM t, dbo.t u") == "WITH t AS (SELECT 1 AS x) SELECT * FROM t, `v_dbo_t` u"
    assert said("SELECT trim(BOTH 'x' FROM y), extract(DAY FROM z) FROM range(3)") == "SELECT trim(BOTH 'x' FROM y), extract(DAY FROM z) FROM range(3)"
    assert said("SELECT TOP 3 a FROM t ORDER BY (SELECT TOP 1 b FROM u)") == "SELECT a FROM `v_t` AS `t` ORDER BY (SELECT b FROM `v_u` AS `u` LIMIT 1 ) LIMIT 3"
    assert said("SELECT a FROM t WHERE b LIKE 'x[%]y\\z' AND c LIKE N'[^a]_'") == r"SELECT a FROM `v_t` AS `t` WHERE b LIKE 'x\\%y\\\\z' AND c RLIKE '\\A[^a](?s:.)\\z'"
    assert split("SELECT ';' AS [a;b]; -- x;y\nSELECT 2") == ["SELECT ';' AS [a;b]", "SELECT 2"]
    for bad in ("SELECT 'x", "SELECT [a", "SELECT TOP 3 WITH TIES a FROM t"):
        with pytest.raises(Refused):
            spark_sql(bad)
