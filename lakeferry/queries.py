"""Registered queries of the engine proper, each with SQL that gives the same rows from the same Parquet files."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import EngineError
from .functions import convert
from .functions.collation import collate
from .functions.literals import literal
from .operators import ddl, dml, load, txn
from .plans.ordering import Key
from .plans.predicates import cast, col, encode, fn, lit, node
from .session import fresh_dir, prepare
from .settings import settings
from .sources.catalog import Catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Primary keys of the attached tables.
KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"], "events": ["event_id"], "conversations": ["conv_id", "turn"]}


def attached(spark: SparkSession, sf_dir: str, **options) -> Catalog:
    """The folder as a read-only catalog `db`, under no name that others could hold."""
    return Catalog(prepare(spark), "db", sf_dir, lazy_validation=True, keys=KEYS, **options)


def new_store(spark: SparkSession) -> Catalog:
    return Catalog(prepare(spark), "wh", fresh_dir(spark, "store"), store=True)


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# -- scans, aggregates, order


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge, round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL ORDER BY 1, 2")
def q1_pricing_summary(spark, sf_dir):
    li = attached(spark, sf_dir).table("db.dbo.lineitem").where(F.col("l_shipdate") <= F.lit(dt.datetime(1998, 9, 2)))
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    out = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"), F.round(F.sum(price), 2).alias("sum_disc_price"), F.round(F.sum(price * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("count_order"),
    )
    return out.orderBy("l_returnflag", "l_linestatus")


@query("SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1994-01-01' AND l_shipdate < TIMESTAMP '1995-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24")
def q6_revenue(spark, sf_dir):
    where = node("and", node("between", col("l_shipdate"), lit(dt.datetime(1994, 1, 1)), lit(dt.datetime(1995, 1, 1)), True, False), node("between", col("l_discount"), lit(0.05), lit(0.07), True, True), node("<", col("l_quantity"), lit(24.0)))
    return attached(spark, sf_dir).scan("lineitem", where=where).agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("revenue"))


@query("SELECT count(*) AS n, count(DISTINCT l_returnflag || l_linestatus) AS kinds FROM lineitem")
def scan_two_columns(spark, sf_dir):
    return attached(spark, sf_dir).scan("lineitem", ["l_returnflag", "l_linestatus"]).agg(F.count("*").alias("n"), F.count_distinct(F.concat("l_returnflag", "l_linestatus")).alias("kinds"))


@query("SELECT count(*) AS n FROM lineitem")
def scan_zero_columns(spark, sf_dir):
    return attached(spark, sf_dir).table("lineitem").agg(F.count("*").alias("n"))


@query("SELECT * FROM lineitem")
def scan_full(spark, sf_dir):
    return attached(spark, sf_dir).table("dbo.lineitem")


def _filter(name: str, table: str, columns: list[str], where, sql: str, extra=None):
    """A scan whose filter goes as text, but for what its name calls residual."""

    def run(spark, sf_dir):
        c = attached(spark, sf_dir)
        if extra is not None:
            c.add_view("derived", lambda k: extra(k.table(table)))
        said, rest = encode(where)
        assert bool(rest) == ("residual" in name) and (said or rest)
        return c.scan(table if extra is None else "derived", columns, where)

    QUERIES[name] = run
    ORACLES[name] = f"SELECT {', '.join(columns)} FROM {sql}"


_LI = ["l_orderkey", "l_linenumber"]
_CU = ["c_custkey", "c_name"]
_nullable = "(SELECT *, nullif(l_tax, 0.0) AS t FROM lineitem)"
_tax = lambda df: df.withColumn("t", F.nullif(F.col("l_tax"), F.lit(0.0)))
_flag = lambda df: df.withColumn("r", F.col("l_returnflag") == "R")
for _n, _op in (("eq", "="), ("ne", "<>"), ("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">=")):
    _filter(f"filter_{_n}", "lineitem", _LI, node(_op, col("l_quantity"), lit(25.0)), f"lineitem WHERE l_quantity {_op} 25")
_filter("filter_is_null", "lineitem", _LI, node("null", col("t")), f"{_nullable} WHERE t IS NULL", _tax)
_filter("filter_is_not_null", "lineitem", _LI, node("notnull", col("t")), f"{_nullable} WHERE t IS NOT NULL", _tax)
_filter("filter_in", "customer", _CU, node("in", col("c_mktsegment"), "BUILDING", "MACHINERY"), "customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
_filter("filter_and", "lineitem", _LI, node("and", node(">", col("l_quantity"), lit(40.0)), node("=", col("l_returnflag"), lit("R"))), "lineitem WHERE l_quantity > 40 AND l_returnflag = 'R'")
_filter("filter_or", "lineitem", _LI, node("or", node(">", col("l_quantity"), lit(49.0)), node("<", col("l_discount"), lit(0.01))), "lineitem WHERE l_quantity > 49 OR l_discount < 0.01")
_filter("filter_not", "lineitem", _LI, node("not", node("in", col("l_returnflag"), "R", "A")), "lineitem WHERE NOT l_returnflag IN ('R', 'A')")
_filter("filter_between", "orders", ["o_orderkey"], node("between", col("o_totalprice"), lit(1000.0), lit(20000.0), True, True), "orders WHERE o_totalprice BETWEEN 1000 AND 20000")
_filter("filter_between_exclusive", "lineitem", _LI, node("between", col("l_quantity"), lit(10.0), lit(12.0), False, False), "lineitem WHERE l_quantity > 10 AND l_quantity < 12")
_filter("filter_case", "lineitem", _LI, node("=", node("case", (node("=", col("l_returnflag"), lit("R")), lit(1)), (node("=", col("l_linestatus"), lit("O")), lit(2)), lit(0)), lit(2)), "lineitem WHERE CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_linestatus = 'O' THEN 2 ELSE 0 END = 2")
_filter("filter_bool", "lineitem", _LI, node("and", col("r", "bit"), node("<", col("l_quantity"), lit(5.0))), "lineitem WHERE l_returnflag = 'R' AND l_quantity < 5", _flag)
_filter("filter_prefix", "customer", _CU, node("like", "prefix", col("c_mktsegment"), "BUI", False), "customer WHERE starts_with(c_mktsegment, 'BUI')")
_filter("filter_suffix", "customer", _CU, node("like", "suffix", col("c_name"), "7", False), "customer WHERE ends_with(c_name, '7')")
_filter("filter_contains", "part", ["p_partkey"], node("like", "contains", col("p_type"), "S", False), "part WHERE contains(p_type, 'S')")
_filter("filter_iprefix", "customer", _CU, node("like", "prefix", col("c_mktsegment"), "bUi", True), "customer WHERE starts_with(lower(c_mktsegment), 'bui')")
_filter("filter_isuffix", "customer", _CU, node("like", "suffix", col("c_mktsegment"), "inG", True), "customer WHERE ends_with(lower(c_mktsegment), 'ing')")
_filter("filter_icontains", "customer", _CU, node("like", "contains", col("c_mktsegment"), "Hine", True), "customer WHERE contains(lower(c_mktsegment), 'hine')")
_filter("filter_like_escaped", "events", ["event_id"], node("like", "contains", col("props"), '": "', False), """events WHERE contains(props, '": "')""")
_filter("filter_residual_length", "customer", _CU, node(">", fn("length", col("c_mktsegment")), lit(8)), "customer WHERE length(c_mktsegment) > 8")
_filter("filter_residual_division", "part", ["p_partkey"], node(">", fn("/", col("p_size"), lit(4)), lit(12.25)), "part WHERE p_size / 4 > 12.25")
_filter("filter_residual_float_modulo", "lineitem", _LI, node("=", fn("%", col("l_quantity", "float"), lit(7.0)), lit(3.0)), "lineitem WHERE l_quantity % 7 = 3")
_filter("filter_residual_cast_date", "orders", ["o_orderkey"], node("=", fn("to_date", col("o_orderdate")), lit(dt.date(1995, 3, 15))), "orders WHERE CAST(o_orderdate AS DATE) = DATE '1995-03-15'")
_filter("filter_cast_date_part", "orders", ["o_orderkey"], node("=", fn("month", cast(col("o_orderdate"), "timestamp_ntz", "timestamp_ntz")), lit(7)), "orders WHERE month(o_orderdate) = 7")
_filter("filter_residual_cast_text", "orders", ["o_orderkey"], node("like", "suffix", cast(col("o_orderkey"), "bigint", "string"), "77", False), "orders WHERE ends_with(CAST(o_orderkey AS VARCHAR), '77')")
_filter("filter_fn_year_month", "orders", ["o_orderkey"], node("and", node("=", fn("year", col("o_orderdate")), lit(1996)), node("=", fn("month", col("o_orderdate")), lit(2))), "orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 2")
_filter("filter_fn_day", "orders", ["o_orderkey"], node("=", fn("day", col("o_orderdate")), lit(29)), "orders WHERE day(o_orderdate) = 29")
_filter("filter_fn_time", "events", ["event_id"], node("and", node("=", fn("hour", col("ts")), lit(13)), node("<", fn("minute", col("ts")), lit(30)), node(">=", fn("second", col("ts")), lit(0))), "events WHERE hour(ts) = 13 AND minute(ts) < 30 AND second(ts) >= 0")
_filter("filter_fn_arithmetic", "lineitem", _LI, node("=", fn("%", fn("-", fn("*", col("l_linenumber"), lit(3)), fn("negate", fn("+", col("l_linenumber"), lit(1)))), lit(5)), lit(0)), "lineitem WHERE (l_linenumber * 3 - (-(l_linenumber + 1))) % 5 = 0")
_filter("filter_fn_trim_case", "customer", _CU, node("=", fn("lower", fn("trim", fn("upper", col("c_mktsegment")))), lit("building")), "customer WHERE lower(trim(upper(c_mktsegment))) = 'building'")


@query("SELECT p_partkey, ltrim('  ' || p_brand || ' ') AS l, rtrim('  ' || p_brand || ' ') AS r, length(p_brand || ' ') AS n FROM part")
def fn_trims(spark, sf_dir):
    padded = F.concat(F.lit("  "), "p_brand", F.lit(" "))
    return attached(spark, sf_dir).table("part").select("p_partkey", F.ltrim(padded).alias("l"), F.rtrim(padded).alias("r"), F.length(F.concat("p_brand", F.lit(" "))).alias("n"))


@query("SELECT c_custkey, round(c_acctbal) AS r, floor(c_acctbal) AS f, ceil(c_acctbal) AS c, abs(c_acctbal) AS a, left(c_name, 4) AS l, right(c_name, 3) AS g, repeat(c_mktsegment, 2) AS p, octet_length(CAST(c_name AS BLOB)) AS o FROM customer")
def fn_host_functions(spark, sf_dir):
    b = F.col("c_acctbal")
    return attached(spark, sf_dir).table("customer").select("c_custkey", F.round(b).alias("r"), F.floor(b).cast("double").alias("f"), F.ceil(b).cast("double").alias("c"), F.abs(b).alias("a"), F.left("c_name", F.lit(4)).alias("l"), F.right("c_name", F.lit(3)).alias("g"), F.repeat("c_mktsegment", 2).alias("p"), F.octet_length("c_name").alias("o"))


@query("SELECT o_orderkey, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS days, CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS due, weekofyear(o_orderdate) AS week FROM orders")
def fn_dates(spark, sf_dir):
    d = F.to_date("o_orderdate")
    return attached(spark, sf_dir).table("orders").select("o_orderkey", F.date_diff(d, F.lit(dt.date(1992, 1, 1))).alias("days"), F.date_add(d, 30).alias("due"), F.weekofyear("o_orderdate").alias("week"))


@query("SELECT s, v FROM (VALUES (1, 'Apple'), (2, 'apple'), (3, 'APPLE'), (4, 'Banana'), (5, 'Test123')) t(s, v) WHERE lower(v) = 'apple'")
def filter_collation_ci(spark, sf_dir):
    rows = _rows(prepare(spark), [(1, "Apple"), (2, "apple"), (3, "APPLE"), (4, "Banana"), (5, "Test123")], "s int, v string")
    return rows.where(collate(F.col("v"), "Latin1_General_CI_AS") == "Apple").select("s", "v")


@query("SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)")
def filter_exists(spark, sf_dir):
    return attached(spark, sf_dir).query("SELECT c_custkey FROM dbo.customer c WHERE EXISTS (SELECT 1 FROM dbo.orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)")


@query("SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%0_1%'")
def filter_like(spark, sf_dir):
    return attached(spark, sf_dir).table("customer").where("c_name LIKE '%0_1%'").select(*_CU)


# -- order, limit


def _ordered(name: str, build, sql: str):
    QUERIES[name] = lambda spark, sf_dir: build(attached(spark, sf_dir, order_pushdown=True))
    ORACLES[name] = sql


def _derived(c: Catalog, build, table: str) -> Catalog:
    c.add_view("derived", lambda k: build(k.table(table)))
    return c


_key = lambda c, **k: Key(c, nullable=False, **k)
_ordered("order_asc", lambda c: c.scan("customer", _CU, order=[_key("c_acctbal"), _key("c_custkey")]), "SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal, c_custkey")
_ordered("order_desc", lambda c: c.scan("customer", _CU, order=[_key("c_acctbal", descending=True), _key("c_custkey")]), "SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey")
_ordered("order_multi", lambda c: c.scan("customer", _CU, order=[_key("c_mktsegment"), _key("c_nationkey", descending=True), _key("c_custkey")]), "SELECT c_custkey, c_name FROM customer ORDER BY c_mktsegment, c_nationkey DESC, c_custkey")
_ordered("order_fn_year", lambda c: c.scan("orders", ["o_orderkey"], order=[_key("o_orderdate", function="year"), _key("o_orderkey")]), "SELECT o_orderkey FROM orders ORDER BY year(o_orderdate), o_orderkey")
_ordered("order_nulls_first", lambda c: _derived(c, _tax, "lineitem").scan("derived", _LI, order=[Key("t", nulls_first=True), _key("l_orderkey"), _key("l_linenumber")]), f"SELECT l_orderkey, l_linenumber FROM {_nullable} ORDER BY t NULLS FIRST, l_orderkey, l_linenumber")
_ordered("order_nulls_last", lambda c: _derived(c, _tax, "lineitem").scan("derived", _LI, order=[Key("t", descending=True, nulls_first=False), _key("l_orderkey"), _key("l_linenumber")]), f"SELECT l_orderkey, l_linenumber FROM {_nullable} ORDER BY t DESC NULLS LAST, l_orderkey, l_linenumber")
_ordered("order_prefix", lambda c: _derived(c, _tax, "lineitem").scan("derived", _LI, order=[_key("l_orderkey"), Key("t", nulls_first=False)]), f"SELECT l_orderkey, l_linenumber FROM {_nullable} ORDER BY l_orderkey, t NULLS LAST")
_ordered("order_not_pushed", lambda c: attached(c.spark, c.source).scan("customer", _CU, order=[_key("c_custkey", descending=True)]), "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey DESC")
_ordered("topn", lambda c: c.scan("orders", ["o_orderkey", "o_totalprice"], order=[_key("o_totalprice", descending=True), _key("o_orderkey")], limit=100), "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
_ordered("topn_filtered", lambda c: c.scan("orders", ["o_orderkey"], node("=", col("o_orderstatus"), lit("F")), [_key("o_orderdate", descending=True), _key("o_orderkey")], 50), "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 50")
_ordered("topn_residual", lambda c: c.scan("customer", ["c_custkey"], node(">", fn("length", col("c_mktsegment")), lit(8)), [_key("c_acctbal"), _key("c_custkey")], 30), "SELECT c_custkey FROM customer WHERE length(c_mktsegment) > 8 ORDER BY c_acctbal, c_custkey LIMIT 30")
_ordered("topn_nulls_last", lambda c: _derived(c, _tax, "lineitem").scan("derived", _LI, order=[Key("t", nulls_first=False), _key("l_orderkey"), _key("l_linenumber"), _key("l_partkey"), _key("l_suppkey")], limit=40), f"SELECT l_orderkey, l_linenumber FROM {_nullable} ORDER BY t NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 40")
_ordered("topn_pruned_key", lambda c: c.scan("orders", ["o_orderkey"], order=[_key("o_totalprice"), _key("o_orderkey")], limit=20), "SELECT o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20")
_ordered("limit_offset", lambda c: c.table("customer").orderBy("c_custkey").offset(100).limit(25).select(*_CU), "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 25 OFFSET 100")

# -- joins, aggregates, sets


@query("SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def join_inner(spark, sf_dir):
    c = attached(spark, sf_dir)
    both = c.table("orders").join(c.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return both.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT n_nationkey, n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey AND c_acctbal > 9000 GROUP BY 1, 2")
def join_left(spark, sf_dir):
    c = attached(spark, sf_dir)
    rich = c.table("customer").where("c_acctbal > 9000")
    return c.table("nation").join(rich, F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("n"))


@query("WITH a AS (SELECT count(*) AS n FROM customer), b AS (SELECT count(*) AS m FROM supplier) SELECT n, m FROM a CROSS JOIN b")
def join_cross_cte(spark, sf_dir):
    return attached(spark, sf_dir).query("WITH a AS (SELECT count(*) AS n FROM dbo.customer), b AS (SELECT count(*) AS m FROM dbo.supplier) SELECT n, m FROM a CROSS JOIN b")


@query("WITH t AS (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50) SELECT o_orderkey, c_name FROM t JOIN customer ON o_custkey = c_custkey")
def join_topn_cte(spark, sf_dir):
    c = attached(spark, sf_dir)
    top = c.scan("orders", order=[Key("o_totalprice", True, nullable=False), Key("o_orderkey", nullable=False)], limit=50)
    return top.join(c.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("SELECT count(*) AS n, count(nullif(l_tax, 0.0)) AS taxed FROM lineitem")
def agg_count(spark, sf_dir):
    return _tax(attached(spark, sf_dir).table("lineitem")).agg(F.count("*").alias("n"), F.count("t").alias("taxed"))


@query("SELECT count(DISTINCT l_suppkey) AS n FROM lineitem")
def agg_distinct(spark, sf_dir):
    return attached(spark, sf_dir).table("lineitem").agg(F.count_distinct("l_suppkey").alias("n"))


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def select_distinct(spark, sf_dir):
    return attached(spark, sf_dir).table("orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, round(avg(c_acctbal), 6) AS mid, round(sum(c_acctbal), 2) AS total FROM customer")
def agg_min_max_avg_sum(spark, sf_dir):
    b = "c_acctbal"
    return attached(spark, sf_dir).table("customer").agg(F.min(b).alias("lo"), F.max(b).alias("hi"), F.round(F.avg(b), 6).alias("mid"), F.round(F.sum(b), 2).alias("total"))


@query("SELECT l_returnflag, CAST(sum(CAST(l_orderkey AS HUGEINT) * 1000000007) AS DECIMAL(38,0)) AS wide FROM lineitem GROUP BY 1")
def agg_sum_wide_decimal(spark, sf_dir):
    wide = F.sum(F.col("l_orderkey").cast("decimal(20,0)") * F.lit(1000000007).cast("decimal(10,0)")).cast("decimal(38,0)")
    return attached(spark, sf_dir).table("lineitem").groupBy("l_returnflag").agg(wide.alias("wide"))


@query("SELECT k, src FROM (SELECT c_custkey AS k, 'c' AS src FROM customer WHERE c_nationkey = 3 UNION ALL SELECT s_suppkey, 's' FROM supplier WHERE s_nationkey = 3)")
def union_all_distinct_scans(spark, sf_dir):
    c = attached(spark, sf_dir)
    a = c.table("customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("k"), F.lit("c").alias("src"))
    return a.union(c.table("supplier").where("s_nationkey = 3").select("s_suppkey", F.lit("s")))


@query("SELECT (SELECT count(*) FROM customer) AS a, (SELECT max(o_orderkey) FROM orders) AS b, (SELECT min(p_size) FROM part) AS c")
def scalar_subqueries(spark, sf_dir):
    return attached(spark, sf_dir).query("SELECT (SELECT count(*) FROM dbo.customer) AS a, (SELECT max(o_orderkey) FROM dbo.orders) AS b, (SELECT min(p_size) FROM dbo.part) AS c")


@query("SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer")
def except_all(spark, sf_dir):
    c = attached(spark, sf_dir)
    return c.table("orders").select("o_custkey").exceptAll(c.table("customer").select("c_custkey"))


@query("SELECT range AS id, range * range AS sq FROM range(0, 1000)")
def source_range(spark, sf_dir):
    return spark.range(1000).select("id", (F.col("id") * F.col("id")).alias("sq"))


@query("SELECT c_custkey, c_acctbal FROM customer")
def csv_round_trip(spark, sf_dir):
    at = fresh_dir(spark, "csv")
    attached(spark, sf_dir).table("customer").select("c_custkey", "c_acctbal").write.option("header", "true").csv(at)
    return spark.read.schema("c_custkey bigint, c_acctbal double").option("header", "true").csv(at)


# -- conversion


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DECIMAL(18,1)) AS d1, CAST(CAST(-l_extendedprice AS DECIMAL(18,4)) AS DECIMAL(18,1)) AS d2 FROM lineitem")
def conv_decimal_rescale(spark, sf_dir):
    d = lambda c: c.cast("decimal(18,4)").cast("decimal(18,1)")
    return attached(spark, sf_dir).table("lineitem").select(*_LI, "l_partkey", d(F.col("l_extendedprice")).alias("d1"), d(-F.col("l_extendedprice")).alias("d2"))


@query("SELECT p_partkey, CAST(p_size AS SMALLINT) AS s FROM part")
def conv_int_narrow_ok(spark, sf_dir):
    return attached(spark, sf_dir).table("part").select("p_partkey", convert.narrow(F.col("p_size"), "tinyint").alias("s"))


@query("SELECT event_id, CASE WHEN extract('microsecond' FROM ts) % 1000000 >= 500000 THEN date_trunc('second', ts) + INTERVAL 1 SECOND ELSE date_trunc('second', ts) END AS s FROM events")
def conv_ts_round_s(spark, sf_dir):
    return attached(spark, sf_dir).table("events").select("event_id", convert.round_timestamp(F.col("ts"), 0).alias("s"))


@query("SELECT event_id, CASE WHEN extract('microsecond' FROM ts) % 1000 >= 500 THEN date_trunc('millisecond', ts) + INTERVAL 1 MILLISECOND ELSE date_trunc('millisecond', ts) END AS s FROM events")
def conv_ts_round_ms(spark, sf_dir):
    return attached(spark, sf_dir).table("events").select("event_id", convert.round_timestamp(F.col("ts"), 3).alias("s"))


@query("SELECT * FROM (VALUES (1, TIMESTAMP '2000-01-01 00:00:00', 86399000000), (2, TIMESTAMP '1969-12-31 23:59:58', 1000000), (3, TIMESTAMP '2020-02-29 12:00:01', 0)) t(id, s, t)")
def conv_ts_carry_time_saturates(spark, sf_dir):
    rows = _rows(prepare(spark), [(1, "1999-12-31 23:59:59.999999", 86399999999), (2, "1969-12-31 23:59:57.5", 500000), (3, "2020-02-29 12:00:01.499999", 499999)], "id int, x string, m bigint")
    return rows.select("id", convert.round_timestamp(F.col("x").cast("timestamp_ntz"), 0).alias("s"), convert.round_time_micros(F.col("m"), 0).alias("t"))


@query("SELECT * FROM (VALUES (1, 'abcde', 'abcde'), (2, 'абвгд', 'аб'), (3, '漢字漢字漢', '漢'), (4, 'ab😀', 'ab'), (5, '😀😀', '😀'), (6, '', ''), (7, NULL, NULL)) t(id, u, b)")
def conv_string_bounds(spark, sf_dir):
    rows = _rows(prepare(spark), [(1, "abcdefgh", "abcdefgh"), (2, "абвгдежз", "абвгд"), (3, "漢字漢字漢字", "漢字"), (4, "ab😀x", "ab😀x"), (5, "😀😀😀", "😀😀"), (6, "", ""), (7, None, None)], "id int, u string, b string")
    u = F.when(F.col("id") == 4, convert.truncate_utf16(F.col("u"), 4)).otherwise(convert.truncate_utf16(F.col("u"), 5))
    return rows.select("id", u.alias("u"), convert.truncate_utf8(F.col("b"), 5).alias("b"))


@query("SELECT * FROM (VALUES (1, 'NULL'), (2, '1'), (3, '-5'), (4, 'CAST(18446744073709551615 AS DECIMAL(20,0))'), (5, '0.5'), (6, '2.0'), (7, 'N''it''''s'''), (8, '0x00FF'), (9, 'CAST(''2024-01-02T03:04:05.0600000'' AS DATETIME2(7))'), (10, '12.50')) t(id, s)")
def literal_forms(spark, sf_dir):
    from decimal import Decimal

    values = [None, True, -5, 2**64 - 1, 0.5, 2.0, "it's", b"\x00\xff", dt.datetime(2024, 1, 2, 3, 4, 5, 60000), Decimal("12.50")]
    return _rows(spark, [(i, literal(v)) for i, v in enumerate(values, 1)], "id int, s string")


# -- catalog


@query("SELECT o_orderkey AS rowid, o_custkey FROM orders WHERE o_orderkey IN (1, 7, 32)")
def rowid_scalar(spark, sf_dir):
    return attached(spark, sf_dir).table("orders", rowid=True).where(F.col("rowid").isin(1, 7, 32)).select("rowid", "o_custkey")


@query("SELECT conv_id, turn, role FROM conversations WHERE conv_id = 3 AND turn = 1")
def rowid_composite(spark, sf_dir):
    return attached(spark, sf_dir).by_rowid("conversations", {"conv_id": 3, "turn": 1}).select("conv_id", "turn", "role")


@query("SELECT c_custkey AS rowid FROM customer WHERE c_custkey BETWEEN 10 AND 20 OR c_custkey > 140")
def rowid_range(spark, sf_dir):
    return attached(spark, sf_dir).table("customer", rowid=True).where("rowid BETWEEN 10 AND 20 OR rowid > 140").select("rowid")


@query("SELECT * FROM (VALUES ('dbo', 'customer', 'table', 'c_custkey'), ('dbo', 'orders', 'table', 'o_orderkey'), ('dbo', 'region', 'table', 'r_regionkey')) t(schema, name, kind, key)")
def catalog_tables_filtered(spark, sf_dir):
    return attached(spark, sf_dir, table_filter="^(orders|customer|region)$").tables().select("schema", "name", "kind", "key")


@query("SELECT * FROM (VALUES ('n_name', 2, 'string'), ('n_nationkey', 1, 'int'), ('n_regionkey', 3, 'int')) t(name, ordinal, type)")
def catalog_columns(spark, sf_dir):
    return attached(spark, sf_dir).columns("nation").select("name", "ordinal", "type")


@query("SELECT n_name, r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey ORDER BY n_name LIMIT 7")
def scan_sql_passthrough(spark, sf_dir):
    return attached(spark, sf_dir).query("SELECT TOP 7 [n_name], r_name FROM [dbo].[nation] n JOIN db.dbo.region r ON n.n_regionkey = r.r_regionkey ORDER BY n_name")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS status FROM customer")
def scan_view(spark, sf_dir):
    c = attached(spark, sf_dir)
    c.add_view("balances", lambda k: k.table("customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("status")))
    return c.table("dbo.balances")


# -- statements as text: what a dialect's literals, brackets and TOP mean


def _text(name: str, tsql: str, sql: str):
    QUERIES[name] = lambda spark, sf_dir: attached(spark, sf_dir).query(tsql)
    ORACLES[name] = sql


_text("text_literals", "SELECT r_name, 'copied from nation, join region' AS x, 'it''s {0} -- [a]' AS y, N'back\\slash' AS z FROM dbo.region WHERE r_name NOT LIKE '{%'", "SELECT r_name, 'copied from nation, join region' AS x, 'it''s {0} -- [a]' AS y, 'back\\slash' AS z FROM region")
_text("text_like_classes", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%[0-4][^1-8]' AND c_mktsegment LIKE 'B%'", "SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '[0-4][^1-8]$') AND c_mktsegment LIKE 'B%'")
_text("text_top_nested", "SELECT TOP 5 t.[o_orderkey] FROM (SELECT TOP (20) o_orderkey, o_totalprice FROM [dbo].[orders] ORDER BY o_totalprice DESC, o_orderkey) AS t ORDER BY t.o_orderkey", "SELECT o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20) ORDER BY 1 LIMIT 5")
_text("text_top_cte", "WITH t AS (SELECT TOP 3 c_custkey AS k FROM dbo.customer ORDER BY c_acctbal, c_custkey) SELECT TOP 2 k FROM t ORDER BY k DESC", "WITH t AS (SELECT c_custkey AS k FROM customer ORDER BY c_acctbal, c_custkey LIMIT 3) SELECT k FROM t ORDER BY k DESC LIMIT 2")
_text("text_top_union", "SELECT TOP 2 s_suppkey AS k FROM supplier UNION ALL SELECT n_nationkey FROM dbo.nation ORDER BY 1 DESC", "SELECT k FROM (SELECT s_suppkey AS k FROM supplier LIMIT 2) UNION ALL SELECT n_nationkey FROM nation")
_text("text_top_ties", "SELECT TOP 7 WITH TIES p_partkey, p_size FROM part ORDER BY p_size", "SELECT p_partkey, p_size FROM (SELECT *, rank() OVER (ORDER BY p_size) AS r FROM part) WHERE r <= 7")
_text("text_top_percent", "SELECT TOP 10 PERCENT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey", "SELECT o_orderkey FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS r, count(*) OVER () AS n FROM orders) WHERE r <= ceil(n / 10.0)")
_text("text_indexing", "SELECT n_nationkey, array(n_name, 'x')[0] AS a, [n_regionkey] AS b FROM [dbo].[nation] WITH (NOLOCK) WHERE split(n_name, 'A')[0] <> ''", "SELECT n_nationkey, n_name AS a, n_regionkey AS b FROM nation WHERE NOT starts_with(n_name, 'A')")
_text("text_subplans", "SELECT a.n, b.m FROM (SELECT count(*) AS n FROM dbo.orders, nation WHERE n_nationkey = 1) a CROSS JOIN (SELECT max(x.s) AS m FROM (SELECT extract(YEAR FROM o_orderdate) AS s FROM db.dbo.orders) x) b", "SELECT (SELECT count(*) FROM orders) AS n, (SELECT max(year(o_orderdate)) FROM orders) AS m")
_text("text_types", "SELECT event_id, CAST(value AS FLOAT) AS f, DATEPART(HOUR, [ts]) AS h, ISNULL(NULLIF(event_type, 'click'), N'-') AS k FROM events WHERE ts >= CAST('1990-01-01T00:00:00.0000000' AS DATETIME2(7))", "SELECT event_id, value AS f, hour(ts) AS h, coalesce(nullif(event_type, 'click'), '-') AS k FROM events")


# -- store, DDL, DML


def _customers(spark, sf_dir) -> Catalog:
    c = new_store(spark)
    ddl.create_table(c, "cust", "id bigint, name string, bal double", ["id"])
    dml.insert(c, "cust", attached(spark, sf_dir).table("customer").select("c_custkey", "c_name", "c_acctbal"))
    return c


_cust = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS bal FROM customer"


@query(_cust)
def insert_select(spark, sf_dir):
    return _customers(spark, sf_dir).table("cust")


@query("SELECT n_nationkey AS id, 'none' AS note, n_name AS name FROM nation")
def insert_partial_columns(spark, sf_dir):
    c = new_store(spark)
    ddl.create_table(c, "t", T.StructType([T.StructField("id", T.IntegerType()), dml.column_for("note", "string", default="'none'"), T.StructField("name", T.StringType())]), ["id"])
    dml.insert(c, "t", attached(spark, sf_dir).table("nation").select("n_name", "n_nationkey"), ["name", "id"])
    return c.table("t")


@query("SELECT CAST(100 + 10 * (row_number() OVER (ORDER BY r_regionkey) - 1) AS BIGINT) AS id, r_name AS name FROM region")
def insert_returning(spark, sf_dir):
    c = new_store(spark)
    ddl.create_table(c, "t", T.StructType([dml.column_for("id", "bigint", identity=(100, 10)), T.StructField("name", T.StringType())]), ["id"])
    return dml.insert(c, "t", attached(spark, sf_dir).table("region").orderBy("r_regionkey").coalesce(1).select("r_name"), ["name"], returning=True)


@query(f"SELECT id, CASE WHEN bal < 0 THEN upper(name) ELSE name END AS name, CASE WHEN bal < 0 THEN 0 ELSE bal END AS bal FROM ({_cust})")
def update_pk(spark, sf_dir):
    c = _customers(spark, sf_dir)
    dml.update(c, "cust", {"bal": F.lit(0.0), "name": F.upper("name")}, "bal < 0")
    return c.table("cust")


@query("SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'first' ELSE role END AS role FROM conversations")
def update_composite_pk(spark, sf_dir):
    c, src = new_store(spark), attached(spark, sf_dir).table("conversations").select("conv_id", "turn", "role")
    ddl.create_table(c, "t", src.schema, ["conv_id", "turn"])
    dml.insert(c, "t", src)
    dml.update_from(c, "t", src.where("turn = 0").select("conv_id", "turn", F.lit("first").alias("role")))
    return c.table("t")


@query(f"{_cust} WHERE NOT c_acctbal < 0")
def delete_pk(spark, sf_dir):
    c = _customers(spark, sf_dir)
    c.execute("DELETE FROM cust WHERE bal < 0")
    return c.table("cust")


@query("SELECT conv_id, turn, role FROM conversations WHERE NOT (turn = 1 AND conv_id % 2 = 0)")
def delete_composite_pk(spark, sf_dir):
    c, src = new_store(spark), attached(spark, sf_dir).table("conversations").select("conv_id", "turn", "role")
    ddl.create_table(c, "t", src.schema, ["conv_id", "turn"])
    dml.insert(c, "t", src)
    dml.delete_from(c, "t", src.where("turn = 1 AND conv_id % 2 = 0").select("conv_id", "turn"))
    return c.table("t")


@query("SELECT c_custkey AS id, c_name AS title, CAST(NULL AS INTEGER) AS extra FROM customer")
def alter_add_drop_rename(spark, sf_dir):
    c = _customers(spark, sf_dir)
    ddl.add_column(c, "cust", "extra", "int")
    ddl.drop_column(c, "cust", "bal")
    ddl.rename_column(c, "cust", "name", "title")
    ddl.rename_table(c, "cust", "people")
    return c.table("people")


@query("SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(12,1)) AS bal FROM customer")
def alter_type(spark, sf_dir):
    c = _customers(spark, sf_dir)
    ddl.alter_type(c, "cust", "bal", "decimal(12,1)")
    return c.table("cust").select("id", "bal")


@query("SELECT r_regionkey AS a, r_name AS b FROM region WHERE r_regionkey > 1")
def exec_statements(spark, sf_dir):
    c = new_store(spark)
    c.execute("CREATE TABLE [my table] (a INT PRIMARY KEY, b NVARCHAR(50)); INSERT INTO [my table] VALUES (100, N'it''s; here')")
    dml.insert(c, "[my table]", attached(spark, sf_dir).table("region"))
    c.execute("DELETE FROM [my table] WHERE a = 100 OR a <= 1")
    return c.query("SELECT * FROM [my table]")


# -- bulk load


@query(_cust)
def copy_create(spark, sf_dir):
    c = new_store(spark)
    load.copy_to(c, attached(spark, sf_dir).query(_cust), "wh.dbo.t")
    return c.table("t")


@query("SELECT n_nationkey, n_name FROM nation")
def copy_replace(spark, sf_dir):
    c = _customers(spark, sf_dir)
    load.copy_to(c, attached(spark, sf_dir).table("nation").select("n_nationkey", "n_name"), "cust", replace_table=True)
    return c.table("cust")


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS bal FROM supplier")
def copy_truncate(spark, sf_dir):
    c = _customers(spark, sf_dir)
    load.copy_to(c, attached(spark, sf_dir).query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS bal FROM supplier"), "cust", truncate=True)
    return c.table("cust")


@query("SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(NULL AS DOUBLE) AS bal FROM nation")
def copy_column_mapping(spark, sf_dir):
    c = new_store(spark)
    ddl.create_table(c, "t", "id bigint, name string, bal double")
    load.copy_to(c, attached(spark, sf_dir).table("nation").select(F.col("n_name").alias("NAME"), F.col("n_regionkey").alias("unused"), F.col("n_nationkey").alias("Id")), "t")
    return c.table("t")


@query("SELECT n_nationkey AS id, CAST(NULL AS DATE) AS d FROM nation")
def copy_null_only(spark, sf_dir):
    c = new_store(spark)
    ddl.create_table(c, "t", "id int, d date")
    load.copy_to(c, attached(spark, sf_dir).table("nation").select(F.col("n_nationkey").alias("id"), F.lit(None).cast("int").alias("d")), "t")
    return c.table("t")


@query("SELECT l_returnflag AS flag, sum(l_quantity) AS qty FROM lineitem GROUP BY 1")
def ctas(spark, sf_dir):
    c = new_store(spark)
    load.create_table_as(c, "t", attached(spark, sf_dir).query("SELECT l_returnflag AS flag, sum(l_quantity) AS qty FROM dbo.lineitem GROUP BY 1"))
    return c.table("t")


@query("SELECT r_regionkey AS k FROM region")
def ctas_if_not_exists(spark, sf_dir):
    c, src = new_store(spark), attached(spark, sf_dir)
    load.create_table_as(c, "t", src.table("region").select(F.col("r_regionkey").alias("k")))
    assert load.create_table_as(c, "t", src.table("nation"), if_not_exists=True) == 0
    return c.table("t")


@query("SELECT n_nationkey AS k FROM nation")
def ctas_or_replace(spark, sf_dir):
    c, src = new_store(spark), attached(spark, sf_dir)
    load.create_table_as(c, "t", src.table("region").select(F.col("r_regionkey").alias("k")))
    load.create_table_as(c, "t", src.table("nation").select(F.col("n_nationkey").alias("k")), or_replace=True)
    return c.table("t")


@query("SELECT count(*) AS n, count(DISTINCT l_orderkey * 10000000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber) AS ids, sum(l_orderkey) AS total FROM lineitem")
def copy_parallel_exactly_once(spark, sf_dir):
    c = new_store(spark)
    load.copy_to(c, attached(spark, sf_dir).table("lineitem"), "t", parallel=4, flush_rows=10_000)
    key = F.col("l_orderkey") * 10000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")
    return c.table("t").agg(F.count("*").alias("n"), F.count_distinct(key).alias("ids"), F.sum("l_orderkey").alias("total"))


@query("SELECT l_suppkey, l_linenumber, CAST(sum(l_partkey) AS DECIMAL(38,0)) AS parts FROM lineitem GROUP BY 1, 2")
def aggregate_then_write(spark, sf_dir):
    c = new_store(spark)
    agg = attached(spark, sf_dir).table("lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.sum("l_partkey").cast("decimal(38,0)").alias("parts"))
    load.copy_to(c, agg, "t")
    return c.table("t")


@query("SELECT n_nationkey, n_name FROM nation")
def copy_temporary(spark, sf_dir):
    c = new_store(spark)
    load.copy_to(c, attached(spark, sf_dir).table("nation").select("n_nationkey", "n_name"), f"wh..#t{uuid.uuid4().hex}")
    return next(iter(c.views.values()))(c)


@query("SELECT c_custkey, c_name FROM customer")
def ctas_by_insert(spark, sf_dir):
    """CREATE TABLE, then INSERT: what ctas_use_bcp off asks for."""
    c = new_store(spark)
    settings["ctas_use_bcp"] = False
    try:
        load.create_table_as(c, "t", attached(spark, sf_dir).table("customer").select("c_custkey", "c_name"))
    finally:
        settings.reset("ctas_use_bcp")
    return c.table("t")


@query("SELECT r_regionkey, left(r_name, 4) AS r_name FROM region")
def copy_string_length(spark, sf_dir):
    c = new_store(spark)
    load.copy_to(c, attached(spark, sf_dir).table("region").select("r_regionkey", "r_name"), "t", string_length=4)
    return c.table("t")


@query("SELECT 'false' AS clustered, 'true' AS heap")
def copy_table_lock(spark, sf_dir):
    """The decision that a load notes: heaps are locked whole, tables with an order aren't."""
    c, src = new_store(spark), attached(spark, sf_dir).table("region").select("r_regionkey")
    load.copy_to(c, src, "heap")
    load.copy_to(c, src, "cold", table_kind="columnstore")
    return _rows(spark, [tuple(str(c.meta("dbo", t).options["tablock"]).lower() for t in ("cold", "heap"))], "clustered string, heap string")


@query("SELECT 1 AS files, 4 AS written, true AS sorted")
def table_options(spark, sf_dir):
    """A clustered table's files are in its order; data_compression is the files' codec; parallel loads write so many files."""
    c = new_store(spark)
    ddl.create_table(c, "t", "o_orderkey bigint, o_totalprice double", options={"clustered_index": "o_totalprice", "data_compression": "page"})
    load.copy_to(c, attached(spark, sf_dir).table("orders").select("o_orderkey", "o_totalprice"), "t", parallel=4, flush_rows=0)
    m = c.meta("dbo", "t")
    names = c.store.data_files(m.segments[0])
    rows = c.table("t").withColumn("p", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id()).where(F.input_file_name().endswith(names[0]))
    late = rows.withColumn("before", F.lag("o_totalprice").over(Window.partitionBy("p").orderBy("i"))).where("before > o_totalprice")
    return _rows(spark, [(int(all(".zstd." in n for n in names)), len(names), late.isEmpty())], "files int, written int, sorted boolean")


@query("SELECT 1 AS rewritten, 3 AS kept, true AS same_names, c AS rows FROM (SELECT count(*) AS c FROM orders)")
def update_rewrites_files(spark, sf_dir):
    """Of a load's files, only those with touched rows are written anew."""
    c = new_store(spark)
    ddl.create_table(c, "t", "o_orderkey bigint, o_totalprice double", ["o_orderkey"])
    load.copy_to(c, attached(spark, sf_dir).table("orders").select("o_orderkey", "o_totalprice").repartitionByRange(4, "o_orderkey"), "t", flush_rows=0)
    segment = c.meta("dbo", "t").segments[0]
    names = c.store.data_files(segment)
    dml.update(c, "t", {"o_totalprice": F.lit(0.0)}, f"o_orderkey = {c.table('t').agg(F.max('o_orderkey')).first()[0]}")
    m = c.meta("dbo", "t")
    left = set(names) - set(m.gone[segment])
    read = {f.rsplit("/", 1)[1] for f in c.table("t").inputFiles()}
    return c.table("t").agg(F.lit(len(m.gone[segment])).alias("rewritten"), F.lit(len(left)).alias("kept"), F.lit(left <= read).alias("same_names"), F.count("*").alias("rows"))


@query(f"SELECT id, name, CASE WHEN bal < 0 THEN 0 ELSE bal END AS bal FROM ({_cust}) WHERE id % 7 <> 0")
def vacuum(spark, sf_dir):
    """After a vacuum the table is as before, and its old data gone."""
    c = _customers(spark, sf_dir)
    dml.update(c, "cust", {"bal": F.lit(0.0)}, "bal < 0")
    dml.delete(c, "cust", "id % 7 = 0")
    assert c.vacuum(older_than=0) > 0 and c.vacuum(older_than=0) == 0
    return c.table("cust")


@query("SELECT a.column_name, true AS same FROM (VALUES ('id'), ('name'), ('bal')) a(column_name)")
def content_checksum(spark, sf_dir):
    """Sums of hashes by column: a copy's are its source's, whatever the order of rows."""
    c = _customers(spark, sf_dir)
    load.copy_to(c, c.table("cust").repartition(3), "copy")
    a, b = c.checksum("cust").alias("a"), c.checksum("copy").alias("b")
    return a.join(b, F.col("a.column") == F.col("b.column")).select(F.col("a.column").alias("column_name"), (F.col("a.sum") == F.col("b.sum")).alias("same"))


@query("SELECT p_partkey, 'string' AS t, chr(CAST(65 + p_partkey % 26 AS INTEGER)) AS c, CAST('p' AS BLOB) AS e, 36 AS u, year(DATE '2020-02-29') AS y FROM part")
def fn_more_host_functions(spark, sf_dir):
    return attached(spark, sf_dir).table("part").select("p_partkey", F.typeof("p_name").alias("t"), F.char((65 + F.col("p_partkey") % 26).cast("bigint")).alias("c"), F.encode(F.lit("p"), "UTF-8").alias("e"), F.length(F.uuid()).alias("u"), F.date_part(F.lit("year"), F.lit(dt.date(2020, 2, 29))).cast("bigint").alias("y"))


# -- schemas, catalog, server


@query("SELECT * FROM (VALUES ('dbo', 't'), ('s 2', 'x.y')) t(schema, name)")
def schemas_and_tables(spark, sf_dir):
    c = new_store(spark)
    for s in ("s 2", "gone"):
        ddl.create_schema(c, s)
    for t in ("dbo.t", "[s 2].[x.y]", "gone.t", "dbo.gone"):
        ddl.create_table(c, t, "a int")
    ddl.drop_table(c, "gone")
    ddl.drop_schema(c, "gone", cascade=True)
    return c.tables().select("schema", "name")


@query("SELECT * FROM (VALUES ('after change', 'STALE'), ('after load', 'LOADED'), ('after refresh', 'LOADED'), ('at first', 'NOT_LOADED'), ('missing', 'LOADED')) t(moment, state)")
def metadata_cache(spark, sf_dir):
    """States of one table's metadata; that a table is missing is remembered as well."""
    c = _customers(spark, sf_dir)
    fresh, seen = Catalog(spark, "wh2", c.source, store=True, ttl=600), []
    seen.append(("at first", fresh.state("cust")))
    fresh.table("cust")
    seen.append(("after load", fresh.state("cust")))
    ddl.add_column(fresh, "cust", "x", "int")
    seen.append(("after change", fresh.state("cust")))
    fresh.refresh()
    seen.append(("after refresh", fresh.state("cust")))
    assert fresh.meta("dbo", "nothing") is None
    seen.append(("missing", fresh.state("nothing")))
    return _rows(spark, seen, "moment string, state string")


@query("SELECT n_nationkey, n_name, n_regionkey * 10 AS r FROM nation WHERE n_regionkey >= 2")
def server_scan(spark, sf_dir):
    """A table on a live server (an embedded one), loaded over JDBC, scanned with the filter pushed there."""
    c = _server(spark)
    load.copy_to(c, attached(spark, sf_dir).table("nation"), "APP.nation")
    df = c.scan("APP.nation", ["n_nationkey", "n_name", "n_regionkey"], node(">=", col("n_regionkey"), lit(2)))
    plan = c.server.scanned or df._jdf.queryExecution().executedPlan().toString()
    assert "n_regionkey" in re.search(r"PushedFilters: \[.*?\]", plan)[0]
    return df.select("n_nationkey", "n_name", (F.col("n_regionkey") * 10).alias("r"))


@query("SELECT * FROM (VALUES ('APP', 'region', 'table', 'r_regionkey', 5)) t(schema, name, kind, key, rows)")
def server_catalog(spark, sf_dir):
    c = _server(spark, table_filter="^reg")
    c.execute('CREATE TABLE APP."region" ("r_regionkey" INT NOT NULL PRIMARY KEY, "r_name" VARCHAR(30)); CREATE TABLE APP."other" (a INT)')
    load.copy_to(c, attached(spark, sf_dir).table("region"), "APP.region", create_table=False)
    t = c.tables().where("schema = 'APP'").select("schema", "name", "kind", "key")
    return t.withColumn("rows", F.lit(c.rows("APP.region")).cast("int"))


def _server(spark, **options) -> Catalog:
    return Catalog(prepare(spark), "live", url=f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true", **options)


# -- transactions


@query("SELECT * FROM (VALUES ('kept', 'a', 1), ('kept', 'b', 2)) t(name, v, k)")
def txn_rollback_of_ddl(spark, sf_dir):
    """Create, drop, rename and alter, rolled back: all is as it was."""
    c = new_store(spark)
    c.execute("CREATE TABLE kept (k INT PRIMARY KEY, v NVARCHAR(9)); INSERT INTO kept VALUES (1, 'a'), (2, 'b'); CREATE TABLE dropped (a INT)")
    t = txn.begin(c)
    c.execute("CREATE TABLE made (a INT); INSERT INTO made VALUES (1); DROP TABLE dropped; ALTER TABLE kept ADD x INT; INSERT INTO kept (k) VALUES (3); ALTER TABLE kept RENAME TO moved")
    assert c.table_names() == ["made", "moved"] and c.table("moved").count() == 3
    t.rollback()
    assert c.table_names() == ["dropped", "kept"]
    return c.table("kept").select(F.lit("kept").alias("name"), "v", "k")


@query("SELECT * FROM (VALUES ('made', 1, 1), ('moved', 3, 2)) t(name, rows, columns)")
def txn_commit_of_ddl(spark, sf_dir):
    c = new_store(spark)
    c.execute("CREATE TABLE kept (k INT PRIMARY KEY, v NVARCHAR(9)); INSERT INTO kept VALUES (1, 'a'), (2, 'b'); CREATE TABLE dropped (a INT)")
    with txn.begin(c):
        c.execute("CREATE TABLE made (a INT); INSERT INTO made VALUES (1); DROP TABLE dropped; INSERT INTO kept (k) VALUES (3); ALTER TABLE kept RENAME TO moved")
    other = Catalog(spark, "other", c.source, store=True)
    return _rows(spark, [(t, other.table(t).count(), len(other.table(t).columns)) for t in other.table_names()], "name string, rows int, columns int")


def _transacted(spark, sf_dir, end: str):
    c = _customers(spark, sf_dir)
    t = txn.begin(c)
    dml.update(c, "cust", {"bal": F.lit(1.0)}, "id <= 50")
    dml.delete(c, "cust", "id > 100")
    if end == "read":
        return c.table("cust")
    getattr(t, end)()
    return c.table("cust")


@query("SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey <= 50 THEN 1 ELSE c_acctbal END AS bal FROM customer WHERE c_custkey <= 100")
def txn_commit(spark, sf_dir):
    return _transacted(spark, sf_dir, "commit")


@query(_cust)
def txn_rollback(spark, sf_dir):
    return _transacted(spark, sf_dir, "rollback")


@query("SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey <= 50 THEN 1 ELSE c_acctbal END AS bal FROM customer WHERE c_custkey <= 100")
def txn_read_your_writes(spark, sf_dir):
    return _transacted(spark, sf_dir, "read")


@query("SELECT * FROM (VALUES ('create index'), ('delete without key'), ('nested column'), ('read-only'), ('rowid of view'), ('two result sets'), ('unknown option'), ('update of key')) t(refused)")
def refusals(spark, sf_dir):
    """What must raise, and does."""
    c, ro = _customers(spark, sf_dir), attached(spark, sf_dir)
    ddl.create_table(c, "heap", "a int")
    ro.add_view("v", lambda k: k.table("nation"))
    tries = {
        "create index": lambda: c.execute("CREATE INDEX i ON cust (id)"),
        "delete without key": lambda: dml.delete(c, "heap"),
        "nested column": lambda: load.create_table_as(c, "n", spark.sql("SELECT array(1) AS a")),
        "read-only": lambda: dml.insert(ro, "nation", ro.table("nation")),
        "rowid of view": lambda: ro.table("v", rowid=True),
        "two result sets": lambda: c.query("SELECT 1; SELECT 2"),
        "unknown option": lambda: ddl.create_table(c, "o", "a int", options={"fillfactor": "1"}),
        "update of key": lambda: dml.update(c, "cust", {"id": F.lit(1)}),
    }
    done = []
    for k, f in tries.items():
        try:
            f()
        except EngineError:
            done.append((k,))
    return _rows(spark, done, "refused string")
