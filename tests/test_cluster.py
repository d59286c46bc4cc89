"""Embedded databases where executors are other processes: what lives in the driver is out of their reach."""

import subprocess
import sys
import textwrap

import pytest
from .conftest import ROOT, SF

START = f"""
import json, os, sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
conf = {{"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "700m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1"}}
conf |= {{"spark.checkpoint.dir": "file://" + sys.argv[1], "spark.sql.shuffle.partitions": "4"}}
spark = SparkSession.builder.config(map=conf).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
import __spark_entry__
from lakeferry.errors import EngineError
from lakeferry.operators import dml, load
from lakeferry.plans.ordering import Key
from lakeferry.plans.predicates import col, lit, node
from lakeferry.queries import _server, attached
SF = {SF!r}
"""


@pytest.fixture
def cluster(tmp_path):
    def run(code):
        got = subprocess.run([sys.executable, "-c", START + textwrap.dedent(code) + "\nprint('done')\nspark.stop()\n", str(tmp_path)], capture_output=True, text=True, timeout=300, cwd=tmp_path, check=False)
        assert "done" in got.stdout, got.stderr[-3000:]

    return run


def test_server_catalog(cluster):
    """The query's row; and loads in every mode, reads of more rows than the driver holds at once, and the server's errors."""
    cluster("""
    assert [tuple(r) for r in __spark_entry__.queries()["server_catalog"](spark, SF).collect()] == [("APP", "region", "table", "r_regionkey", 5)]
    c, src = _server(spark), spark.range(0, 25_000, 1, 3).selectExpr("CAST(id AS INT) AS a", "IF(id % 5 = 0, NULL, concat('t', id)) AS `b c`", "CAST(id AS DECIMAL(12,2)) / 4 AS d", "timestamp_ntz'2020-01-01 00:00:00.5' AS e")
    assert load.copy_to(c, src, "APP.x") == 25_000 == c.rows("APP.x")
    back = c.table("APP.x")
    assert back.columns == src.columns and back.selectExpr("a", "`b c`", "CAST(d AS DECIMAL(12,2)) AS d", "CAST(e AS STRING) AS e").exceptAll(src.selectExpr("a", "`b c`", "CAST(d AS DECIMAL(12,2))", "CAST(e AS STRING)")).count() == 0
    assert back.count() == 25_000
    assert load.copy_to(c, src.limit(3), "APP.x") == 3 and c.table("APP.x").count() == 25_003
    assert load.copy_to(c, src.limit(3), "APP.x", truncate=True) == 3 and c.table("APP.x").count() == 3
    assert load.copy_to(c, src.selectExpr("a AS other").limit(4), "APP.x", replace_table=True) == 4 and c.table("APP.x").columns == ["other"]
    assert dml.insert(c, "APP.x", spark.sql("SELECT 77")) == 1 and c.query('SELECT "other" FROM APP."x" WHERE "other" > 50').collect() == [(77,)]
    assert load.copy_to(c, src.limit(0), "APP.none") == 0 and c.table("APP.none").collect() == []
    try:
        c.query('SELECT 1 / ("other" - "other") AS "n" FROM APP."x"').collect()
        raise SystemExit("no error")
    except EngineError:
        pass
    assert not [x for x in os.listdir(sys.argv[1]) if x.startswith("load-")]
    """)


def test_server_scan(cluster):
    """The query's rows; filters and columns reach the database, whatever is sorted and cut here."""
    cluster("""
    got = __spark_entry__.queries()["server_scan"](spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in attached(spark, SF).table("nation").where("n_regionkey >= 2").selectExpr("n_nationkey", "n_name", "n_regionkey * 10").collect())
    c = _server(spark)
    load.copy_to(c, spark.range(25_000).selectExpr("id", "-id AS n", "'x' AS t"), "APP.x")
    df = c.scan("APP.x", ["t", "id"], node(">=", col("id"), lit(13_000)))
    assert "GreaterThanOrEqual(id,13000)" in c.server.scanned and "n#" not in c.server.scanned, c.server.scanned
    assert df.columns == ["t", "id"] and df.count() == 12_000 == df.distinct().count()
    assert c.scan("APP.x", ["id"], node("<", col("id"), lit(90)), [Key("n")], 2).collect() == [(89,), (88,)]
    assert c.scan("APP.x", ["id"], node("=", col("id"), lit(-1))).collect() == []
    """)
