import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakeferry.session import build

    s = build("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.environment["PYTHONPATH"] = str(ROOT)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _norm(v):
    import decimal

    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


@pytest.fixture(scope="session")
def same(spark, sf, duck):
    """Asserts that a query's rows are its SQL's."""

    def check(df, sql):
        cols = sorted(df.columns)
        rel = duck.sql(sql)
        names = list(rel.columns)
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        want = sorted((tuple(_norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)
        got = sorted((tuple(_norm(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
        assert got == want

    return check
