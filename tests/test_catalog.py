"""Every query with SQL equals DuckDB's result on the smallest tables."""

import math
import os

import duckdb
import pytest

from marlstone.plans import ORACLE_SQL, QUERIES
from marlstone.plans.views import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def one(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            return "NaN" if math.isnan(v) else f"{float(v):.6f}"
        return str(v)

    return sorted(tuple(one(r[k]) for k in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLE_SQL:
        result = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(df.columns)
        assert canonical(rows, df.columns) == canonical(result.fetchall(), names)
    else:
        assert df.columns
