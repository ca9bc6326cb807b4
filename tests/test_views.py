"""The derived views hold the same rows in Spark and in the checking engine."""

import duckdb
import pytest

from conftest import SF
import patronage.queries  # noqa: F401  (adds the views of single queries)
from patronage.warehouse import BASE, VIEWS, Warehouse, with_views


def norm(v):
    if v is None or type(v).__name__ in ("float", "Decimal"):
        return v if v is None else round(float(v), 6)
    # key lists have no order
    return ",".join(sorted(str(v).split(",")))


@pytest.mark.parametrize("name", list(VIEWS))
def test_view(spark, name):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = Warehouse.of(spark, SF)[name]
    got = sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr)
    cur = con.execute(with_views(f"select * from {name}"))
    assert [d[0] for d in cur.description] == df.columns
    want = sorted((tuple(norm(v) for v in r) for r in cur.fetchall()), key=repr)
    assert got == want and got
