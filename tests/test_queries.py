import glob
import math
import os

import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or type(v).__name__ == "NAType":
        return None
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return round(float(v), 9)
    return norm(v.item()) if hasattr(v, "item") and not isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    own = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        own.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return own


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_matches_its_sql(spark, duck, name):
    got, want = __spark_entry__.queries()[name](spark, SF).toPandas(), duck.execute(__spark_entry__.oracle_sql()[name]).fetchdf()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    table = [sorted(repr(tuple(norm(x) for x in r)) for r in df[columns].itertuples(index=False)) for df in (got, want)]
    assert table[0] == table[1]


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1
