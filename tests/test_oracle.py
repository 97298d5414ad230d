"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from courtload.plans.oracle import ORACLE
from courtload.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.helpers import duck, table


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_registered_with_oracle_or_rows_only():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    rows_only = set(QUERIES) - set(ORACLE)
    assert set(ORACLE) <= set(QUERIES)
    assert rows_only == set()


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in sdf.schema.fields}
    assert types == {r[0]: r[1] for r in con.sql(f"DESCRIBE {ORACLE[name]}").fetchall()}
    got = table(sdf.toPandas())
    want = table(con.sql(ORACLE[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"player_id", "rolling_5g_distance", "rolling_5g_avg_hr", "rolling_5g_minutes"} <= set(df.columns)
