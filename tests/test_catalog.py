"""Every query of the library against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from strataphon.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    plain = lambda v: v + 0.0 if isinstance(v, float) else v  # noqa: E731  -0.0 is 0.0
    return sorted(repr(tuple(map(plain, r))) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    mine, other = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    assert rows(mine) == rows(other)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_unpivot_scans_once(spark):
    plan = QUERIES["q_latest_unpivot"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan


def test_array_queries_do_not_shuffle(spark):
    plan = QUERIES["q_array_stats"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_scan_reads_two_columns(spark):
    plan = QUERIES["q_group_means"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string,value:double,props:string>" in plan
