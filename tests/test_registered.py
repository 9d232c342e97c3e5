"""Every registered query against its SQL, and what its plan must not contain."""

import os

import pytest

import __spark_entry__ as entry_point
import oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        assert oracle.differences(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["item", "window_end", "ct", "rk"]


def plan_of(spark, name) -> str:
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "filter_parse")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    plan = plan_of(spark, "pv_hourly")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def test_top_n_is_limited_before_the_shuffle(spark):
    for name in ("topn_items", "sql_topn_items", "udtaf_top2", "hot_urls"):
        assert "WindowGroupLimit" in plan_of(spark, name), name


def test_word_count_combines_before_the_shuffle(spark):
    plan = plan_of(spark, "wordcount_batch")
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
