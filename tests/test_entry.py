import pytest

import __spark_entry__ as registered
import compare

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "holding_norm", "dq_unreachable", "clean_demand", "demand_in_horizon", "dense_panel",
    "split_three_way", "split_periods", "ma7_centered", "fc_naive", "fc_seasonal", "fc_rolling",
    "fc_arima110", "fc_ets_grid", "fc_user_model", "metrics", "scores", "outcomes", "holdout",
    "export_forecast", "alloc_kpis", "realized_by_destination", "plan_jit", "plan_inventory",
    "plan_end_to_end", "gen_panel",
]


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, connection, name):
    frame = registered.queries()[name](spark, FOLDER).toPandas()
    assert len(frame)
    expected = connection.execute(registered.oracle_sql()[name]).fetch_df()
    assert compare.differences(frame, expected) == []
