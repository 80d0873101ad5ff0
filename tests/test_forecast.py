import pytest
from conftest import day
from pyspark.sql import functions as F

from flowplan.config import ForecastConfig
from flowplan.plans.forecast import run_forecast

MODELS = ["naive_forecaster", "seasonal_forecaster", "rolling_window_forecaster"]
PARAMS = {"rolling_window_forecaster": {"rolling_window": 7}}


def weekly(n=30):
    return [10 + i % 7 for i in range(n)]


def run(demand, **params):
    return run_forecast(demand, ForecastConfig(**({"model_names": MODELS, "model_params": PARAMS} | params)))


def table(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_weekly_series_selects_the_seasonal_model(make):
    done = run(make.demand(A=weekly(), B=weekly(40)))
    assert table(done.selected, "destination_id", "model", "wape") == [
        ("A", "seasonal_forecaster_lag_7", 0.0),
        ("B", "seasonal_forecaster_lag_7", 0.0),
    ]
    signal = table(done.signal(), "destination_id", "date", "demand")
    assert signal[:2] == [("A", day(24), 13.0), ("A", day(25), 14.0)] and len(signal) == 6 + 8


def test_short_series_are_left_out_not_failed(make):
    done = run(make.demand(A=weekly(), B=[1, 2, 3]), minimum_history_length=10)
    assert table(done.outcomes, "destination_id", "success") == [("A", True)]


def test_all_zero_series_fails_and_others_go_on(make):
    done = run(make.demand(A=weekly(), Z=[0] * 20))
    assert table(done.outcomes, "destination_id", "success", "error") == [
        ("A", True, None),
        ("Z", False, "no usable wape in any model"),
    ]
    assert table(done.signal(), "destination_id") == [("A",)] * 6
    with pytest.raises(ValueError):
        run(make.demand(Z=[0] * 20)).require_success()


def test_model_without_any_forecast_fails_alone(make):
    done = run(make.demand(A=weekly()), model_params={"seasonal_forecaster": {"lag_value": 40}})
    errors = dict(table(done.models, "model", "error"))
    assert errors["seasonal_forecaster_lag_40"] == "every forecast is null"
    assert done.successful.count() == 1


def test_all_models_failed(make):
    done = run(
        make.demand(A=weekly()),
        model_names=["seasonal_forecaster"], model_params={"seasonal_forecaster": {"lag_value": 40}},
    )
    assert table(done.failed, "error") == [("all models failed",)]


def test_windows_of_one_date_fail(make):
    done = run(make.demand(A=weekly(5)), model_names=["naive_forecaster"], model_params={})
    assert table(done.failed, "error") == [("train and selection windows need two dates each",)]


def test_row_order_and_partitions_do_not_matter(make):
    demand = make.demand(A=weekly(), B=weekly(33), C=[3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8])
    once = table(run(demand).selected, "destination_id", "model", "wape")
    shuffled = demand.repartition(11, "date").orderBy(F.desc("demand"))
    assert table(run(shuffled).selected, "destination_id", "model", "wape") == once
    assert table(run(demand.unionByName(demand)).selected, "destination_id", "model", "wape") == once


def test_three_way_selects_on_validation_and_reports_holdout(make):
    # Seasonal until the holdout, flat there: the seasonal model wins and then misses.
    values = weekly(28) + [50] * 4
    done = run(make.demand(A=values), validation_periods=7, test_periods=4)
    row = done.selected.first()
    assert row["model"] == "seasonal_forecaster_lag_7" and row["wape"] == 0.0
    assert row["forecast_window"] == "holdout" and row["final_wape"] > 0.5
    assert table(done.signal(), "date") == [(day(i),) for i in range(28, 32)]
    others = done.forecasts.filter(F.col("model") == "naive_forecaster")
    assert table(others, "forecast_window") == [("validation",)] * 7


def test_three_way_too_short(make):
    done = run(make.demand(A=weekly(), B=weekly(10)), validation_periods=5, test_periods=5)
    assert table(done.failed, "destination_id", "error") == [("B", "series too short for a three-way split")]


def test_one_period_holdout_falls_back_to_validation(make):
    done = run(make.demand(A=weekly()), validation_periods=7, test_periods=1)
    row = done.selected.first()
    assert row["forecast_window"] == "validation"
    assert done.signal().count() == 7


def test_fitted_models_refit_for_the_holdout(make):
    values = [float(i) for i in range(40)]
    done = run(
        make.demand(A=values),
        model_names=["ets_forecaster", "sarimax_forecaster"], model_params={},
        validation_periods=5, test_periods=5,
    )
    assert [r["demand"] for r in done.signal().orderBy("date").collect()] == pytest.approx(values[35:], rel=1e-4)
    assert table(done.selected, "mode") == [("multi_step",)]


def test_signal_null_rules(make):
    values = [5, 5, None, 5, 5, None, 5, 5, 5, None]
    done = run(make.demand(A=values), model_names=["naive_forecaster"], model_params={}, train_ratio=0.5)
    assert [r["demand"] for r in done.signal().orderBy("date").collect()] == [5.0, None, 5.0, 5.0, 5.0]
    assert [r["demand"] for r in done.signal("zero").orderBy("date").collect()] == [5.0, 0.0, 5.0, 5.0, 5.0]
    assert done.signal("drop").count() == 4
    with pytest.raises(ValueError):
        done.signal("other")


def test_nested_shape(make):
    row = run(make.demand(A=weekly())).nested().first()
    assert row["best_model"] == "seasonal_forecaster_lag_7"
    assert len(row["forecast_values"]) == 6 and len(row["all_models"]) == 3
    assert row["metrics"]["wape"] == 0.0


def test_unknown_model_is_rejected_before_any_work(make):
    with pytest.raises(KeyError):
        run(make.demand(A=weekly()), model_names=["nothing"], model_params={})


def test_conflicting_rows_fail_their_destination_only(make):
    demand = make.demand(A=[10 + i % 7 for i in range(40)], B=[10 + i % 7 for i in range(40)])
    broken = demand.union(demand.filter("destination_id = 'B' and date = '2023-01-05'").selectExpr("date", "destination_id", "demand + 1"))
    config = ForecastConfig(["naive_forecaster"])
    found = {r.destination_id: r for r in run_forecast(broken, config).outcomes.collect()}
    assert found["A"].success and found["A"].error is None
    assert not found["B"].success and found["B"].error == "conflicting demand rows"
    summed = {r.destination_id: r for r in run_forecast(broken, config, on_conflict="sum").outcomes.collect()}
    assert summed["A"].success and summed["B"].success
