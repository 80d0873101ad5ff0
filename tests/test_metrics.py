import math

import pytest
from pyspark.sql import functions as F

from flowplan.operators.selection import ALL_NULL, score, select_best


def scored(spark, actual, forecast):
    rows = [("D", a, f) for a, f in zip(actual, forecast)]
    return score(
        spark.createDataFrame(rows, "destination_id string, actual double, forecast double"),
        "destination_id",
    ).first()


def test_hand_case(spark):
    row = scored(spark, [10.0, 20.0, 30.0], [12.0, 18.0, 33.0])
    assert row["mae"] == pytest.approx(7 / 3)
    assert row["mse"] == pytest.approx(17 / 3)
    assert row["rmse"] == pytest.approx(math.sqrt(17 / 3))
    assert row["mape"] == pytest.approx((0.2 + 0.1 + 0.1) / 3)
    assert row["wape"] == pytest.approx(7 / 60)
    assert row["error"] is None


def test_zero_actuals(spark):
    row = scored(spark, [0.0, 0.0, 0.0], [1.0, 2.0, 3.0])
    assert math.isnan(row["wape"]) and row["mae"] == 2.0 and row["mape"] > 1e15


def test_null_rows_are_left_out(spark):
    assert scored(spark, [10.0, 20.0, 30.0], [None, 18.0, 33.0])["mae"] == 2.5
    assert scored(spark, [None, 20.0, 30.0], [5.0, 18.0, 33.0])["mae"] == 2.5


def test_no_forecast_at_all(spark):
    assert scored(spark, [10.0, 20.0], [None, None])["error"] == ALL_NULL


def test_no_pair_left(spark):
    row = scored(spark, [None, None], [1.0, None])
    assert row["error"] is None
    assert all(math.isnan(row[m]) for m in ("mae", "mse", "rmse", "mape", "wape"))


def best(spark, rows, metric="wape"):
    table = spark.createDataFrame(
        [(d, i, m, w) for d, i, m, w in rows], f"destination_id string, ord int, model string, {metric} double"
    )
    return {r["destination_id"]: r for r in select_best(table, metric).collect()}


def test_least_wins_first_breaks_ties(spark):
    found = best(
        spark,
        [("A", 0, "x", 0.3), ("A", 1, "y", 0.1), ("A", 2, "z", 0.1), ("B", 0, "x", float("nan")), ("B", 1, "y", 5.0)],
    )
    assert found["A"]["model"] == "y"
    assert found["B"]["model"] == "y"


def test_nothing_usable_names_destination(spark):
    found = best(spark, [("C", 0, "x", float("nan")), ("C", 1, "y", None)])
    assert found["C"]["model"] is None and "C" in found["C"]["error"]


def test_unknown_metric(spark):
    table = spark.createDataFrame([("A", 0, "x", 1.0)], "destination_id string, ord int, model string, mae double")
    with pytest.raises(ValueError):
        select_best(table, "r2")
    with pytest.raises(ValueError):
        select_best(table, "wape")
    assert select_best(table, "mae").filter(F.col("model") == "x").count() == 1
