import datetime as dt

import pytest

from flowplan import schemas
from flowplan.operators import quality
from flowplan.session import scratch_folder
from flowplan.sources.validated import write_clean


def test_counts_come_with_the_write(spark, make):
    demand = make.demand(D=[1, 2, None]).unionByName(make.demand(D=[1]))
    folder = scratch_folder(spark, "clean")
    clean, report = write_clean({"demand_history": demand}, folder, not_null={})
    assert clean["demand_history"].count() == 3
    row = report.first()
    assert (row.rows, row.kept, row.nulls) == (4, 3, {"date": 0, "destination_id": 0, "demand": 1})


@pytest.mark.parametrize(("series", "message"), [({"D": [1, None]}, "demand has 1 nulls"), ({}, "has no rows")])
def test_faults_are_raised(spark, make, series, message):
    with pytest.raises(quality.QualityError, match=message):
        write_clean({"demand_history": make.demand(**series)}, scratch_folder(spark, "clean"))


def test_missing_columns_fail_before_a_write(spark, make):
    folder = scratch_folder(spark, "clean")
    with pytest.raises(quality.QualityError, match="lacks columns"):
        write_clean({"origins": make.origins(O=1), "lanes": make.lanes(("O", "D", 1)).drop("unit_cost")}, folder)


def test_last_and_first_of_repeated_keys(spark):
    rows = [("a", 1, 9.0), ("a", 2, 1.0), ("a", 2, 3.0), ("a", None, 7.0), ("b", None, None), ("b", None, None)]
    frame = spark.createDataFrame(rows, "k string, seq int, v double").repartition(3)
    keep = lambda how: {tuple(r) for r in quality.resolved_keys(frame, ["k"], ["seq"], how).collect()}
    assert keep("last") == {("a", 2, 3.0), ("b", None, None)}
    assert keep("first") == {("a", None, 7.0), ("b", None, None)}
    assert quality.resolved_keys(frame.limit(0), ["k"], ["seq"]).count() == 0
    with pytest.raises(ValueError, match="keep"):
        quality.resolved_keys(frame, ["k"], ["seq"], "any")


def test_contract(spark):
    day = dt.date(2024, 1, 1)
    rows = [("a", "naive", "mae", day, day + dt.timedelta(1), 1.0), ("b", "naive", None, day, day, 1.0), ("c", "naive", "mae", None, day, 1.0)]
    frame = spark.createDataFrame(rows, schemas.SCORED_WINDOW)
    found = {tuple(r) for r in quality.contract_violations(frame, schemas.SCORED_WINDOW, ["mae"]).collect()}
    assert {(r, k) for r, k, _ in found} == {("unknown_metric", "b"), ("reversed_period", "b"), ("reversed_period", "c")}
    bad = frame.drop("metric", "model").withColumn("value", frame["value"].cast("int"))
    found = {tuple(r) for r in quality.contract_violations(bad.limit(0), schemas.SCORED_WINDOW, ["mae"]).collect()}
    assert found == {("missing_column", "metric", "string"), ("missing_column", "model", "string"), ("wrong_type", "value", "int")}
