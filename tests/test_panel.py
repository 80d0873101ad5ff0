import pytest
from conftest import day
from pyspark.sql import functions as F

from flowplan.operators import panel


def split_of(split, destination="A"):
    rows = split.filter(F.col("destination_id") == destination).orderBy("date").collect()
    return [r["split"] for r in rows]


def test_clean_drops_copies(make):
    demand = make.demand(A=[1, 2])
    twice = panel.clean({"demand_history": demand.unionByName(demand)})["demand_history"]
    assert twice.count() == 2
    assert panel.clean({"demand_history": twice})["demand_history"].count() == 2


def test_unique_series_merges_equal_copies(make):
    demand = make.demand(A=[1, None], B=[3])
    merged = panel.unique_series(demand.unionByName(demand))
    assert sorted(merged.collect()) == sorted(demand.select("destination_id", "date", "demand").collect())


def test_unique_series_conflicts(make):
    both = make.demand(A=[1]).unionByName(make.demand(A=[2]))
    with pytest.raises(Exception, match="conflicting demand rows for A"):
        panel.unique_series(both).collect()
    assert panel.unique_series(both, "sum").first()["demand"] == 3.0


def test_two_way_counts_rows_down(make):
    split = panel.split_two_way(make.demand(A=range(9), B=range(10)), 0.8)
    assert split_of(split, "A") == ["train"] * 7 + ["test"] * 2
    assert split_of(split, "B") == ["train"] * 8 + ["test"] * 2


def test_three_way(make):
    split = panel.split_three_way(make.demand(A=range(6), B=range(5)), 2, 3)
    assert split_of(split, "A") == ["train", "validation", "validation", "holdout", "holdout", "holdout"]
    assert split_of(split, "B") == [None] * 5


def test_split_periods(make):
    periods = panel.split_periods(panel.split_two_way(make.demand(A=range(5)), 0.8))
    rows = {r["split"]: r for r in periods.collect()}
    assert rows["train"]["valid"] and not rows["test"]["valid"]
    assert rows["test"]["start_date"] == day(4)


def test_dense_and_horizon(make):
    demand = make.demand(A=[1, 2, 3]).unionByName(make.demand(B=[5]))
    cells = panel.dense(demand.select("destination_id").distinct(), panel.horizon_array(demand), demand)
    rows = {(r["destination_id"], r["t"]): r["demand"] for r in cells.collect()}
    assert rows == {("A", 0): 1, ("A", 1): 2, ("A", 2): 3, ("B", 0): 5, ("B", 1): 0, ("B", 2): 0}


def test_demand_in_horizon_sums_and_zero_fills(make):
    demand = make.demand(A=[1, None, 3]).unionByName(make.demand(A=[4, 5]))
    kept = panel.demand_in_horizon(demand, panel.last_dates(demand, 2))
    assert {r["date"]: r["demand"] for r in kept.collect()} == {day(1): 5.0, day(2): 3.0}


def test_last_dates_are_global(make):
    demand = make.demand(A=range(5), B=range(3))
    assert {r["date"] for r in panel.last_dates(demand, 2).collect()} == {day(3), day(4)}


def test_min_history(make):
    kept = panel.long_enough(make.demand(A=range(5), B=range(3)), 4)
    assert {r["destination_id"] for r in kept.collect()} == {"A"}


def test_centered_mean(make):
    rows = panel.centered_mean(make.demand(A=range(9))).orderBy("date").collect()
    assert [r["centered_mean"] for r in rows] == [None] * 3 + [3.0, 4.0, 5.0] + [None] * 3
