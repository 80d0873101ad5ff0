import random

import pytest
from conftest import day

from flowplan.operators import evaluation
from flowplan.operators.inventory import replay


def test_closed_form_equals_recursion(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for d in range(60):
        stock = 0.0
        for t in range(40):
            inflow, demand = float(rng.choice([0, 0, 5, 9, 30])), float(rng.randint(-3, 20))
            rows.append((str(d), t, inflow, demand))
            available = stock + inflow
            fulfilled = min(demand, available)
            stock = available - fulfilled
            expected[str(d), t] = (stock, max(0.0, demand - available), fulfilled)
    table = spark.createDataFrame(rows, "destination_id string, t int, inflow double, demand double")
    for r in replay(table.repartition(7)).collect():
        assert (r["inventory"], r["shortage"], r["fulfilled"]) == pytest.approx(
            expected[r["destination_id"], r["t"]]
        )


@pytest.fixture
def case(spark, make):
    flows = spark.createDataFrame(
        [("O1", "A", day(0), 10.0), ("O1", "A", day(1), 2.0), ("O2", "B", day(0), 4.0), ("O1", "X", day(0), 3.0)],
        "origin_id string, destination_id string, period date, flow double",
    )
    lanes = make.lanes(("O1", "A", 2), ("O1", "X", 5))
    demand = make.demand(A=[6, 9, 50], B=[1, 1, 1])
    return flows, demand, lanes, make.destinations(A=0.5, B=None, C=1.0)


def test_realized(case):
    rows = {r["destination_id"]: r for r in evaluation.realized(*case).collect()}
    a = rows["A"]
    assert (a["transport_cost"], a["realized_holding_cost"]) == (24.0, 2.0)
    assert (a["total_actual_demand"], a["total_fulfilled"], a["total_shortage"]) == (15.0, 12.0, 3.0)
    assert a["fill_rate"] == pytest.approx(0.8) and a["cost_per_unit_fulfilled"] == pytest.approx(26 / 12)
    # No lane: free transport. No demand: filled by definition, no unit cost.
    assert rows["B"]["transport_cost"] == 0.0 and rows["B"]["realized_holding_cost"] == 0.0
    assert rows["C"]["fill_rate"] == 1.0 and rows["C"]["cost_per_unit_demanded"] == 0.0
    # X is not a listed destination, yet its transport counts in the total.
    assert "X" not in rows
    total = rows[None]
    assert total["transport_cost"] == 39.0 and total["total_actual_demand"] == 17.0
    assert total["realized_total_cost"] == 41.0


def test_full_horizon_keeps_dates_without_flow(case):
    flows, demand, lanes, destinations = case
    kpis = evaluation.realized(flows, demand, lanes, destinations, demand.select("date"))
    total = evaluation.grand_total(kpis).first()
    assert total["total_actual_demand"] == 68.0


def test_plan_cost_without_holding_column(spark, make, case):
    flows, _, lanes, destinations = case
    stock = spark.createDataFrame([("A", day(0), 7.0)], "destination_id string, period date, inventory double")
    row = evaluation.plan_cost(flows, stock, lanes, destinations.drop("holding_cost")).first()
    assert (row["transportation_cost"], row["holding_cost"], row["total_cost"]) == (39.0, 0.0, 39.0)
