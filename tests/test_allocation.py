import pytest
from conftest import day

from flowplan.operators import evaluation
from flowplan.operators.allocation import allocate
from flowplan.operators.models import lag_one_panel
from flowplan.operators.panel import last_dates


def flows_of(allocation):
    return {
        (r["origin_id"], r["destination_id"], r["period"]): r["flow"] for r in allocation.flows().collect()
    }


def test_shares_three_to_one(make):
    flows = flows_of(allocate(make.demand(A=[30], B=[10]), make.origins(O=80)))
    assert flows == {("O", "A", day(0)): 60.0, ("O", "B", day(0)): 20.0}


def test_zero_forecast_is_shared_equally(make):
    flows = flows_of(allocate(make.demand(A=[0], B=[0]), make.origins(O=100)))
    assert set(flows.values()) == {50.0}


def test_negative_forecast_is_clamped(make):
    flows = flows_of(allocate(make.demand(A=[-5], B=[10]), make.origins(O=100)))
    assert flows["O", "A", day(0)] == 0.0 and flows["O", "B", day(0)] == 100.0


def test_null_and_absent_forecasts_count_as_zero(make):
    flows = flows_of(allocate(make.demand(A=[None, 5], B=[10]), make.origins(O=100)))
    assert flows["O", "B", day(0)] == 100.0 and flows["O", "A", day(1)] == 100.0
    assert flows["O", "B", day(1)] == 0.0


def test_cost_of_two_origins(make):
    plan = allocate(make.demand(A=[30], B=[70]), make.origins(O1=60, O2=40))
    lanes = make.lanes(("O1", "A", 1), ("O1", "B", 2), ("O2", "A", 3), ("O2", "B", 4))
    row = plan.kpis(make.demand(A=[30], B=[70]), lanes).first()
    assert row["transportation_cost"] == pytest.approx(250)
    assert row["total_cost"] == row["transportation_cost"] and row["holding_cost"] == 0.0
    assert row["infeasibility_rate"] == 0.0 and row["unmet_demand_pct"] == pytest.approx(0.0)


def test_missing_lane_ships_free(make):
    signal = make.demand(A=[50], B=[50])
    plan = allocate(signal, make.origins(O=100))
    assert plan.kpis(signal, make.lanes(("O", "A", 5))).first()["transportation_cost"] == pytest.approx(250)
    assert len(flows_of(plan)) == 2


def test_unmet_share(make):
    signal = make.demand(A=[100])
    plan = allocate(signal, make.origins(O=50))
    assert plan.kpis(signal, make.lanes(("O", "A", 1))).first()["unmet_demand_pct"] == pytest.approx(50)


def test_stock_carries_over(make):
    demand = make.demand(A=[20, 150])
    plan = allocate(demand, make.origins(O=100))
    assert plan.kpis(demand, make.lanes(("O", "A", 1))).first()["unmet_demand_pct"] == pytest.approx(0)
    stock = {r["date"]: r["inventory"] for r in plan.replayed(demand).collect()}
    assert stock == pytest.approx({day(0): 80.0, day(1): 30.0})


def test_factored_kpis_equal_those_of_the_flows(make):
    demand = make.demand(A=[5, 9, 2], B=[7, 1, 30], C=[4, 4, 4])
    lanes = make.lanes(("O1", "A", 1), ("O1", "B", 2), ("O2", "C", 3), ("O2", "B", 4))
    destinations = make.destinations(A=0.5, B=1.0, C=2.0)
    plan = allocate(make.demand(A=[1, 2, 3], B=[3, 2, 1], C=[0, 1, 0]), make.origins(O1=9, O2=6))
    direct = evaluation.realized(plan.flows(), demand, lanes, destinations)
    by_id = {r["destination_id"]: r for r in direct.collect()}
    for row in plan.realized(demand, lanes, destinations).collect():
        assert list(row)[1:] == pytest.approx(list(by_id[row["destination_id"]])[1:])


def test_lag_one_panel(make):
    history = make.demand(D1=[1, 2, 3, 4, 5], D2=[11, 12, 13, 14, 15])
    rows = lag_one_panel(history, last_dates(history, 3)).orderBy("destination_id", "date").collect()
    assert [r["demand"] for r in rows] == [2, 3, 4, 12, 13, 14]


def test_lag_one_panel_drops_the_first_date(make):
    history = make.demand(D=[10, 20])
    assert [r["demand"] for r in lag_one_panel(history, last_dates(history, 2)).collect()] == [10.0]
