import pytest

from flowplan.config import ForecastConfig, ScenarioConfig
from flowplan.operators import evaluation
from flowplan.plans import scenarios
from flowplan.sources import artifacts

NAMES = tuple(f"{f}_{p}" for f, p in scenarios.GRID)
FORECAST = ForecastConfig(
    ["naive_forecaster", "seasonal_forecaster"], validation_periods=7, test_periods=5
)


@pytest.fixture(scope="module")
def grid(spark):
    from conftest import Make

    make = Make(spark)
    tables = {
        "demand_history": make.demand(A=[10 + i % 7 for i in range(30)], B=[5 + i % 7 for i in range(30)]),
        "destinations": make.destinations(A=0.5, B=1.0),
        "lanes": make.lanes(("O1", "A", 1), ("O1", "B", 2), ("O2", "A", 2), ("O2", "B", 1)),
        "origins": make.origins(O1=16, O2=14),
    }
    configs = [
        ScenarioConfig(name, f, p, 5, FORECAST) for name, (f, p) in zip(NAMES, scenarios.GRID)
    ]
    broken = ScenarioConfig("broken", "selected", "naive", 5, ForecastConfig(["nothing"]))
    return tables, *scenarios.run_grid(tables, [*configs, broken])


def test_grid_goes_on_past_a_failure(grid):
    _, results, failures = grid
    assert list(results) == list(NAMES)
    assert list(failures) == ["broken"] and "nothing" in failures["broken"]


def test_perfect_forecast_with_optimal_plan_serves_everything(grid):
    _, results, _ = grid
    total = evaluation.grand_total(results["selected_optimized"].kpis).first()
    assert total["fill_rate"] == pytest.approx(1.0) and total["realized_holding_cost"] == pytest.approx(0)
    planned = results["selected_optimized"].planning.first()
    assert planned["mean_wape"] == 0.0 and planned["n_successful_destinations"] == 2
    assert planned["total_cost"] == pytest.approx(total["realized_total_cost"])


def test_naive_rows_have_no_forecast_figures(grid):
    _, results, _ = grid
    planned = results["naive_naive"].planning.first()
    assert planned["mean_wape"] is None and planned["holding_cost"] == 0.0


def test_summary_marks_missing(spark, grid):
    _, results, _ = grid
    made = scenarios.summary(
        spark, [*NAMES, "other"], scenarios.scenario_planning(results), scenarios.scenario_kpis(results)
    )
    rows = {r["scenario"]: r for r in made.collect()}
    assert rows["other"]["status"] == "MISSING" and rows["other"]["planned_cost"] is None
    assert rows["naive_naive"]["status"] == "OK" and len(rows) == 5


def test_decomposition_adds_up(grid):
    _, results, _ = grid
    kpis = scenarios.scenario_kpis(results)
    cost = {
        r["scenario"]: r["realized_total_cost"] for r in kpis.filter("destination_id IS NULL").collect()
    }
    row = scenarios.decomposition(kpis, NAMES).first()
    a, b, c, d = (cost[n] for n in NAMES)
    assert tuple(row) == pytest.approx((a - b, a - c, a - d, (a - d) - (a - b) - (a - c)))
    missing = scenarios.decomposition(kpis, ("naive_naive", "absent", *NAMES[2:])).first()
    assert missing["optimization_impact"] is None and missing["total_impact"] is not None


def test_breakdown(grid):
    _, results, _ = grid
    table = scenarios.breakdown(scenarios.scenario_kpis(results))
    assert table.count() == 8 and "fill_pct" in table.columns


def test_saved_results_read_back(spark, grid, tmp_path):
    tables, results, _ = grid
    root = str(tmp_path)
    for name in ("naive_naive", "selected_optimized"):
        artifacts.save(results[name], root)
        artifacts.save(results[name], root)
    summary = {r["scenario"]: r for r in artifacts.load_summary(spark, root, list(NAMES)).collect()}
    assert [summary[n]["status"] for n in NAMES] == ["OK", "MISSING", "MISSING", "OK"]
    again = artifacts.reevaluate(root, "naive_naive", tables)
    expected = {r["destination_id"]: list(r)[1:] for r in results["naive_naive"].kpis.collect()}
    for row in again.collect():
        assert list(row)[1:] == pytest.approx(expected[row["destination_id"]])
    models = artifacts.load(spark, root, "planning_models").filter("scenario = 'selected_optimized'")
    assert {r["selected_model"] for r in models.collect()} == {"seasonal_forecaster_lag_7"}


def test_nothing_saved(spark, tmp_path):
    rows = artifacts.load_summary(spark, str(tmp_path / "none"), ["s"]).collect()
    assert [r["status"] for r in rows] == ["MISSING"]
