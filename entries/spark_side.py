"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from functools import wraps

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowplan.config import METRICS, ForecastConfig, ScenarioConfig
from flowplan.functions.columns import one_row
from flowplan.operators import evaluation, panel, quality
from flowplan.operators.allocation import Allocation, allocate
from flowplan.operators.arima import arima
from flowplan.operators.models import (
    MULTI_STEP,
    SeriesModel,
    lag_one_panel,
    naive,
    rolling,
    seasonal,
)
from flowplan.operators.skew import every_pair
from flowplan.operators.selection import score, select_best
from flowplan.operators.smoothing import ets, ets_grid
from flowplan import schemas
from flowplan.plans import certificate, check, scenarios
from flowplan.plans.forecast import ForecastRun, default_registry, run_forecast
from flowplan.plans.netting import Demand, demand_of
from flowplan.plans.planner import optimize
from flowplan.plans.priced import priced_plan
from flowplan.plans.slack import overload, slack_flows, slack_plan
from flowplan.session import cut_lineage, scratch_folder
from flowplan.sources import artifacts, generate, tables, validated
from flowplan.sources.testnet import TestNetwork

BASELINES = ("naive_forecaster", "seasonal_forecaster", "rolling_window_forecaster")
BASELINE_PARAMS = {
    "seasonal_forecaster": {"lag_value": 12},
    "rolling_window_forecaster": {"rolling_window": 3},
}
ALL_MODELS = (*BASELINES, "ets_forecaster", "sarimax_forecaster")
LAST_MONTHS = 12
SCENARIO_NAMES = tuple(f"{forecast}_{plan}" for forecast, plan in scenarios.GRID)

QUERIES = {}


def query(function):
    """Register ``function(net)`` under its name."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(TestNetwork(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def rounded(column: str, digits: int) -> Column:
    """A rounded figure under its own name; adding zero turns -0.0 into 0.0."""
    return (F.round(F.col(column), digits) + F.lit(0.0)).alias(column.split(".")[-1])


def known(column: str, digits: int) -> Column:
    """A rounded figure, null where it is NaN."""
    return F.when(~F.isnan(column), rounded(column, digits)).alias(column.split(".")[-1])


def months(net: TestNetwork) -> DataFrame:
    return cut_lineage(net.demand_month())


def baselines(three_way: int | None = None, **params) -> ForecastConfig:
    if three_way:
        params |= {"validation_periods": three_way, "test_periods": three_way}
    return ForecastConfig(BASELINES, model_params=BASELINE_PARAMS, **params)


def with_model(demand: DataFrame, name: str, factory, **params) -> ForecastRun:
    registry = default_registry()
    registry.register(name, factory)
    return run_forecast(demand, ForecastConfig((name,), model_params={name: params}), registry)


def initial_stock(net: TestNetwork) -> DataFrame:
    return net.table("nation").select(
        F.col("n_name").alias("destination_id"),
        (100.0 * (F.col("n_nationkey") % 4)).alias("qty"),
    )


def lag_signal(net: TestNetwork, demand: DataFrame) -> DataFrame:
    return lag_one_panel(demand, panel.last_dates(demand, LAST_MONTHS))


# Sources and sinks


@query
def src_network(net):
    folder = scratch_folder(net.spark, "network")
    generate.write_network(
        {
            "demand_history": net.demand_month(),
            "destinations": net.destinations(),
            "lanes": net.lanes(),
            "origins": net.origins_slack(),
        },
        folder,
    )
    read = tables.read_network(net.spark, folder)
    value = {
        "demand_history": "demand",
        "destinations": "holding_cost",
        "lanes": "unit_cost",
        "origins": "daily_capacity",
    }
    return quality.union(
        read[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(column).alias("total"),
        )
        for name, column in value.items()
    )


@query
def src_records(net):
    folder = scratch_folder(net.spark, "records")
    net.demand_event_day().write.json(folder)
    return tables.read_records(net.spark, folder, "demand_history")


@query
def holding_norm(net):
    some = F.when(F.col("n_nationkey") % 4 != 3, 0.25 * (1 + F.col("n_nationkey") % 4))
    nations = net.table("nation").select(F.col("n_name").alias("destination_id"), some.alias("holding_cost"))
    none = nations.select("destination_id")
    return quality.union(
        tables.normalize_holding(table).withColumn("case_name", F.lit(case))
        for case, table in (("some", nations), ("none", none))
    )


def saved_scenario(net) -> tuple[str, dict[str, DataFrame]]:
    network = network_tables(net)
    config = ScenarioConfig("naive_optimized", "naive", "optimized", LAST_MONTHS)
    results, failures = scenarios.run_grid(network, [config])
    if failures:
        raise RuntimeError(failures)
    root = scratch_folder(net.spark, "scenario")
    artifacts.save(results[config.name], root)
    return root, network


def network_tables(net) -> dict[str, DataFrame]:
    network = {
        "demand_history": net.demand_month(),
        "destinations": net.destinations(),
        "lanes": net.lanes(),
        "origins": net.origins_slack(),
    }
    return panel.clean(network)


@query
def sink_roundtrip(net):
    root, _ = saved_scenario(net)
    return artifacts.load(net.spark, root, "inventory").select(
        "scenario", "destination_id", "period", "inventory"
    )


@query
def realized_from_saved(net):
    root, network = saved_scenario(net)
    kpis = artifacts.reevaluate(root, "naive_optimized", network)
    return rounded_kpis(evaluation.by_destination(kpis), "destination_id")


def rounded_kpis(kpis: DataFrame, *keys: str) -> DataFrame:
    return kpis.select(
        *keys,
        *[
            rounded(name, 6 if "per_unit" in name or name == "fill_rate" else 2)
            for name in evaluation.KPIS
        ],
    )


# Quality


def broken_network(net) -> dict[str, DataFrame]:
    """The test network with faults that depend on its keys."""
    nations = net.table("nation")
    served = nations.filter("n_nationkey % 7 != 5").select(F.col("n_name").alias("destination_id"))
    return {
        "signal": net.demand_cells(),
        "lanes": net.lanes()
        .join(served, "destination_id", "left_semi")
        .withColumn("unit_cost", F.col("unit_cost") - 1.25),
        "origins": net.table("supplier")
        .filter("s_suppkey % 9 != 4")
        .select(
            F.col("s_suppkey").cast("string").alias("origin_id"),
            (F.col("s_suppkey") % 5 - 1.0).alias("daily_capacity"),
        ),
        "destinations": nations.select(
            F.col("n_name").alias("destination_id"),
            (F.col("n_nationkey") % 4 - 1.0).alias("holding_cost"),
        ),
        "initial": nations.select(
            F.col("n_name").alias("destination_id"), (F.col("n_nationkey") - 2.0).alias("qty")
        ),
    }


def broken_report(net) -> DataFrame:
    broken = broken_network(net)
    signal = cut_lineage(broken["signal"])
    return quality.plan_report(
        signal, broken["origins"], broken["lanes"], broken["destinations"],
        signal.select("date").distinct(), broken["initial"], limit=1000,
    )


@query
def dq_report(net):
    return broken_report(net)


@query
def dq_first_violation(net):
    return quality.first_violation(broken_report(net))


@query
def dq_network(net):
    gappy = net.demand_cells().withColumn(
        "demand", F.when(F.col("demand") % 7 != 0, F.col("demand"))
    )
    empty = net.destinations().filter("holding_cost > 1")
    return quality.network_report(
        {
            "demand_history": gappy,
            "destinations": empty,
            "lanes": net.lanes(),
            "origins": net.origins_slack(),
        }
    )


@query
def dq_unreachable(net):
    broken = broken_network(net)
    return quality.unreachable(broken["signal"], broken["lanes"]).select("rule", "key")


@query
def dq_capacity(net):
    signal = net.demand_cells()
    return quality.capacity_balance(
        signal, broken_network(net)["origins"], signal.select("date")
    )


@query
def dq_duplicate_keys(net):
    lanes = net.lanes()
    changed = lanes.filter("unit_cost > 10").withColumn("unit_cost", F.col("unit_cost") + 1)
    return quality.conflicting_keys(
        lanes.unionByName(changed).unionByName(lanes.filter("unit_cost < 4")),
        ["origin_id", "destination_id"], "unit_cost", "lanes",
    )


@query
def plan_size(net):
    signal = net.demand_cells()
    return quality.plan_size(signal, net.lanes(), signal.select("date"))


# Panel


@query
def clean_demand(net):
    weeks = net.demand_supplier_week()
    repeated = weeks.unionByName(weeks.filter(F.col("destination_id").cast("int") % 3 == 0))
    return panel.clean({"demand_history": repeated})["demand_history"].select(
        "date", "destination_id", "demand"
    )


@query
def clean_report(net):
    """Rows, distinct rows and nulls of each table, counted by the jobs that write the cleaned tables."""
    weeks = net.demand_supplier_week()
    repeated = weeks.unionByName(weeks.filter(F.col("destination_id").cast("int") % 3 == 0))
    places = net.destinations().withColumn("holding_cost", F.when(F.col("holding_cost") > 0.25, F.col("holding_cost")))
    inputs = {"demand_history": repeated, "destinations": places, "lanes": net.lanes(), "origins": net.origins_slack()}
    _, report = validated.write_clean(inputs, scratch_folder(net.spark, "clean"))
    return report.select(
        "name", "rows", "kept", F.aggregate(F.map_values("nulls"), F.lit(0).cast("long"), lambda a, b: a + b).alias("nulls")
    )


@query
def dq_resolved_keys(net):
    """The latest order of each customer, where several state a price."""
    orders = net.table("orders").select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_totalprice").alias("stated"))
    latest = quality.resolved_keys(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    first = quality.resolved_keys(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], keep="first")
    return latest.select("o_custkey", F.col("o_orderkey").alias("last_order"), F.col("stated").alias("last_price")).join(
        first.select("o_custkey", F.col("o_orderkey").alias("first_order"), F.col("stated").alias("first_price")), "o_custkey"
    )


@query
def result_contract(net):
    """Windows of orders per customer, of which some name no known metric, some run backwards, and one column is text."""
    orders = net.table("orders")
    spans = orders.groupBy(F.col("o_custkey").cast("string").alias("destination_id")).agg(
        F.min("o_orderdate").cast("date").alias("start_date"), F.max("o_orderdate").cast("date").alias("end_date"),
        F.count(F.lit(1)).cast("string").alias("value"),
    )
    metric = F.when(F.col("destination_id").cast("int") % 7 == 0, "medae").otherwise("mae")
    return quality.contract_violations(spans.withColumn("metric", metric), schemas.SCORED_WINDOW, METRICS)


@query
def demand_in_horizon(net):
    weeks = net.demand_supplier_week().withColumn(
        "demand", F.when(F.col("demand") % 7 != 0, F.col("demand"))
    )
    repeated = weeks.unionByName(weeks.filter(F.col("destination_id").cast("int") % 3 == 0))
    return panel.demand_in_horizon(repeated, panel.last_dates(weeks, 52))


@query
def horizon(net):
    return panel.horizon(net.demand_supplier_week())


@query
def last_n_dates(net):
    return panel.last_dates(net.demand_supplier_week(), 30)


@query
def dense_panel(net):
    weeks = net.demand_supplier_week()
    return panel.dense(
        weeks.select("destination_id").distinct(), panel.horizon_array(weeks), weeks
    )


@query
def lane_periods(net):
    return panel.on_horizon(
        net.lanes().select("origin_id", "destination_id"), panel.horizon_array(net.demand_cells())
    )


@query
def min_history(net):
    kept = panel.long_enough(net.demand_supplier_week(), 285)
    return kept.select("destination_id", "n").distinct()


@query
def split_two_way(net):
    split = panel.split_two_way(net.demand_supplier_week(), 0.8)
    return split.select("destination_id", "date", "split")


@query
def split_three_way(net):
    split = panel.split_three_way(net.demand_supplier_week(), 100, 185)
    return split.select("destination_id", "date", "split")


@query
def split_periods(net):
    periods = panel.split_periods(panel.split_two_way(net.demand_supplier_week(), 0.8))
    return periods.withColumnRenamed("rows", "n_rows")


@query
def ma7_centered(net):
    centered = panel.centered_mean(net.demand_event_day())
    return centered.select("destination_id", "date", rounded("centered_mean", 6))


@query
def series_stats(net):
    return panel.series_stats(net.demand_event_day()).withColumnRenamed("rows", "n_rows")


# Forecasts


def model_rows(run: ForecastRun, digits: int = 6) -> DataFrame:
    return run.forecasts.select(
        "destination_id", "date", "actual", rounded("forecast", digits)
    )


@query
def fc_naive(net):
    return model_rows(with_model(net.demand_supplier_week(), "previous", naive))


@query
def fc_seasonal(net):
    return model_rows(with_model(net.demand_supplier_week(), "seasonal", seasonal, lag_value=52))


@query
def fc_rolling(net):
    return model_rows(with_model(net.demand_supplier_week(), "mean", rolling, rolling_window=7))


@query
def fc_lag1_panel(net):
    weeks = net.demand_supplier_week()
    return lag_one_panel(weeks, panel.last_dates(weeks, 30))


@query
def fc_ets(net):
    return model_rows(with_model(net.demand_supplier_week(), "ets", ets))


@query
def fc_ets_seasonal(net):
    return model_rows(
        with_model(net.demand_month(), "ets", ets, trend="add", seasonal="add", seasonal_periods=12)
    )


@query
def fc_ets_grid(net):
    return model_rows(with_model(net.demand_month(), "ets_grid", ets_grid), 3)


@query
def fc_arima110(net):
    return model_rows(with_model(net.demand_month(), "arima", arima), 3)


@query
def fc_arima110_conditional(net):
    return model_rows(with_model(net.demand_month(), "arima", arima, estimate="conditional"), 3)


@query
def fc_arima(net):
    return model_rows(
        with_model(net.demand_month(), "arima", arima, order=(1, 0, 1), seasonal_order=(0, 1, 0, 12))
    )


def last_four() -> SeriesModel:
    """A user's own model: the mean of the last four fitted values."""

    def forecast(train: pd.DataFrame, window: pd.DataFrame):
        return [train["demand"].tail(4).mean()] * len(window)

    return SeriesModel("last_four", MULTI_STEP, forecast)


@query
def fc_user_model(net):
    return model_rows(with_model(net.demand_supplier_week(), "last_four", last_four))


@query
def metrics(net):
    weeks = panel.split_two_way(net.demand_supplier_week(), 0.8)
    forecasts = weeks.select(
        "destination_id", "split", F.col("demand").alias("actual"),
        F.lag("demand", 52).over(panel.in_series()).alias("forecast"),
    ).filter(F.col("split") == "test")
    return score(forecasts, "destination_id").select(
        "destination_id", *[known(name, 4) for name in METRICS], "error"
    )


@query
def scores(net):
    run = run_forecast(net.demand_supplier_week(), baselines())
    return run.models.select(
        "destination_id", F.col("ord").cast("long").alias("ord"), "model", "registry_key", "mode",
        *[known(name, 4) for name in METRICS], "error",
    )


@query
def select_model(net):
    run = run_forecast(net.demand_supplier_week(), baselines())
    best = select_best(run.models, "mae")
    return best.select("destination_id", "model", known("mae", 4), "error")


def failing_run(net) -> ForecastRun:
    """Holdout lengths that the shorter series cannot give."""
    config = ForecastConfig(
        BASELINES, model_params=BASELINE_PARAMS, validation_periods=100, test_periods=185
    )
    return run_forecast(net.demand_supplier_week(), config)


@query
def outcomes(net):
    return failing_run(net).outcomes.select(
        "destination_id", "success", "error",
        F.col("best.model").alias("model"), known("best.wape", 4),
    )


@query
def holdout(net):
    run = failing_run(net)
    return run.selected.select(
        "destination_id", "model", "forecast_window", known("wape", 4),
        known("final_wape", 4), known("final_mae", 4),
    )


@query
def forecast_pipeline(net):
    run = run_forecast(net.demand_supplier_week(), baselines())
    return run.selected.select(
        "destination_id", "model", "mode", *[known(name, 4) for name in METRICS]
    )


@query
def forecast_all_models(net):
    config = ForecastConfig(ALL_MODELS, model_params=BASELINE_PARAMS)
    run = run_forecast(net.demand_supplier_week(), config)
    return run.selected.select("destination_id", "model", *[known(name, 4) for name in METRICS])


@query
def forecast_nested(net):
    return run_forecast(net.demand_supplier_week(), baselines()).nested()


@query
def export_forecast(net):
    signal = run_forecast(net.demand_supplier_week(), baselines()).signal("zero")
    return signal.withColumn("demand", rounded("demand", 6))


# Allocation and replay


@query
def alloc_proportional(net):
    demand = months(net)
    flows = allocate(lag_signal(net, demand), net.origins_tight()).flows()
    return flows.withColumn("flow", rounded("flow", 6))


@query
def alloc_kpis(net):
    demand = months(net)
    kpis = allocate(lag_signal(net, demand), net.origins_tight()).kpis(demand, net.lanes())
    return kpis.select(
        rounded("transportation_cost", 2), "holding_cost",
        rounded("total_cost", 2),
        rounded("unmet_demand_pct", 6), "infeasibility_rate",
    )


@query
def alloc_overbooked(net):
    """Share of cells above capacity when every month ships its demand relative to the mean month."""
    demand = months(net)
    plan = allocate(lag_signal(net, demand), net.origins_tight())
    totals = cut_lineage(demand.groupBy("date").agg(F.sum("demand").alias("total")))
    load = F.col("total") / totals.agg(F.avg("total")).scalar()
    shares = plan.shares.join(totals, "date").withColumn("share", F.col("share") * load)
    rate = Allocation(shares.select("destination_id", "t", "date", "share"), plan.origins).infeasibility_rate()
    return rate.select(rounded("infeasibility_rate", 9))


def lag_flows(net, demand: DataFrame) -> DataFrame:
    wanted = demand_of(lag_signal(net, demand))
    return cut_lineage(slack_flows(wanted.required(), net.lanes()))


@query
def transport_cost(net):
    # Half of the lanes are unknown to the price list and cost nothing.
    lanes = net.lanes().filter(F.col("origin_id").cast("int") % 2 == 0)
    return evaluation.transport_cost(lag_flows(net, months(net)), lanes)


@query
def inventory_replay(net):
    demand = months(net)
    flows = lag_flows(net, demand)
    played = evaluation.inventory_replay(
        evaluation.arrivals(flows), demand, net.destinations(),
        flows.select(F.col("period").alias("date")),
    )
    return played.select(
        "destination_id", "date", "inflow", "demand", "inventory", "shortage", "fulfilled"
    )


def lag_kpis(net) -> DataFrame:
    demand = months(net)
    return evaluation.realized(lag_flows(net, demand), demand, net.lanes(), net.destinations())


@query
def realized_by_destination(net):
    return rounded_kpis(evaluation.by_destination(lag_kpis(net)), "destination_id")


@query
def realized_total(net):
    return rounded_kpis(evaluation.grand_total(lag_kpis(net)))


# Plans


def stocked_plan(net):
    return slack_plan(
        demand_of(months(net), initial=initial_stock(net)), net.lanes(), net.destinations()
    )


@query
def plan_jit(net):
    return stocked_plan(net).flows


@query
def plan_inventory(net):
    return stocked_plan(net).inventory()


@query
def plan_cost(net):
    return stocked_plan(net).cost()


@query
def plan_overload(net):
    flows = slack_flows(demand_of(months(net)).required(), net.lanes())
    return overload(flows, net.origins_tight()).select("origin_id", "period", "shipped", "excess")


@query
def plan_violations(net):
    plan = slack_plan(demand_of(months(net)), net.lanes(), net.destinations())
    return check.plan_violations(
        plan.demand, plan.flows, plan.inventory(), net.origins_tight(), plan.cost()
    )


def regional_plan(net):
    net.keep_demand()
    lanes = net.regional_lanes()
    served = lanes.select("destination_id").distinct()
    signal = net.demand_month().join(served, "destination_id", "left_semi")
    return optimize(signal, net.origins_regional(), lanes, net.destinations())


@query
def plan_batch(net):
    return regional_plan(net).flows


@query
def plan_batch_shipped(net):
    return (
        regional_plan(net).flows.groupBy("destination_id").agg(F.round(F.sum("flow"), 3).alias("shipped"))
    )


@query
def plan_batch_violations(net):
    plan = regional_plan(net)
    found = check.plan_violations(
        plan.demand, plan.flows, plan.inventory(), net.origins_regional(), plan.cost()
    )
    return found.agg(F.count(F.lit(1)).alias("violations"))


@query
def plan_priced(net):
    net.keep_demand()
    origins = cut_lineage(net.origins_tight())
    demand = Demand(cut_lineage(demand_of(net.demand_month()).cells))
    return priced_plan(demand, origins, net.lanes(), net.destinations()).flows


@query
def plan_priced_check(net):
    """Violations and unmet cells of the priced plan, and whether its bound lies below its cost."""
    net.keep_demand()
    origins = cut_lineage(net.origins_tight())
    demand = Demand(cut_lineage(demand_of(net.demand_month()).cells), initial_stock(net))
    plan = priced_plan(demand, origins, net.lanes(), net.destinations())
    cost = plan.cost()
    found = check.plan_violations(demand, plan.flows, plan.inventory(), origins, cost)
    return one_row(
        found.agg(F.count(F.lit(1)).alias("violations")),
        plan.unmet.agg(F.count(F.lit(1)).alias("unmet")),
        cost.select((F.col("total_cost") >= plan.lower_bound).alias("bounded")),
    )


def priced_overload(net):
    """Cheapest-lane shipments of the tight network, priced by how far they overload an origin, with the values this gives."""
    demand, lanes, origins = demand_of(months(net)), net.lanes(), cut_lineage(net.origins_tight())
    required = cut_lineage(demand.required())
    flows = slack_flows(required, lanes)
    heavy = overload(flows, origins).select("origin_id", F.col("period").alias("date"), (F.col("excess") / F.col("daily_capacity")).alias("price"))
    dates = panel.small_calendar(required, "t", "date")
    grid = every_pair(origins.select("origin_id"), dates, "origin_id", "t")
    prices = cut_lineage(grid.join(heavy, ["origin_id", "date"], "left").select("origin_id", "t", F.coalesce("price", F.lit(0.0)).alias("price")))
    values = cut_lineage(certificate.cell_values(prices, lanes, certificate.needs(required, net.destinations())))
    named = flows.join(dates, flows["period"] == dates["date"]).select("origin_id", "destination_id", "t", "flow")
    return named, prices, values, lanes, origins


@query
def plan_certificate(net):
    """Values of all cells by those prices, and what each shipment costs above them."""
    flows, prices, values, lanes, _ = priced_overload(net)
    cost = certificate.reduced_costs(flows, lanes, prices, values)
    return values.join(cost, ["destination_id", "t"], "left").select(
        "destination_id", "t", "need", rounded("lane", 6), rounded("value", 6), "origin_id", rounded("reduced", 6)
    )


@query
def plan_certificate_faults(net):
    """Shipments that the prices show to be dear."""
    flows, prices, values, lanes, _ = priced_overload(net)
    return certificate.violations(flows, lanes, prices, values, 1e-6).select("rule", "key", "t", rounded("detail", 6))


@query
def plan_bound(net):
    """The bound those prices prove for every plan of the network."""
    _, prices, values, _, origins = priced_overload(net)
    bound = certificate.lower_bound(prices, values, origins.select("origin_id", F.col("daily_capacity").alias("capacity")))
    return net.spark.createDataFrame([(bound,)], "bound double").select(rounded("bound", 2))


@query
def plan_end_to_end(net):
    signal = run_forecast(months(net), baselines()).signal("zero")
    plan = optimize(signal, net.origins_slack(), net.lanes(), net.destinations())
    return plan.flows.withColumn("flow", rounded("flow", 6))


# Scenarios


def grid(net):
    results, failures = scenarios.run_grid(
        network_tables(net),
        [
            ScenarioConfig(name, forecast, plan, LAST_MONTHS, baselines(LAST_MONTHS))
            for name, (forecast, plan) in zip(SCENARIO_NAMES, scenarios.GRID)
        ],
    )
    if failures:
        raise RuntimeError(failures)
    return results


@query
def planning_metrics(net):
    return scenarios.scenario_planning(grid(net)).select(
        "scenario",
        F.coalesce("n_successful_destinations", F.lit(0)).alias("n_successful_destinations"),
        F.coalesce("n_failed_destinations", F.lit(0)).alias("n_failed_destinations"),
        rounded("mean_wape", 6), rounded("mean_mae", 4),
        rounded("total_cost", 2),
        rounded("holding_cost", 2),
        rounded("unmet_demand_pct", 6), "infeasibility_rate",
    )


@query
def scenario_summary(net):
    results = grid(net)
    planning = scenarios.scenario_planning(results)
    kpis = cut_lineage(scenarios.scenario_kpis(results))
    made = scenarios.summary(net.spark, [*SCENARIO_NAMES, "not_run"], planning, kpis)
    return made.select(
        "scenario", "status", "forecast_strategy", "plan_strategy",
        rounded("mean_wape", 6),
        *[rounded(c, 2) for c in ("planned_cost", "realized_cost", "holding_cost")],
        rounded("unmet_pct", 6),
    )


@query
def value_decomposition(net):
    effects = scenarios.decomposition(scenarios.scenario_kpis(grid(net)), SCENARIO_NAMES)
    return effects.select(*[rounded(c, 2) for c in effects.columns])


@query
def scenario_breakdown(net):
    table = scenarios.breakdown(scenarios.scenario_kpis(grid(net)))
    return table.select(
        "scenario", "destination_id",
        *[rounded(c, 2) for c in table.columns[2:-2]],
        rounded("fill_pct", 4),
        rounded("cost_per_unit_demanded", 6),
    )


# Generators


@query
def gen_panel(net):
    bases = net.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("destination_id"),
        (20.0313 + F.col("s_suppkey") % 50).alias("base"),
    )
    return generate.demand_panel(
        bases, generate.calendar("2024-01-01", "2024-06-30"), noisy=False
    )


@query
def gen_patterns(net):
    ids = net.table("customer").select(
        F.col("c_custkey").cast("string").alias("destination_id"),
        (F.col("c_custkey") % 6).cast("int").alias("pattern"),
    )
    return generate.pattern_panel(
        ids, generate.calendar("2024-01-01", "2024-03-31"), noisy=False
    )
