"""The same queries in SQL, composed from named sub-selects."""

from __future__ import annotations

import re

PARTS: dict[str, str] = {}


def part(**named: str) -> None:
    PARTS.update(named)


def sql(select: str) -> str:
    """``select`` preceded by every part it needs, in definition order."""
    wanted: set[str] = set()
    open_texts = [select]
    while open_texts:
        words = set(re.findall(r"[a-z_0-9]+", open_texts.pop()))
        for name in words & (PARTS.keys() - wanted):
            wanted.add(name)
            open_texts.append(PARTS[name])
    parts = [f"{name} AS ({text})" for name, text in PARTS.items() if name in wanted]
    head = "WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else ""
    return head + select


def r(value: str, digits: int) -> str:
    return f"(round({value}, {digits}) + 0.0)"


def named_r(digits: int, *names: str) -> str:
    return ", ".join(f"{r(name, digits)} AS {name}" for name in names)


part(
    order_cells="""
        SELECT date_trunc('month', o_orderdate)::DATE AS date, n_name AS destination_id,
               sum(l_quantity) AS demand
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY ALL""",
    month_dates="""
        SELECT date, row_number() OVER (ORDER BY date) - 1 AS t
        FROM (SELECT DISTINCT date FROM order_cells)""",
    months="""
        SELECT d.date, d.t, i.destination_id, coalesce(c.demand, 0.0) AS demand
        FROM month_dates d CROSS JOIN (SELECT DISTINCT destination_id FROM order_cells) i
        LEFT JOIN order_cells c ON c.date = d.date AND c.destination_id = i.destination_id""",
    weeks="""
        SELECT date_trunc('week', l_shipdate)::DATE AS date, l_suppkey::VARCHAR AS destination_id,
               sum(l_quantity) AS demand
        FROM lineitem GROUP BY ALL""",
    event_days="""
        SELECT ts::DATE AS date, event_type AS destination_id, count(*)::DOUBLE AS demand
        FROM events GROUP BY ALL""",
    places="""
        SELECT n_name AS destination_id, 0.25::DOUBLE * (1 + n_nationkey % 4) AS holding_cost
        FROM nation""",
    routes="""
        SELECT s_suppkey::VARCHAR AS origin_id, n_name AS destination_id,
               1.0::DOUBLE + abs(s_nationkey - n_nationkey) + 0.25::DOUBLE * (s_suppkey % 5)
                   AS unit_cost
        FROM supplier CROSS JOIN nation""",
    peak="""
        SELECT max(total) AS peak FROM
        (SELECT sum(demand) AS total FROM order_cells GROUP BY date)""",
    slack_origins="""
        SELECT s_suppkey::VARCHAR AS origin_id,
               ceil(1.25::DOUBLE * (SELECT peak FROM peak)) AS daily_capacity
        FROM supplier""",
    tight_origins="""
        SELECT s_suppkey::VARCHAR AS origin_id,
               ceil(1.25::DOUBLE * (SELECT peak FROM peak) / (SELECT count(*) FROM supplier))
                   * (1 + s_suppkey % 3) AS daily_capacity
        FROM supplier""",
    regional_ids="""
        SELECT DISTINCT n.n_name AS destination_id FROM nation n
        JOIN nation h ON h.n_regionkey = n.n_regionkey
        JOIN supplier ON s_nationkey = h.n_nationkey""",
)

ORACLES: dict[str, str] = {}


def oracle(**named: str) -> None:
    ORACLES.update({name: sql(text) for name, text in named.items()})


WEEK_LAST = "date IN (SELECT DISTINCT date FROM weeks ORDER BY date DESC LIMIT {n})"

# Sources

oracle(
    src_network="""
        SELECT 'demand_history' AS table_name, count(*) AS n_rows, sum(demand) AS total FROM months
        UNION ALL SELECT 'destinations', count(*), sum(holding_cost) FROM places
        UNION ALL SELECT 'lanes', count(*), sum(unit_cost) FROM routes
        UNION ALL SELECT 'origins', count(*), sum(daily_capacity) FROM slack_origins""",
    src_records="SELECT date, destination_id, demand FROM event_days",
    holding_norm="""
        SELECT n_name AS destination_id,
               CASE WHEN n_nationkey % 4 <> 3 THEN 0.25::DOUBLE * (1 + n_nationkey % 4) ELSE 0.0::DOUBLE END
                   AS holding_cost,
               TRUE AS has_holding_cost, 'some' AS case_name FROM nation
        UNION ALL SELECT n_name, NULL::DOUBLE, FALSE, 'none' FROM nation""",
)

# Quality

part(
    bad_lanes="""
        SELECT origin_id, routes.destination_id, unit_cost - 1.25::DOUBLE AS unit_cost
        FROM routes JOIN nation ON n_name = destination_id WHERE n_nationkey % 7 <> 5""",
    bad_origins="""
        SELECT s_suppkey::VARCHAR AS origin_id, s_suppkey % 5 - 1.0::DOUBLE AS daily_capacity
        FROM supplier WHERE s_suppkey % 9 <> 4""",
    bad_size="""
        SELECT (SELECT count(*) FROM bad_lanes) AS lanes,
               (SELECT count(DISTINCT destination_id) FROM order_cells) AS destinations,
               (SELECT count(DISTINCT date) FROM order_cells) AS periods""",
    balance="""
        SELECT sum(demand) AS total_demand,
               (SELECT coalesce(sum(daily_capacity), 0.0) FROM bad_origins)
                   * (SELECT count(DISTINCT date) FROM order_cells) AS total_capacity
        FROM order_cells""",
    bad_report="""
        SELECT 3 AS rank, 'negative_unit_cost' AS rule, origin_id || '->' || destination_id AS key,
               unit_cost AS detail
        FROM bad_lanes WHERE unit_cost < 0
        UNION ALL SELECT 4, 'negative_holding_cost', n_name, n_nationkey % 4 - 1.0::DOUBLE
        FROM nation WHERE n_nationkey % 4 < 1
        UNION ALL SELECT 5, 'capacity_not_positive', origin_id, daily_capacity
        FROM bad_origins WHERE daily_capacity <= 0
        UNION ALL SELECT 6, 'unknown_origin', origin_id, NULL
        FROM (SELECT DISTINCT origin_id FROM bad_lanes)
        WHERE origin_id NOT IN (SELECT origin_id FROM bad_origins)
        UNION ALL SELECT 7, 'negative_initial_inventory', n_name, n_nationkey - 2.0::DOUBLE
        FROM nation WHERE n_nationkey < 2
        UNION ALL SELECT 8, 'too_many_variables', '1000', ((lanes + destinations) * periods)::DOUBLE
        FROM bad_size WHERE (lanes + destinations) * periods > 1000
        UNION ALL SELECT 9, 'unreachable', destination_id, NULL
        FROM (SELECT DISTINCT destination_id FROM order_cells)
        WHERE destination_id NOT IN (SELECT destination_id FROM bad_lanes)
        UNION ALL SELECT 10, 'capacity_short', 'network', total_demand - total_capacity
        FROM balance WHERE total_demand > total_capacity""",
)
oracle(
    dq_report="SELECT rank, rule, key, detail::DOUBLE AS detail FROM bad_report",
    dq_first_violation="""
        SELECT rank, rule, count(*) AS violations FROM bad_report GROUP BY ALL
        ORDER BY rank LIMIT 1""",
    dq_network="""
        SELECT 1 AS rank, 'empty_table' AS rule, 'destinations' AS key, 0.0::DOUBLE AS detail
        FROM places HAVING max(holding_cost) <= 1 UNION ALL
        SELECT 2 AS rank, 'null_values' AS rule, 'demand_history.demand' AS key,
               count(*)::DOUBLE AS detail
        FROM order_cells WHERE demand % 7 = 0 HAVING count(*) > 0""",
    dq_unreachable="SELECT rule, key FROM bad_report WHERE rule = 'unreachable'",
    dq_capacity="""
        SELECT total_demand, total_capacity,
               greatest(0.0::DOUBLE, total_demand - total_capacity) AS shortfall FROM balance""",
    dq_duplicate_keys="""
        SELECT 11 AS rank, 'conflicting_keys' AS rule,
               'lanes|' || origin_id || '|' || destination_id AS key, 2.0::DOUBLE AS detail
        FROM routes WHERE unit_cost > 10""",
    plan_size="""
        SELECT lanes, destinations, periods, lanes * periods AS flow_variables,
               destinations * periods AS inventory_variables,
               (lanes + destinations) * periods AS variables
        FROM (SELECT (SELECT count(*) FROM routes) AS lanes,
                     count(DISTINCT destination_id) AS destinations,
                     count(DISTINCT date) AS periods FROM order_cells)""",
)

# Panel

WEEK_NUMBERED = """
    SELECT *, row_number() OVER (PARTITION BY destination_id ORDER BY date) AS rn,
           count(*) OVER (PARTITION BY destination_id) AS n FROM weeks"""
part(
    weeks_numbered=WEEK_NUMBERED,
    weeks_two_way="""
        SELECT destination_id, date,
               CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
        FROM weeks_numbered""",
)
oracle(
    clean_demand="SELECT date, destination_id, demand FROM weeks",
    demand_in_horizon=f"""
        SELECT destination_id, date,
               CASE WHEN demand % 7 = 0 THEN 0.0::DOUBLE ELSE demand END
               * CASE WHEN destination_id::INT % 3 = 0 THEN 2 ELSE 1 END AS demand
        FROM weeks WHERE {WEEK_LAST.format(n=52)}""",
    horizon="""
        SELECT (row_number() OVER (ORDER BY date) - 1)::INT AS t, date
        FROM (SELECT DISTINCT date FROM weeks)""",
    last_n_dates="SELECT DISTINCT date FROM weeks ORDER BY date DESC LIMIT 30",
    dense_panel="""
        SELECT i.destination_id, d.t::INT AS t, d.date, coalesce(w.demand, 0.0::DOUBLE) AS demand
        FROM (SELECT DISTINCT destination_id FROM weeks) i
        CROSS JOIN (SELECT date, row_number() OVER (ORDER BY date) - 1 AS t
                    FROM (SELECT DISTINCT date FROM weeks)) d
        LEFT JOIN weeks w ON w.destination_id = i.destination_id AND w.date = d.date""",
    lane_periods="""
        SELECT origin_id, destination_id, t::INT AS t, date AS period
        FROM routes CROSS JOIN month_dates""",
    min_history="SELECT DISTINCT destination_id, n FROM weeks_numbered WHERE n >= 285",
    split_two_way="SELECT destination_id, date, split FROM weeks_two_way",
    split_three_way="""
        SELECT destination_id, date,
               CASE WHEN n < 286 THEN NULL WHEN n - rn < 185 THEN 'holdout'
                    WHEN n - rn < 285 THEN 'validation' ELSE 'train' END AS split
        FROM weeks_numbered""",
    split_periods="""
        SELECT destination_id, split, min(date) AS start_date, max(date) AS end_date,
               count(*) AS n_rows, min(date) < max(date) AS valid
        FROM weeks_two_way GROUP BY destination_id, split""",
    ma7_centered=f"""
        SELECT destination_id, date,
               CASE WHEN count(demand) OVER f = 7 THEN {r("avg(demand) OVER f", 6)} END AS centered_mean
        FROM event_days
        WINDOW f AS (PARTITION BY destination_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
    series_stats="""
        SELECT destination_id, count(*) AS n_rows, round(avg(demand), 2) AS mean,
               round(stddev_samp(demand), 2) AS std, round(min(demand), 2) AS min,
               round(max(demand), 2) AS max
        FROM event_days GROUP BY destination_id""",
)

# Single models


def test_rows(source: str, forecast: str, digits: int = 6) -> str:
    """Rows after the first 80 % of each series with a forecast over the whole series."""
    return f"""
        SELECT destination_id, date, actual, {r("forecast", digits)} AS forecast FROM (
            SELECT destination_id, date, demand AS actual, {forecast} AS forecast,
                   row_number() OVER w AS rn, count(*) OVER (PARTITION BY destination_id) AS n
            FROM {source} WINDOW w AS (PARTITION BY destination_id ORDER BY date),
                 f AS (PARTITION BY destination_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
        WHERE rn > floor(n * 0.8::DOUBLE)"""


part(
    fit_rows="""
        SELECT destination_id, date, demand AS y, rn, cut FROM (
            SELECT *, row_number() OVER (PARTITION BY destination_id ORDER BY date) AS rn,
                   floor(count(*) OVER (PARTITION BY destination_id) * 0.8::DOUBLE)::INT AS cut
            FROM months)""",
    weights="""
        SELECT a / 4.0::DOUBLE AS a, b / 4.0::DOUBLE AS b
        FROM range(1, 4) x(a), range(0, 4) z(b) WHERE b <= a""",
    holt="""
        SELECT destination_id, a, b, 1::BIGINT AS rn, 0.0::DOUBLE AS sse, y AS level, nxt - y AS slope
        FROM (SELECT *, lead(y) OVER (PARTITION BY destination_id ORDER BY rn) AS nxt FROM fit_rows)
        CROSS JOIN weights WHERE rn = 1
        UNION ALL
        SELECT h.destination_id, a, b, r.rn, sse + e * e, level + slope + a * e, slope + a * b * e
        FROM (SELECT h0.*, r0.y - (h0.level + h0.slope) AS e FROM holt h0
              JOIN fit_rows r0 ON r0.destination_id = h0.destination_id AND r0.rn = h0.rn + 1
                  AND r0.rn <= r0.cut) h
        JOIN fit_rows r ON r.destination_id = h.destination_id AND r.rn = h.rn + 1""",
    holt_best="""
        SELECT DISTINCT ON (destination_id) destination_id, level, slope
        FROM holt JOIN (SELECT DISTINCT destination_id AS id, cut FROM fit_rows)
             ON id = destination_id AND rn = cut
        ORDER BY destination_id, sse, a, b""",
    differences="""
        SELECT *, lag(x) OVER (PARTITION BY destination_id ORDER BY rn) AS x_lag FROM (
            SELECT *, y - lag(y) OVER (PARTITION BY destination_id ORDER BY rn) AS x
            FROM fit_rows WHERE rn <= cut)""",
    moments="""
        SELECT destination_id, count(x)::DOUBLE AS n, sum(CASE WHEN rn = 2 THEN x * x END) AS x1,
               sum(CASE WHEN x_lag IS NOT NULL THEN x * x END) AS own, sum(x * x_lag) AS crossed,
               sum(x_lag * x_lag) AS past, max(CASE WHEN rn = cut THEN x END) AS x_end,
               max(CASE WHEN rn = cut THEN y END) AS y_end
        FROM differences GROUP BY destination_id""",
    cubic="""
        SELECT *, c - b * b / 3 AS p, 2 * b * b * b / 27 - b * c / 3 + d AS q FROM (
            SELECT *, -(n - 2) * crossed / ((n - 1) * (past - x1)) AS b,
                   -(n * (past - x1) + x1 + own) / ((n - 1) * (past - x1)) AS c,
                   n * crossed / ((n - 1) * (past - x1)) AS d
            FROM moments)""",
    phi_ml="""
        SELECT destination_id, x_end, y_end,
               2 * sqrt(-p / 3) * cos(acos(least(1, greatest(-1, 1.5 * q / p * sqrt(-3 / p)))) / 3
                   - 2.0943951023931953) - b / 3 AS phi
        FROM cubic""",
    phi_conditional="SELECT destination_id, x_end, y_end, crossed / past AS phi FROM moments",
)


def arima_rows(phi: str) -> str:
    value = "y_end + x_end * phi * (1 - pow(phi, rn - cut)) / (1 - phi)"
    return f"""
        SELECT destination_id, date, y AS actual, {r(value, 3)} AS forecast
        FROM fit_rows JOIN {phi} USING (destination_id) WHERE rn > cut"""


oracle(
    fc_naive=test_rows("weeks", "lag(demand) OVER w"),
    fc_seasonal=test_rows("weeks", "lag(demand, 52) OVER w"),
    fc_rolling=test_rows(
        "weeks", "CASE WHEN count(demand) OVER f = 7 THEN avg(demand) OVER f END"
    ),
    fc_lag1_panel=f"""
        SELECT destination_id, date, past AS demand FROM (
            SELECT *, lag(demand) OVER (PARTITION BY destination_id ORDER BY date) AS past FROM weeks)
        WHERE past IS NOT NULL AND {WEEK_LAST.format(n=30)}""",
    fc_ets_grid=f"""
        SELECT destination_id, date, y AS actual, {r("level + slope * (rn - cut)", 3)} AS forecast
        FROM fit_rows JOIN holt_best USING (destination_id) WHERE rn > cut""",
    fc_arima110=arima_rows("phi_ml"),
    fc_arima110_conditional=arima_rows("phi_conditional"),
    fc_user_model=f"""
        SELECT w.destination_id, date, demand AS actual, {r("m", 6)} AS forecast
        FROM weeks_numbered w JOIN (
            SELECT destination_id, avg(demand) AS m FROM weeks_numbered
            WHERE rn <= floor(n * 0.8::DOUBLE) AND rn > floor(n * 0.8::DOUBLE) - 4 GROUP BY 1) k
        USING (destination_id) WHERE rn > floor(n * 0.8::DOUBLE)""",
)

# Model selection

GAP = "abs(actual - forecast)"
SIZE = f"CASE WHEN {GAP} IS NOT NULL THEN abs(actual) END"
ERRORS = f"""
    avg({GAP}) AS mae, avg({GAP} * {GAP}) AS mse, sqrt(avg({GAP} * {GAP})) AS rmse,
    avg({GAP} / greatest({SIZE}, 2.220446049250313e-16)) AS mape,
    CASE WHEN sum({SIZE}) > 0 THEN sum({GAP}) / sum({SIZE}) END AS wape,
    count(forecast) AS present"""
MODELS = """(VALUES (0, 'naive_forecaster', 'naive_forecaster'),
    (1, 'seasonal_forecaster_lag_12', 'seasonal_forecaster'),
    (2, 'ma_3_forecaster', 'rolling_window_forecaster')) m(ord, model, registry_key)"""


def selection(prefix: str, source: str, split: str, first: str, last: str = "none") -> None:
    """Parts <prefix>_long, _score, _spans, _best, _final for the three baselines."""
    part(
        **{
            f"{prefix}_rows": f"""
                SELECT *, {split} AS split FROM (
                    SELECT destination_id, date, demand AS actual, lag(demand) OVER w AS f0,
                           lag(demand, 12) OVER w AS f1,
                           CASE WHEN count(demand) OVER f = 3 THEN avg(demand) OVER f END AS f2,
                           row_number() OVER w AS rn, count(*) OVER (PARTITION BY destination_id) AS n
                    FROM {source} WINDOW w AS (PARTITION BY destination_id ORDER BY date),
                         f AS (PARTITION BY destination_id ORDER BY date
                               ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
                WHERE n >= 2""",
            f"{prefix}_long": f"""
                SELECT destination_id, date, actual, split, ord, model, registry_key,
                       CASE ord WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END AS forecast
                FROM {prefix}_rows CROSS JOIN {MODELS}""",
            f"{prefix}_score": f"""
                SELECT destination_id, ord, model, registry_key, split, {ERRORS}
                FROM {prefix}_long GROUP BY ALL""",
            f"{prefix}_spans": f"""
                SELECT destination_id, bool_or(split IS NULL) AS too_short,
                       coalesce(min(date) FILTER (split = 'train') < max(date) FILTER (split = 'train')
                       AND min(date) FILTER (split = '{first}') < max(date) FILTER (split = '{first}'),
                       FALSE) AS spans,
                       coalesce(min(date) FILTER (split = '{last}') < max(date) FILTER (split = '{last}'),
                       FALSE) AS last_span
                FROM {prefix}_rows GROUP BY 1""",
            f"{prefix}_best": f"""
                SELECT DISTINCT ON (destination_id) s.* FROM {prefix}_score s
                JOIN {prefix}_spans USING (destination_id)
                WHERE split = '{first}' AND present > 0 AND wape IS NOT NULL AND spans AND NOT too_short
                ORDER BY destination_id, wape, ord""",
            f"{prefix}_final": f"""
                SELECT b.destination_id, b.ord, b.model, b.wape, b.mae,
                       CASE WHEN last_span AND l.present > 0 THEN '{last}' ELSE '{first}' END
                           AS forecast_window,
                       CASE WHEN last_span AND l.present > 0 THEN l.wape ELSE b.wape END AS final_wape,
                       CASE WHEN last_span AND l.present > 0 THEN l.mae ELSE b.mae END AS final_mae
                FROM {prefix}_best b JOIN {prefix}_spans USING (destination_id)
                LEFT JOIN {prefix}_score l ON l.destination_id = b.destination_id
                    AND l.ord = b.ord AND l.split = '{last}'""",
            f"{prefix}_signal": f"""
                SELECT f.destination_id, l.date, coalesce(l.forecast, 0.0::DOUBLE) AS demand
                FROM {prefix}_final f JOIN {prefix}_long l ON l.destination_id = f.destination_id
                    AND l.ord = f.ord AND l.split = f.forecast_window""",
        }
    )


TWO_WAY = "CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END"


def three_way(validation: int, holdout: int) -> str:
    return f"""CASE WHEN n < {validation + holdout + 1} THEN NULL
        WHEN n - rn < {holdout} THEN 'holdout'
        WHEN n - rn < {validation + holdout} THEN 'validation' ELSE 'train' END"""


selection("wk", "weeks", TWO_WAY, "test")
selection("mo", "months", TWO_WAY, "test")
selection("fail", "weeks", three_way(100, 185), "validation", "holdout")
selection("sc", "months", three_way(12, 12), "validation", "holdout")

FIVE = ("mae", "mse", "rmse", "mape", "wape")
oracle(
    metrics=f"""
        SELECT destination_id, {named_r(4, *FIVE)},
               CASE WHEN present = 0 THEN 'every forecast is null' END AS error
        FROM (SELECT destination_id, {ERRORS} FROM (
            SELECT destination_id, demand AS actual, rn, n,
                   lag(demand, 52) OVER (PARTITION BY destination_id ORDER BY date) AS forecast
            FROM weeks_numbered) WHERE rn > floor(n * 0.8::DOUBLE) GROUP BY 1)""",
    scores=f"""
        SELECT destination_id, ord::BIGINT AS ord, model, registry_key, 'one_step' AS mode,
               {named_r(4, *FIVE)},
               CASE WHEN present = 0 THEN 'every forecast is null' END AS error
        FROM wk_score WHERE split = 'test'""",
    select_model=f"""
        SELECT i.destination_id, model, {r("mae", 4)} AS mae,
               CASE WHEN model IS NULL THEN 'no usable mae for destination ' || i.destination_id END
                   AS error
        FROM (SELECT DISTINCT destination_id FROM wk_score) i
        LEFT JOIN (SELECT DISTINCT ON (destination_id) * FROM wk_score
                   WHERE split = 'test' AND mae IS NOT NULL
                   ORDER BY destination_id, mae, ord) b USING (destination_id)""",
    outcomes=f"""
        SELECT s.destination_id, model IS NOT NULL AS success,
               CASE WHEN too_short THEN 'series too short for a three-way split'
                    WHEN NOT spans THEN 'train and selection windows need two dates each'
                    WHEN model IS NULL THEN 'all models failed' END AS error,
               model, {r("wape", 4)} AS wape
        FROM fail_spans s LEFT JOIN fail_best b USING (destination_id)""",
    holdout=f"""
        SELECT destination_id, model, forecast_window,
               {named_r(4, "wape", "final_wape", "final_mae")}
        FROM fail_final""",
    forecast_pipeline=f"""
        SELECT destination_id, model, 'one_step' AS mode, {named_r(4, *FIVE)} FROM wk_best""",
    export_forecast=f"SELECT destination_id, date, {r('demand', 6)} AS demand FROM wk_signal",
)


# Replay, plans


def replayed(source: str, keys: str = "destination_id") -> str:
    """Stock and shortage of rows (keys, date, inflow, demand)."""
    return f"""
        SELECT *, s + lost AS inventory,
               lost - lag(lost, 1, 0.0) OVER (PARTITION BY {keys} ORDER BY date) AS shortage
        FROM (SELECT *, greatest(0.0, -min(s) OVER (PARTITION BY {keys} ORDER BY date)) AS lost
              FROM (SELECT *, sum(inflow - demand) OVER (PARTITION BY {keys} ORDER BY date) AS s
                    FROM ({source})))"""


part(
    cheapest="""
        SELECT DISTINCT ON (destination_id) destination_id, origin_id, unit_cost FROM routes
        ORDER BY destination_id, unit_cost, origin_id""",
    lag_signal="""
        SELECT destination_id, date, past AS demand FROM (
            SELECT *, lag(demand) OVER (PARTITION BY destination_id ORDER BY date) AS past FROM months)
        WHERE past IS NOT NULL
          AND date IN (SELECT date FROM month_dates ORDER BY date DESC LIMIT 12)""",
    stock="SELECT n_name AS destination_id, 100.0::DOUBLE * (n_nationkey % 4) AS qty FROM nation",
    stocked="""
        SELECT destination_id, date, t, demand,
               CASE WHEN t = 0 THEN qty ELSE 0.0::DOUBLE END AS inflow
        FROM months JOIN stock USING (destination_id)""",
    jit_flows=f"""
        SELECT origin_id, p.destination_id, date AS period, shortage AS flow
        FROM ({replayed("SELECT * FROM stocked")}) p JOIN cheapest USING (destination_id)
        WHERE shortage > 1e-6""",
    jit_inventory="""
        SELECT s.destination_id, s.date AS period,
               sum(inflow + coalesce(flow, 0.0) - demand)
                   OVER (PARTITION BY s.destination_id ORDER BY s.date) AS inventory
        FROM stocked s LEFT JOIN jit_flows f
          ON f.destination_id = s.destination_id AND f.period = s.date""",
    tight_load="""
        SELECT origin_id, date AS period, sum(demand) AS shipped, max(daily_capacity) AS cap
        FROM months JOIN cheapest USING (destination_id) JOIN tight_origins USING (origin_id)
        WHERE demand > 1e-6 GROUP BY 1, 2""",
    lag_shipped="""
        SELECT origin_id, destination_id, date AS period, demand AS flow, unit_cost
        FROM lag_signal JOIN cheapest USING (destination_id) WHERE demand > 1e-6""",
    lag_replay=replayed("""
        SELECT p.destination_id, d.period AS date, coalesce(f.flow, 0.0) AS inflow,
               coalesce(m.demand, 0.0) AS demand
        FROM places p CROSS JOIN (SELECT DISTINCT period FROM lag_shipped) d
        LEFT JOIN lag_shipped f ON f.destination_id = p.destination_id AND f.period = d.period
        LEFT JOIN months m ON m.destination_id = p.destination_id AND m.date = d.period"""),
    lag_sums="""
        SELECT p.destination_id, coalesce(t.cost, 0.0) AS transport_cost,
               h.held * holding_cost AS realized_holding_cost,
               h.demand AS total_actual_demand, h.demand - h.shortage AS total_fulfilled,
               h.shortage AS total_shortage
        FROM places p
        JOIN (SELECT destination_id, sum(inventory) AS held, sum(demand) AS demand,
                     sum(shortage) AS shortage FROM lag_replay GROUP BY 1) h USING (destination_id)
        LEFT JOIN (SELECT destination_id, sum(flow * unit_cost) AS cost FROM lag_shipped GROUP BY 1) t
        USING (destination_id)""",
)

SUMS = (
    "transport_cost", "realized_holding_cost", "total_actual_demand", "total_fulfilled",
    "total_shortage",
)


def kpis(source: str, keys: str = "") -> str:
    """KPI columns of rows that hold the five sums."""
    total = "(transport_cost + realized_holding_cost)"
    return f"""
        SELECT {keys} {named_r(2, *SUMS)}, {r(total, 2)} AS realized_total_cost,
               {r("CASE WHEN total_actual_demand > 0 THEN total_fulfilled / total_actual_demand ELSE 1.0 END", 6)}
                   AS fill_rate,
               {r(f"CASE WHEN total_actual_demand > 0 THEN {total} / total_actual_demand ELSE 0.0 END", 6)}
                   AS cost_per_unit_demanded,
               {r(f"CASE WHEN total_fulfilled > 0 THEN {total} / total_fulfilled ELSE 0.0 END", 6)}
                   AS cost_per_unit_fulfilled
        FROM {source}"""


ALL_SUMS = ", ".join(f"sum({name}) AS {name}" for name in SUMS)
oracle(
    transport_cost="""
        SELECT f.destination_id,
               sum(flow * CASE WHEN origin_id::INT % 2 = 0 THEN unit_cost ELSE 0.0 END) AS transport_cost
        FROM lag_shipped f GROUP BY 1""",
    inventory_replay="""
        SELECT destination_id, date, inflow, demand, inventory, shortage,
               demand - shortage AS fulfilled FROM lag_replay""",
    realized_by_destination=kpis("lag_sums", "destination_id,"),
    realized_from_saved=kpis("lag_sums", "destination_id,"),
    realized_total=kpis(f"(SELECT {ALL_SUMS} FROM lag_sums)"),
    plan_jit="SELECT origin_id, destination_id, period, flow FROM jit_flows",
    plan_inventory="SELECT destination_id, period, inventory FROM jit_inventory",
    plan_cost="""
        SELECT t AS transportation_cost, h AS holding_cost, t + h AS total_cost FROM (
            SELECT (SELECT sum(flow * unit_cost) FROM jit_flows JOIN cheapest USING (destination_id)) AS t,
                   (SELECT sum(inventory * holding_cost)
                    FROM jit_inventory JOIN places USING (destination_id)) AS h)""",
    plan_overload="""
        SELECT origin_id, period, shipped, shipped - cap AS excess
        FROM tight_load WHERE shipped > cap + 1e-6""",
    plan_violations="""
        SELECT 'capacity' AS rule, origin_id AS key, period, shipped - cap AS detail
        FROM tight_load WHERE shipped > cap + 1e-6""",
    plan_batch_shipped=f"""
        SELECT destination_id, {r("sum(demand)", 3)} AS shipped
        FROM months JOIN regional_ids USING (destination_id) GROUP BY 1""",
    plan_priced_check="SELECT 0::BIGINT AS violations, 0::BIGINT AS unmet, TRUE AS bounded",
    plan_batch_violations="SELECT 0::BIGINT AS violations",
    plan_end_to_end=f"""
        SELECT origin_id, destination_id, date AS period, {r("demand", 6)} AS flow
        FROM mo_signal JOIN cheapest USING (destination_id) WHERE demand > 1e-6""",
    sink_roundtrip="""
        SELECT 'naive_optimized' AS scenario, destination_id, date AS period, 0.0::DOUBLE AS inventory
        FROM lag_signal""",
)

# Proofs, checked inputs and results

part(
    cert_prices="""
        SELECT o.origin_id, d.t, coalesce(greatest(shipped - cap, 0.0) / cap, 0.0) AS price, daily_capacity
        FROM tight_origins o CROSS JOIN month_dates d
        LEFT JOIN tight_load l ON l.origin_id = o.origin_id AND l.period = d.date AND shipped > cap + 1e-6""",
    cert_values="""
        SELECT destination_id, t, demand AS need, lane,
               min(lane - holding_cost * t) OVER (PARTITION BY destination_id ORDER BY t) + holding_cost * t AS value
        FROM (SELECT destination_id, t, min(unit_cost + price) AS lane
              FROM routes JOIN cert_prices USING (origin_id) GROUP BY ALL)
        JOIN places USING (destination_id) JOIN months USING (destination_id, t)""",
    cert_shipped="""
        SELECT c.origin_id, v.destination_id, v.t, c.unit_cost + p.price - v.value AS reduced
        FROM cert_values v JOIN cheapest c USING (destination_id)
        JOIN cert_prices p ON p.origin_id = c.origin_id AND p.t = v.t WHERE need > 1e-6""",
)

oracle(
    plan_certificate=f"""
        SELECT v.destination_id, v.t::INT AS t, need, {r("lane", 6)} AS lane, {r("value", 6)} AS value, origin_id,
               {r("reduced", 6)} AS reduced
        FROM cert_values v LEFT JOIN cert_shipped s ON s.destination_id = v.destination_id AND s.t = v.t""",
    plan_certificate_faults=f"""
        SELECT 'dear_shipment' AS rule, origin_id || '|' || destination_id AS key, t::INT AS t, {r("reduced", 6)} AS detail
        FROM cert_shipped WHERE reduced > 1e-6""",
    plan_bound=f"""
        SELECT {r("(SELECT sum(need * value) FROM cert_values) - (SELECT sum(price * daily_capacity) FROM cert_prices)", 2)} AS bound""",
    clean_report="""
        SELECT 'demand_history' AS name, count(*) + count_if(destination_id::INT % 3 = 0)::BIGINT AS rows,
               count(*) AS kept, 0::BIGINT AS nulls FROM weeks
        UNION ALL SELECT 'destinations', count(*), count(*), count_if(holding_cost <= 0.25)::BIGINT FROM places
        UNION ALL SELECT 'lanes', count(*), count(*), 0 FROM routes
        UNION ALL SELECT 'origins', count(*), count(*), 0 FROM slack_origins""",
    dq_resolved_keys="""
        SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order,
               arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price,
               arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
               arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price
        FROM orders GROUP BY 1""",
    result_contract="""
        WITH w AS (
            SELECT o_custkey::VARCHAR AS k, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1)
        SELECT 'missing_column' AS rule, 'model' AS key, 'string' AS detail
        UNION ALL SELECT 'wrong_type', 'value', 'string'
        UNION ALL SELECT 'unknown_metric', k, 'medae' FROM w WHERE k::INT % 7 = 0
        UNION ALL SELECT 'reversed_period', k, a::VARCHAR || '..' || b::VARCHAR FROM w WHERE a >= b""",
)

# Allocation and scenarios

part(
    lag_shares="""
        SELECT destination_id, date,
               CASE WHEN sum(demand) OVER d > 0 THEN demand / sum(demand) OVER d
                    ELSE 1.0 / count(*) OVER d END AS share
        FROM lag_signal WINDOW d AS (PARTITION BY date)""",
    lag_alloc=replayed("""
        SELECT destination_id, date, share * (SELECT sum(daily_capacity) FROM tight_origins) AS inflow,
               m.demand
        FROM lag_shares JOIN months m USING (destination_id, date)"""),
    signals="""
        SELECT 'naive' AS forecast, destination_id, date, demand FROM lag_signal
        UNION ALL SELECT 'selected', destination_id, date, demand FROM sc_signal""",
    signal_shares="""
        SELECT forecast, destination_id, date,
               greatest(demand, 0.0) / sum(greatest(demand, 0.0)) OVER (PARTITION BY forecast, date) AS share
        FROM signals""",
    lane_rates="""
        SELECT destination_id, sum(unit_cost * daily_capacity) AS rate
        FROM routes JOIN slack_origins USING (origin_id) GROUP BY 1""",
    scenario_inflow="""
        SELECT forecast || '_naive' AS scenario, destination_id, date,
               share * (SELECT sum(daily_capacity) FROM slack_origins) AS inflow, share * rate AS cost
        FROM signal_shares JOIN lane_rates USING (destination_id)
        UNION ALL
        SELECT forecast || '_optimized', destination_id, date, demand, demand * unit_cost
        FROM signals JOIN cheapest USING (destination_id)""",
    scenario_replay=replayed(
        """
        SELECT s.scenario, p.destination_id, d.date, coalesce(i.inflow, 0.0) AS inflow,
               coalesce(m.demand, 0.0) AS demand
        FROM (SELECT DISTINCT scenario FROM scenario_inflow) s CROSS JOIN places p
        CROSS JOIN (SELECT date FROM month_dates ORDER BY date DESC LIMIT 12) d
        LEFT JOIN scenario_inflow i ON i.scenario = s.scenario
            AND i.destination_id = p.destination_id AND i.date = d.date
        LEFT JOIN months m ON m.destination_id = p.destination_id AND m.date = d.date""",
        "scenario, destination_id",
    ),
    scenario_sums="""
        SELECT h.scenario, h.destination_id, coalesce(c.cost, 0.0) AS transport_cost,
               h.held * holding_cost AS realized_holding_cost, h.demand AS total_actual_demand,
               h.demand - h.shortage AS total_fulfilled, h.shortage AS total_shortage
        FROM (SELECT scenario, destination_id, sum(inventory) AS held, sum(demand) AS demand,
                     sum(shortage) AS shortage FROM scenario_replay GROUP BY 1, 2) h
        JOIN places USING (destination_id)
        LEFT JOIN (SELECT scenario, destination_id, sum(cost) AS cost FROM scenario_inflow GROUP BY 1, 2) c
          ON c.scenario = h.scenario AND c.destination_id = h.destination_id""",
    scenario_totals=f"SELECT scenario, {ALL_SUMS} FROM scenario_sums GROUP BY 1",
    scenario_costs="""
        SELECT scenario, transport_cost + realized_holding_cost AS cost FROM scenario_totals""",
    scenario_plans="""
        SELECT scenario, split_part(scenario, '_', 1) AS f, split_part(scenario, '_', 2) AS p,
               transport_cost AS planned_cost,
               100 * CASE WHEN total_actual_demand > 0 THEN total_shortage / total_actual_demand
                          ELSE 0.0 END AS unmet,
               CASE WHEN f = 'selected' THEN (SELECT avg(final_wape) FROM sc_final) END AS mean_wape,
               CASE WHEN f = 'selected' THEN (SELECT avg(final_mae) FROM sc_final) END AS mean_mae,
               CASE WHEN f = 'selected' THEN (SELECT count(*) FROM sc_final) END AS good,
               CASE WHEN f = 'selected' THEN (SELECT count(*) FROM sc_spans)
                   - (SELECT count(*) FROM sc_final) END AS bad
        FROM scenario_totals""",
)
oracle(
    alloc_proportional=f"""
        SELECT origin_id, destination_id, date AS period, {r("daily_capacity * share", 6)} AS flow
        FROM lag_shares CROSS JOIN tight_origins""",
    alloc_kpis=f"""
        SELECT {r("c", 2)} AS transportation_cost, 0.0::DOUBLE AS holding_cost, {r("c", 2)} AS total_cost,
               {r("100 * short / wanted", 6)} AS unmet_demand_pct, infeasibility_rate
        FROM (SELECT avg(CASE WHEN daily_capacity * over > 1e-6 THEN 1.0 ELSE 0.0 END)::DOUBLE AS infeasibility_rate
              FROM (SELECT date, sum(share) - 1 AS over FROM lag_shares GROUP BY date) CROSS JOIN tight_origins),
             (SELECT sum(shortage) AS short, sum(demand) AS wanted FROM lag_alloc),
             (SELECT sum(share * unit_cost * daily_capacity) AS c FROM lag_shares
              JOIN routes USING (destination_id) JOIN tight_origins USING (origin_id))""",
    alloc_overbooked=f"""
        SELECT {r("avg(CASE WHEN daily_capacity * (booked * total / mean - 1) > 1e-6 THEN 1.0 ELSE 0.0 END)", 9)} AS infeasibility_rate
        FROM (SELECT date, sum(share) AS booked FROM lag_shares GROUP BY date)
        JOIN (SELECT date, sum(demand) AS total, avg(sum(demand)) OVER () AS mean FROM months GROUP BY date) USING (date)
        CROSS JOIN tight_origins""",
    planning_metrics=f"""
        SELECT scenario, coalesce(good, 0) AS n_successful_destinations,
               coalesce(bad, 0) AS n_failed_destinations,
               {r("mean_wape", 6)} AS mean_wape, {r("mean_mae", 4)} AS mean_mae,
               {r("planned_cost", 2)} AS total_cost, 0.0::DOUBLE AS holding_cost,
               {r("unmet", 6)} AS unmet_demand_pct, 0.0::DOUBLE AS infeasibility_rate
        FROM scenario_plans""",
    scenario_summary=f"""
        SELECT scenario, 'OK' AS status, f AS forecast_strategy, p AS plan_strategy,
               {r("mean_wape", 6)} AS mean_wape, {r("planned_cost", 2)} AS planned_cost,
               {r("transport_cost + realized_holding_cost", 2)} AS realized_cost,
               {r("realized_holding_cost", 2)} AS holding_cost,
               {r("(1 - total_fulfilled / total_actual_demand) * 100", 6)} AS unmet_pct
        FROM scenario_plans JOIN scenario_totals USING (scenario)
        UNION ALL SELECT 'not_run', 'MISSING', NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
    value_decomposition=f"""
        SELECT {r("a - b", 2)} AS optimization_impact, {r("a - c", 2)} AS forecasting_impact,
               {r("a - d", 2)} AS total_impact, {r("(a - d) - (a - b) - (a - c)", 2)} AS interaction
        FROM (SELECT max(cost) FILTER (scenario = 'naive_naive') AS a,
                     max(cost) FILTER (scenario = 'naive_optimized') AS b,
                     max(cost) FILTER (scenario = 'selected_naive') AS c,
                     max(cost) FILTER (scenario = 'selected_optimized') AS d FROM scenario_costs)""",
    scenario_breakdown=f"""
        SELECT scenario, destination_id, {named_r(2, "transport_cost", "realized_holding_cost")},
               {r("transport_cost + realized_holding_cost", 2)} AS realized_total_cost,
               {named_r(2, "total_actual_demand", "total_shortage")},
               {r("100 * CASE WHEN total_actual_demand > 0 THEN total_fulfilled / total_actual_demand ELSE 1.0 END", 4)}
                   AS fill_pct,
               {r("CASE WHEN total_actual_demand > 0 THEN (transport_cost + realized_holding_cost) / total_actual_demand ELSE 0.0 END", 6)}
                   AS cost_per_unit_demanded
        FROM scenario_sums""",
)

# Generators

oracle(
    gen_panel="""
        SELECT d::DATE AS date, s_suppkey::VARCHAR AS destination_id,
               round((20.0313::DOUBLE + s_suppkey % 50)
                   * CASE WHEN isodow(d) >= 6 THEN 0.85::DOUBLE ELSE 1.0::DOUBLE END
                   * (1.0::DOUBLE + 0.0015::DOUBLE * date_diff('day', DATE '2024-01-01', d::DATE)), 2) AS demand
        FROM supplier
        CROSS JOIN generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-06-30', INTERVAL 1 DAY) g(d)""",
    gen_patterns="""
        SELECT d::DATE AS date, c_custkey::VARCHAR AS destination_id,
               round(((level + step * date_diff('day', DATE '2024-01-01', d::DATE))
                   * week[isodow(d)])::DECIMAL(18, 8), 1)::DOUBLE AS demand
        FROM customer JOIN (VALUES
            (0, 80.0::DOUBLE, 0.0::DOUBLE, [1.20, 1.15, 1.00, 0.90, 0.85, 0.70, 0.75]::DOUBLE[]),
            (1, 60.0, 0.0, [1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00]::DOUBLE[]),
            (2, 50.0, 0.1, [1.05, 1.02, 1.00, 0.98, 0.97, 0.99, 1.00]::DOUBLE[]),
            (3, 90.0, 0.08, [1.25, 1.20, 1.05, 0.95, 0.85, 0.70, 0.80]::DOUBLE[]),
            (4, 70.0, 0.0, [1.00, 1.00, 1.00, 1.00, 1.00, 1.00, 1.00]::DOUBLE[]),
            (5, 100.0, -0.05, [1.10, 1.05, 1.00, 0.95, 0.90, 0.95, 1.00]::DOUBLE[])
        ) p(pattern, level, step, week) ON pattern = c_custkey % 6
        CROSS JOIN generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-31', INTERVAL 1 DAY) g(d)""",
)
