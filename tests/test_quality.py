import pytest

from flowplan.operators import quality


@pytest.fixture
def network(make):
    return {
        "demand_history": make.demand(A=[1, 2]),
        "destinations": make.destinations(A=1),
        "lanes": make.lanes(("O", "A", 1)),
        "origins": make.origins(O=5),
    }


def rules(report):
    return sorted((r["rule"], r["key"]) for r in report.collect())


def test_sound_network_passes(network):
    report = quality.network_report(network)
    assert rules(report) == []
    quality.enforce(report)
    assert quality.first_violation(report).count() == 0


def test_missing_column_names_table(network):
    network["lanes"] = network["lanes"].drop("unit_cost")
    with pytest.raises(quality.QualityError, match=r"lanes lacks columns \['unit_cost'\]"):
        quality.network_report(network)


def test_empty_and_null(network, make):
    network["origins"] = network["origins"].limit(0)
    network["demand_history"] = make.demand(A=[1, None, None])
    report = quality.network_report(network)
    assert rules(report) == [("empty_table", "origins"), ("null_values", "demand_history.demand")]
    assert quality.first_violation(report).first()["rule"] == "empty_table"
    with pytest.raises(quality.QualityError, match="empty_table"):
        quality.enforce(report)


def test_structure_is_reported_before_feasibility(make):
    signal = make.demand(A=[10], B=[10])
    report = quality.plan_report(
        signal, make.origins(O=1), make.lanes(("O", "A", -2)), make.destinations(A=0, B=0), signal
    )
    assert rules(report) == [
        ("capacity_short", "network"), ("negative_unit_cost", "O->A"), ("unreachable", "B"),
    ]
    with pytest.raises(quality.QualityError, match="negative_unit_cost"):
        quality.enforce(report)


def test_capacity_balance_counts_periods_and_nulls(make):
    signal = make.demand(A=[10, None, 30])
    row = quality.capacity_balance(signal, make.origins(O=12), signal).first()
    assert tuple(row) == (40.0, 36.0, 4.0)


def test_conflicting_keys(make):
    lanes = make.lanes(("O", "A", 1), ("O", "A", 1), ("O", "B", 1), ("O", "B", 2))
    found = quality.conflicting_keys(lanes, ["origin_id", "destination_id"], "unit_cost", "lanes")
    assert rules(found) == [("conflicting_keys", "lanes|O|B")]
