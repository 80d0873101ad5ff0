import json

import pytest
from pyspark.sql import functions as F

from flowplan.operators import evaluation
from flowplan.sources import generate, tables


def test_read_network_round_trip(spark, make, tmp_path):
    written = {
        "demand_history": make.demand(A=[1, 2]),
        "destinations": make.destinations(A=1).withColumn("label", F.lit("x")),
        "lanes": make.lanes(("O", "A", 1)),
        "origins": make.origins(O=5).withColumn("daily_capacity", F.col("daily_capacity").cast("long")),
    }
    generate.write_network(written, str(tmp_path))
    read = tables.read_network(spark, str(tmp_path))
    assert read["origins"].schema["daily_capacity"].dataType.typeName() == "double"
    assert read["destinations"].columns == ["destination_id", "holding_cost", "label"]
    assert sorted(read["demand_history"].collect()) == sorted(written["demand_history"].collect())


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="demand_history"):
        tables.read_network(spark, str(tmp_path))


def test_records(spark, tmp_path):
    path = tmp_path / "demand.json"
    path.write_text("\n".join(json.dumps(r) for r in [
        {"date": "2024-01-01", "destination_id": "A", "demand": 3},
        {"date": "2024-01-02", "destination_id": "A", "demand": 4.5},
    ]))
    rows = tables.read_records(spark, str(path), "demand_history").orderBy("date").collect()
    assert [(str(r["date"]), r["demand"]) for r in rows] == [("2024-01-01", 3.0), ("2024-01-02", 4.5)]
    path.write_text('{"date": "never", "destination_id": "A", "demand": 3}')
    with pytest.raises(Exception):
        tables.read_records(spark, str(path), "demand_history").collect()


def test_holding_normalisation(make):
    some = {r[0]: (r[1], r[2]) for r in tables.normalize_holding(make.destinations(D1=1.5, D2=None)).collect()}
    assert some == {"D1": (1.5, True), "D2": (0.0, True)}
    none = tables.normalize_holding(make.destinations(D1=None, D2=None)).collect()
    assert {(r[1], r[2]) for r in none} == {(None, False)}
    bare = tables.normalize_holding(make.destinations(D1=None).drop("holding_cost")).first()
    assert bare["holding_cost"] is None and not bare["has_holding_cost"]


def ids(spark, n=12):
    return spark.range(n).select(F.concat(F.lit("D"), "id").alias("destination_id"), "id")


def test_generated_demand_does_not_depend_on_partitioning(spark):
    days = generate.calendar("2024-01-01", "2024-03-31")
    bases = generate.base_demand(ids(spark))
    once = generate.demand_panel(bases, days)
    again = generate.demand_panel(bases.repartition(7), days)
    assert sorted(once.collect()) == sorted(again.collect())
    assert once.agg(F.min("demand")).first()[0] >= 0
    # Noise averages out: about 0.95 for weekends, 1.07 for growth, 1.02 for promotions.
    mean = once.join(bases, "destination_id").agg(F.avg(F.col("demand") / F.col("base"))).first()[0]
    assert 0.97 < mean < 1.12


def test_weekend_and_growth(spark):
    days = generate.calendar("2024-01-01", "2024-01-08")
    bases = spark.createDataFrame([("A", 100.0)], "destination_id string, base double")
    rows = generate.demand_panel(bases, days, noisy=False).orderBy("date").collect()
    assert [r["demand"] for r in rows][:7] == [100.0, 100.15, 100.3, 100.45, 100.6, 85.64, 85.76]


def test_patterns(spark):
    days = generate.calendar("2024-01-01", "2024-12-30")
    table = ids(spark, 6).select("destination_id", F.col("id").cast("int").alias("pattern"))
    panel = generate.pattern_panel(table, days)
    assert panel.count() == 6 * 365
    means = {r[0]: r[1] for r in panel.groupBy("destination_id").agg(F.avg("demand")).collect()}
    assert means["D1"] == pytest.approx(60, abs=1) and means["D3"] == pytest.approx(101, abs=4)


def test_generated_network_tables(spark):
    origins = spark.range(3).select(F.concat(F.lit("O"), "id").alias("origin_id"))
    lanes = generate.complete_lanes(origins, ids(spark, 5))
    assert lanes.count() == 15 == lanes.distinct().count()
    low, high = lanes.agg(F.min("unit_cost"), F.max("unit_cost")).first()
    assert 5 <= low <= high <= 24
    capacity = generate.capacities(origins).agg(F.min("daily_capacity"), F.max("daily_capacity")).first()
    assert 80 <= capacity[0] <= capacity[1] <= 179
    holding = generate.holding(ids(spark, 5))
    assert evaluation.holding_costs(holding).filter("holding_cost < 0.5 OR holding_cost > 2").count() == 0
