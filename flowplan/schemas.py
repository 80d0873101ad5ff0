"""Table schemas."""

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, DAY, NUMBER = T.StringType(), T.DateType(), T.DoubleType()

DEMAND_HISTORY = _table(date=DAY, destination_id=TEXT, demand=NUMBER)
DEMAND_SIGNAL = _table(destination_id=TEXT, date=DAY, demand=NUMBER)
DESTINATIONS = _table(destination_id=TEXT, holding_cost=NUMBER)
LANES = _table(origin_id=TEXT, destination_id=TEXT, unit_cost=NUMBER)
ORIGINS = _table(origin_id=TEXT, daily_capacity=NUMBER)
INITIAL_INVENTORY = _table(destination_id=TEXT, qty=NUMBER)
FLOWS = _table(origin_id=TEXT, destination_id=TEXT, period=DAY, flow=NUMBER)
INVENTORY = _table(destination_id=TEXT, period=DAY, inventory=NUMBER)
SCORED_WINDOW = _table(destination_id=TEXT, model=TEXT, metric=TEXT, start_date=DAY, end_date=DAY, value=NUMBER)

NETWORK = {
    "demand_history": DEMAND_HISTORY,
    "destinations": DESTINATIONS,
    "lanes": LANES,
    "origins": ORIGINS,
}
