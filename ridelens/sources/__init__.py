from ridelens.sources.readers import TRIP_COLUMNS, TRIP_SCHEMA, ZONE_COLUMNS, ZONE_SCHEMA, read_trips, read_zones
from ridelens.sources.sinks import export_csv, restore_export
from ridelens.sources.star import (
    load_inputs, load_prepared, materialize_trips, materialize_zones, trips_from_star, zones_from_star,
)

__all__ = [
    "TRIP_COLUMNS", "TRIP_SCHEMA", "ZONE_COLUMNS", "ZONE_SCHEMA", "read_trips", "read_zones",
    "export_csv", "restore_export", "load_inputs", "load_prepared", "materialize_trips", "materialize_zones", "trips_from_star", "zones_from_star",
]
