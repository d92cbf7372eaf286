"""The analyses over a folder that keeps receiving trip files."""

from ridelens.streaming.files import business_month_totals_stream, read_table, read_trip_stream, run_to_table

__all__ = ["business_month_totals_stream", "read_table", "read_trip_stream", "run_to_table"]
