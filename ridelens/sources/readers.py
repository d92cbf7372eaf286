"""Readers for the trip fact table and the zone lookup.

The original data is header CSV read without a schema, so every column is a
string and all typing happens per analysis (see ``ridelens.functions.casts``).
Parquet and any other Spark format go through the same entry points; with a
columnar format the scan only reads the columns an analysis touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The column names of the two inputs.
TRIP_COLUMNS = (
    "business",
    "pickup_location",
    "dropoff_location",
    "trip_length",
    "request_to_pickup",
    "total_ride_time",
    "date",
    "time_of_day",
    "driver_total_pay",
    "rideshare_profit",
)
ZONE_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")

TRIP_SCHEMA = StructType([StructField(c, StringType(), True) for c in TRIP_COLUMNS])
ZONE_SCHEMA = StructType([StructField(c, StringType(), True) for c in ZONE_COLUMNS])


def _read(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | None,
    options: dict[str, str] | None,
) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # Header line holds the names; an empty field is null.
        reader = reader.option("header", "true")
        if schema is not None:
            # A declared schema skips the extra job Spark runs to read the
            # header for names, and pins string types for every column.
            reader = reader.schema(schema).option("enforceSchema", "false")
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    df = reader.load(path)
    if fmt != "csv" and schema is not None:
        # Columnar sources carry their own types: cast by name so callers see
        # the declared types, and leave unknown columns untouched.
        declared = {f.name: f.dataType for f in schema.fields}
        df = df.select(
            *[
                F.col(c).cast(declared[c]).alias(c) if c in declared else F.col(c)
                for c in df.columns
            ]
        )
    return df


def read_trips(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read the trip fact table. Columns not listed in ``TRIP_COLUMNS`` pass
    through. With ``fmt='csv'`` and no schema, every column is a string."""
    return _read(spark, path, fmt, schema, options)


def read_zones(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read the zone lookup (``LocationID, Borough, Zone, service_zone``)."""
    return _read(spark, path, fmt, schema, options)
