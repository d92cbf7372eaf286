from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from ridelens.session import PINNED_SQL_CONF  # noqa: E402
from ridelens.sources.readers import read_trips, read_zones  # noqa: E402

# The small hand-made fixture: nulls, an unmatched zone id (9), a zero-padded
# id ('01'), a third business, a null business, bad numbers, a fractional
# wait, and one January of another year.
TRIPS_CSV = """business,pickup_location,dropoff_location,trip_length,request_to_pickup,total_ride_time,date,time_of_day,driver_total_pay,rideshare_profit
Uber,1,2,2.0,100,600,1672531200,evening,10.01,1.5
Uber,1,9,3.0,,700,1672531200,morning,0.1,-0.25
Lyft,2,1,1.0,500,300,1672617600,evening,5.5,2
Lyft,1,2,4.0,400,300,1704067200,evening,8.0,-1.1
Via,9,9,0,301.7,10,1675209600,night,1,1
,1,1,1.0,1,20,1675209600,,1,1
Uber,2,1,bad,7,30,1672704000,morning,bad,0.3
Lyft,01,1,2.0,,40,1672790400,evening,3.0,0.1
"""

ZONES_CSV = """LocationID,Borough,Zone,service_zone
1,Brooklyn,A,Boro
2,Staten Island,B,Boro
3,Queens,C,Boro
"""

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="ridelens-tests-")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("ridelens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in PINNED_SQL_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ridelens-case-")


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="ridelens-fixture-")
    path = os.path.join(d, "data.csv")
    with open(path, "w") as fh:
        fh.write(text)
    return path


@pytest.fixture(scope="session")
def trips_path():
    return _write(TRIPS_CSV)


@pytest.fixture(scope="session")
def zones_path():
    return _write(ZONES_CSV)


@pytest.fixture(scope="session")
def trips(spark, trips_path):
    return read_trips(spark, trips_path)


@pytest.fixture(scope="session")
def zones(spark, zones_path):
    return read_zones(spark, zones_path)


@pytest.fixture(scope="session")
def merged(trips, zones):
    from ridelens.operators.zone_merge import enrich

    return enrich(trips, zones)


def rows(df, *cols):
    """Rows as tuples of the given columns, sorted with nulls first."""
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))


def plan_text(df) -> str:
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def count_nodes(plan: str, name: str) -> int:
    """How many physical operators called ``name`` a formatted plan has."""
    import re

    return len(re.findall(rf"^\(\d+\) {re.escape(name)}\b", plan, flags=re.M))
