"""Merge trips with the zone lookup, once as pickup and once as dropoff.

Semantics kept from the original merge:

* left outer joins: every trip survives; an unmatched id gives null zone
  columns; ids compare as strings (``'01'`` does not match ``'1'``);
* a lookup id listed twice multiplies its trips (fan-out). Pass
  ``unique_zones=True`` to keep one row per id instead; that also lets
  Catalyst drop a join whose columns an analysis never reads;
* all trip columns pass through, and ``date`` is replaced by its
  ``yyyy-MM-dd`` string.

Join strategy. The lookup is a dimension table (a few hundred rows in the
real data), so the normal plan is a broadcast hash join: the fact table is
never shuffled for the merge. The broadcast is only requested after one
aggregate over the lookup (:func:`prepare_lookup`) proves it within
``broadcast_max_rows`` rows and ``broadcast_max_bytes`` of values. Beyond
that, the lookup is joined by shuffle on ``(id, salt)``: an id with more trips
than a task should hold is dealt over as many salts as its trip count needs
(:func:`most_salts` at most), and only its lookup rows are copied once per salt. The counts of both roles
come from one pass over the two id columns, written once to the shared folder
(:func:`count_trip_ids`). Trips without an id match nothing and are dealt over
as many salts as their count needs. So no task grows with one id, whatever its
share.

Salts survive a lost executor. A trip's salts for both roles derive from one
address (:func:`trip_address`), fixed where the trip is read: its file and its
position in it, never its place behind a shuffle, where rows may come in another
order the next time. A task that runs again deals every trip as before.

The same aggregate tells whether ids are unique. When they are, fan-out
cannot happen, the plain merge and the ``unique_zones`` merge are the same
relation, and the deduplicated plan is used for both: Catalyst then removes
each zone join whose columns the analysis never reads, at any lookup size and
with it everything that only fed that join.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelens.functions.dates import epoch_to_date
from ridelens.session import scratch_dir

# Lookup size we are willing to ship to every executor: both bounds must hold.
# The real lookup has 265 rows of a few short strings.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Beyond the broadcast bound: ids with more trips than this are dealt over
# enough salts that a task gets about this many trips of one id.
ROWS_PER_SALT_TASK = 2_000_000
# Salts of one id, as a multiple of the shuffle's partitions: more would not
# part its trips further, only copy its lookup rows more often.
SALTS_PER_PARTITION = 8
# Salts of every id in a stream.
STREAM_BUCKETS = 32

# The names the merge produces.
ROLES = ("Pickup", "Dropoff")
ROLE_KEY = {"Pickup": "pickup_location", "Dropoff": "dropoff_location"}
ZONE_ATTRIBUTES = ("Borough", "Zone", "service_zone")
ZONE_ID = "LocationID"


def _plain(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def unique_lookup(zones: DataFrame, *keys: str) -> DataFrame:
    """One row per id (or per value of ``keys``). With duplicates, the smallest attribute tuple wins, so
    the choice is the same on every run."""
    keys = keys or (ZONE_ID,)
    attrs = [c for c in zones.columns if c not in keys]
    if not attrs:
        return zones.select(*keys).distinct()
    best = F.min(F.struct(*[_plain(c).alias(f"a{i}") for i, c in enumerate(attrs)])).alias("_best")
    return zones.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.a{i}").alias(c) for i, c in enumerate(attrs)])


@dataclass(frozen=True)
class ZoneLookup:
    """A zone lookup with its checked properties.

    All are exact. ``bytes`` is the size in bytes of all values as text plus 8
    per value, a bound on what the broadcast carries beyond its hash-table
    overhead."""

    df: DataFrame
    rows: int
    bytes: int
    broadcastable: bool
    unique_ids: bool
    _roles: dict = field(default_factory=dict, compare=False, repr=False)

    def role_frames(self, dedup: bool) -> dict[str, DataFrame]:
        """The per-role projections of the (optionally deduplicated) lookup,
        built once and reused by every merge."""
        if dedup not in self._roles:
            base = self.df
            if dedup:
                # A lookup proven small is collected for the broadcast anyway;
                # deduplicating it inside one partition saves an exchange.
                base = unique_lookup(base.coalesce(1) if self.broadcastable else base)
            self._roles[dedup] = {role: _role_lookup(base, role) for role in ROLES}
        return self._roles[dedup]


def prepare_lookup(
    zones: DataFrame,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
) -> ZoneLookup:
    """Check the lookup once, in one job: row count, value bytes and whether
    ids are unique. It is a plain aggregate, computed partially in every scan
    task (a ``limit`` would funnel up to that many rows per partition into a
    single task). Null ids never match a trip, so they do not count against
    uniqueness."""
    value_bytes = sum(
        (F.coalesce(F.octet_length(_plain(c).cast("string")), F.lit(0)) + F.lit(8) for c in zones.columns),
        F.lit(0),
    )
    probe = zones.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(value_bytes), F.lit(0)).alias("bytes"),
        F.count(F.col(ZONE_ID)).alias("ids"),
        F.count_distinct(F.col(ZONE_ID)).alias("distinct_ids"),
    )
    rows, size, ids, distinct_ids = probe.first()
    small = rows <= broadcast_max_rows and size <= broadcast_max_bytes
    return ZoneLookup(zones, rows, size, small, ids == distinct_ids)


def _role_lookup(zones: DataFrame, role: str) -> DataFrame:
    """The role's columns of the lookup; ids compare as strings."""
    return zones.select(
        F.col(ZONE_ID).cast("string").alias(_key(role)),
        *[F.col(a).alias(f"{role}_{a}") for a in ZONE_ATTRIBUTES],
    )


def _key(role: str) -> str:
    return f"_{role.lower()}_{ZONE_ID}"


def _trip_id(role: str) -> Column:
    return F.col(ROLE_KEY[role]).cast("string")


def _no_exchange_below(df: DataFrame) -> bool:
    """Whether each partition of ``df`` is read in an order of its own, with no
    shuffle or cached table before it."""
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    except AttributeError:  # a remote client does not see the plan
        return False
    return "Exchange" not in plan and "InMemoryTableScan" not in plan


def trip_address(trips: DataFrame) -> Column:
    """A number that says where a trip comes from, the same however often and in
    whatever order its row is computed.

    It is a hash of the file and the row's position where the source tells them
    (parquet). Else it is the position within the scan's task, which is fixed as
    long as nothing was shuffled before; behind a shuffle it is a hash of the
    trip's values (equal trips then share it)."""
    if "_metadata" not in {c.lower() for c in trips.columns}:
        try:
            address = F.xxhash64("_metadata.file_path", "_metadata.row_index")
            trips.select(address)
            return address
        except AnalysisException:  # not one file scan, or one without positions
            pass
    if trips.isStreaming:
        return F.xxhash64(F.rand(7))  # of a batch's scan; the batch is read alike when it runs again
    if _no_exchange_below(trips):
        return F.xxhash64(F.monotonically_increasing_id())
    return F.xxhash64(*[_plain(f.name).cast("string") if f.dataType.typeName() == "map" else _plain(f.name) for f in trips.schema])


@dataclass(frozen=True)
class TripIdCounts:
    """Trips per role and id, as a written table (``role``, ``id``, ``n``).
    ``total`` is the number of trips, ``without_id`` that of a role's trips
    whose id is null."""

    df: DataFrame
    total: int
    without_id: dict[str, int]


def count_trip_ids(trips: DataFrame) -> TripIdCounts:
    """Counts both roles' ids in one pass over the trips' two id columns,
    partially aggregated, and writes the counts to the shared folder: every plan
    built on them reads that table and not the trips."""
    spark = trips.sparkSession
    ids = [F.struct(F.lit(role).alias("role"), _trip_id(role).alias("id")) for role in ROLES]
    counts = trips.select(F.explode(F.array(*ids)).alias("x")).groupBy("x.role", "x.id").agg(F.count(F.lit(1)).alias("n"))
    path = f"{scratch_dir(spark)}/trip-ids-{uuid.uuid4().hex}"
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    sums = counts.groupBy("role").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("none"))
    found = {r["role"]: r for r in sums.collect()}  # a row per role
    total = max((r["n"] for r in found.values()), default=0)
    return TripIdCounts(counts, total, {role: found[role]["none"] if role in found else 0 for role in ROLES})


def most_salts(spark: SparkSession) -> int:
    """Beyond so many salts an id's trips are in every shuffle partition anyway."""
    return SALTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_ids(
    counts: TripIdCounts, role: str, rows_per_task: int = ROWS_PER_SALT_TASK, salt_buckets: int | None = None, most: int | None = None
) -> DataFrame:
    """``id, buckets`` of the role's ids with more than ``rows_per_task`` trips
    (or than a ``BROADCAST_MAX_ROWS``-th of all trips, if that is more: so at
    most that many ids can qualify, and the frame may be broadcast). ``buckets``
    follows the id's trip count, up to ``most``, unless ``salt_buckets`` fixes it."""
    least = max(rows_per_task, counts.total // BROADCAST_MAX_ROWS)
    by_count = F.ceil(F.col("n") / rows_per_task)
    buckets = F.lit(salt_buckets) if salt_buckets else F.least(by_count, F.lit(most)) if most else by_count
    mine = counts.df.where((F.col("role") == role) & F.col("id").isNotNull() & (F.col("n") > least))
    # An id has one row; the aggregate tells Catalyst so, which lets it drop the join of an unread role.
    return mine.groupBy("id").agg(F.max(buckets.cast("int")).alias("buckets"))


_ADDRESS = "_trip_address"


def _salted(
    trips: DataFrame, lookup: DataFrame, role: str, hot: DataFrame | None, null_buckets: int, stream_buckets: int
) -> tuple[DataFrame, DataFrame, Column, tuple[str, str]]:
    """Both sides of a role's shuffle join with their salt columns, the join's
    condition, and the salt columns' names. The salt follows from the trip's
    address and the role."""
    key, id_col, n_col, salt, copy = (f"_{role.lower()}_{x}" for x in (ZONE_ID, "hot", "buckets", "salt", "copy"))
    place = F.xxhash64(F.col(_ADDRESS), F.lit(role))
    if hot is None:
        salted = trips.withColumn(salt, F.pmod(place, F.lit(stream_buckets)).cast("int"))
        copies = lookup.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(stream_buckets - 1))))
    else:
        named = F.broadcast(hot.select(F.col("id").alias(id_col), F.col("buckets").alias(n_col)))
        buckets = F.when(_trip_id(role).isNull(), F.lit(null_buckets)).otherwise(F.coalesce(F.col(n_col), F.lit(1)))
        salted = trips.join(named, _trip_id(role) == F.col(id_col), "left")
        salted = salted.withColumn(salt, F.pmod(place, buckets).cast("int")).drop(id_col, n_col)
        copies = lookup.join(named, F.col(key) == F.col(id_col), "left")
        copies = copies.withColumn(copy, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n_col), F.lit(1)) - 1))).drop(id_col, n_col)
    return salted, copies, (_trip_id(role) == F.col(key)) & (F.col(salt) == F.col(copy)), (salt, copy)


def _shuffle_join(
    trips: DataFrame, lookup: DataFrame, role: str, unique: bool, hot: DataFrame | None, null_buckets: int, stream_buckets: int
) -> DataFrame:
    salted, copies, on, (salt, copy) = _salted(trips, lookup, role, hot, null_buckets, stream_buckets)
    if unique:
        # Says to Catalyst that a trip meets one row at most, so that it can drop the join.
        copies = unique_lookup(copies, _key(role), copy)
    return salted.join(copies, on, "left").drop(salt, copy)


def enrich(
    trips: DataFrame,
    zones: DataFrame | ZoneLookup,
    unique_zones: bool = False,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    salt_buckets: int | None = None,
    rows_per_salt_task: int = ROWS_PER_SALT_TASK,
) -> DataFrame:
    """Trips with ``Pickup_*`` and ``Dropoff_*`` zone columns and a
    ``yyyy-MM-dd`` ``date``. Output columns: the trip columns in their order
    and by their names (``date``, in any case, replaced in place), then the
    three pickup and the three dropoff zone columns. Ids of any type compare as
    strings.

    ``zones`` may be a :class:`ZoneLookup` from :func:`prepare_lookup`, to
    check a lookup once and merge many times. ``broadcast_max_rows`` applies
    when ``zones`` is a plain DataFrame. ``rows_per_salt_task`` and
    ``salt_buckets`` shape the shuffle join used beyond the broadcast bound
    (see :func:`hot_ids`). There the trips' ids are counted here, once for all
    plans built on the result; a stream cannot be counted ahead, so in it every
    id is dealt over ``salt_buckets`` (default ``STREAM_BUCKETS``) salts."""
    checked = zones if isinstance(zones, ZoneLookup) else prepare_lookup(zones, broadcast_max_rows)
    unique = unique_zones or checked.unique_ids
    roles = checked.role_frames(unique)
    out = trips
    if not checked.broadcastable:
        counts = None if trips.isStreaming else count_trip_ids(trips)
        most = most_salts(trips.sparkSession)
        out = out.withColumn(_ADDRESS, trip_address(trips))
    for role in ROLES:
        if checked.broadcastable:
            out = out.join(F.broadcast(roles[role]), _trip_id(role) == F.col(_key(role)), "left")
        else:
            hot = counts and hot_ids(counts, role, rows_per_salt_task, salt_buckets, most)
            null_buckets = min(most, -(-counts.without_id[role] // rows_per_salt_task)) if counts else 1
            out = _shuffle_join(out, roles[role], role, unique, hot, max(1, null_buckets), salt_buckets or STREAM_BUCKETS)
    trip_cols = [epoch_to_date(_plain(c)).alias(c) if c.lower() == "date" else _plain(c) for c in trips.columns]
    zone_cols = [F.col(f"{role}_{a}") for role in ROLES for a in ZONE_ATTRIBUTES]
    return out.select(*trip_cols, *zone_cols)
