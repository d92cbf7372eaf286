"""The analyses over a growing folder of trip files.

The original jobs read one CSV file in batch. When trip files keep arriving,
the same merge and aggregate plans run under Structured Streaming: the
folder is a file source, the zone lookup is a static broadcast side of a
stream-static join, and an aggregate keeps one state row per key. The keys of
these analyses are bounded (business x month, day of month), so state does
not grow with the data and no watermark is needed; nothing is dropped as
late, because the results have no event-time window.

Each trigger writes the complete result as a version of its own under the
table's folder, with ``foreachBatch``; readers take the newest complete version
(:func:`read_table`), so a run that dies while writing leaves the one before it.
A batch replayed after a failure writes the same version again. Progress lives
in a checkpoint folder under the shared scratch folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridelens.operators.zone_merge import ZoneLookup, enrich
from ridelens.plans.series import business_month_totals
from ridelens.session import scratch_dir


def read_trip_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Header CSV files appearing under ``path`` as a streaming DataFrame of
    strings. A file source needs its columns up front: they are those of the
    files already there, in their order, whatever they are (or ``schema``). A
    later file whose header differs fails the query instead of being read by
    position."""
    if schema is None:
        names = spark.read.option("header", "true").csv(path).columns
        schema = StructType([StructField(name, StringType()) for name in names])
    reader = spark.readStream.schema(schema).option("header", "true").option("enforceSchema", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(path)


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The newest complete version of a table written by :func:`run_to_table`."""
    newest = spark.read.schema("version bigint").parquet(f"{table_path}/complete").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{table_path}/version={newest}")


def business_month_totals_stream(trips: DataFrame, zones: DataFrame | ZoneLookup) -> DataFrame:
    """The business-month totals of a trip stream (stateful, one row per
    business-month)."""
    return business_month_totals(enrich(trips, zones))


def run_to_table(
    aggregate: DataFrame,
    table_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
    state_partitions: int = 8,
) -> str:
    """Run a streaming aggregate, writing the complete result as a new version
    under ``table_path`` (parquet) after every trigger. With ``available_now`` it processes
    the files present at start in as many triggers as the source's limits
    allow, then stops. Returns ``table_path``.

    ``state_partitions`` fixes the number of state-store partitions when the
    checkpoint is first created (it cannot change later). The state is one
    row per key and partial aggregation runs before the exchange, so a few
    partitions suffice however large each batch is."""
    spark = aggregate.sparkSession
    name = hashlib.sha1(table_path.encode()).hexdigest()[:16]
    checkpoint = checkpoint_location or f"{scratch_dir(spark)}/streams/{name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/version={batch_id}")
        done = batch.sparkSession.createDataFrame([(batch_id,)], "version bigint")
        done.coalesce(1).write.mode("append").parquet(f"{table_path}/complete")

    writer = (
        aggregate.writeStream.outputMode("complete")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        query = writer.trigger(availableNow=True).start() if available_now else writer.start()
    finally:
        spark.conf.set(key, previous)
    if available_now:
        query.awaitTermination()
    return table_path
