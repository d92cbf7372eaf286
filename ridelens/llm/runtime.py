"""What the operators share on the driver: shipping the package to executors,
cutting lineage into the shared folder, fresh column names."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ridelens.session import scratch_dir

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that tasks
    import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ridelens-ship-"), "ridelens_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(_PACKAGE.rglob("*.py")):
            z.write(f, str(Path(_PACKAGE.name) / f.relative_to(_PACKAGE)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back: later
    steps start from files that any executor can read again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column (of any case) has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def carry(df: DataFrame, run: Callable, fields: str) -> tuple[DataFrame, list[str]]:
    """Appends columns to the rows of ``df`` without a join: ``run`` gets each
    batch (text as string) and returns, in slices, (slice, new arrays). Returns
    the frame and the new columns' names, lengthened where ``df`` has them."""
    df = df.withColumn("text", F.col("text").cast("string"))
    new = StructType.fromDDL(fields)
    names = [fresh(df.columns, f.name) for f in new]

    def tasks(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part, arrays in run(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *names])

    schema = StructType([*df.schema.fields, *[StructField(n, f.dataType) for n, f in zip(names, new, strict=True)]])
    return df.mapInArrow(tasks, schema), names


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, with the types the operators expect. Columns
    that have them already are not wrapped in a cast, so that two uses of the
    frame plan alike and can share one shuffle."""
    types = {"doc_id": "bigint", "page_id": "bigint", "item_id": "bigint"}
    have = dict(df.dtypes)

    def column(name: str) -> Column:
        wanted = types.get(name, "string")
        plain = F.col(f"`{name}`")
        return plain if have.get(name) == wanted else plain.cast(wanted).alias(name)

    return df.select(*[column(c) for c in columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
