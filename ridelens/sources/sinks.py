"""Result sinks.

An export replaces the one before it, and must not lose it when the job dies
on the way. So the rows are written beside the export first; only when all of
them are there is the old folder put aside, the new one given its name, and the
old one removed. What a job that died left behind is put right by the next
export to the same path, or by :func:`restore_export`.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# Beside the export: rows being written, and the export they are to replace.
# A leading dot hides them from readers of the folder above.
_WRITING, _BEFORE = ".writing", ".before"


class _Store:
    """The file system of a path, as Hadoop sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.target = self._path(path)
        self._fs = self.target.getFileSystem(spark._jsc.hadoopConfiguration())

    def beside(self, mark: str):
        return self._path(self.target.getParent(), f".{self.target.getName()}{mark}")

    def exists(self, place) -> bool:
        return self._fs.exists(place)

    def rename(self, source, to) -> None:
        if not self._fs.rename(source, to):
            raise OSError(f"{source} could not be renamed to {to}")

    def remove(self, place) -> None:
        self._fs.delete(place, True)


def restore_export(spark: SparkSession, path: str) -> bool:
    """Puts back the export at ``path`` if a job died after it was put aside and
    before the new one had its name. Returns whether there is an export."""
    store = _Store(spark, path)
    before = store.beside(_BEFORE)
    if not store.exists(store.target) and store.exists(before):
        store.rename(before, store.target)
    return store.exists(store.target)


def _swap(store: _Store, written) -> None:
    """Gives ``written`` the export's name. Until then the old export is there,
    by its name or put aside."""
    before = store.beside(_BEFORE)
    if store.exists(store.target):
        store.remove(before)  # of a job that died after its swap
        store.rename(store.target, before)
    try:
        store.rename(written, store.target)
    except (OSError, Py4JError):
        if store.exists(before) and not store.exists(store.target):
            store.rename(before, store.target)
        raise
    store.remove(before)


def export_csv(df: DataFrame, path: str, order_by: list[str] | None = None, single_file: bool = True) -> str:
    """Write ``df`` as header CSV, replacing whatever is at ``path`` once all
    rows are written.

    ``single_file`` (the exports' contract) gathers the rows in one task that
    sorts them by ``order_by`` and writes one part file; what computes them
    stays as parallel as it was. It suits the tables the analyses produce (a
    handful of business-months or days). Pass ``single_file=False`` for output
    that grows with the input: every task then writes its own file, in overall
    order if ``order_by`` is given. Nothing is counted first. ``df`` may read
    the export it replaces. If writing fails, the old export stays as it is.
    Two jobs must not export to one path at a time. Returns ``path``.
    """
    if single_file:
        out = df.repartition(1)
        out = out.sortWithinPartitions(*order_by) if order_by else out
    else:
        out = df.orderBy(*order_by) if order_by else df
    spark = df.sparkSession
    store = _Store(spark, path)
    restore_export(spark, path)
    written = store.beside(f"{_WRITING}-{uuid.uuid4().hex}")
    try:
        out.write.option("header", "true").csv(written.toString())
        _swap(store, written)
    finally:
        if store.exists(written):
            store.remove(written)
    return path
