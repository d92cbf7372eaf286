"""Session setup shared by every job.

Three things change answers or survival at scale and are pinned here:

* the session time zone (epoch -> date conversion depends on it),
* AQE with skew-join splitting (hot pickup zones, hot business-months),
* a shared scratch folder for written intermediate tables. On a cluster this
  is whatever ``spark.checkpoint.dir`` names; we only pick our own folder when
  the session has none (local runs and tests).
"""

from __future__ import annotations

import tempfile
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Conf that the analyses rely on. They are all runtime SQL confs, so they can
# be applied to a session somebody else built (the driver owns its session).
PINNED_SQL_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "ridelens",
    shuffle_partitions: int | None = None,
    max_partition_bytes: str | None = None,
    extra_conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pinned settings.

    ``max_partition_bytes`` sets the scan split size
    (``spark.sql.files.maxPartitionBytes``, e.g. ``"256m"``); with columnar
    input a task reads only the used columns of its split, so large splits
    stay small in memory. ``shuffle_partitions`` matters only where raw trips
    are shuffled (the merge beyond the broadcast bound): aim at about 200 MB
    per partition of the shuffled columns. The analyses' own shuffles carry
    one row per group per task, and AQE coalesces them to a few partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(PINNED_SQL_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if max_partition_bytes is not None:
        conf["spark.sql.files.maxPartitionBytes"] = max_partition_bytes
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs the analyses depend on to an existing session."""
    for key, value in PINNED_SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style_access: bool = True,
    ssl_enabled: bool = False,
) -> dict[str, str]:
    """Hadoop S3A options for an S3-compatible store, as session conf keys.

    Pass the result as ``extra_conf`` to :func:`build_session`; paths are then
    plain ``s3a://bucket/key`` URIs given to the readers. Credentials come
    from the caller, never from this module.
    """
    prefix = "spark.hadoop.fs.s3a."
    return {
        prefix + "endpoint": endpoint,
        prefix + "access.key": access_key,
        prefix + "secret.key": secret_key,
        prefix + "path.style.access": str(path_style_access).lower(),
        prefix + "connection.ssl.enabled": str(ssl_enabled).lower(),
    }


# Where the jobs find the object store's settings; values never come from argv.
STORE_ENVIRONMENT = {"endpoint": "S3_ENDPOINT", "access_key": "S3_ACCESS_KEY", "secret_key": "S3_SECRET_KEY"}


def store_conf_from_environment(env: Mapping[str, str]) -> dict[str, str]:
    """:func:`object_store_conf` from ``S3_ENDPOINT``, ``S3_ACCESS_KEY`` and
    ``S3_SECRET_KEY``; empty if none is set, an error if only some are."""
    found = {k: env[v] for k, v in STORE_ENVIRONMENT.items() if env.get(v)}
    if not found:
        return {}
    missing = sorted(v for k, v in STORE_ENVIRONMENT.items() if k not in found)
    if missing:
        raise ValueError(f"object store settings are incomplete: {', '.join(missing)} not set")
    return object_store_conf(**found)


def application_id(spark: SparkSession) -> str:
    """The application id, read from the conf (works without a local
    SparkContext, e.g. over Spark Connect)."""
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def _one_machine(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``)."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from the
    conf. When both are unset, a ``local`` master gets a new folder, registered
    so that later ``checkpoint()`` calls agree with us; on a cluster that folder
    would be another one on each machine, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # no local context (Spark Connect): the conf decides
        if configured:
            return configured.rstrip("/")
        # A folder on this client machine would be invisible to the cluster.
        raise RuntimeError("set spark.checkpoint.dir to a folder the cluster shares") from None
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not _one_machine(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder the cluster shares")
    local = tempfile.mkdtemp(prefix="ridelens-scratch-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")
