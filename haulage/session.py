"""Session settings and the shared scratch folder.

Nothing here fixes a master, a memory size or a partition count: those belong
to the cluster. Only settings the results depend on (time zone) or that let
Spark adapt to the data (AQE) are set.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from haulage import storage

BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def object_store_settings(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store.

    Unset arguments come from ``S3_ENDPOINT``, ``S3_ACCESS_KEY`` and
    ``S3_SECRET_KEY``. Without keys, the cluster's own credentials apply.
    """
    endpoint = endpoint or os.environ.get("S3_ENDPOINT")
    access_key = access_key or os.environ.get("S3_ACCESS_KEY")
    secret_key = secret_key or os.environ.get("S3_SECRET_KEY")
    prefix = "spark.hadoop.fs.s3a."
    settings = {
        prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        prefix + "path.style.access": str(path_style).lower(),
    }
    if endpoint:
        settings[prefix + "endpoint"] = endpoint
        settings[prefix + "connection.ssl.enabled"] = str(
            not endpoint.startswith("http://")
        ).lower()
    if access_key and secret_key:
        settings[prefix + "access.key"] = access_key
        settings[prefix + "secret.key"] = secret_key
    return settings


def catalog_settings(name: str, implementation: str, **options: str) -> dict[str, str]:
    """Settings that register the catalog ``name`` (any ``TableCatalog`` class)."""
    prefix = f"spark.sql.catalog.{name}"
    settings = {prefix: implementation}
    for key, value in options.items():
        settings[f"{prefix}.{key.replace('__', '.')}"] = value
    return settings


def build_session(
    app_name: str = "haulage",
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the base settings plus ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**BASE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session setting for the duration of a block, then put it back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors share one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


_fallback_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can see, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a new folder under
    the machine's temporary directory. On a cluster a missing setting is an
    error, because a driver-local path would be lost with its machine.
    """
    setting = "spark.checkpoint.dir"
    root = spark.conf.get(setting, None) or spark.sparkContext.getConf().get(setting)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError(
            f"{setting} is not set: a cluster job needs a folder all executors share"
        )
    app = spark.sparkContext.applicationId
    if app not in _fallback_roots:
        _fallback_roots[app] = tempfile.mkdtemp(prefix="haulage-")
    return _fallback_roots[app]


def session_dir(spark: SparkSession) -> str:
    """This application's own folder under the shared one, deleted when it ends."""
    path = f"{shared_root(spark)}/haulage/{spark.sparkContext.applicationId}"
    storage.make_until_exit(spark, path)
    return path


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path for intermediate data, gone when the application ends."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"
