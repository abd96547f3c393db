"""A database inside the driver's JVM, for local runs and tests.

Spark ships Apache Derby. With ``jdbc:derby:memory:`` it lives in the memory of
one process and opens no port, so only a local session, whose tasks share that
process, can use it. A cluster needs a database its executors can reach: name
it in ``spark.haulage.jdbc.url`` (plus ``.user``, ``.password``, ``.driver``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from haulage.session import is_local
from haulage.sources.jdbc import Endpoint

SETTING = "spark.haulage.jdbc"


def working_endpoint(spark: SparkSession, name: str) -> Endpoint:
    """The configured database, or an in-memory one called ``name``."""
    url = spark.conf.get(f"{SETTING}.url", None)
    if url:
        return Endpoint(
            url,
            *[spark.conf.get(f"{SETTING}.{key}", None) for key in ("user", "password", "driver")],
        )
    if not is_local(spark):
        raise RuntimeError(
            f"{SETTING}.url is not set: the in-memory database is visible to one process only"
        )
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    database = f"{name}-{spark.sparkContext.applicationId}"
    return Endpoint(f"jdbc:derby:memory:{database};create=true")
