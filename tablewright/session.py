"""A Spark session with the settings that the library's semantics rest on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: ANSI casts raise on bad values, times are UTC, and Spark re-plans joins and partitions from what it measures.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "tablewright", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


#: Temporary folders of local sessions that name no shared one.
_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder; on a cluster that is an error, as every machine would
    write to a disk of its own.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if context.applicationId not in _FOLDERS:
            _FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tablewright-")
        found = _FOLDERS[context.applicationId]
    return found.rstrip("/")
