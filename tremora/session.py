"""The session that the engine expects: UTC, ANSI arithmetic, adaptive plans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, name: str = "tremora", **settings: str) -> SparkSession:
    """A session with SETTINGS; on a cluster, master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("_", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Fails unless the session's time zone is UTC: dates and keys are derived in it."""
    if (zone := spark.conf.get("spark.sql.session.timeZone")) != "UTC":
        raise ValueError(f"the session's time zone is {zone}, not UTC")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Ends lineage, so that later plans don't repeat earlier work: a table below the folder that spark.checkpoint.dir
    names, which a lost executor doesn't take along; where none is named (tests, notebooks), a persisted frame."""
    base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if base is None:
        return df.persist()
    path = f"{base.rstrip('/')}/tremora/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
