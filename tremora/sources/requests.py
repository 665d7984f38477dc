"""Request plans for a paged feed: revision overlap, chunks of at most N days, half-open."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def plan_requests(spark: SparkSession, start: datetime, end: datetime, overlap_days: int = 0, chunk_days: int = 3, seed: datetime | None = None, limit: int = 20_000) -> DataFrame:
    """(target_start, target_end, chunk_start, chunk_end, api_end, request_limit): chunks of [start - overlap, end).

    The query begins at the seed at the earliest; the feed's own end is inclusive, so api_end is a millisecond less.
    """
    if not start < end:
        raise ValueError("a plan needs start < end")
    if seed and start < seed:
        raise ValueError("the target begins before the seed")
    if chunk_days < 1:
        raise ValueError("chunks have at least a day")
    first = max(start - timedelta(days=overlap_days), seed or datetime.min)
    one = spark.createDataFrame([(start, end, first)], "target_start timestamp, target_end timestamp, query_start timestamp")
    step = F.expr(f"interval {chunk_days} days")
    chunks = one.withColumn("chunk_start", F.explode(F.sequence("query_start", F.col("target_end") - F.expr("interval 1 microsecond"), step)))
    chunk_end = F.least(F.col("chunk_start") + step, F.col("target_end"))
    return chunks.select("target_start", "target_end", "chunk_start", chunk_end.alias("chunk_end"), (chunk_end - F.expr("interval 1 millisecond")).alias("api_end"), F.lit(limit).alias("request_limit"))


def plan_daily(spark: SparkSession, run_at: datetime, revision_days: int, chunk_days: int = 3, seed: datetime | None = None) -> DataFrame:
    """Target: the UTC day before run_at. The query goes back revision_days from that day's end, to see late revisions."""
    end = run_at.replace(hour=0, minute=0, second=0, microsecond=0)
    start = max(end - timedelta(days=1), seed) if seed else end - timedelta(days=1)
    if not start < end:
        raise ValueError("the daily target is before the seed")
    return plan_requests(spark, start, end, max(0, revision_days - (end - start).days), chunk_days, seed)
