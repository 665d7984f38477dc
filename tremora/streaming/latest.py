"""Streaming counterparts: latest revisions, late records, windows over event time, month recomputation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import classify_revisions
from ..sources.versioned import VersionedTable


def upsert_latest(stream: DataFrame, target: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Keeps `target` the table of all revisions, classified; each micro-batch replaces the keys that it brings.

    A batch that is run again finds its id in the snapshot log and changes nothing.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        head = target.head()
        if head and any(f'"batch": {batch_id},' in s.summary or f'"batch": {batch_id}}}' in s.summary for s in target.snapshots().select("summary").collect()):
            return
        old = target.read() if head else None
        rows = df if old is None else df.unionByName(old.select(*df.columns))
        target.overwrite(classify_revisions(rows.dropDuplicates(["source_observation_id"])), summary={"batch": batch_id}, baseline=head)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_deduplicated(stream: DataFrame, time: str, delay: str, *keys: str) -> DataFrame:
    """First arrival of each key among records that come at most `delay` late."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def tumbling(df: DataFrame, time: str, width: str, *by: str, measures: list[Column] | None = None) -> DataFrame:
    """Counts (and measures) of half-open windows; on a stream with a watermark, and alike on a table."""
    out = df.groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"), *(measures or []))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, *[c for c in out.columns if c not in ("window", *by)])


def sessions(df: DataFrame, time: str, gap: str, *by: str) -> DataFrame:
    """Sessions that a pause of `gap` ends: an extension, the batch engine has none."""
    out = df.groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n"))
    return out.select(*by, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def recompute_months(stream: DataFrame, month: Column, rebuild: Callable[[set[str], int], None], checkpoint: str) -> StreamingQuery:
    """Calls rebuild(months, batch) with the distinct months of each micro-batch: a calendar's worth, whatever its rows."""

    def batch(df: DataFrame, batch_id: int) -> None:
        rebuild({r.m for r in df.select(month.alias("m")).distinct().collect() if r.m is not None}, batch_id)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def as_of(observations: DataFrame, cutoff: Column) -> DataFrame:
    """What was known at the cutoff: revisions that had been made by then, marked provisional."""
    known = F.coalesce("source_updated_at_utc", "catalog_release_at_utc", "processed_at_utc")
    return observations.where(known <= cutoff).withColumns({"publication_state": F.lit("PROVISIONAL"), "observed_as_of": cutoff})
