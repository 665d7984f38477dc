"""Revisions of source records: which is current, and why the others are not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import release_order

KEY = ("source_system", "source_record_key")


def revision_order(inventory: Sequence[str] = ()) -> list:
    """Latest first. Bulletin records go by their release, others by their update; then by processing, hash and id."""
    bulletin = F.upper("source_system") == "JMA_BULLETIN"
    return [
        F.when(bulletin, F.col("catalog_release_at_utc")).otherwise(F.col("source_updated_at_utc")).desc_nulls_last(),
        F.when(bulletin, release_order(F.col("catalog_release"), inventory)).desc_nulls_last(),
        F.col("processed_at_utc").desc(),
        F.col("raw_record_hash").asc(),
        F.col("source_observation_id").asc(),
    ]


def classify_revisions(observations: DataFrame, inventory: Sequence[str] = ()) -> DataFrame:
    """Observations with revision_rank, is_current_source_revision and revision_class CURRENT, DUPLICATE or SUPERSEDED.

    A revision that is not current is a duplicate if an earlier ranked one has its hash. One shuffle by record serves
    both windows.
    """
    ranked = observations.withColumn("revision_rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(*revision_order(inventory))))
    nth = F.row_number().over(Window.partitionBy(*KEY, "raw_record_hash").orderBy("revision_rank"))
    kind = F.when(F.col("revision_rank") == 1, "CURRENT").when(nth > 1, "DUPLICATE").otherwise("SUPERSEDED")
    return ranked.withColumn("revision_class", kind).withColumn("is_current_source_revision", F.col("revision_rank") == 1)


def current(classified: DataFrame) -> DataFrame:
    return classified.where("is_current_source_revision")


def history(classified: DataFrame) -> DataFrame:
    return classified.where("not is_current_source_revision")


def presentation(classified: DataFrame) -> DataFrame:
    """A total order for output: by time, source, key, current first, id."""
    return classified.orderBy("event_time_utc", *KEY, F.col("is_current_source_revision").desc(), "source_observation_id")


def metrics(classified: DataFrame) -> DataFrame:
    """Counts by source: input = current + duplicates + superseded."""
    kinds = {"current_count": "CURRENT", "duplicate_count": "DUPLICATE", "superseded_count": "SUPERSEDED"}
    return classified.groupBy("source_system").agg(F.count("*").alias("input_count"), *(F.count_if(F.col("revision_class") == k).alias(n) for n, k in kinds.items()))
