"""Record validation with reason codes, and assertions over frames that share one scan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import blank, finite
from ..functions.reasons import all_reasons

#: Fixed values of the record contract.
SYSTEMS = ("USGS", "JMA_BULLETIN")
EVENT_TYPES = ("EARTHQUAKE", "ARTIFICIAL", "ERUPTION", "OTHER", "UNKNOWN")
ERAS = ("LEGACY", "UNIFIED")
DETERMINATION_FLAGS = ("K", "S", "k", "s", "A", "a", "N", "F")


def rules(run_id: str) -> dict[str, Column]:
    """Conditions that reject an observation, by reason code."""
    c = F.col
    either = lambda *xs: F.expr("false") if not xs else xs[0] if len(xs) == 1 else xs[0] | either(*xs[1:])
    outside = lambda name, most: ~finite(c(name)) | (F.abs(c(name)) > most)
    bulletin, feed = c("source_system").eqNullSafe("JMA_BULLETIN"), c("source_system").eqNullSafe("USGS")
    lineage = ("bronze_manifest_id", "raw_object_uri", "raw_sha256", "raw_record_locator", "raw_record_hash", "ingest_run_id")
    contract = either(
        ~c("schema_version").eqNullSafe("1.0"),
        ~F.coalesce(c("source_system").isin(*SYSTEMS), F.lit(False)),
        *(blank(c(name)) for name in lineage),
        ~c("ingest_run_id").eqNullSafe(run_id),
        ~F.coalesce(c("quality_status").isin("VALID", "WARNING"), F.lit(False)),
        bulletin & (blank(c("catalog_release")) | ~F.coalesce(c("catalog_era").isin(*ERAS), F.lit(False))),
        bulletin & ~blank(c("source_status")) & ~c("source_status").isin(*DETERMINATION_FLAGS),
        ~bulletin & (c("catalog_release").isNotNull() | c("catalog_era").isNotNull()),
        feed & c("source_updated_at_utc").isNull(),
    )
    return {
        "MISSING_SOURCE_KEY": blank(c("source_record_key")) | blank(c("source_revision_key")),
        "INVALID_EVENT_TIME": c("event_time_utc").isNull(),
        "INVALID_LATITUDE": outside("latitude", 90.0),
        "INVALID_LONGITUDE": outside("longitude", 180.0),
        "NON_FINITE_NUMBER": either(*(c(n).isNotNull() & ~finite(c(n)) for n in ("depth_km", "magnitude"))),
        "UNSUPPORTED_RECORD_TYPE": ~F.coalesce(c("event_type_code").isin(*EVENT_TYPES), F.lit(False)),
        "CONTRACT_MISMATCH": contract,
    }


def validate(observations: DataFrame, run_id: str) -> DataFrame:
    """Observations with reject_reasons, empty for valid ones; split() separates them."""
    return observations.withColumn("reject_reasons", all_reasons(rules(run_id)))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected)."""
    return validated.where("size(reject_reasons) = 0").drop("reject_reasons"), validated.where("size(reject_reasons) > 0")


def summary(validated: DataFrame) -> DataFrame:
    """One row: input, valid and rejected counts, and publish_blocked if anything was rejected."""
    bad = F.count_if(F.size("reject_reasons") > 0)
    return validated.agg(F.count("*").alias("input_count"), (F.count("*") - bad).alias("valid_count"), bad.alias("reject_count"), (bad > 0).alias("publish_blocked"))


def reason_counts(validated: DataFrame, column: str = "reject_reasons", weight: Column | None = None) -> DataFrame:
    """How many rows have each reason; weight: how many a row stands for."""
    n = F.count("*") if weight is None else F.sum("w")
    return validated.select(F.explode(column).alias("reason"), (F.lit(1) if weight is None else weight).alias("w")).groupBy("reason").agg(n.alias("n"))


def violations(df: DataFrame, checks: Mapping[str, Column], weight: Column | None = None) -> dict[str, int]:
    """How many rows break each check (a condition that must never hold), all in one scan; weight: how many a row stands for."""
    n = F.count_if if weight is None else lambda c: F.coalesce(F.sum(F.when(c, weight)), F.lit(0))
    row = df.agg(*(n(F.coalesce(c, F.lit(False))).alias(name) for name, c in checks.items())).first()
    return row.asDict()


def assert_none(df: DataFrame, checks: Mapping[str, Column]) -> None:
    if broken := {k: n for k, n in violations(df, checks).items() if n}:
        raise ValueError(f"rows break: {broken}")


def assert_unique(df: DataFrame, *keys: str) -> None:
    """Fails if a key is blank or occurs twice."""
    if not df.where(" or ".join(f"{k} is null" for k in keys)).isEmpty():
        raise ValueError(f"null in {keys}")
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"{keys} is not unique")


def assert_empty(df: DataFrame, what: str) -> None:
    if not df.isEmpty():
        raise ValueError(what)


def bounded(df: DataFrame, most: int, *order: str) -> list:
    """At most `most` rows on the driver, in order; fails rather than cutting."""
    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return rows
