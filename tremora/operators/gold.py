"""The canonical star: event fact, source bridge and dimensions from observations and memberships."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.numeric import blank, finite
from ..session import require_utc
from .validate import EVENT_TYPES, SYSTEMS, assert_empty, assert_none

REGION_CATEGORIES = ("PREFECTURE", "OFFSHORE", "UNKNOWN")
JST = "Asia/Tokyo"


@dataclass(frozen=True)
class Star:
    events: DataFrame
    bridge: DataFrame
    dim_date: DataFrame
    dim_region: DataFrame
    dim_magnitude_band: DataFrame
    dim_depth_band: DataFrame

    @property
    def natural_in_area(self) -> DataFrame:
        return self.events.where("is_natural_earthquake and is_in_study_area")


def observation_checks() -> dict[str, Column]:
    """Conditions that no current observation may meet, for one scan."""
    c = F.col
    known = lambda name, values: ~F.coalesce(c(name).isin(*values), F.lit(False))
    outside = lambda name, most: ~finite(c(name)) | (F.abs(c(name)) > most)
    broken = lambda name: c(name).isNotNull() & ~finite(c(name))
    return {
        "quality or source": known("quality_status", ("VALID", "WARNING")) | known("source_system", SYSTEMS),
        "time or place": c("event_time_utc").isNull() | outside("latitude", 90.0) | outside("longitude", 180.0) | c("is_in_study_area").isNull(),
        "numbers": broken("depth_km") | broken("magnitude"),
        "lineage": blank(c("source_record_key")) | blank(c("bronze_manifest_id")) | blank(c("raw_object_uri")) | blank(c("source_observation_id")),
        "event type": known("event_type_code", EVENT_TYPES),
    }


def check_inputs(now: DataFrame, members: DataFrame, regions: DataFrame) -> None:
    """Fails on anything that would make the star wrong. Each frame is scanned once for all its row checks."""
    assert_none(now, observation_checks())
    c = F.col
    status = ~F.coalesce(c("membership_status").isin("PRIMARY", "SUPPORTING"), F.lit(False))
    assert_none(members, {"membership": blank(c("canonical_event_id")) | blank(c("source_observation_id")) | blank(c("canonical_model_version")) | status})
    own_key = c("region_category").isin("OFFSHORE", "UNKNOWN") & (c("region_key") != c("region_category"))
    prefecture = (c("region_category") == "PREFECTURE") & ~c("region_key").startswith("PREFECTURE:")
    assert_none(regions, {"region": blank(c("region_key")) | blank(c("region_name")) | ~F.coalesce(c("region_category").isin(*REGION_CATEGORIES), F.lit(False)) | own_key | prefecture})
    for frame, name in ((now, "observation"), (members, "membership"), (regions, "region")):
        assert_empty(frame.groupBy("source_observation_id").count().where("count > 1"), f"two rows of one {name}")
    both = now.select("source_observation_id", "source_system").join(members, "source_observation_id", "full_outer")
    assert_none(both, {"observation without membership": c("canonical_event_id").isNull(), "membership without observation": c("source_system").isNull()})
    per_event = both.groupBy("canonical_event_id").agg(F.count_if(c("membership_status") == "PRIMARY").alias("p"), F.count_distinct("canonical_model_version").alias("v"), F.count("*").alias("n"), F.count_distinct("source_system").alias("s"))
    assert_none(per_event, {"one primary and one version": (c("p") != 1) | (c("v") != 1), "one member of a source": c("n") != c("s")})


def to_gold(observations: DataFrame, members: DataFrame, links: DataFrame, regions: DataFrame, run_id: str, updated_at: Column, check: bool = True) -> Star:
    """The star of the current observations.

    What an event takes from each source, its coverage and its primary come from one aggregation by event, instead of
    a join for each: the members of an event are few, and meet once.
    """
    spark = observations.sparkSession
    require_utc(spark)
    now = observations.where("is_current_source_revision")
    if check:
        check_inputs(now, members, regions)
    ends = F.explode(F.array("left_observation_id", "right_observation_id"))
    ambiguous = links.where("link_decision = 'AMBIGUOUS'").select(ends.alias("source_observation_id")).distinct().withColumn("_ambiguous", F.lit(True))
    rows = now.join(members, "source_observation_id").join(ambiguous, "source_observation_id", "left").join(regions, "source_observation_id", "left")
    c = F.col
    feed, bulletin, first = c("source_system") == "USGS", c("source_system") == "JMA_BULLETIN", c("membership_status") == "PRIMARY"
    of = lambda who, name: F.max(F.when(who, c(name)))
    from_primary = ("source_observation_id", "source_system", "event_time_utc", "latitude", "longitude", "depth_km", "magnitude", "magnitude_type", "event_type_code", "place_name", "is_in_study_area", "region_key", "region_name", "region_category")
    grouped = rows.groupBy("canonical_event_id").agg(
        F.max(F.when(first, F.struct(*from_primary))).alias("p"),
        F.count("*").cast("int").alias("source_count"),
        F.bool_or(feed).alias("has_usgs"),
        F.bool_or(bulletin).alias("has_jma"),
        F.bool_or("tsunami_flag").alias("tsunami_flag"),  # true if any says so, false if some deny, else null
        of(feed, "alert_level").alias("alert_level"),
        of(feed, "significance").alias("significance"),
        of(bulletin, "max_intensity_code").alias("max_intensity_code"),
        of(bulletin, "determining_agency_code").alias("determining_agency_code"),
        of(bulletin, "catalog_era").alias("catalog_era"),
        F.bool_or(c("quality_status") == "WARNING").alias("warned"),
        F.bool_or(F.coalesce("_ambiguous", F.lit(False))).alias("ambiguous"),
        F.max("canonical_model_version").alias("canonical_model_version"),
    )
    jst = F.from_utc_timestamp(c("p.event_time_utc"), JST)
    key = lambda t: F.date_format(t, "yyyyMMdd").cast("int")
    events = grouped.select(
        F.lit("1.0").alias("schema_version"),
        "canonical_event_id",
        c("p.source_observation_id").alias("primary_observation_id"),
        c("p.source_system").alias("canonical_source_system"),
        c("p.event_time_utc").alias("event_time_utc"),
        jst.cast("timestamp_ntz").alias("event_time_jst"),
        F.to_date(c("p.event_time_utc")).alias("event_date_utc"),
        F.to_date(jst).alias("event_date_jst"),
        key(c("p.event_time_utc")).alias("event_date_key_utc"),
        key(jst).alias("event_date_key_jst"),
        *(c(f"p.{n}").alias(n) for n in ("latitude", "longitude", "depth_km", "magnitude", "magnitude_type", "event_type_code")),
        (c("p.event_type_code") == "EARTHQUAKE").alias("is_natural_earthquake"),
        c("p.place_name").alias("place_name"),
        c("p.is_in_study_area").alias("is_in_study_area"),
        F.coalesce("p.region_key", F.lit("UNKNOWN")).alias("region_key"),
        F.coalesce("p.region_name", F.lit("Unknown")).alias("region_name"),
        F.coalesce("p.region_category", F.lit("UNKNOWN")).alias("region_category"),
        bands.magnitude_band(c("p.magnitude")).alias("magnitude_band_code"),
        bands.depth_band(c("p.depth_km")).alias("depth_band_code"),
        *("tsunami_flag alert_level significance max_intensity_code determining_agency_code catalog_era source_count has_usgs has_jma".split()),
        F.when(c("source_count") == 2, "USGS_JMA").when(c("has_usgs"), "USGS_ONLY").otherwise("JMA_ONLY").alias("source_coverage_code"),
        F.when(c("ambiguous"), "AMBIGUOUS").when(c("source_count") > 1, "MATCHED").otherwise("SINGLE_SOURCE").alias("link_status"),
        F.when(c("warned"), "WARNING").otherwise("VALID").alias("quality_status"),
        "canonical_model_version",
        F.lit(run_id).alias("gold_run_id"),
        updated_at.alias("record_updated_at_utc"),
    )
    bridge = rows.select("canonical_event_id", "source_observation_id", "source_system", "source_record_key", first.alias("is_primary"), "source_link_id", "raw_object_uri", "bronze_manifest_id", "catalog_release", "source_updated_at_utc")
    return Star(events, bridge, date_dimension(events), events.select("region_key", "region_name", "region_category").distinct(), bands.dimension(spark, bands.MAGNITUDE), bands.dimension(spark, bands.DEPTH))


def date_dimension(events: DataFrame, *columns: str) -> DataFrame:
    """A row for each date in the columns, UTC and JST dates by default."""
    days = events.select(F.explode(F.array(*(columns or ("event_date_utc", "event_date_jst")))).alias("calendar_date")).where("calendar_date is not null").distinct()
    d = F.col("calendar_date")
    parts = {"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d), "month_name": F.date_format(d, "MMMM"), "day_of_month": F.dayofmonth(d), "day_of_week": F.dayofweek(d)}
    return days.select(F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d, *(x.alias(n) for n, x in parts.items()), F.dayofweek(d).isin(1, 7).alias("is_weekend"))
