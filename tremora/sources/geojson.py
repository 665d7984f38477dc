"""GeoJSON feature collections as observations and rejects, on the variant type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import in_study_area
from ..functions.ids import feed_revision_key, observation_id
from ..functions.numeric import finite
from ..functions.reasons import all_reasons, first_reason

#: What the feed's event types mean.
ARTIFICIAL = ("quarry blast", "quarry", "explosion", "mining explosion", "mining hazard", "rock burst", "rockslide", "sonic boom", "nuclear explosion", "chemical explosion", "accidental explosion", "collapse", "induced or triggered event")
ERUPTION = ("volcanic eruption", "volcanic explosion", "volcano")


def event_type(raw: Column) -> Column:
    name = F.lower(F.trim(raw))
    known = F.when(name == "earthquake", "EARTHQUAKE").when(name.isin(*ARTIFICIAL), "ARTIFICIAL").when(name.isin(*ERUPTION), "ERUPTION").otherwise("OTHER")
    return F.when(F.coalesce(name == "", F.lit(True)), "UNKNOWN").otherwise(known)


def structure_reason(payload: Column) -> Column:
    """Why a payload is no feature collection; null if it is one."""
    v = F.try_parse_json(payload)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    features = F.try_variant_get(v, "$.features", "array<variant>")
    all_features = F.forall(features, lambda f: F.try_variant_get(f, "$.type", "string").eqNullSafe("Feature"))
    return first_reason(
        {
            "INVALID_ENCODING": ~F.is_valid_utf8(payload),
            "INVALID_JSON": v.isNull(),
            "ROOT_NOT_OBJECT": ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)),
            "NOT_A_FEATURE_COLLECTION": ~F.try_variant_get(v, "$.type", "string").eqNullSafe("FeatureCollection"),
            "FEATURES_NOT_ARRAY": ~F.coalesce(kind("$.features").startswith("ARRAY"), F.lit(False)) | features.isNull(),
            "NOT_A_FEATURE": ~F.coalesce(all_features, F.lit(False)),
        }
    )


def _field(v: Column, path: str) -> tuple[Column, Column]:
    """(text of a scalar or null, whether the path holds a value other than JSON null)."""
    raw = F.try_variant_get(v, path, "variant")
    there = raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(True))
    return F.when(there, F.try_variant_get(v, path, "string")), there


def _number(v: Column, path: str, out_of: tuple[float, str] | None = None, required: str | None = None) -> tuple[Column, dict[str, Column]]:
    """A JSON number or numeric text, and the reasons against it."""
    text, there = _field(v, path)
    raw = F.try_variant_get(v, path, "variant")
    scalar = F.coalesce(~F.schema_of_variant(raw).rlike("^(BOOLEAN|OBJECT|ARRAY)"), F.lit(False))
    value = F.when(scalar, F.trim(text).try_cast("double"))
    reasons = {"INVALID_NUMBER": there & value.isNull(), "NON_FINITE_NUMBER": value.isNotNull() & ~finite(value)}
    if out_of:
        reasons[out_of[1]] = finite(value) & (F.abs(value) > out_of[0])
    if required:
        reasons[required] = F.coalesce(reasons.get(required), F.lit(False)) | ~there
    return value, reasons


def parse_geojson(files: DataFrame, run_id: str, processed_at: Column) -> DataFrame:
    """A row for each feature of files (manifest_id, uri, sha256, payload) with observation columns and reject_reasons.

    Payloads that are no feature collection belong in quarantine first (structure_reason). split() of the validation
    operators separates observations from rejects.
    """
    v = F.try_parse_json("payload")
    rows = files.select("manifest_id", "uri", "sha256", F.posexplode(F.try_variant_get(v, "$.features", "array<variant>")).alias("pos", "f"))
    f = F.col("f")
    text = lambda path: F.nullif(F.trim(_field(f, path)[0]), F.lit(""))
    lon, lon_bad = _number(f, "$.geometry.coordinates[0]", (180.0, "INVALID_LONGITUDE"), "INVALID_LONGITUDE")
    lat, lat_bad = _number(f, "$.geometry.coordinates[1]", (90.0, "INVALID_LATITUDE"), "INVALID_LATITUDE")
    depth, depth_bad = _number(f, "$.geometry.coordinates[2]")
    mag, mag_bad = _number(f, "$.properties.mag")
    millis = lambda path: F.trim(_field(f, path)[0]).try_cast("decimal(38,6)").try_cast("bigint")
    time = millis("$.properties.time")
    updated = millis("$.properties.updated")
    shape = F.coalesce(F.schema_of_variant(F.try_variant_get(f, "$.geometry", "variant")), F.lit("VOID"))
    coords = F.try_variant_get(f, "$.geometry.coordinates", "array<variant>")
    has_geometry = shape.startswith("OBJECT")
    enough = F.coalesce(F.size(coords) >= 2, F.lit(False))
    point = F.lower(F.try_variant_get(f, "$.geometry.type", "string")).eqNullSafe("point")
    any_of = lambda code: _or([b[code] for b in (lon_bad, lat_bad, depth_bad)])
    placed = has_geometry & enough
    codes = {
        "MISSING_SOURCE_KEY": text("$.id").isNull(),
        "INVALID_EVENT_TIME": time.isNull(),
        "CONTRACT_MISMATCH": ~has_geometry | ~enough,
        "UNSUPPORTED_RECORD_TYPE": has_geometry & ~point,
        "INVALID_LONGITUDE": placed & lon_bad["INVALID_LONGITUDE"],
        "INVALID_LATITUDE": placed & lat_bad["INVALID_LATITUDE"],
        "INVALID_NUMBER": (placed & any_of("INVALID_NUMBER")) | mag_bad["INVALID_NUMBER"],
        "NON_FINITE_NUMBER": (placed & any_of("NON_FINITE_NUMBER")) | mag_bad["NON_FINITE_NUMBER"],
    }
    record_hash = F.sha2(F.to_json(f), 256)
    flag = _field(f, "$.properties.tsunami")[0].try_cast("double").cast("int")
    out = rows.select(
        F.lit("1.0").alias("schema_version"), F.lit("USGS").alias("source_system"), text("$.id").alias("source_record_key"), updated.alias("updated_ms"), record_hash.alias("raw_record_hash"),
        F.timestamp_millis(time).alias("event_time_utc"), F.timestamp_millis(updated).alias("source_updated_at_utc"),
        lat.alias("latitude"), lon.alias("longitude"), depth.alias("depth_km"), mag.alias("magnitude"), text("$.properties.magType").alias("magnitude_type"),
        event_type(_field(f, "$.properties.type")[0]).alias("event_type_code"), text("$.properties.place").alias("place_name"), text("$.properties.status").alias("source_status"),
        F.coalesce(text("$.properties.url"), text("$.properties.detail")).alias("source_url"),
        F.when(flag == 1, True).when(flag == 0, False).alias("tsunami_flag"), F.lower(text("$.properties.alert")).alias("alert_level"), _field(f, "$.properties.sig")[0].try_cast("double").cast("int").alias("significance"),
        F.col("manifest_id").alias("bronze_manifest_id"), F.col("uri").alias("raw_object_uri"), F.col("sha256").alias("raw_sha256"), F.concat(F.lit("features["), F.col("pos"), F.lit("]")).alias("raw_record_locator"),
        F.lit(run_id).alias("ingest_run_id"), processed_at.alias("processed_at_utc"), all_reasons(codes).alias("reject_reasons"),
    )
    out = out.withColumn("source_revision_key", feed_revision_key(F.col("updated_ms"), F.col("raw_record_hash"))).drop("updated_ms")
    out = out.withColumn("source_observation_id", observation_id(F.col("source_system"), F.col("source_record_key"), F.col("source_revision_key")))
    none = F.lit(None).cast("string")
    flags = F.array_compact(F.array(F.when(F.col("depth_km") < 0, "NEGATIVE_DEPTH")))
    return out.withColumns({"is_in_study_area": in_study_area(F.col("latitude"), F.col("longitude")), "quality_flags": flags, "quality_status": F.when(F.size(flags) > 0, "WARNING").otherwise("VALID"), "catalog_release": none, "catalog_era": none, "catalog_release_at_utc": F.lit(None).cast("timestamp"), "determining_agency_code": none, "max_intensity_code": none})


def _or(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out
