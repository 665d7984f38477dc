"""Queries of the parsers, the validator and the batch pipeline: the driver's events rendered to bytes and read back.

What a field should hold is SQL over `events` alone. The texts of fields are SQL that both engines read; only dates differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.reasons import first_reason
from ..operators import validate
from ..sources import fixedwidth, geojson
from . import views
from .integrate import Integrated, integrate
from .surrogate import _bands, table

RUN = "rendered"
#: Event i happens ten minutes after event i - 1.
START_MS, STEP_MS = 946_684_800_000, 600_000
_MS = f"({START_MS} + i * {STEP_MS})"
_TIME = {"spark": f"date_format(timestamp_millis({_MS} + 32400000), 'yyyyMMddHHmm')", "duckdb": "strftime(TIMESTAMP '2000-01-01 09:00:00' + to_minutes(10 * i), '%Y%m%d%H%M')"}


def _text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _padded(x: str, width: int, fill: str = " ") -> str:
    return f"lpad({_text(x)}, {width}, '{fill}')"


def _hundredths(whole: str, part: str) -> str:
    return f"{_text(whole)} || '.' || {_padded(part, 2, '0')}"


# --- feature collections ---------------------------------------------------------------------------------------------

#: JSON texts of a feature's fields; every 29th event has each kind of fault.
FEATURE = {
    "id": "CASE WHEN i % 29 IN (0, 9) THEN '  ' ELSE 'us' || i END",
    "time": f"CASE WHEN i % 29 = 1 THEN '\"soon\"' WHEN i % 29 = 10 THEN '\"' || {_MS} || '\"' ELSE {_text(_MS)} END",
    "updated": f"CASE WHEN i % 10 = 0 THEN 'null' ELSE {_text(f'{_MS} + i % 1000')} END",
    "lon": f"CASE WHEN i % 29 = 2 THEN '181.5' ELSE {_hundredths('120 + i % 40', 'i * 11 % 100')} END",
    "lat": f"CASE WHEN i % 29 = 3 THEN '-91.5' WHEN i % 29 = 9 THEN '91.0' ELSE {_hundredths('20 + i % 40', 'i * 7 % 100')} END",
    "depth": f"CASE WHEN i % 29 = 4 THEN '\"deep\"' WHEN i % 17 = 0 THEN 'null' WHEN i % 17 = 1 THEN '-1.5' ELSE {_text('i % 700')} END",
    "mag": f"CASE WHEN i % 29 = 5 THEN '\"NaN\"' WHEN i % 13 = 0 THEN 'null' ELSE {_text('i % 8')} || '.' || {_text('i % 10')} END",
    "kind": "CASE i % 5 WHEN 0 THEN 'earthquake' WHEN 1 THEN ' Quarry Blast ' WHEN 2 THEN 'volcanic eruption' WHEN 3 THEN 'meteor' ELSE '' END",
    "tsunami": "CASE i % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE 'null' END",
    "alert": "CASE WHEN i % 4 = 0 THEN '\" Green \"' ELSE 'null' END",
    "shape": "CASE WHEN i % 29 = 7 THEN 'LineString' ELSE 'Point' END",
}
_COORDS = "CASE WHEN i % 29 = 6 THEN lon ELSE lon || ',' || lat || ',' || depth END"
_GEOMETRY = f"CASE WHEN i % 29 = 8 THEN 'null' ELSE '{{\"type\":\"' || shape || '\",\"coordinates\":[' || {_COORDS} || ']}}' END"
_FEATURE = f"""'{{"type":"Feature","id":"' || id || '","properties":{{"time":' || time || ',"updated":' || updated || ',"mag":' || mag || ',"type":"' || kind || '","tsunami":' || tsunami
  || ',"alert":' || alert || ',"sig":' || {_text('i % 1000')} || ',"place":"km ' || i || '"}},"geometry":' || {_GEOMETRY} || '}}'"""


def _pieces(fields: dict[str, str]) -> str:
    return ", ".join(f"{x} AS {n}" for n, x in fields.items())


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("i"))


def _collections(features: DataFrame, per_file: int = 100) -> DataFrame:
    """Files of `per_file` features (i, feature), in order of i."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "feature"))), lambda x: x["feature"])
    payload = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(ordered, ","), F.lit("]}"))
    files = features.groupBy(F.expr(f"i div {per_file}").alias("file")).agg(payload.alias("payload"))
    return files.select(F.lit("m").alias("manifest_id"), F.concat(F.lit("feed/"), "file").alias("uri"), F.sha2("payload", 256).alias("sha256"), "payload")


def _parsed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _ids(spark, sf_dir).selectExpr("i", *(f"{x} AS {n}" for n, x in FEATURE.items())).selectExpr("i", f"{_FEATURE} AS feature")
    return geojson.parse_geojson(_collections(features), RUN, F.lit("2024-01-01").cast("timestamp"))


_FEED = f"WITH ev AS (SELECT event_id AS i FROM events), fe AS (SELECT i, {_pieces(FEATURE)} FROM ev)"
_FEED_LAT, _FEED_LON = "CAST(lat AS DOUBLE)", "CAST(lon AS DOUBLE)"
GEOJSON_OBSERVATIONS = f"""{_FEED} SELECT 'feed/' || (i // 100) AS uri, 'features[' || i % 100 || ']' AS locator, id AS source_record_key, {_MS} AS time_ms, TRY_CAST(updated AS BIGINT) AS updated_ms,
  CASE WHEN updated = 'null' THEN 'null' ELSE updated END AS revision, {_FEED_LAT} AS latitude, {_FEED_LON} AS longitude, TRY_CAST(depth AS DOUBLE) AS depth_km, TRY_CAST(mag AS DOUBLE) AS magnitude,
  CASE i % 5 WHEN 0 THEN 'EARTHQUAKE' WHEN 1 THEN 'ARTIFICIAL' WHEN 2 THEN 'ERUPTION' WHEN 3 THEN 'OTHER' ELSE 'UNKNOWN' END AS event_type_code, 'km ' || i AS place_name,
  CASE i % 3 WHEN 0 THEN true WHEN 1 THEN false END AS tsunami_flag, CASE WHEN i % 4 = 0 THEN 'green' END AS alert_level, CAST(i % 1000 AS INTEGER) AS significance,
  {_FEED_LAT} BETWEEN 20 AND 50 AND {_FEED_LON} BETWEEN 120 AND 155 AS is_in_study_area, CASE WHEN i % 17 = 1 THEN 'WARNING' ELSE 'VALID' END AS quality_status
  FROM fe WHERE i % 29 > 9"""


def geojson_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser takes from features without a fault."""
    fine, _ = validate.split(_parsed_feed(spark, sf_dir))
    ms = lambda name: F.unix_millis(name)
    return fine.select(
        F.col("raw_object_uri").alias("uri"), F.col("raw_record_locator").alias("locator"), "source_record_key", ms("event_time_utc").alias("time_ms"), ms("source_updated_at_utc").alias("updated_ms"),
        F.substring_index("source_revision_key", ":", 1).alias("revision"), *"latitude longitude depth_km magnitude event_type_code place_name tsunami_flag alert_level significance is_in_study_area quality_status".split(),
    )


GEOJSON_REJECTS = """SELECT 'feed/' || (event_id // 100) AS uri, 'features[' || event_id % 100 || ']' AS locator, CASE event_id % 29 WHEN 0 THEN 'MISSING_SOURCE_KEY' WHEN 1 THEN 'INVALID_EVENT_TIME' WHEN 2 THEN 'INVALID_LONGITUDE'
  WHEN 3 THEN 'INVALID_LATITUDE' WHEN 4 THEN 'INVALID_NUMBER' WHEN 5 THEN 'NON_FINITE_NUMBER' WHEN 7 THEN 'UNSUPPORTED_RECORD_TYPE' WHEN 9 THEN 'MISSING_SOURCE_KEY,INVALID_LATITUDE' ELSE 'CONTRACT_MISMATCH' END AS reasons
  FROM events WHERE event_id % 29 < 10"""


def geojson_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = validate.split(_parsed_feed(spark, sf_dir))
    return bad.select(F.col("raw_object_uri").alias("uri"), F.col("raw_record_locator").alias("locator"), F.array_join("reject_reasons", ",").alias("reasons"))


GEOJSON_STRUCTURE = """SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'INVALID_JSON' WHEN 1 THEN 'ROOT_NOT_OBJECT' WHEN 2 THEN 'NOT_A_FEATURE_COLLECTION' WHEN 3 THEN 'FEATURES_NOT_ARRAY'
  WHEN 4 THEN 'NOT_A_FEATURE' WHEN 5 THEN 'ROOT_NOT_OBJECT' WHEN 6 THEN 'FEATURES_NOT_ARRAY' END AS reason FROM events"""


def geojson_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate that sends payloads to quarantine, on a payload an event, seven of eight broken."""
    payload = F.expr("""CASE i % 8 WHEN 0 THEN '{"i":' || i WHEN 1 THEN '[' || i || ']' WHEN 2 THEN '{"type":"X","features":[],"i":' || i || '}' WHEN 3 THEN '{"type":"FeatureCollection","i":' || i || '}'
        WHEN 4 THEN '{"type":"FeatureCollection","features":[{"type":"Feature"},{"type":"Y","i":' || i || '}]}' WHEN 5 THEN CAST(i AS STRING) WHEN 6 THEN '{"type":"FeatureCollection","features":{"i":' || i || '}}'
        ELSE '{"type":"FeatureCollection","features":[{"type":"Feature","i":' || i || '}]}' END""")
    return _ids(spark, sf_dir).select(F.col("i").alias("event_id"), geojson.structure_reason(payload).alias("reason"))


# --- fixed-width records ---------------------------------------------------------------------------------------------


def _record(engine: str) -> dict[str, str]:
    """The texts of a record's fields, from column 1 on; every 53rd event has each kind of fault."""
    when = f"{_TIME[engine]} || '0000'"
    return {
        "agency": "CASE WHEN i % 53 = 0 THEN 'X' WHEN i % 2 = 0 THEN 'J' ELSE 'U' END",
        "origin": f"CASE WHEN i % 53 = 1 THEN substr({when}, 1, 4) || '13' || substr({when}, 7) ELSE {when} END",
        "b18": "'    '",
        "lat_deg": f"CASE WHEN i % 41 = 0 THEN '- 5' ELSE {_padded('20 + i % 30', 3)} END",
        "lat_min": f"CASE WHEN i % 53 = 2 THEN '6000' ELSE {_padded('i * 7 % 6000', 4, '0')} END",
        "b29": "'    '",
        "lon_deg": f"CASE WHEN i % 53 = 3 THEN ' 181' ELSE {_padded('120 + i % 40', 4)} END",
        "lon_min": _padded("i * 11 % 6000", 4, "0"),
        "b41": "'    '",
        "dep": f"CASE WHEN i % 53 = 4 THEN 'ab123' WHEN i % 37 = 0 THEN '  0 4' WHEN i % 17 = 0 THEN '     ' ELSE {_padded('i % 70000', 5)} END",
        "b50": "'   '",
        "mag1": f"CASE WHEN i % 13 = 0 THEN '  ' WHEN i % 7 = 0 THEN 'A5' ELSE {_padded('i % 80', 2)} END",
        "kind1": "CASE WHEN i % 13 = 0 OR i % 11 = 0 THEN ' ' WHEN i % 19 = 0 THEN 'Q' ELSE 'J' END",
        "b56": "'    '",
        "pre": "CASE WHEN i % 37 = 0 THEN '1' ELSE ' ' END",
        "cat": "substr('123459', CAST(i % 6 + 1 AS INT), 1)",
        "intensity": "CASE WHEN i % 23 = 0 THEN 'Z' WHEN i % 4 = 0 THEN '3' ELSE ' ' END",
        "b63": "' '",
        "wave": "CASE WHEN i % 29 = 0 THEN 'T' ELSE ' ' END",
        "b65": "'    '",
        "place": "rpad('OFF ' || i, 24, ' ')",
        "b93": "'   '",
        "flag": "CASE WHEN i % 31 = 0 THEN 'Z' ELSE 'K' END",
    }


_RECORD_KEY = "'jma_k1_' || substr(sha256(agency || '|' || origin || '|' || trim(lat_deg || lat_min) || '|' || trim(lon_deg || lon_min)), 1, 24)"


def _members(lines: DataFrame, per_file: int = 500) -> DataFrame:
    """Archive members of `per_file` records (i, line), in order of i; every other one has CRLF."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"])
    end = F.when(F.col("file") % 2 == 0, F.lit("\n")).otherwise(F.lit("\r\n"))
    files = lines.groupBy(F.expr(f"i div {per_file}").alias("file")).agg(ordered.alias("lines"))
    content = F.expr("array_join(lines, end)").cast("binary")
    return files.withColumn("end", end).select(F.concat(F.lit("bulletin/"), "file").alias("uri"), F.lit("m").alias("manifest_id"), F.sha2(content, 256).alias("sha256"), F.concat("file", F.lit(".hyp")).alias("member"), content.alias("content"))


def _lines(ids: DataFrame, fields: dict[str, str]) -> DataFrame:
    return ids.selectExpr("i", *(f"{x} AS {n}" for n, x in fields.items())).select("i", F.concat(*fields).alias("line"))


def _parsed_bulletin(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixedwidth.split_records(_members(_lines(_ids(spark, sf_dir), _record("spark"))))
    at = F.lit("2024-01-01").cast("timestamp")
    return fixedwidth.parse_records(records, RUN, "v1", at, at)


_BULLETIN = f"WITH ev AS (SELECT event_id AS i FROM events), re AS (SELECT i, {_pieces(_record('duckdb'))} FROM ev)"
_KM = "CASE WHEN i % 37 = 0 THEN 0.04 WHEN i % 17 = 0 THEN NULL ELSE CAST(i % 70000 AS DOUBLE) / 100 END"
_WARNINGS = """CASE WHEN i % 37 = 0 THEN 'DEPTH_BLANK_ENCODING' END, CASE WHEN i % 13 > 0 AND i % 11 = 0 THEN 'MISSING_MAGNITUDE_TYPE' END, CASE WHEN i % 13 > 0 AND i % 11 > 0 AND i % 19 = 0 THEN 'UNKNOWN_MAGNITUDE_TYPE' END,
  CASE WHEN i % 6 = 5 THEN 'UNKNOWN_EVENT_CATEGORY' END, CASE WHEN i % 23 = 0 THEN 'UNKNOWN_INTENSITY_CODE' END, CASE WHEN i % 31 = 0 THEN 'UNKNOWN_DETERMINATION_FLAG' END"""
BULLETIN_OBSERVATIONS = f"""{_BULLETIN} SELECT 'member=' || (i // 500) || '.hyp;line=' || (i % 500 + 1) AS locator, {_RECORD_KEY} AS source_record_key, 'v1:' || sha256({' || '.join(_record('duckdb'))}) AS source_revision_key, {_MS} AS time_ms,
  round(CASE WHEN i % 41 = 0 THEN -1 ELSE 1 END * (CASE WHEN i % 41 = 0 THEN 5 ELSE 20 + i % 30 END + CAST(i * 7 % 6000 AS DOUBLE) / 100 / 60), 6) AS latitude, round(120 + i % 40 + CAST(i * 11 % 6000 AS DOUBLE) / 100 / 60, 6) AS longitude,
  {_KM} AS depth_km, CASE WHEN i % 13 = 0 THEN NULL WHEN i % 7 = 0 THEN -1.5 ELSE CAST(i % 80 AS DOUBLE) / 10 END AS magnitude, nullif(kind1, ' ') AS magnitude_type,
  CASE i % 6 WHEN 2 THEN 'ARTIFICIAL' WHEN 3 THEN 'ERUPTION' WHEN 5 THEN 'UNKNOWN' ELSE 'EARTHQUAKE' END AS event_type_code, 'OFF ' || i AS place_name, flag AS source_status, CASE WHEN i % 29 = 0 THEN true END AS tsunami_flag,
  nullif(intensity, ' ') AS max_intensity_code, agency AS determining_agency_code, 'UNIFIED' AS catalog_era, concat_ws(',', {_WARNINGS}) AS quality_flags FROM re WHERE i % 53 > 4"""


def bulletin_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser takes from records without a fault."""
    fine, _ = validate.split(_parsed_bulletin(spark, sf_dir))
    return fine.select(
        F.col("raw_record_locator").alias("locator"), "source_record_key", "source_revision_key", F.unix_millis("event_time_utc").alias("time_ms"), F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
        *"depth_km magnitude magnitude_type event_type_code place_name source_status tsunami_flag max_intensity_code determining_agency_code catalog_era".split(), F.array_join("quality_flags", ",").alias("quality_flags"),
    )


BULLETIN_REJECTS = """SELECT 'member=' || (event_id // 500) || '.hyp;line=' || (event_id % 500 + 1) AS locator, CASE event_id % 53 WHEN 0 THEN 'UNSUPPORTED_RECORD_TYPE' WHEN 1 THEN 'INVALID_EVENT_TIME' WHEN 2 THEN 'INVALID_LATITUDE'
  WHEN 3 THEN 'INVALID_LONGITUDE' ELSE 'INVALID_NUMBER' END AS reasons FROM events WHERE event_id % 53 < 5"""


def bulletin_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = validate.split(_parsed_bulletin(spark, sf_dir))
    return bad.select(F.col("raw_record_locator").alias("locator"), F.array_join("reject_reasons", ",").alias("reasons"))


BULLETIN_FILES = "WITH f AS (SELECT event_id // 500 AS k, count(*) AS n FROM events GROUP BY 1) SELECT 'bulletin/' || k AS uri, CASE WHEN k % 3 = 2 THEN 'INVALID_RECORD_LENGTH' END AS reason, CASE WHEN k % 3 = 2 THEN 0 ELSE n END AS records FROM f"


def bulletin_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a record of another width are refused whole; every third file is one."""
    fields = _record("spark")
    short = F.when(F.expr("i div 500 % 3 = 2 and i % 500 = 0"), F.expr("left(line, 95)")).otherwise(F.col("line"))
    rows = fixedwidth.split_records(_members(_lines(_ids(spark, sf_dir), fields).withColumn("line", short)))
    reason = first_reason({"INVALID_RECORD_LENGTH": F.col("problem").startswith("INVALID_RECORD_LENGTH")})
    return rows.groupBy("uri").agg(F.max(reason).alias("reason"), F.count("line").alias("records"))


# --- validation ------------------------------------------------------------------------------------------------------

RECORD_REASONS = """SELECT event_id, CASE event_id % 23 WHEN 1 THEN 'MISSING_SOURCE_KEY' WHEN 2 THEN 'INVALID_EVENT_TIME' WHEN 3 THEN 'INVALID_LATITUDE' WHEN 4 THEN 'INVALID_LONGITUDE' WHEN 5 THEN 'NON_FINITE_NUMBER' WHEN 6 THEN 'UNSUPPORTED_RECORD_TYPE'
  WHEN 7 THEN 'CONTRACT_MISMATCH' WHEN 8 THEN 'CONTRACT_MISMATCH' WHEN 9 THEN 'CONTRACT_MISMATCH' WHEN 10 THEN 'CONTRACT_MISMATCH' WHEN 11 THEN 'CONTRACT_MISMATCH' WHEN 12 THEN CASE WHEN event_id % 2 = 1 THEN 'CONTRACT_MISMATCH' ELSE '' END
  WHEN 13 THEN CASE WHEN event_id % 2 = 0 THEN 'CONTRACT_MISMATCH' ELSE '' END WHEN 14 THEN CASE WHEN event_id % 2 = 1 THEN 'CONTRACT_MISMATCH' ELSE '' END WHEN 15 THEN CASE WHEN event_id % 2 = 0 THEN 'CONTRACT_MISMATCH' ELSE '' END
  WHEN 16 THEN 'INVALID_LATITUDE,UNSUPPORTED_RECORD_TYPE' ELSE '' END AS reasons FROM events"""


def record_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record validator on observations of both feeds (even ids are the feed's) with a fault in 16 of 23."""
    i, feed = F.col("event_id"), F.col("event_id") % 2 == 0
    k = i % 23
    spoilt = lambda at, bad, good: F.when(k == at, F.lit(bad)).otherwise(good)
    e = table(spark, sf_dir, "events")
    rows = e.select(
        "event_id", spoilt(7, "2.0", F.lit("1.0")).alias("schema_version"), spoilt(10, "XX", F.when(feed, "USGS").otherwise("JMA_BULLETIN")).alias("source_system"), spoilt(1, " ", i.cast("string")).alias("source_record_key"), F.lit("1:a").alias("source_revision_key"),
        F.lit("m").alias("bronze_manifest_id"), spoilt(11, "", F.lit("u")).alias("raw_object_uri"), F.lit("s").alias("raw_sha256"), F.lit("l").alias("raw_record_locator"), F.lit("h").alias("raw_record_hash"), spoilt(8, "other", F.lit(RUN)).alias("ingest_run_id"),
        spoilt(9, "BAD", F.lit("VALID")).alias("quality_status"), F.when(~feed | (k == 13), "v1").alias("catalog_release"), F.when(~feed & (k != 12), "UNIFIED").alias("catalog_era"), spoilt(14, "?", F.lit("K")).alias("source_status"),
        F.when(feed & (k != 15), F.col("ts").cast("timestamp")).alias("source_updated_at_utc"), F.when(k != 2, F.col("ts").cast("timestamp")).alias("event_time_utc"), F.when(k == 16, float("nan")).otherwise(spoilt(3, 90.5, F.lit(35.0))).alias("latitude"),
        F.when(k != 4, 139.0).alias("longitude"), spoilt(5, float("inf"), F.lit(10.0)).alias("depth_km"), F.lit(4.0).alias("magnitude"), F.when(k != 16, spoilt(6, "QUAKE", F.lit("EARTHQUAKE"))).alias("event_type_code"),
    )
    return validate.validate(rows, RUN).select("event_id", F.array_join("reject_reasons", ",").alias("reasons"))


# --- from bytes to the star ------------------------------------------------------------------------------------------

#: Events that the feed and the bulletin report; both report the same place, depth and magnitude.
_IN_FEED, _IN_BULLETIN = "i % 5 > 0", "i % 3 > 0"
_TENTHS = _padded("i % 60", 2, "0")
_QUARTER = _padded("i % 4 * 25", 2, "0")


def _clean_feature(mag: str, updated: str) -> str:
    return f"""'{{"type":"Feature","id":"us' || i || '","properties":{{"time":' || {_MS} || ',"updated":' || {updated} || ',"mag":' || {mag} || ',"magType":"mb","type":"earthquake","place":"km ' || i || '"}},"geometry":{{"type":"Point","coordinates":[139.' || {_QUARTER} || ',35.' || {_QUARTER} || ',' || i % 200 || ']}}}}'"""


def _clean_record(engine: str) -> dict[str, str]:
    quarter = _padded("i % 4 * 1500", 4, "0")
    return _record(engine) | {
        "agency": "CASE WHEN i % 2 = 0 THEN 'J' ELSE 'U' END", "origin": f"{_TIME[engine]} || '0000'", "lat_deg": "' 35'", "lat_min": quarter, "lon_deg": "' 139'", "lon_min": quarter, "dep": _padded("i % 200 * 100", 5),
        "mag1": _TENTHS, "kind1": "CASE WHEN i % 19 = 0 THEN ' ' ELSE 'J' END", "pre": "' '", "cat": "'1'", "intensity": "' '", "wave": "' '", "flag": "'K'",
    }


def _integrated(spark: SparkSession, sf_dir: str) -> Integrated:
    """Both feeds from their bytes; every seventh event of the feed has an earlier revision with another magnitude."""
    at, ids = F.lit("2024-01-01").cast("timestamp"), _ids(spark, sf_dir)
    feed = ids.where(_IN_FEED)
    now = feed.selectExpr("i", f"{_clean_feature(f'substr({_TENTHS}, 1, 1) || chr(46) || substr({_TENTHS}, 2, 1)', f'({_MS} + 5000)')} AS feature")
    before = feed.where("i % 7 = 0").selectExpr("i", f"{_clean_feature(_text('9.9'), _MS)} AS feature")
    parsed = geojson.parse_geojson(_collections(now.unionByName(before)), RUN, at)
    records = fixedwidth.split_records(_members(_lines(ids.where(_IN_BULLETIN), _clean_record("spark"))))
    return integrate([parsed, fixedwidth.parse_records(records, RUN, "v1", at, at)], RUN, at)


_GOLD = f"""WITH ev AS (SELECT event_id AS i, event_id % 5 > 0 AS u, event_id % 3 > 0 AS j FROM events), re AS (SELECT i, u, j, {_pieces(_clean_record('duckdb'))} FROM ev WHERE u OR j),
  pr AS (SELECT *, j AND (NOT u OR i % 2 = 0 AND i % 19 > 0) AS own, {_RECORD_KEY} AS key, TIMESTAMP '2000-01-01' + to_minutes(10 * i) AS moment, CAST(i % 60 AS DOUBLE) / 10 AS magnitude, CAST(i % 200 AS DOUBLE) AS depth_km FROM re)"""
GOLD_EVENTS = f"""{_GOLD} SELECT 'evt_' || substr(sha256('CANONICAL|' || CASE WHEN own THEN 'JMA_BULLETIN|' || key ELSE 'USGS|us' || i END), 1, 32) AS canonical_event_id, CASE WHEN own THEN 'JMA_BULLETIN' ELSE 'USGS' END AS canonical_source_system, {_MS} AS time_ms,
  35 + CAST(i % 4 AS DOUBLE) / 4 AS latitude, 139 + CAST(i % 4 AS DOUBLE) / 4 AS longitude, depth_km, magnitude, CASE WHEN own THEN nullif(kind1, ' ') ELSE 'mb' END AS magnitude_type, CASE WHEN own THEN 'OFF ' ELSE 'km ' END || i AS place_name,
  CASE WHEN u AND j THEN 2 ELSE 1 END AS source_count, u AS has_usgs, j AS has_jma, CASE WHEN u AND j THEN 'USGS_JMA' WHEN u THEN 'USGS_ONLY' ELSE 'JMA_ONLY' END AS source_coverage_code, CASE WHEN u AND j THEN 'MATCHED' ELSE 'SINGLE_SOURCE' END AS link_status,
  CASE WHEN j AND i % 19 = 0 THEN 'WARNING' ELSE 'VALID' END AS quality_status, CAST(strftime(moment, '%Y%m%d') AS INTEGER) AS event_date_key_utc, CAST(strftime(moment + INTERVAL 9 HOUR, '%Y%m%d') AS INTEGER) AS event_date_key_jst,
  {_bands('magnitude', 'm')} AS magnitude_band_code, {_bands('depth_km', 'd')} AS depth_band_code, CASE WHEN j THEN agency END AS determining_agency_code FROM pr"""


def gold_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event fact that the whole pipeline makes: parsers, validation, revisions, resolution, star."""
    return _integrated(spark, sf_dir).star.events.select(
        "canonical_event_id", "canonical_source_system", F.unix_millis("event_time_utc").alias("time_ms"),
        *"latitude longitude depth_km magnitude magnitude_type place_name source_count has_usgs has_jma source_coverage_code link_status quality_status event_date_key_utc event_date_key_jst magnitude_band_code depth_band_code determining_agency_code".split(),
    )


GOLD_BRIDGE = f"{_GOLD} SELECT 'USGS' AS source_system, 'us' || i AS source_record_key, NOT own AS is_primary, u AND j AS linked FROM pr WHERE u UNION ALL SELECT 'JMA_BULLETIN', key, own, u AND j FROM pr WHERE j"


def gold_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integrated(spark, sf_dir).star.bridge.select("source_system", "source_record_key", "is_primary", F.col("source_link_id").isNotNull().alias("linked"))


#: By event: without latitude, without members, an hour off, of no region, on a day that no dimension has.
_NO_PLACE, _NO_MEMBER, _OFF, _NO_REGION = "i % 11 = 0", "i % 13 = 0", "i % 17 = 0", "i % 19 = 0"
PUBLICATION_BLOCKERS = f"""{_GOLD}, n AS (SELECT count(*) FILTER ({_NO_PLACE}) AS place, count(*) FILTER ({_NO_MEMBER}) AS member, count(*) FILTER ({_OFF}) AS off, count(*) FILTER ({_NO_REGION}) AS region, count(*) FILTER (day(moment) = 5) AS utc,
  count(*) FILTER (day(moment + INTERVAL 9 HOUR) = 5) AS jst FROM pr) SELECT unnest(['required_fields', 'bridge_lineage', 'source_counts', 'primary_provenance', 'utc_jst', 'dim_region_region_key', 'dim_date_event_date_key_utc', 'dim_date_event_date_key_jst', 'unique_dim_magnitude_band',
  'unique_dim_date', 'unique_dim_region', 'unique_dim_depth_band', 'dim_magnitude_band_magnitude_band_code', 'dim_depth_band_depth_band_code', 'unique_event', 'unique_observation']) AS blocker, unnest([place, member, member, member, off, region, utc, jst, 7, 0, 0, 0, 0, 0, 0, 0]) AS violations FROM n"""


def publication_blockers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blockers of publication on a star that was spoilt in eight ways."""
    star = _integrated(spark, sf_dir).star
    i = ((F.unix_millis("event_time_utc") - START_MS) / STEP_MS).cast("long")
    events = star.events.withColumn("i", i)
    bridge = star.bridge.join(events.where(_NO_MEMBER).select("canonical_event_id"), "canonical_event_id", "left_anti")
    spoilt = events.withColumns({
        "latitude": F.when(~F.expr(_NO_PLACE), F.col("latitude")), "event_time_jst": F.when(F.expr(_OFF), F.col("event_time_jst") + F.expr("interval 1 hour")).otherwise(F.col("event_time_jst")),
        "region_key": F.when(F.expr(_NO_REGION), F.lit("NOWHERE")).otherwise(F.col("region_key")),
    }).drop("i")
    dims = {"dim_date": star.dim_date.where("day_of_month <> 5"), "dim_region": star.dim_region, "dim_magnitude_band": star.dim_magnitude_band.unionByName(star.dim_magnitude_band), "dim_depth_band": star.dim_depth_band}
    return views.blockers(spoilt, bridge, dims).select("blocker", "violations")


QUERIES = {q.__name__: q for q in (geojson_observations, geojson_rejects, geojson_structure, bulletin_observations, bulletin_rejects, bulletin_files, record_reasons, gold_events, gold_bridge, publication_blockers)}
ORACLE = {name: globals()[name.upper()] for name in QUERIES}
