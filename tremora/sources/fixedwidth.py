"""Fixed-width bulletin records of 96 bytes: splitting, field slicing, implied decimals, code tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import in_study_area
from ..functions.ids import bulletin_record_key, bulletin_revision_key, observation_id
from ..functions.reasons import all_reasons

WIDTH = 96
#: Code tables; case matters.
AGENCIES = ("J", "U", "I")
CATEGORIES = {"1": "EARTHQUAKE", "2": "EARTHQUAKE", "3": "ARTIFICIAL", "4": "ERUPTION", "5": "EARTHQUAKE"}
MAGNITUDE_TYPES = ("J", "D", "d", "V", "v", "W", "B", "S")
INTENSITIES = ("1", "2", "3", "4", "5", "6", "7", "A", "B", "C", "D", "R", "M", "S", "L", "F", "X")
TSUNAMI = ("1", "2", "3", "4", "5", "6", "T")
DETERMINATION = ("K", "S", "k", "s", "A", "a", "N", "F")
#: The first day of the unified catalogue, in local time.
UNIFIED_FROM = "1997-10-01 00:00:00"


def split_records(files: DataFrame) -> DataFrame:
    """(uri, manifest_id, sha256, member, line_no, line, record_hash, problem) from files (…, content binary).

    Lines end with LF or CRLF, the last one may have no end; a bare CR or another width is a problem of the whole file,
    reported in its first row. Bytes are kept one to a character. Files are members of one archive and so bounded.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for pdf in batches:
            for f in pdf.itertuples(index=False):
                raw = bytes(f.content or b"")
                lines = raw.replace(b"\r\n", b"\n").split(b"\n")
                lines = lines[:-1] if lines and lines[-1] == b"" else lines
                wrong = next((f"INVALID_RECORD_LENGTH: line {i} has {len(x)} bytes" for i, x in enumerate(lines, 1) if len(x) != WIDTH), None)
                if b"\r" in raw.replace(b"\r\n", b"\n"):
                    wrong = "INVALID_RECORD_LENGTH: bare CR"
                rows = [(0, None, None)] if wrong else [(i, x.decode("latin-1"), hashlib.sha256(x).hexdigest()) for i, x in enumerate(lines, 1)]
                for a in range(0, len(rows), 10_000):
                    part = rows[a : a + 10_000]
                    yield pd.DataFrame({"uri": f.uri, "manifest_id": f.manifest_id, "sha256": f.sha256, "member": f.member, "line_no": [r[0] for r in part], "line": [r[1] for r in part], "record_hash": [r[2] for r in part], "problem": wrong})

    return files.select("uri", "manifest_id", "sha256", "member", "content").mapInPandas(split, "uri string, manifest_id string, sha256 string, member string, line_no int, line string, record_hash string, problem string")


def field(line: Column, first: int, last: int) -> Column:
    """Columns first to last, counted from 1, both included."""
    return F.substring(line, first, last - first + 1)


def code(raw: Column) -> Column:
    return F.nullif(F.trim(raw), F.lit(""))


def implied_decimal(raw: Column, places: int) -> tuple[Column, Column]:
    """(value, whether the field is malformed). A point in the field wins; else blanks behind digits count as zeros."""
    t = F.ltrim(raw)
    plain = F.trim(raw)
    pointed = F.contains(t, F.lit("."))
    good_point = plain.rlike(r"^[+-]?([0-9]+(\.[0-9]{0,2})?|\.[0-9]{1,2})$")
    good = t.rlike(r"^[+-]?[0-9]+ *$")
    value = F.when(plain == "", None).when(pointed, F.when(good_point, plain.try_cast("double"))).when(good, F.replace(t, F.lit(" "), F.lit("0")).try_cast("double") / float(10**places))
    return value, (plain != "") & ~F.when(pointed, good_point).otherwise(good)


def degrees(deg: Column, minutes: Column, most: int) -> tuple[Column, Column]:
    """(decimal degrees, whether malformed). Blanks between sign and digits are allowed, and the pole has no minutes."""
    text = F.regexp_replace(F.trim(deg), r"^([+-]) +([0-9]+)$", "$1$2")
    d = F.abs(F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int")))
    m, _ = implied_decimal(minutes, 2)
    ok = F.coalesce((m >= 0) & (m < 60) & (d <= most) & ((d < most) | (m == 0)), F.lit(False))
    value = d + m / 60.0
    return F.when(ok, F.when(F.startswith(F.ltrim(deg), F.lit("-")), -value).otherwise(value)), ~ok


def origin_time(line: Column) -> Column:
    """Local wall clock as a timestamp without zone; null for dates and times that don't exist."""
    number = lambda a, b: F.when(field(line, a, b).rlike(r"^ *[+-]?[0-9]+ *$"), F.trim(field(line, a, b)).try_cast("int"))
    s, _ = implied_decimal(field(line, 14, 17), 2)
    hundredths = F.floor(s * 100 + 0.5) / 100
    ok = (number(2, 5) >= 1) & (s >= 0) & (s < 60)
    made = F.try_make_timestamp_ntz(number(2, 5), number(6, 7), number(8, 9), number(10, 11), number(12, 13), hundredths.cast("decimal(16,6)"))
    return F.when(ok, made)


def magnitude(raw: Column) -> tuple[Column, Column]:
    """(value, whether malformed): a letter A to C and a digit is below zero, A5 being -1.5."""
    letter = raw.rlike("^[A-C][0-9]$")
    value, bad = implied_decimal(raw, 1)
    below = -(F.ascii(raw) - 64).cast("double") - F.substring(raw, 2, 1).try_cast("double") / 10.0
    return F.when(letter, below).otherwise(value), ~letter & bad


def depth(raw: Column, precision: Column) -> tuple[Column, Column, Column]:
    """(value, whether malformed, whether the blank encoding was read): `  0 4` with precision 1 is 0.04 km."""
    odd = (precision == "1") & raw.rlike("^  0 [0-9]$")
    value, bad = implied_decimal(raw, 2)
    return F.when(odd, F.substring(raw, 5, 1).try_cast("double") / 100.0).otherwise(value), ~odd & bad, odd


def parse_records(records: DataFrame, run_id: str, release: str | None, release_at: Column, processed_at: Column) -> DataFrame:
    """Observation columns and reject_reasons for each row of split_records() without a problem."""
    line = F.col("line")
    lat, lat_bad = degrees(field(line, 22, 24), field(line, 25, 28), 90)
    lon, lon_bad = degrees(field(line, 33, 36), field(line, 37, 40), 180)
    dep, dep_bad, dep_odd = depth(field(line, 45, 49), field(line, 60, 60))
    m1, m1_bad = magnitude(field(line, 53, 54))
    m2, m2_bad = magnitude(field(line, 56, 57))
    kind = F.when(m1.isNotNull(), code(field(line, 55, 55))).when(m2.isNotNull(), code(field(line, 58, 58)))
    local = origin_time(line)
    agency, category, intensity, tsunami, flag = (code(field(line, a, a)) for a in (1, 61, 62, 64, 96))
    bad_number = dep_bad | m1_bad | m2_bad
    for a, b in ((18, 21), (29, 32), (41, 44), (50, 52)):
        bad_number = bad_number | implied_decimal(field(line, a, b), 2)[1]
    for a, b in ((65, 65), (66, 68), (93, 95)):
        raw = F.trim(field(line, a, b))
        bad_number = bad_number | ((raw != "") & ~raw.rlike(r"^\+?[0-9]+$"))
    codes = {
        "CONTRACT_MISMATCH": line.rlike(r"[^ -~]"),
        "UNSUPPORTED_RECORD_TYPE": ~F.coalesce(agency.isin(*AGENCIES), F.lit(False)),
        "INVALID_EVENT_TIME": local.isNull(),
        "INVALID_LATITUDE": lat_bad,
        "INVALID_LONGITUDE": lon_bad,
        "INVALID_NUMBER": bad_number,
    }
    unknown = lambda x, table: x.isNotNull() & ~x.isin(*table)
    mag = F.coalesce(m1, m2)
    warnings = {
        "DEPTH_BLANK_ENCODING": dep_odd,
        "NEGATIVE_DEPTH": dep < 0,
        "MISSING_MAGNITUDE_TYPE": mag.isNotNull() & kind.isNull(),
        "UNKNOWN_MAGNITUDE_TYPE": unknown(kind, MAGNITUDE_TYPES),
        "UNKNOWN_EVENT_CATEGORY": unknown(category, tuple(CATEGORIES)),
        "UNKNOWN_INTENSITY_CODE": unknown(intensity, INTENSITIES),
        "UNKNOWN_TSUNAMI_CODE": unknown(tsunami, TSUNAMI),
        "UNKNOWN_DETERMINATION_FLAG": unknown(flag, DETERMINATION),
    }
    event = F.coalesce(*(F.when(category == k, v) for k, v in CATEGORIES.items()), F.lit("UNKNOWN"))
    out = records.where("problem is null").select(
        F.lit("1.0").alias("schema_version"), F.lit("JMA_BULLETIN").alias("source_system"), bulletin_record_key(line).alias("source_record_key"),
        bulletin_revision_key(F.lit(release).cast("string"), F.col("record_hash")).alias("source_revision_key"), F.col("record_hash").alias("raw_record_hash"),
        F.to_utc_timestamp(local.cast("timestamp"), "Asia/Tokyo").alias("event_time_utc"), local.alias("event_time_jst"), F.lit(None).cast("timestamp").alias("source_updated_at_utc"),
        lat.alias("latitude"), lon.alias("longitude"), dep.alias("depth_km"), mag.alias("magnitude"), kind.alias("magnitude_type"), event.alias("event_type_code"),
        code(field(line, 69, 92)).alias("place_name"), flag.alias("source_status"), F.when(tsunami.isin(*TSUNAMI), True).alias("tsunami_flag"),
        F.lit(None).cast("string").alias("alert_level"), F.lit(None).cast("int").alias("significance"), intensity.alias("max_intensity_code"), agency.alias("determining_agency_code"),
        F.lit(release).cast("string").alias("catalog_release"), release_at.alias("catalog_release_at_utc"), F.when(local < F.lit(UNIFIED_FROM).cast("timestamp_ntz"), "LEGACY").when(local.isNotNull(), "UNIFIED").alias("catalog_era"),
        F.col("manifest_id").alias("bronze_manifest_id"), F.col("uri").alias("raw_object_uri"), F.col("sha256").alias("raw_sha256"), F.concat(F.lit("member="), F.col("member"), F.lit(";line="), F.col("line_no")).alias("raw_record_locator"),
        F.lit(run_id).alias("ingest_run_id"), processed_at.alias("processed_at_utc"), all_reasons(codes).alias("reject_reasons"), all_reasons(warnings).alias("quality_flags"),
    )
    out = out.withColumn("source_observation_id", observation_id(F.col("source_system"), F.col("source_record_key"), F.col("source_revision_key")))
    return out.withColumns({"is_in_study_area": in_study_area(F.col("latitude"), F.col("longitude")), "quality_status": F.when(F.size("quality_flags") > 0, "WARNING").otherwise("VALID")})


def pilot_slice(observations: DataFrame, days: int = 7, above: float = 5.5) -> DataFrame:
    """Records within `days` of the first record (by line) that could be a mainshock: a bounded sample for trials."""
    first = observations.where((F.col("magnitude") > above) & F.col("depth_km").between(50.0, 200.0)).agg(F.min_by("event_time_utc", "raw_record_locator").alias("_at"))
    gap = F.abs(F.unix_micros("event_time_utc") - F.unix_micros("_at"))
    return observations.crossJoin(F.broadcast(first)).where(gap <= days * 86_400_000_000).drop("_at")  # one row
