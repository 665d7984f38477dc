"""Parsers on golden cases, raw objects, archives, versioned tables, streams, and the pipeline from bytes to star."""

import io
import json
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tremora.operators import dedup, sets, validate
from tremora.plans import integrate
from tremora.sources import bronze, fixedwidth, geojson, requests
from tremora.sources.versioned import Conflict, VersionedTable, export_buckets, publish, published, write_partitioned
from tremora.streaming import latest

def now():
    return F.lit(datetime(2024, 1, 1))


def feature(fid="us1", time=1696443000000, updated=1696443000000, mag=4.0, coords=(140.0, 35.0, 10.0), **props):
    return {"type": "Feature", "id": fid, "properties": {"time": time, "updated": updated, "mag": mag, "magType": "mb", "type": "earthquake", "tsunami": 0, "sig": 246, "place": "x", **props}, "geometry": {"type": "Point", "coordinates": list(coords)}}


def collection(*features):
    return json.dumps({"type": "FeatureCollection", "metadata": {"count": len(features)}, "features": list(features)})


def parse(spark, *payloads):
    files = spark.createDataFrame([(f"m{i}", f"u{i}", f"s{i}", p) for i, p in enumerate(payloads)], "manifest_id string, uri string, sha256 string, payload string")
    return geojson.parse_geojson(files, "run", now())


def reasons(df):
    return [set(r.reject_reasons) for r in df.orderBy("raw_object_uri", "raw_record_locator").collect()]


def test_structure_gate(spark):
    cases = {collection(): None, collection(feature()): None, "{": "INVALID_JSON", "[]": "ROOT_NOT_OBJECT", '{"type":"X","features":[]}': "NOT_A_FEATURE_COLLECTION", '{"type":"FeatureCollection"}': "FEATURES_NOT_ARRAY", '{"type":"FeatureCollection","features":[{"type":"Y"}]}': "NOT_A_FEATURE"}
    df = spark.createDataFrame([(p,) for p in cases], "payload string")
    got = {r.payload: r.x for r in df.select("payload", geojson.structure_reason(F.col("payload")).alias("x")).collect()}
    assert got == cases


def test_geojson_fields(spark):
    r = parse(spark, collection(feature(alert=" Green ", tsunami=1, coords=(155.0, 20.0, -1.5), url=None, detail="d"))).first()
    assert (r.source_record_key, r.latitude, r.longitude, r.depth_km, r.magnitude, r.event_type_code) == ("us1", 20.0, 155.0, -1.5, 4.0, "EARTHQUAKE")
    assert (r.alert_level, r.tsunami_flag, r.significance, r.source_url, r.is_in_study_area, r.quality_status, r.quality_flags) == ("green", True, 246, "d", True, "WARNING", ["NEGATIVE_DEPTH"])
    assert r.reject_reasons == [] and r.source_revision_key.startswith("1696443000000:") and r.event_time_utc == datetime(2023, 10, 4, 18, 10)
    assert r.source_observation_id.startswith("obs_") and r.raw_record_locator == "features[0]"


def test_geojson_is_tolerant_of_text_numbers(spark):
    r = parse(spark, collection(feature(time="1696443000000", mag="4.5", coords=("140", "35", None)))).first()
    assert (r.reject_reasons, r.magnitude, r.latitude, r.depth_km) == ([], 4.5, 35.0, None)


def test_geojson_rejects(spark):
    bad = [feature(fid="  "), feature(time="soon"), feature(coords=(181.0, 91.0, "deep")), feature(mag="NaN"), feature(coords=(140.0,)), feature(mag=[1]), feature(time=None), feature(coords=(None, 35.0))]
    line, empty = feature(), feature()
    line["geometry"]["type"] = "LineString"
    empty["geometry"] = None
    got = reasons(parse(spark, *(collection(f) for f in (*bad, line, empty))))
    want = [{"MISSING_SOURCE_KEY"}, {"INVALID_EVENT_TIME"}, {"INVALID_LONGITUDE", "INVALID_LATITUDE", "INVALID_NUMBER"}, {"NON_FINITE_NUMBER"}, {"CONTRACT_MISMATCH"}, {"INVALID_NUMBER"}, {"INVALID_EVENT_TIME"}, {"INVALID_LONGITUDE"}, {"UNSUPPORTED_RECORD_TYPE"}, {"CONTRACT_MISMATCH"}]
    assert got == want


@pytest.mark.parametrize("raw, code", [("earthquake", "EARTHQUAKE"), (" Quarry Blast ", "ARTIFICIAL"), ("volcanic eruption", "ERUPTION"), ("meteor", "OTHER"), ("", "UNKNOWN"), (None, "UNKNOWN")])
def test_event_types(spark, raw, code):
    assert spark.createDataFrame([(raw,)], "t string").select(geojson.event_type(F.col("t"))).first()[0] == code


def record(**kw):
    """A record of 96 bytes from column numbers to text."""
    line = list("J2023100412300500    0 35300000    01403000    0 1000   42V      3".ljust(96))
    base = {1: "J", 2: "20231004123005000   ", 22: " 35", 25: "3000", 33: " 140", 37: "3000", 45: " 1000", 53: "42", 55: "V", 61: "1", 62: "4", 64: " ", 69: "OFF SOMEWHERE", 93: " 12", 96: "K"}
    line = [" "] * 96
    for at, text in (base | {int(k[1:]): v for k, v in kw.items()}).items():
        line[at - 1 : at - 1 + len(text)] = text
    return "".join(line)[:96]


def parse_lines(spark, *lines, end="\n"):
    content = bytearray(end.join(lines).encode("latin-1"))
    files = spark.createDataFrame([("u", "m", "s", "x.hyp", content)], "uri string, manifest_id string, sha256 string, member string, content binary")
    recs = fixedwidth.split_records(files)
    return recs, fixedwidth.parse_records(recs, "run", "v1", now(), now()).orderBy("raw_record_locator")


def test_fixed_width_fields(spark):
    r = parse_lines(spark, record())[1].first()
    assert r.reject_reasons == [] and r.quality_flags == []
    assert (r.latitude, r.longitude, r.depth_km, r.magnitude, r.magnitude_type, r.event_type_code) == (35.5, 140.5, 10.0, 4.2, "V", "EARTHQUAKE")
    assert (r.event_time_utc, r.max_intensity_code, r.determining_agency_code, r.catalog_era, r.place_name, r.source_status) == (datetime(2023, 10, 4, 3, 30, 5), "4", "J", "UNIFIED", "OFF SOMEWHERE", "K")
    assert r.source_record_key.startswith("jma_k1_") and len(r.source_record_key) == 31


@pytest.mark.parametrize("kw, field, want", [
    ({"c53": "A5"}, "magnitude", -1.5), ({"c53": "  ", "c56": "51"}, "magnitude", 5.1), ({"c45": "     "}, "depth_km", None), ({"c45": "12.5 "}, "depth_km", 12.5),
    ({"c45": " 12  "}, "depth_km", 12.0), ({"c45": "  0 4", "c60": "1"}, "depth_km", 0.04), ({"c22": "- 1"}, "latitude", -1.5), ({"c33": "-179"}, "longitude", -179.5),
    ({"c22": " 90", "c25": "0000"}, "latitude", 90.0), ({"c2": "199709302359590"}, "catalog_era", "LEGACY"), ({"c2": "199710010000000"}, "catalog_era", "UNIFIED"), ({"c61": "3"}, "event_type_code", "ARTIFICIAL"), ({"c61": " "}, "event_type_code", "UNKNOWN"), ({"c64": "T"}, "tsunami_flag", True),
])
def test_fixed_width_values(spark, kw, field, want):
    r = parse_lines(spark, record(**kw))[1].first()
    assert r.reject_reasons == [] and r[field] == want


@pytest.mark.parametrize("kw, reason", [({"c1": "X"}, "UNSUPPORTED_RECORD_TYPE"), ({"c2": "20230230"}, "INVALID_EVENT_TIME"), ({"c14": "6000"}, "INVALID_EVENT_TIME"), ({"c22": " 90"}, "INVALID_LATITUDE"), ({"c25": "6000"}, "INVALID_LATITUDE"), ({"c33": " 181"}, "INVALID_LONGITUDE"), ({"c45": "  1 4"}, "INVALID_NUMBER"), ({"c53": "X1"}, "INVALID_NUMBER"), ({"c93": "  -"}, "INVALID_NUMBER"), ({"c70": "\xe9"}, "CONTRACT_MISMATCH")])
def test_fixed_width_rejects(spark, kw, reason):
    assert reason in parse_lines(spark, record(**kw))[1].first().reject_reasons


def test_record_ends(spark):
    for end in ("\n", "\r\n"):
        recs, obs = parse_lines(spark, record(), record(c1="U"), end=end)
        assert obs.count() == 2 and recs.where("problem is not null").isEmpty()
    for content in (record()[:95], record() + "\r" + record(), record() + "x"):
        assert parse_lines(spark, content)[0].first().problem.startswith("INVALID_RECORD_LENGTH")
    assert parse_lines(spark, "")[1].collect() == []


def test_duplicate_and_revised_records(spark):
    """The same bytes twice are a duplicate, other values in the same place and time a revision."""
    _, obs = parse_lines(spark, record(), record(), record(c53="44"))
    m = dedup.metrics(dedup.classify_revisions(obs)).first()
    assert (m.input_count, m.current_count, m.duplicate_count + m.superseded_count) == (3, 1, 2) and m.duplicate_count == 1


def test_plan(spark):
    plan = requests.plan_requests(spark, datetime(2024, 1, 5), datetime(2024, 1, 9), overlap_days=3).orderBy("chunk_start").collect()
    assert [(r.chunk_start.day, r.chunk_end.day) for r in plan] == [(2, 5), (5, 8), (8, 9)]
    assert plan[-1].api_end == datetime(2024, 1, 8, 23, 59, 59, 999000)
    daily = requests.plan_daily(spark, datetime(2024, 1, 9, 7), 5, seed=datetime(2020, 1, 1)).agg(F.min("chunk_start"), F.max("chunk_end"), F.min("target_start")).first()
    assert [d.day for d in daily] == [4, 9, 8]
    with pytest.raises(ValueError):
        requests.plan_requests(spark, datetime(2024, 1, 5), datetime(2024, 1, 5))


def test_bronze(spark, tmp_path):
    root = str(tmp_path)
    m = bronze.put(root, "a", b"payload", source_system="USGS")
    assert bronze.put(root, "a", b"payload", source_system="USGS")["sha256"] == m["sha256"]
    with pytest.raises(ValueError):
        bronze.put(root, "a", b"other")
    bronze.put(root, "bad", b"{", reason="INVALID_JSON")
    got = bronze.inputs(spark, root).collect()
    assert [bytes(r.content) for r in got] == [b"payload"]
    assert bronze.manifests(spark, root, "quarantine").first().reason == "INVALID_JSON"
    (tmp_path / "raw/a/object.bin").write_bytes(b"tampered")
    with pytest.raises(ValueError, match="differ"):
        bronze.inputs(spark, root)


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/"), data)
    return bytearray(out.getvalue())


def test_archives(spark):
    rows = [("ok", "m", "s", zipped(h2023=record())), ("two", "m", "s", zipped(a="1", b="2")), ("up", "m", "s", zipped(**{"..__x": "1"})), ("junk", "m", "s", bytearray(b"PK junk"))]
    got = {r.uri: (r.member, r.problem) for r in bronze.zip_members(spark.createDataFrame(rows, "uri string, manifest_id string, sha256 string, content binary")).collect()}
    assert got == {"ok": ("h2023", None), "two": (None, "NOT_ONE_MEMBER"), "up": (None, "UNSAFE_MEMBER"), "junk": (None, "BAD_ARCHIVE")}


def test_versioned_table(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    df = lambda *rows: spark.createDataFrame(list(rows), "m string, v int")
    assert t.head() == 0
    assert t.append(df(("a", 1), ("b", 2))) == 1
    assert t.overwrite(df(("a", 9)), "m = 'a'") == 2
    assert sorted(map(tuple, t.read().collect())) == [("a", 9), ("b", 2)]
    assert sorted(map(tuple, t.read(1).collect())) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        t.overwrite(df(("z", 0)), "m = 'a'")
    with pytest.raises(Conflict):
        t.append(df(("c", 3)), baseline=1)
    assert [(r.version, r.operation, r.rows) for r in t.snapshots().orderBy("version").collect()] == [(1, "append", 2), (2, "overwrite", 2)]
    with pytest.raises(Conflict):
        t._commit("append", [], "m string, v int", 0, {}, 1)  # a writer that lost the race
    publish(spark, f"file://{tmp_path}/head.json", {"t": 2})
    publish(spark, f"file://{tmp_path}/head.json", {"t": 1})
    assert published(spark, f"file://{tmp_path}/head.json") == {"t": 1}
    assert [p.name for p in tmp_path.glob("head.json*")] == ["head.json"]


def test_partitioned_writes(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "m string, v int")
    write_partitioned(rows, path, "m")
    write_partitioned(spark.createDataFrame([("a", 5)], "m string, v int"), path, "m")
    assert sorted((r.m, r.v) for r in spark.read.parquet(path).collect()) == [("a", 5), ("b", 2)]
    export_buckets(spark.range(100).withColumnRenamed("id", "k"), f"file://{tmp_path}/b", ["k"], 4)
    back = spark.read.parquet(f"file://{tmp_path}/b")
    assert back.count() == 100 and {r.bucket for r in back.select("bucket").distinct().collect()} == {0, 1, 2, 3}
    assert sets.fingerprint(back.drop("bucket")) == sets.fingerprint(spark.range(100).withColumnRenamed("id", "k"))


OBS = "source_system string, source_record_key string, source_observation_id string, raw_record_hash string, event_time_utc timestamp, source_updated_at_utc timestamp, catalog_release string, catalog_release_at_utc timestamp, processed_at_utc timestamp"


def test_stream_of_revisions_equals_batch(spark, tmp_path):
    rows = [("USGS", f"k{i % 7}", f"o{i}", f"h{i % 3}", datetime(2024, 1, 1 + i % 5), datetime(2024, 1, 1, i % 24), None, None, datetime(2024, 1, 1)) for i in range(40)]
    src = f"file://{tmp_path}/in"
    target = VersionedTable(spark, f"file://{tmp_path}/t")
    for part in (rows[:15], rows[15:30], rows[10:]):  # the last one repeats records
        spark.createDataFrame(part, OBS).coalesce(1).write.mode("append").parquet(src)
        latest.upsert_latest(spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).parquet(src), target, f"{tmp_path}/ck").awaitTermination()
    pick = lambda df: sorted((r.source_observation_id, r.revision_class) for r in df.collect())
    assert pick(target.read()) == pick(dedup.classify_revisions(spark.createDataFrame(rows, OBS)))


def test_late_and_windowed_streams(spark, tmp_path):
    src = f"file://{tmp_path}/in"
    rows = [(i, datetime(2024, 1, 1, i % 12, 30)) for i in range(30)] * 2
    spark.createDataFrame(rows, "id long, t timestamp").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("id long, t timestamp").parquet(src)
    q = latest.late_deduplicated(stream, "t", "1 day", "id").writeStream.format("memory").queryName("late").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("late").count() == 30
    q = latest.tumbling(stream.withWatermark("t", "1 hour"), "t", "6 hours").writeStream.outputMode("complete").format("memory").queryName("tumble").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = latest.tumbling(spark.read.schema("id long, t timestamp").parquet(src), "t", "6 hours")
    assert sorted(map(tuple, spark.table("tumble").collect())) == sorted(map(tuple, batch.collect()))
    months = []
    latest.recompute_months(stream, F.date_format("t", "yyyyMM"), lambda m, b: months.append(m), f"{tmp_path}/ck").awaitTermination()
    assert months == [{"202401"}]


def test_from_bytes_to_star(spark):
    """Two feeds: one event that both saw, one of each alone, a revision and a duplicate."""
    feed = parse(spark, collection(feature("us1", mag=4.0), feature("us1", mag=4.2, updated=1696446600000), feature("us2", time=1600000000000)), collection(feature("us1", mag=4.0)))
    _, bulletin = parse_lines(spark, record(c2="202310050310020000", c22=" 35", c25="0060", c33=" 140", c37="0060", c53="41"), record(c2="202001010000000000"))
    out = integrate.integrate([feed, bulletin], "run", now())
    assert all(integrate.reconciles(out).values()) and out.rejects.isEmpty()
    events = {r.canonical_source_system: r for r in out.star.events.where("source_count = 2").collect()}
    assert out.star.events.count() == 3 and list(events) == ["JMA_BULLETIN"]
    assert events["JMA_BULLETIN"].link_status == "MATCHED" and events["JMA_BULLETIN"].significance == 246
    with pytest.raises(ValueError, match="rejects"):
        integrate.integrate([parse(spark, collection(feature(fid=" "))), bulletin], "run", now())
    allowed = integrate.integrate([parse(spark, collection(feature(fid=" "))), bulletin], "run", now(), allow_rejects=True)
    assert allowed.rejects.count() == 1
    assert {r.reason: r.n for r in validate.reason_counts(allowed.rejects).collect()} == {"MISSING_SOURCE_KEY": 1}
