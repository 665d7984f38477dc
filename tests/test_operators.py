"""Operators on made-up records: revisions, resolution, star, audit, windows, sequences."""

import itertools
import math
import random
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tremora.functions import geo
from tremora.functions.ids import release_order
from tremora.functions.reasons import reasons_of
from tremora.functions.score import LinkRules
from tremora.operators import audit, dedup, features, gold, models, resolve, rollup, sequences, sets, validate, windows
from tremora.plans import integrate

T0 = datetime(2023, 10, 5, 3, 0, 0)
OBS = "source_system string, source_record_key string, source_observation_id string, raw_record_hash string, event_time_utc timestamp, source_updated_at_utc timestamp, catalog_release string, catalog_release_at_utc timestamp, processed_at_utc timestamp"
slow = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def obs(key, oid, digest, updated, system="USGS", release=None):
    return (system, key, oid, digest, T0, updated, release, None, T0)


def test_revisions(spark):
    rows = [obs("a", "1", "h1", T0), obs("a", "2", "h2", T0 + timedelta(hours=1)), obs("a", "3", "h1", T0 - timedelta(hours=1)), obs("a", "4", "h2", None), obs("b", "5", "h1", None)]
    got = {r.source_observation_id: r.revision_class for r in dedup.classify_revisions(spark.createDataFrame(rows, OBS)).collect()}
    assert got == {"2": "CURRENT", "1": "SUPERSEDED", "3": "DUPLICATE", "4": "DUPLICATE", "5": "CURRENT"}
    m = dedup.metrics(dedup.classify_revisions(spark.createDataFrame(rows, OBS))).first()
    assert (m.input_count, m.current_count, m.duplicate_count, m.superseded_count) == (5, 2, 2, 1)


@slow
@given(st.permutations(range(6)))
def test_revisions_do_not_depend_on_order(spark, order):
    rows = [obs("a", str(i), f"h{i % 3}", T0 + timedelta(hours=i % 2)) for i in range(6)]
    pick = lambda rs: sorted((r.source_observation_id, r.revision_rank, r.revision_class) for r in dedup.classify_revisions(spark.createDataFrame(rs, OBS)).collect())
    assert pick([rows[i] for i in order]) == pick(rows)


def test_releases_sort_as_people_read(spark):
    ordered = ["alpha", "Beta", "1.2", "1.2.1", "1.10", "v2", "release-v10", "jma-lm-20160819T034858Z-a", "jma-lm-20230901T120000Z-b"]
    df = spark.createDataFrame([(r,) for r in random.Random(0).sample(ordered, len(ordered))], "r string")
    assert [r.r for r in df.orderBy(release_order(F.col("r"))).collect()] == ordered
    listed = [r.r for r in df.orderBy(release_order(F.col("r"), ["1.10", "ALPHA"])).collect()]
    assert listed[-2:] == ["1.10", "alpha"]


@pytest.mark.parametrize("block", [7, 1 << 16])
def test_places_of_all_rows(spark, block):
    ids = [*random.Random(1).sample(range(5000), 1000), -3, None]
    names = ["v2", "release-v10", "1.10", "1.9", None]
    data = [(i, names[(i or 0) % 5]) for i in ids]
    rank = {n: k for k, n in enumerate([None, "1.9", "1.10", "v2", "release-v10"])}
    want = sorted(data, key=lambda r: (rank[r[1]], r[0] is not None, r[0] or 0))
    df = spark.createDataFrame(data, "id long, r string").repartition(5)
    got = sets.place(df, release_order(F.col("r")), "id", block).orderBy("place").collect()
    assert [(r.id, r.r) for r in got] == want
    assert [r.place for r in got] == list(range(1, len(data) + 1))


def links_of(spark, left, right, rules):
    cols = "source_observation_id string, event_time_utc timestamp, latitude double, longitude double, depth_km double, magnitude double, source_record_key string, quality_status string, determining_agency_code string"
    return resolve.evaluate_links(spark.createDataFrame(left, cols), spark.createDataFrame(right, cols), rules)


def quake(oid, seconds, lat=35.0, lon=140.0, depth=60.0, mag=5.0, agency="J"):
    return (oid, T0 + timedelta(seconds=seconds), lat, lon, depth, mag, f"k{oid}", "VALID", agency)


def plain_links(left, right, rules):
    """Pairs one after the other, as a sequential program takes them."""
    def km(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    good, out = [], {}
    for a, b in itertools.product(left, right):
        s = abs((a[1] - b[1]).total_seconds())
        if s > rules.seconds:
            continue
        parts = [(s, rules.seconds, 0.4), (km(a, b), rules.km, 0.4), (None if None in (a[4], b[4]) else abs(a[4] - b[4]), rules.depth_km, 0.1), (None if None in (a[5], b[5]) else abs(a[5] - b[5]), rules.magnitude, 0.1)]
        known = [(v, m, w) for v, m, w in parts if v is not None]
        score = math.floor(sum(w * (1 - min(1, v / m)) for v, m, w in known) / sum(w for *_, w in known) * 1e4 + 0.5) / 1e4
        if any(v > m for v, m, _ in known) or score < rules.least_score:
            out[a[0], b[0]] = "REJECTED"
        else:
            good.append((a, b, score))
    flagged = set()
    for side in (0, 1):
        for x in {g[side][0] for g in good}:
            mine = sorted((g for g in good if g[side][0] == x), key=lambda g: -g[2])
            if len(mine) > 1 and mine[0][2] - mine[1][2] < rules.ambiguity:
                flagged.add((side, x))
                flagged.update((1 - side, g[1 - side][0]) for g in mine)
    taken = set()
    for a, b, _ in sorted(good, key=lambda g: (-g[2], g[0][1], g[0][0], g[1][1], g[1][0])):
        if (0, a[0]) in flagged or (1, b[0]) in flagged:
            out[a[0], b[0]] = "AMBIGUOUS"
        elif (0, a[0]) in taken or (1, b[0]) in taken:
            out[a[0], b[0]] = "REJECTED"
        else:
            out[a[0], b[0]] = "ACCEPTED"
            taken |= {(0, a[0]), (1, b[0])}
    return out


@pytest.mark.parametrize("margin", [0.0, 0.02, 0.15])
def test_links_are_greedy(spark, margin):
    rng = random.Random(7)
    make = lambda p: [quake(f"{p}{i:03}", rng.uniform(0, 300), 35 + rng.uniform(0, 0.6), 140.0, None if i % 9 == 0 else rng.uniform(50, 70), None if i % 7 == 0 else rng.uniform(4.8, 5.6)) for i in range(60)]
    left, right, rules = make("u"), make("j"), LinkRules(ambiguity=margin)
    got = {(r.l_source_observation_id, r.r_source_observation_id): r.link_decision for r in links_of(spark, left, right, rules).collect()}
    want = plain_links(left, right, rules)
    assert got == want and (margin > 0.1 or "ACCEPTED" in got.values())


def test_link_reasons(spark):
    rules = LinkRules()
    left = [quake("u", 0)]
    right = [quake("far", 1, lat=36.5), quake("deep", 1, depth=120.0), quake("big", 1, mag=6.5), quake("low", 15.9, lat=35.85, depth=105.0, mag=5.9), quake("late", 16.001)]
    got = {r.r_source_observation_id: r.reject_reasons for r in links_of(spark, left, right, rules).collect()}
    assert got == {"far": ["DISTANCE_EXCEEDED"], "deep": ["DEPTH_DELTA_EXCEEDED"], "big": ["MAGNITUDE_DELTA_EXCEEDED"], "low": ["SCORE_BELOW_MINIMUM"]}


@pytest.mark.parametrize("agency, primary", [("J", "JMA_BULLETIN"), ("U", "USGS")])
def test_primary_of_a_pair(spark, agency, primary):
    links = links_of(spark, [quake("u", 0)], [quake("j", 1, agency=agency), quake("k", 500)], LinkRules())
    both = spark.createDataFrame([("u", "USGS", "ku"), ("j", "JMA_BULLETIN", "kj"), ("k", "JMA_BULLETIN", "kk")], "source_observation_id string, source_system string, source_record_key string")
    got = resolve.memberships(both, links, LinkRules()).join(both, "source_observation_id").collect()
    assert len(got) == 3 and len({r.canonical_event_id for r in got}) == 2
    pair = [r for r in got if r.source_link_id]
    assert [r.source_system for r in pair if r.membership_status == "PRIMARY"] == [primary]
    report = resolve.match_report(both, links, resolve.memberships(both, links, LinkRules())).first()
    assert (report.matched_events, report.usgs_only, report.jma_only, report.balanced) == (1, 0, 1, True)


def test_validation_reasons(spark):
    names = "schema_version source_system source_record_key source_revision_key event_time_utc latitude longitude depth_km magnitude event_type_code bronze_manifest_id raw_object_uri raw_sha256 raw_record_locator raw_record_hash ingest_run_id quality_status catalog_release catalog_era source_status source_updated_at_utc".split()
    good = dict.fromkeys(names, "x") | {"schema_version": "1.0", "source_system": "USGS", "event_time_utc": T0, "latitude": 35.0, "longitude": 140.0, "depth_km": None, "magnitude": 4.0, "event_type_code": "EARTHQUAKE", "ingest_run_id": "run", "quality_status": "VALID", "catalog_release": None, "catalog_era": None, "source_updated_at_utc": T0}
    cases = [({}, []), ({"source_record_key": " "}, ["MISSING_SOURCE_KEY"]), ({"event_time_utc": None}, ["INVALID_EVENT_TIME"]), ({"latitude": 91.0, "longitude": float("nan")}, ["INVALID_LATITUDE", "INVALID_LONGITUDE"]), ({"depth_km": float("inf")}, ["NON_FINITE_NUMBER"]), ({"event_type_code": None}, ["UNSUPPORTED_RECORD_TYPE"]), ({"source_updated_at_utc": None}, ["CONTRACT_MISMATCH"]), ({"ingest_run_id": "other"}, ["CONTRACT_MISMATCH"]), ({"source_system": "JMA_BULLETIN"}, ["CONTRACT_MISMATCH"]), ({"source_system": "JMA_BULLETIN", "catalog_release": "v1", "catalog_era": "UNIFIED", "source_status": "K"}, [])]
    types = {"event_time_utc": "timestamp", "source_updated_at_utc": "timestamp", **dict.fromkeys(("latitude", "longitude", "depth_km", "magnitude"), "double")}
    df = spark.createDataFrame([tuple((good | c)[n] for n in names) for c, _ in cases], ", ".join(f"{n} {types.get(n, 'string')}" for n in names))
    out = validate.validate(df, "run")
    assert sorted(map(tuple, (r.reject_reasons for r in out.collect()))) == sorted(tuple(w) for _, w in cases)
    s = validate.summary(out).first()
    assert (s.input_count, s.valid_count, s.reject_count, s.publish_blocked) == (10, 2, 8, True)


def star_inputs(spark, rows, members, links=()):
    types = "source_observation_id string, source_system string, source_record_key string, event_time_utc timestamp, latitude double, longitude double, depth_km double, magnitude double, magnitude_type string, event_type_code string, place_name string, is_in_study_area boolean, quality_status string, tsunami_flag boolean, alert_level string, significance int, max_intensity_code string, determining_agency_code string, catalog_era string, raw_object_uri string, bronze_manifest_id string, catalog_release string, source_updated_at_utc timestamp, is_current_source_revision boolean"
    obs_ = spark.createDataFrame(rows, types)
    mem = spark.createDataFrame(members, "canonical_event_id string, source_observation_id string, membership_status string, source_link_id string, canonical_model_version string")
    lnk = spark.createDataFrame(list(links), "left_observation_id string, right_observation_id string, link_decision string")
    reg = spark.createDataFrame([("u1", "PREFECTURE:13", "Tokyo", "PREFECTURE")], "source_observation_id string, region_key string, region_name string, region_category string")
    return obs_, mem, lnk, reg


def member(oid, system, tsunami=None, quality="VALID", when=T0, current=True, **kw):
    d = {"alert": None, "intensity": None, "depth": 10.0, "mag": 4.0} | kw
    return (oid, system, f"k{oid}", when, 35.0, 140.0, d["depth"], d["mag"], "mb", "EARTHQUAKE", "p", True, quality, tsunami, d["alert"], 5, d["intensity"], "J", "UNIFIED" if system != "USGS" else None, "uri", "man", None, T0, current)


def test_star(spark):
    late = datetime(2023, 10, 5, 16, 0, 0)  # the next day in Japan
    rows = [member("u1", "USGS", False, alert="green"), member("j1", "JMA_BULLETIN", True, "WARNING", intensity="4"), member("u2", "USGS", None, when=late, mag=None, depth=-1.0), member("u0", "USGS", current=False)]
    members = [("e1", "u1", "PRIMARY", "l", "v"), ("e1", "j1", "SUPPORTING", "l", "v"), ("e2", "u2", "PRIMARY", None, "v")]
    star = gold.to_gold(*star_inputs(spark, rows, members, [("u2", "jx", "AMBIGUOUS")]), "run", F.lit(T0))
    e = {r.canonical_event_id: r for r in star.events.collect()}
    a, b = e["e1"], e["e2"]
    assert (a.source_coverage_code, a.link_status, a.tsunami_flag, a.alert_level, a.max_intensity_code, a.quality_status, a.region_name, a.source_count) == ("USGS_JMA", "MATCHED", True, "green", "4", "WARNING", "Tokyo", 2)
    assert (b.source_coverage_code, b.link_status, b.tsunami_flag, b.region_key, b.magnitude_band_code, b.depth_band_code) == ("USGS_ONLY", "AMBIGUOUS", None, "UNKNOWN", "UNKNOWN", "NEGATIVE")
    assert (b.event_date_key_utc, b.event_date_key_jst) == (20231005, 20231006)
    assert star.bridge.count() == 3 and {r.date_key for r in star.dim_date.collect()} == {20231005, 20231006}
    from tremora.plans.views import blockers

    dims = {"dim_date": star.dim_date, "dim_region": star.dim_region, "dim_magnitude_band": star.dim_magnitude_band, "dim_depth_band": star.dim_depth_band}
    assert {r.violations for r in blockers(star.events, star.bridge, dims).collect()} == {0}
    broken = star.bridge.withColumn("is_primary", F.lit(True))
    assert {r.blocker for r in blockers(star.events, broken, dims).collect() if r.violations} == {"primary_provenance"}


@pytest.mark.parametrize("members", [
    [("e1", "u1", "SUPPORTING", None, "v")],
    [("e1", "u1", "PRIMARY", None, "v"), ("e2", "u1", "PRIMARY", None, "v")],
    [("e1", "u1", "PRIMARY", None, "v"), ("e2", "zz", "PRIMARY", None, "v")],
    [],
    [("e1", "u1", "PRIMARY", None, " ")],
])
def test_star_refuses(spark, members):
    with pytest.raises(ValueError):
        gold.to_gold(*star_inputs(spark, [member("u1", "USGS")], members), "run", F.lit(T0))


def test_completeness(spark):
    mags = [1.0] * 30 + [1.1] * 30 + [2.0] * 20 + [-0.25] * 3
    df = spark.createDataFrame([(m,) for m in mags] + [(float("nan"),), (None,)], "magnitude double")
    r = audit.completeness(audit.histogram(df)).first()
    assert (r.mc, r.mc_low, r.mc_high, r.n_events, r.n_above, r.is_reliable) == (1.0, 0.8, 1.2, 83, 80, True)
    mean = (30 * 1.0 + 30 * 1.1 + 20 * 2.0) / 80
    assert r.b_value == round(math.log10(math.e) / (mean - 0.95), 3)
    assert {x.bin for x in audit.histogram(df).collect()} == {1.0, 1.1, 2.0, -0.2}  # halves go up
    assert audit.completeness(audit.histogram(df.where("magnitude < 0"))).first().b_value is None


def test_audit_never_guesses(spark):
    """Too few events for an estimate: nothing is eligible, and the reason says so."""
    cols = "canonical_event_id string, canonical_source_system string, event_time_utc timestamp, latitude double, longitude double, depth_km double, magnitude double, event_type_code string, is_natural_earthquake boolean, is_in_study_area boolean, catalog_era string"
    df = spark.createDataFrame([(str(i), "JMA_BULLETIN", T0, 35.0, 140.0, 10.0, 3.0, "EARTHQUAKE", True, True, "UNIFIED") for i in range(10)], cols)
    rules = audit.AuditRules("2023-01-01 00:00:00", "2024-01-01 00:00:00")
    assert {(r.exclusion_reason, r.is_eligible) for r in audit.audit(df, rules)[0].collect()} == {("ML_MC_UNRELIABLE", False)}
    fixed = audit.AuditRules("2023-01-01 00:00:00", "2024-01-01 00:00:00", fixed_mc=2.0)
    assert {r.is_eligible for r in audit.audit(df, fixed)[0].collect()} == {True}
    assert audit.audit(df.limit(0), rules)[0].collect() == []


CAT = "canonical_event_id string, event_time_utc timestamp, latitude double, longitude double, depth_km double, magnitude double, is_eligible boolean"
SEL = windows.Selection("2023-01-01 00:00:00", "2024-01-01 00:00:00", 2.0)


def catalogue(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(f"e{i:04}", T0 + timedelta(hours=rng.uniform(-3000, 3000)), 35 + rng.uniform(-1.5, 1.5), 140 + rng.uniform(-1.5, 1.5), rng.uniform(0, 220), rng.uniform(1.5, 7), rng.random() < 0.95) for i in range(n)]
    return rows, spark.createDataFrame(rows, CAT)


def test_windows_match_a_nested_loop(spark):
    rows, df = catalogue(spark)
    mains = windows.mainshocks(df, SEL)
    got = {(r.mainshock_event_id, r.candidate_event_id): r.relative_time_role for r in windows.candidates(df, mains, SEL).collect()}
    fit = [r for r in rows if r[6] and r[5] >= 2.0 and datetime(2023, 1, 1) <= r[1] < datetime(2024, 1, 1)]
    want = {}
    for m in fit:
        if m[5] > 5.5 and 50 <= m[4] <= 200:
            radius, post = math.exp(-1.024 + 0.804 * m[5]), math.exp(-2.870 + 1.235 * m[5]) * 24
            pre = max(168.0, 0.1 * post)
            for c in fit:
                dx, dy = 111.32 * math.cos(math.radians(m[2])) * (c[3] - m[3]), 110.57 * (c[2] - m[2])
                hours = (c[1] - m[1]).total_seconds() / 3600
                if -pre <= hours <= post and math.hypot(dx, dy) <= radius + 1e-5 and abs(dy) <= radius and abs(dx) <= radius:
                    want[m[0], c[0]] = "MAINSHOCK" if c is m else "PRE" if hours < 0 else "POST"
    assert got == want and len(want) > 100
    g = windows.guarded(mains, windows.candidates(df, mains, SEL), SEL)
    assert set(windows.broken_invariants(g, windows.candidates(df, mains, SEL)).values()) == {0}


@pytest.mark.parametrize("most", [windows.FEW, 0])
def test_invariants_count_what_is_broken(spark, monkeypatch, most):
    """A repeated pair, a lost mainshock and a wrong role; only the repeated pair's candidate is grouped pair by pair."""
    monkeypatch.setattr(windows, "FEW", most)
    _, df = catalogue(spark)
    mains = windows.mainshocks(df, SEL)
    cands = windows.candidates(df, mains, SEL).persist()
    a, b, c = cands.where("not is_mainshock").orderBy("mainshock_event_id", "candidate_event_id").limit(3).collect()
    is_ = lambda x: (F.col("mainshock_event_id") == x.mainshock_event_id) & (F.col("candidate_event_id") == x.candidate_event_id)
    lost = F.col("is_mainshock") & (F.col("mainshock_event_id") == b.mainshock_event_id)
    bad = cands.where(~lost).withColumn("relative_time_role", F.when(is_(c), F.when(F.col("delta_time_hours") < 0, "POST").otherwise("PRE")).otherwise(F.col("relative_time_role"))).unionByName(cands.where(is_(a)))
    bad = bad.unionByName(cands.where(is_(a)).withColumns({"mainshock_event_id": F.lit("none"), "candidate_event_id": F.lit(None).cast("string")}))
    seen, count = [], windows.violations
    monkeypatch.setattr(windows, "violations", lambda rows, checks, *w: (seen.append(rows.count()) if "grain" in checks else None) or count(rows, checks, *w))
    found = windows.broken_invariants(windows.guarded(mains, cands, SEL), bad)
    # a window that isn't known, too, has no mainshock and another count; that which lost one and has a row twice has the same
    assert found == {"self vector": 0, "role": 1, "self role": 0, "grain": 1, "self once": 2, "count": 1}
    assert seen == [bad.where(F.col("candidate_event_id") == a.candidate_event_id).count() - 1 if most else bad.count() - 1]


def test_runs_stand_for_all_pairs(spark):
    """Of few places: by mainshock and role as many as pairs, with events at the mainshock's time and the window's bounds."""
    rows, _ = catalogue(spark)
    post, pre = math.exp(-2.870 + 1.235 * 6.0) * 24, max(168.0, 0.1 * math.exp(-2.870 + 1.235 * 6.0) * 24)
    rows = [(*r[:2], 35.0 + i % 3 / 10, 140.0 + i % 2 / 10, 60.0 + i % 2, *r[5:]) for i, r in enumerate(rows)]
    rows += [(f"m{k}", T0, 35.0, 140.0, 60.0, 6.0, True) for k in range(3)]
    rows += [(f"b{k}{x}", T0 + timedelta(microseconds=round(h * 3.6e9) + x), 35.0, 140.0, 60.0, 2.5, True) for k, h in enumerate((-pre, post)) for x in (-1, 0, 0.5, 1)]
    df = spark.createDataFrame(rows, CAT)
    events = windows.settled(df, SEL)
    mains = windows.mainshocks(events, SEL)
    runs, pairs = windows.candidates(events, mains, SEL), windows.candidates(df, windows.mainshocks(df, SEL), SEL).persist()
    by = lambda c, n: {r[:3]: r[3] for r in c.groupBy("mainshock_event_id", "relative_time_role", "distance_3d_km").agg(F.sum(n)).collect()}
    assert by(runs, "pairs") == by(pairs, F.lit(1)) and runs.count() < pairs.count() / 3
    # a run's row is one of its pairs, and that nearest to the mainshock
    named = ["mainshock_event_id", "candidate_event_id", "relative_time_role", "delta_time_hours", "dx_km", "dy_km", "dz_km"]
    assert runs.select(*named).exceptAll(pairs.select(*named)).isEmpty()
    assert set(windows.broken_invariants(windows.guarded(mains, runs, SEL), runs).values()) == {0}
    want = {r[0]: r[1:] for r in pairs.where("relative_time_role <> 'PRE'").groupBy("candidate_event_id").agg(F.count("*"), F.count_if(~F.col("is_mainshock"))).collect()}
    got = {r[0]: r[1:] for r in windows.covers(events, runs.where("relative_time_role <> 'PRE'")).collect() if r[1]}
    assert got == want and any(n > 1 for n, _ in want.values())


def test_nearest_sequences_of_short_windows(spark, monkeypatch):
    """Windows that end before an event while earlier, larger ones still hold it; distances at a rounding half."""
    assert list(windows._hundredths(np.array([0.125, 0.285, 1.005, 2.675, 0.124999, 3.0]))) == [13, 29, 101, 268, 12, 300]
    rng = random.Random(3)
    rows = [(f"e{i:03}", T0 + timedelta(hours=rng.randrange(0, 4000)), 35.0 + i % 3 / 10, 140.0, 60.0, rng.choice((3.0, 5.6, 6.4)), True) for i in range(240)]
    df = spark.createDataFrame(rows, CAT)
    law = replace(SEL.law, days=(-2.870, 0.9))
    s = replace(SEL, law=law)
    events = windows.settled(df, s)
    mains = windows.mainshocks(events, s)
    scaling = features.Scaling(most_candidates=10**6, keep_flagged=True)
    judged = lambda m, c: features.valid(features.features(windows.guarded(m, c, s), c, scaling)).where("relative_time_role <> 'PRE'")
    got = {r[0]: (r[1], min(r[2], 2), r[3]) for r in windows.nearest(events, judged(mains, windows.candidates(events, mains, s))).collect()}
    plain, want = windows.mainshocks(df, s), {}
    d = F.round(F.sqrt(sum((F.col(v) * F.col(v) for v in features.VECTOR[1:]), F.col(features.VECTOR[0]) * F.col(features.VECTOR[0]))), 2)
    for r in judged(plain, windows.candidates(df, plain, s)).groupBy("candidate_event_id").agg(F.collect_list(F.struct(d.alias("d"), "mainshock_event_id")).alias("all")).collect():
        near = sorted(tuple(x) for x in r["all"])
        ties = sum(x[0] == near[0][0] for x in near)
        want[r[0]] = (len(near), min(ties, 2), near[0][1] if ties == 1 else None)
    assert got == want and len({x[1] for x in want.values()}) == 2 and len({x[0] for x in want.values()}) > 5


def test_events_without_common_places_are_not_settled(spark):
    _, df = catalogue(spark)
    assert windows.settled(df, SEL) is None
    one = df.limit(20).withColumns({"latitude": F.lit(35.0), "longitude": F.lit(140.0), "depth_km": F.lit(60.0), "magnitude": F.lit(3.0), "event_time_utc": F.lit(T0)})
    assert windows.settled(one, SEL) is not None and windows.settled(one.unionByName(one), SEL) is None


def test_simultaneous_events_are_after(spark):
    rows = [("m", T0, 35.0, 140.0, 100.0, 6.0, True), ("s", T0, 35.0, 140.0, 90.0, 3.0, True)]
    df = spark.createDataFrame(rows, CAT)
    got = {r.candidate_event_id: (r.relative_time_role, r.delta_time_hours, r.dz_km) for r in windows.candidates(df, windows.mainshocks(df, SEL), SEL).collect()}
    assert got == {"m": ("MAINSHOCK", 0.0, 0.0), "s": ("POST", 0.0, -10.0)}


def test_guard_flags_and_cuts_nothing(spark):
    _, df = catalogue(spark)
    for reject, status in ((False, "FLAGGED"), (True, "REJECTED")):
        s = windows.Selection(SEL.period_start, SEL.period_end, 2.0, most_candidates=3, reject_excess=reject)
        mains = windows.mainshocks(df, s)
        cands = windows.candidates(df, mains, s)
        g = windows.guarded(mains, cands, s)
        assert {r.resource_guard_status for r in g.where("candidate_count > 3").collect()} == {status}
        assert g.agg(F.sum("candidate_count")).first()[0] == cands.count()


def test_coverage_policy(spark):
    rows = [("mid", datetime(2023, 6, 1), 35.0, 140.0, 100.0, 5.6, True), ("early", datetime(2023, 1, 2), 35.0, 140.0, 100.0, 5.6, True), ("late", datetime(2023, 12, 31), 35.0, 140.0, 100.0, 5.6, True)]
    mains = windows.mainshocks(spark.createDataFrame(rows, CAT), SEL)
    got = {r.mainshock_event_id: r.x for r in mains.select("mainshock_event_id", windows.coverage_reason(SEL).alias("x")).collect()}
    assert got == {"mid": None, "early": "PRE_OUTSIDE_SPLIT", "late": "POST_OUTSIDE_SPLIT"}
    assert [r.mainshock_event_id for r in windows.covered(mains, SEL).collect()] == ["mid"]


def test_window_laws_at_the_pole(spark):
    df = spark.createDataFrame([(6.0, 0.0), (6.0, 89.5), (9.5, 35.0)], "m double, lat double")
    got = [tuple(r) for r in df.select(*(geo.EXPANDED.dimensions(F.col("m"), F.col("lat"))[k] for k in ("delta_lon_deg", "search_radius_km", "post_window_hours", "pre_window_hours"))).collect()]
    assert got[1][0] == 180.0 and got[2][1:] == (250.0, 17520.0, 720.0)


def test_feature_reasons(spark):
    _, df = catalogue(spark)
    mains = windows.mainshocks(df, SEL)
    cands = windows.candidates(df, mains, SEL)
    g = windows.guarded(mains, cands, SEL)
    ok = features.features(g, cands)
    assert features.valid(ok).count() == cands.count()
    assert features.same_rows(features.valid(ok), features.valid(features.features(g, cands)))
    one = cands.where("not is_mainshock").first()
    hit = (F.col("mainshock_event_id") == one.mainshock_event_id) & (F.col("candidate_event_id") == one.candidate_event_id)
    cases = {
        "ML_RELATIVE_COORDINATE_CONFLICT": cands.withColumn("dx_km", F.when(hit, F.col("dx_km") + 1).otherwise(F.col("dx_km"))),
        "ML_EVENT_ROLE_MISMATCH": cands.withColumn("relative_time_role", F.when(hit, "MAINSHOCK").otherwise(F.col("relative_time_role"))),
        "ML_NON_FINITE_FEATURE": cands.withColumn("candidate_magnitude", F.when(hit, float("nan")).otherwise(F.col("candidate_magnitude"))),
        "ML_DUPLICATE_GRAIN": cands.unionByName(cands.where(hit)),
        "ML_CANDIDATE_COUNT_CONFLICT": cands.where(~hit),
        "ML_CANDIDATE_LINEAGE_CONFLICT": cands.withColumn("mc_value", F.when(hit, 1.0).otherwise(F.col("mc_value"))),
        "ML_INVALID_ID": cands.withColumn("candidate_event_id", F.when(hit, " ").otherwise(F.col("candidate_event_id"))),
        "ML_MISSING_MAINSHOCK": cands.withColumn("mainshock_event_id", F.when(hit, "nobody").otherwise(F.col("mainshock_event_id"))),
        "ML_SELF_PRESENCE_INVALID": cands.where(~F.col("is_mainshock")),
        "ML_SELF_SOURCE_MISMATCH": cands.withColumn("candidate_depth_km", F.when(F.col("is_mainshock"), F.col("candidate_depth_km") + 1).otherwise(F.col("candidate_depth_km"))),
        "ML_WINDOW_MEMBERSHIP_INVALID": cands.withColumn("candidate_latitude", F.when(hit, F.col("candidate_latitude") + 9).otherwise(F.col("candidate_latitude"))),
    }
    for code, bad in cases.items():
        assert code in {r.reason for r in validate.reason_counts(features.features(g, bad), "feature_reason_codes").collect()}, code
    spoilt = {
        "ML_RESOURCE_LIMIT_EXCEEDED": g.withColumn("resource_guard_status", F.lit("FLAGGED")),
        "ML_MAINSHOCK_RULE_INVALID": g.withColumn("mainshock_depth_km", F.lit(10.0)),
        "ML_INVALID_SCALED_FEATURE": g.withColumn("search_radius_km", F.lit(0.0)),
    }
    for code, bad in spoilt.items():
        assert code in {r.reason for r in validate.reason_counts(features.features(bad, cands, features.Scaling(mode="ADAPTIVE_WINDOW")), "feature_reason_codes").collect()}, code


def test_windows_without_features_are_refused(spark):
    _, df = catalogue(spark)
    mains = windows.mainshocks(df, SEL)
    cands = windows.candidates(df, mains, SEL)
    features.require_windows(mains, cands)
    one = mains.first().mainshock_event_id
    with pytest.raises(ValueError, match="ML_EMPTY_WINDOW"):
        features.require_windows(mains, cands.where(F.col("mainshock_event_id") != one))
    with pytest.raises(ValueError, match="ML_DUPLICATE_MAINSHOCK_GRAIN"):
        features.require_windows(mains.unionByName(mains.where(F.col("mainshock_event_id") == one)), cands)


def test_range_join_on_all_grids(spark):
    """Windows of an hour to 30 years and of a hundredth of a degree to the whole earth, against nested loops."""
    import random

    rng, day = random.Random(3), windows.DAY
    w = []
    for i, (span, box) in enumerate([(day / 24, 0.01), (40 * day, 3.0), (400 * day, 9.0), (11000 * day, 180.0)] * 4):
        t, y = rng.uniform(0, 9000 * day), rng.uniform(-80, 80)
        w.append((i, int(t), int(t + span), y - box, y + box))
    p = [(i, int(rng.uniform(0, 12000 * day)), rng.uniform(-90, 90)) for i in range(300)] + [(300 + i, x[1], x[3]) for i, x in enumerate(w)]
    got = windows.range_join(spark.createDataFrame(w, "w long, s long, e long, lo double, hi double"), spark.createDataFrame(p, "p long, t long, y double"), ("s", "e", "t"), [("lo", "hi", "y")])
    want = sorted((a[0], b[0]) for a in w for b in p if a[1] <= b[1] <= a[2] and a[3] <= b[2] <= a[4])
    assert sorted((r.w, r.p) for r in got.collect()) == want and len(want) > 300


MEM = "mainshock_event_id string, candidate_event_id string, is_sequence_member boolean, membership_probability double, normalized_distance double, event_role_candidate string"


def plain_ranks(rows, eps=1e-6):
    """The best row of what is left, until several are best."""
    left, out = list(rows), []
    while left:
        top = [r for r in left if max(x[3] or 0.0 for x in left) - (r[3] or 0.0) <= eps]
        best = [r for r in top if r[4] - min(x[4] for x in top) <= eps]
        if len(best) > 1:
            break
        out.append(best[0])
        left.remove(best[0])
    if len(rows) == 1:
        return {rows[0][0]: ("UNIQUE", 1)}
    if not out:
        return {r[0]: ("AMBIGUOUS", None) for r in rows}
    return {r[0]: ("MULTIPLE", k) for k, r in enumerate([*out, *sorted(left, key=lambda r: r[0])], 1)}


@pytest.mark.parametrize("seed", range(3))
def test_sequence_resolution(spark, seed):
    """Ties, values a hair apart, and chains of these that no order could express."""
    rng, e = random.Random(seed), 1e-6
    rows = []
    for c in range(60):
        base = rng.choice([0.5, 0.9])
        for m in rng.sample(range(9), rng.randrange(1, 6)):
            p = rng.choice([None, base, base - 0.7 * e, base - 1.4 * e, base - 2.1 * e, base - 0.1])
            rows.append((f"m{m}", f"c{c}", rng.random() < 0.85, p, rng.choice([0.1, 0.1 + 0.4 * e, 0.2, 0.3, 0.5]), "POST"))
    got = {(r.mainshock_event_id, r.candidate_event_id): (r.multi_sequence_status, r.resolution_rank) for r in sequences.resolve_sequences(spark.createDataFrame(rng.sample(rows, len(rows)), MEM)).collect()}
    for c in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == c]
        want = plain_ranks([r for r in mine if r[2]]) if any(r[2] for r in mine) else {}
        for r in mine:
            assert got[r[0], c] == want.get(r[0] if r[2] else None, ("NOT_MEMBER", None)), mine
    rec = sequences.reconciliation(sequences.resolve_sequences(spark.createDataFrame(rows, MEM))).first()
    assert rec.raw_aftershocks == rec.resolved_unique_aftershocks + rec.ambiguous_aftershocks + rec.deduplicated_aftershocks


def test_sequences_of_like_probabilities(spark):
    """All of a candidate's rows are one run: sorted in place, and never joined with themselves; no column is lost."""
    rng, e = random.Random(5), 1e-6
    rows = [(f"m{m}", f"c{c}", rng.random() < 0.85, rng.choice([None, 0.4 * e, 0.9 * e]), rng.choice([0.1, 0.1 + 0.4 * e, 0.2, 0.3, 0.5]), "POST") for c in range(60) for m in rng.sample(range(9), rng.randrange(1, 6))]
    df = spark.createDataFrame(rows, MEM).withColumns({"p": F.lit("mine"), "n": F.lit(7), "at": F.lit(8), "_at": F.lit(9), "all": F.lit(10)})
    out = sequences.resolve_sequences(df)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.collect()
    assert len(got) == len(rows) and {(r["p"], r["n"], r["at"], r["_at"], r["all"]) for r in got} == {("mine", 7, 8, 9, 10)}
    found = {(r.mainshock_event_id, r.candidate_event_id): (r.multi_sequence_status, r.resolution_rank) for r in got}
    for c in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == c]
        want = plain_ranks([r for r in mine if r[2]]) if any(r[2] for r in mine) else {}
        assert all(found[r[0], c] == want.get(r[0] if r[2] else None, ("NOT_MEMBER", None)) for r in mine), mine
    none = sequences.resolve_sequences(spark.createDataFrame([("m", None, True, None, 0.1, "POST"), (None, "c", True, None, 0.1, "POST")], MEM)).collect()
    assert {(r.multi_sequence_status, r.resolution_rank) for r in none} == {("AMBIGUOUS", None)}


def test_nested_parents(spark):
    rows = [("a", "b", True, 0.9, 0.1, "POST"), ("c", "b", True, 0.5, 0.1, "POST"), ("b", "b", True, 0.2, 0.0, "MAINSHOCK"), ("a", "c", True, 0.5, 0.3, "POST"), ("b", "c", True, 0.5, 0.3, "POST"), ("a", "a", True, 1.0, 0.0, "MAINSHOCK")]
    resolved = sequences.resolve_sequences(spark.createDataFrame(rows, MEM))
    mains = spark.createDataFrame([("a",), ("b",), ("c",)], "mainshock_event_id string")
    got = {r.mainshock_event_id: (r.is_nested, r.parent_mainshock_event_id, r.reason) for r in sequences.nested_mainshocks(resolved, mains).collect()}
    assert got == {"a": (False, None, None), "b": (True, "a", None), "c": (True, None, "AMBIGUOUS_NESTED_PARENT_TIE")}


def test_closures_and_islands(spark):
    edges = spark.createDataFrame([("1", "2"), ("3", "2"), ("8", "9")], "left string, right string")
    more = spark.createDataFrame([("3", "4")], "left string, right string")
    assert sets.month_closure({"1"}, edges, more) == {"1", "2", "3", "4"}
    iv = spark.createDataFrame([("a", 0, 5), ("a", 5, 7), ("a", 9, 12), ("b", 1, 2)], "k string, s int, e int")
    need = spark.createDataFrame([("a", 1, 7), ("a", 6, 10), ("b", 0, 2)], "k string, need_start int, need_end int")
    assert {(r.k, r.need_start): r.is_covered for r in sets.covers(iv, "s", "e", need, "k").collect()} == {("a", 1): True, ("a", 6): False, ("b", 0): False}


def test_dimension_merge_refuses_changes(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    assert sorted(map(tuple, sets.merge_dimension(old, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "k").collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        sets.merge_dimension(old, spark.createDataFrame([(1, "z")], "k int, v string"), "k")


def test_contracts(tmp_path):
    assert integrate.dataset_id({"b": 1, "a": 2}) == integrate.dataset_id({"a": 2, "b": 1})
    with pytest.raises(ValueError):
        integrate.dataset_id({"x": "/home/me"})
    assert integrate.advance("BUILDING", "VALIDATED") == "VALIDATED"
    with pytest.raises(ValueError):
        integrate.advance("BUILDING", "EXPORTED")
    with pytest.raises(ValueError):
        integrate.refuse_provisional("provisional_2024")
    path = str(tmp_path / "lease")
    with integrate.whole_run_lease(path, "a"), pytest.raises(RuntimeError, match="held by a"), integrate.whole_run_lease(path, "b"):
        pass
    with pytest.raises(RuntimeError, match="phase two"):
        integrate.run_phases([("one", lambda s: s.update(x=1)), ("two", lambda s: 1 / 0)], {})


def test_rollup_of_nothing(spark):
    empty = spark.createDataFrame([], "canonical_event_id long, event_date_jst date, event_date_key_jst int, magnitude double, depth_km double, region_key string, region_name string, region_category string, magnitude_band_code string, depth_band_code string, source_coverage_code string, tsunami_flag boolean, alert_level string, max_intensity_code string, is_natural_earthquake boolean, is_in_study_area boolean")
    assert rollup.monthly(rollup.daily(empty)).collect() == []


def test_sweep_is_bounded(spark):
    with pytest.raises(ValueError):
        models.sweep(None, [models.ModelConfig()] * 9)


def test_greedy_matching_of_a_chain(spark):
    """Scores fall along a chain, so each round settles one pair only; null ends match nothing. By plain greedy matching."""
    pairs = [(f"a{(k + 1) // 2}", f"b{k // 2}", 100 - k) for k in range(9)] + [(None, "b9", 1), ("a9", None, 2), ("a0", "b7", 3)]
    df = spark.createDataFrame(pairs, "l string, r string, score int")
    got = resolve.match_one_to_one(df, [F.col("score").desc(), F.col("l"), F.col("r")], "l", "r").collect()
    used, want = set(), set()
    for a, b, n in sorted((p for p in pairs if p[0] and p[1]), key=lambda p: (-p[2], p[0], p[1])):
        if a not in used and b not in used:
            used |= {a, b}
            want.add((a, b, n))
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 3


def test_greedy_matching_of_nothing(spark):
    df = spark.createDataFrame([], "l string, r string, score int")
    assert resolve.match_one_to_one(df, [F.col("score").desc()], "l", "r").collect() == []


def test_flagged_windows_keep_their_features(spark):
    """Windows above the limit are marked, not cut: all rows are fit where flagged ones are kept, none where they are rejected."""
    _, df = catalogue(spark)
    for reject, kept in ((False, True), (True, False)):
        s = windows.Selection(SEL.period_start, SEL.period_end, 2.0, most_candidates=0, reject_excess=reject)
        mains = windows.mainshocks(df, s)
        cands = windows.candidates(df, mains, s)
        got = features.valid(features.features(windows.guarded(mains, cands, s), cands, features.Scaling(most_candidates=0, keep_flagged=True)))
        assert got.count() == (cands.count() if kept else 0)


def test_reasons_of_bits(spark):
    codes = ["a", "b", "c"]
    got = {r.id: r.codes for r in spark.range(8).select("id", reasons_of(F.col("id").cast("int"), codes).alias("codes")).collect()}
    assert got == {i: [c for k, c in enumerate(codes) if i >> k & 1] for i in range(8)}
