"""Bundles of versioned tables, partitions, checked exports, and an imported catalogue's reconciliation."""

import os

import pytest
from pyspark.sql import functions as F

from tremora.operators import months, reconcile
from tremora.plans import control
from tremora.sources import versioned
from tremora.sources.versioned import Conflict, VersionedTable


@pytest.fixture
def rows(spark):
    return spark.range(100).select("id", (F.col("id") % 4).cast("string").alias("month"))


def test_partitions_leave_other_files_alone(spark, tmp_path, rows):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.overwrite_partitions(rows, "month", ["0", "1", "2", "3"])
    before = t.entry(1)["keys"]
    new = spark.createDataFrame([(1000, "1"), (1001, "1")], "id long, month string")
    assert t.overwrite_partitions(new, "month", ["1", "2"]) == 2
    after = t.entry(2)
    assert after["rows"] == 52 and {k["value"] for k in after["keys"].values()} == {"0", "1", "3"}
    assert {p for p, k in before.items() if k["value"] in "03"} < set(after["parts"])
    got = {(r.id, r.month) for r in t.read().collect()}
    assert got == {(i, str(i % 4)) for i in range(100) if i % 4 in (0, 3)} | {(1000, "1"), (1001, "1")}
    assert t.read(1).count() == 100
    with pytest.raises(ValueError, match="outside"):
        t.overwrite_partitions(rows, "month", ["1"])
    t.append(new)
    with pytest.raises(ValueError, match="isn't held"):
        t.overwrite_partitions(new, "month", ["1"])


def test_partition_names_are_escaped(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    odd = ["a/b", "c=d", "e f", "%41"]
    t.overwrite_partitions(spark.createDataFrame([(v,) for v in odd], "k string"), "k", odd)
    assert sorted(r.k for r in t.read().collect()) == sorted(odd)
    t.overwrite_partitions(spark.createDataFrame([], "k string"), "k", ["a/b"])
    assert sorted(r.k for r in t.read().collect()) == sorted(odd[1:])


def test_bundle(spark, tmp_path, rows):
    root, pointer = str(tmp_path), str(tmp_path / "pointer.json")
    tables = {"a": rows, "b": rows.where("id < 10")}
    first = versioned.commit_bundle(spark, root, "r1", tables, {"a": 0, "b": 0})
    assert first["tables"] == {"a": 1, "b": 1} and first["status"] == "COMMITTED"
    assert versioned.commit_bundle(spark, root, "r1", {"a": rows.repartition(3), "b": tables["b"]}, {"a": 0, "b": 0}) == first
    with pytest.raises(Conflict, match="other contents"):
        versioned.commit_bundle(spark, root, "r1", tables | {"b": rows}, {"a": 0, "b": 0})
    with pytest.raises(Conflict, match="baseline of a"):
        versioned.commit_bundle(spark, root, "r2", tables, {"a": 0, "b": 1})
    assert VersionedTable(spark, f"{root}/b").head() == 1  # nothing was written
    assert versioned.publish_bundle(spark, root, "r1", pointer) == {"a": 1, "b": 1}
    with pytest.raises(ValueError, match="BLOCKER:unique_event"):
        versioned.publish_bundle(spark, root, "r1", pointer, {"unique_event": 2, "fine": 0})
    versioned.commit_bundle(spark, root, "r3", tables, {"a": 1, "b": 1})
    assert versioned.verify_bundle(spark, root, "r1") == ["STALE:a", "STALE:b"]
    assert versioned.publish_bundle(spark, root, "r3", pointer) == {"a": 2, "b": 2}
    assert versioned.publish_bundle(spark, root, "r1", pointer) == {"a": 2, "b": 2}  # not put back
    assert versioned.verify_bundle(spark, root, "r9") == ["COMMIT_MISSING"]


def test_a_broken_off_commit_goes_on(spark, tmp_path, rows, monkeypatch):
    root, tables = str(tmp_path), {"a": rows, "b": rows.where("id < 10")}
    whole = VersionedTable.overwrite

    def fails(self, *args, **kwargs):
        if self.path.endswith("/b"):
            raise OSError("lost")
        return whole(self, *args, **kwargs)

    monkeypatch.setattr(VersionedTable, "overwrite", fails)
    with pytest.raises(OSError):
        versioned.commit_bundle(spark, root, "r1", tables, {"a": 0, "b": 0})
    monkeypatch.setattr(VersionedTable, "overwrite", whole)
    with pytest.raises(Conflict, match="another version of a"):
        versioned.commit_bundle(spark, root, "r1", tables | {"b": rows}, {"a": 0, "b": 0})
    assert versioned.commit_bundle(spark, root, "r1", tables, {"a": 0, "b": 0})["tables"] == {"a": 1, "b": 1}
    assert VersionedTable(spark, f"{root}/a").versions() == [1]


def test_checked_export(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    index = versioned.export_checked(rows, path, ["id"], rows_per_part=30)
    assert len(index) == 4 and versioned.check_export(spark, path) == []
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(100))
    assert [n for n in os.listdir(tmp_path) if n.endswith(".tmp")] == []
    with pytest.raises(Conflict, match="exists"):
        versioned.export_checked(rows, path, ["id"])
    name = sorted(index)[0]
    data = (tmp_path / "out" / name).read_bytes()
    for crc in (tmp_path / "out" / name).parent.glob(".*.crc"):
        crc.unlink()
    (tmp_path / "out" / name).write_bytes(data + b"x")
    assert versioned.check_export(spark, path) == [name]


def test_a_whole_catalogue_reconciles(spark, sf):
    events, bridge, links = control.imported(spark, sf, False)
    pins = reconcile.Pins(events.count(), bridge.count(), links.count(), "1900-01-01 00:00:00", "2100-01-01 00:00:00")
    e, b, k = reconcile.reconcile(events, bridge, links, pins)
    assert (b.count(), k.count()) == (pins.bridge, pins.links) and e.count() < pins.events  # the repeats went
    assert {r.violations for r in reconcile.violations(events, bridge, links, pins).collect()} == {0}
    with pytest.raises(reconcile.Unreconciled, match="EVENT_WITHOUT_BRIDGE"):
        reconcile.reconcile(events, bridge.where("canonical_event_id <> 'ev1'"), links, reconcile.Pins(pins.events, bridge.where("canonical_event_id <> 'ev1'").count(), pins.links, pins.start, pins.end))


def test_every_rule_is_broken_by_some_fault(spark, sf):
    found = {r.rule: r.violations for r in control.QUERIES["reconciliation_spoilt"](spark, "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else sf).collect()}
    assert list(sorted(found)) == sorted(reconcile.RULES) and all(found.values())


def test_nothing_to_reconcile(spark, sf):
    events, bridge, links = (df.limit(0) for df in control.imported(spark, sf, False))
    assert {r.violations for r in reconcile.violations(events, bridge, links, reconcile.Pins(0, 0, 0)).collect()} == {0}


def test_null_keys_are_found(spark, sf):
    events, bridge, links = control.imported(spark, sf, False)
    lost = bridge.withColumn("canonical_event_id", F.when(F.col("source_observation_id") != "j1", F.col("canonical_event_id")))
    found = {r.rule: r.violations for r in reconcile.violations(events, lost, links, reconcile.Pins(0, 0, 0)).collect()}
    assert found["INVALID_GLOBAL_BRIDGE"] == found["ORPHAN_GLOBAL_BRIDGE"] == 1  # the member j1, which lost its event


def test_relocate_refuses_two_places(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, raw_object_uri string")
    places = spark.createDataFrame([(1, "x"), (3, "z")], "k int, raw_object_uri string")
    assert {tuple(r) for r in reconcile.relocate(rows, places, "k").collect()} == {(1, "x"), (2, "b")}
    with pytest.raises(ValueError, match="two places"):
        reconcile.relocate(rows, places.unionByName(places), "k")


def test_inputs_are_judged_in_the_order_of_their_names(spark):
    schema = "manifest_uri string, source_system string, year int, segment string, catalog_release string, sha256 string, position int"
    active = spark.createDataFrame([("j1", "JMA_BULLETIN", 2020, "a", "v2", "s", 0), ("u1", "USGS", 2020, "a", None, "s", 0)], schema)
    incoming = [("j2", "JMA_BULLETIN", 2020, "a", "v10", "t", 0), ("j3", "JMA_BULLETIN", 2020, "a", "v9", "w", 1), ("u1", "USGS", 2020, "a", None, "s", 2), ("u2", "USGS", 2020, "a", None, "s", 3), ("u2", "USGS", 2020, "a", None, "s", 4), ("j4", "JMA_BULLETIN", 2021, "a", "v1", "s", 5)]
    got = {(r.manifest_uri, r.position): (r.is_active, r.reason_code) for r in months.judge_inputs(active, spark.createDataFrame(incoming, schema)).collect()}
    assert got == {("j1", -1): (False, None), ("j2", 0): (False, None), ("j3", 1): (True, "JMA_RELEASE_IDENTITY_OR_ORDER_CONFLICT"), ("u1", -1): (False, None), ("u1", 2): (True, None), ("u2", 3): (False, None), ("u2", 4): (True, "DUPLICATE_INPUT_PIN"), ("j4", 5): (True, None)}


def test_contents_tell_nulls_apart(spark):
    of = lambda *rows: versioned.contents(spark.createDataFrame(rows, "a string, b string"))
    assert of(("x", None), ("y", "z")) == of(("y", "z"), ("x", None)) != of((None, "x"), ("y", "z"))
