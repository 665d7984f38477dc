"""Versioned tables without a catalogue service: immutable data folders, a snapshot log, scoped overwrites, time travel.

A table is a folder with data/<version>/ and log/<version>.json. A version lists the folders of its parts; the log file is
made last and only if absent, so readers see whole versions and two writers of one version collide instead of mixing.
Paths go through Hadoop's file systems.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sets import fingerprint_parts


class Conflict(RuntimeError):
    """Another writer has made the version first, or the baseline isn't the head."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        log = self._path(f"{self.path}/log")
        if not self._fs.exists(log):
            return []
        return sorted(int(s.getPath().getName().split(".")[0]) for s in self._fs.listStatus(log) if s.getPath().getName().endswith(".json"))

    def head(self) -> int:
        """The newest version, 0 if there is none."""
        return max(self.versions(), default=0)

    def entry(self, version: int) -> dict:
        stream = self._fs.open(self._path(f"{self.path}/log/{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def snapshots(self) -> DataFrame:
        """(version, operation, committed_at, rows, summary) of all versions."""
        rows = [(e["version"], e["operation"], e["committed_at"], e["rows"], json.dumps(e["summary"], sort_keys=True)) for e in map(self.entry, self.versions())]
        return self.spark.createDataFrame(rows, "version long, operation string, committed_at double, rows long, summary string")

    def read(self, version: int | None = None) -> DataFrame:
        e = self.entry(version or self.head())
        schema = self.spark.createDataFrame([], e["schema"]).schema
        parts = [f"{self.path}/{p}" for p in e["parts"]]
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def _commit(self, operation: str, parts: Sequence[str], schema: str, rows: int, summary: dict, baseline: int, more: dict | None = None) -> int:
        version = baseline + 1
        entry = (more or {}) | {"version": version, "operation": operation, "parts": list(parts), "schema": schema, "rows": rows, "summary": summary, "committed_at": time.time()}
        if not _put(self.spark, f"{self.path}/log/{version}.json", json.dumps(entry), over=False):
            raise Conflict(f"version {version} exists")
        return version

    def _write(self, df: DataFrame) -> tuple[str, int]:
        part = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{part}")
        return part, self.spark.read.schema(df.schema).parquet(f"{self.path}/{part}").count()

    def append(self, df: DataFrame, summary: dict | None = None, baseline: int | None = None) -> int:
        head = self._baseline(baseline)
        old = self.entry(head) if head else {"parts": [], "rows": 0}
        part, n = self._write(df)
        return self._commit("append", [*old["parts"], part], _ddl(df), old["rows"] + n, summary or {}, head)

    def overwrite(self, df: DataFrame, scope: str | None = None, summary: dict | None = None, baseline: int | None = None) -> int:
        """Replaces all rows, or those for which the SQL condition `scope` holds; df must lie within the scope."""
        head = self._baseline(baseline)
        if scope and not df.where(~F.coalesce(F.expr(scope), F.lit(False))).isEmpty():
            raise ValueError("rows outside the scope")
        parts, rows = [], 0
        if scope and head:
            kept = self.read(head).where(~F.coalesce(F.expr(scope), F.lit(False)))
            part, rows = self._write(kept)
            parts.append(part)
        part, n = self._write(df)
        return self._commit("overwrite", [*parts, part], _ddl(df), rows + n, (summary or {}) | {"scope": scope}, head)

    def overwrite_partitions(self, df: DataFrame, by: str, values: Sequence[str], summary: dict | None = None, baseline: int | None = None) -> int:
        """Replaces the partitions `values` of the column `by` and leaves the files of all others where they are.

        Every part of the version before must be a partition of the same column; a value that df has no rows of is
        emptied. df must lie within the values, which are few (months, say) and compared as text.
        """
        head, wanted = self._baseline(baseline), list(map(str, values))
        if not df.where(~F.coalesce(F.col(by).cast("string").isin(wanted), F.lit(False))).isEmpty():
            raise ValueError("rows outside the partitions")
        old = self.entry(head) if head else {"parts": [], "keys": {}, "by": by}
        if old.get("by") != by or set(old["parts"]) != set(old.get("keys", {})):
            raise ValueError(f"the table isn't held by {by}")
        folder = f"data/{uuid.uuid4().hex}"
        df.withColumn("part_", F.col(by).cast("string")).repartition("part_").write.partitionBy("part_").parquet(f"{self.path}/{folder}")
        at = {r.part_: r.n for r in self.spark.read.schema(f"{_ddl(df)}, part_ string").parquet(f"{self.path}/{folder}").groupBy("part_").agg(F.count("*").alias("n")).collect()}  # a row a value
        keys = {p: k for p, k in old["keys"].items() if k["value"] not in wanted}
        for status in self._fs.listStatus(self._path(f"{self.path}/{folder}")):
            name = status.getPath().getName()
            if name.startswith("part_="):
                value = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name.removeprefix("part_="))
                keys[f"{folder}/{name}"] = {"value": value, "rows": at[value]}
        rows = sum(k["rows"] for k in keys.values())
        return self._commit("overwrite_partitions", sorted(keys), _ddl(df), rows, (summary or {}) | {"values": wanted}, head, {"by": by, "keys": keys})

    def operation(self, run: str) -> int | None:
        """The version that the run committed, if it did; a run's name stands for one version."""
        found = [v for v in self.versions() if self.entry(v)["summary"].get("operation_id") == run]
        if len(found) > 1:
            raise Conflict(f"{run} made the versions {found}")
        return found[0] if found else None

    def _baseline(self, baseline: int | None) -> int:
        head = self.head()
        if baseline is not None and baseline != head:
            raise Conflict(f"the baseline is {baseline}, the head {head}")
        return head


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _put(spark: SparkSession, path: str, text: str, over: bool) -> bool:
    """Writes a file aside and renames it in one step: readers see none or all of it. False if it exists and may not be replaced."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    to, temp = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(temp, False)
    out.write(bytearray(text.encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE if over else hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(temp, to, how)
    except Exception:
        fs.delete(temp, False)
        if over or not fs.exists(to):
            raise
        return False
    return True


def _get(spark: SparkSession, path: str) -> str | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def contents(df: DataFrame) -> dict[str, str]:
    """What a table holds, whatever its order and files: rows and two sums of hashes, from one pass."""
    r = fingerprint_parts(df).first()
    return {"rows": str(r.n), "sum": str(r.sum_h), "xor": str(r.xor_g), "schema": _ddl(df)}


def commit_bundle(spark: SparkSession, root: str, run: str, tables: Mapping[str, DataFrame], baselines: Mapping[str, int], scope: Mapping[str, object] | None = None) -> dict:
    """Commits several tables below root as one bundle, and returns its record {run, identity, tables, scope, status}.

    The identity is a hash of the run, the scope, the baselines and what each table holds. A run that was broken off goes
    on where it stopped: versions that it has made count if their identity is the same, else Conflict. A table whose head
    has moved on from its baseline is a Conflict before anything is written. Each table is read back and compared before
    the record is put, last of all and once; a second commit of the same bundle returns the first one's record.
    """
    if set(tables) != set(baselines):
        raise ValueError("each table needs a baseline")
    held = {n: contents(df) for n, df in sorted(tables.items())}
    pinned = {"run": run, "scope": dict(scope or {}), "baselines": dict(baselines), "contents": held}
    identity = hashlib.sha256(json.dumps(pinned, sort_keys=True).encode()).hexdigest()
    record, stores = f"{root.rstrip('/')}/commits/{run}.json", {n: VersionedTable(spark, f"{root.rstrip('/')}/{n}") for n in tables}
    if (old := _get(spark, record)) is not None:
        if (known := json.loads(old))["identity"] != identity:
            raise Conflict(f"{run} was committed with other contents")
        return known
    made = {n: t.operation(run) for n, t in stores.items()}
    for n, t in stores.items():  # all locks before the first write
        if made[n] is None and t.head() != baselines[n]:
            raise Conflict(f"the baseline of {n} is {baselines[n]}, the head {t.head()}")
        if made[n] is not None and (made[n] != baselines[n] + 1 or t.entry(made[n])["summary"]["identity"] != identity):
            raise Conflict(f"{run} has made another version of {n}")
    for n, df in tables.items():
        if made[n] is None:
            made[n] = stores[n].overwrite(df, summary={"operation_id": run, "identity": identity}, baseline=baselines[n])
        if contents(stores[n].read(made[n])) != held[n]:
            raise Conflict(f"{n} reads back other rows than were written")
    out = {"run": run, "identity": identity, "tables": made, "contents": held, "scope": pinned["scope"], "status": "COMMITTED"}
    if not _put(spark, record, json.dumps(out, sort_keys=True), over=False):
        return commit_bundle(spark, root, run, tables, baselines, scope)
    return out


def verify_bundle(spark: SparkSession, root: str, run: str, blockers: Mapping[str, int] | None = None, heads: bool = True) -> list[str]:
    """What keeps a committed bundle from being published, empty if nothing: tables that changed, other schemas or
    identities, heads that moved on since (freshness), and blockers with violations."""
    text = _get(spark, f"{root.rstrip('/')}/commits/{run}.json")
    if text is None:
        return ["COMMIT_MISSING"]
    record, out = json.loads(text), []
    for n, version in sorted(record["tables"].items()):
        t = VersionedTable(spark, f"{root.rstrip('/')}/{n}")
        if t.entry(version)["summary"].get("identity") != record["identity"]:
            out.append(f"IDENTITY:{n}")
        found = contents(t.read(version))
        out += [f"{k.upper()}:{n}" for k in ("schema", "rows") if found[k] != record["contents"][n][k]]
        if found["rows"] == record["contents"][n]["rows"] and found != record["contents"][n]:
            out.append(f"CONTENTS:{n}")
        if heads and t.head() != version:
            out.append(f"STALE:{n}")
    return out + [f"BLOCKER:{k}" for k, v in (blockers or {}).items() if v]


def publish_bundle(spark: SparkSession, root: str, run: str, pointer: str, blockers: Mapping[str, int] | None = None) -> dict[str, int]:
    """Verifies a bundle and flips the pointer to its versions, last of all. A bundle that was published before and has
    been followed by another is not put back: its pointer stays as it is."""
    journal = f"{root.rstrip('/')}/publications/{run}.json"
    heads = json.loads(_get(spark, f"{root.rstrip('/')}/commits/{run}.json") or "{}").get("tables", {})
    before = _get(spark, journal)
    if broken := verify_bundle(spark, root, run, blockers, heads=before is None):
        raise ValueError(f"{run} cannot be published: {', '.join(broken)}")
    if before is None:
        publish(spark, pointer, heads)
        _put(spark, journal, json.dumps({"run": run, "tables": heads}, sort_keys=True), over=False)
    return published(spark, pointer)


def publish(spark: SparkSession, pointer: str, heads: dict[str, int]) -> None:
    """Flips one pointer file to the versions of several tables, last of all: readers see all of them or none."""
    _put(spark, pointer, json.dumps(heads, sort_keys=True), over=True)


def published(spark: SparkSession, pointer: str) -> dict[str, int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(pointer)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Replaces whole partitions that df has rows of, and leaves the others: reruns give the same files."""
    df.repartition(*by).sortWithinPartitions(*by).write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def export_buckets(df: DataFrame, path: str, keys: Sequence[str], parts: int) -> None:
    """`parts` files by hash of the keys, each sorted by them; the bucket is a column of the folder names."""
    bucketed = df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
    bucketed.repartition(parts, "bucket").sortWithinPartitions("bucket", *keys).write.partitionBy("bucket").mode("overwrite").parquet(path)


def export_checked(df: DataFrame, path: str, keys: Sequence[str], rows_per_part: int = 10_000) -> dict[str, str]:
    """Files of about rows_per_part rows by hash of the keys, with an index of their checksums, that appear all at once.

    Everything is written aside, read back and compared with df, and then renamed; a path that exists is refused, so
    nothing is ever replaced. Returns {file: sha256}, which is also in checksums.sha256. df must give the same rows twice.
    """
    if "bucket" in df.columns:
        raise ValueError("bucket is the name of the export's folders")
    spark = df.sparkSession
    held = contents(df)
    parts = max(1, -(-int(held["rows"]) // rows_per_part))
    hadoop = spark._jvm.org.apache.hadoop.fs
    to, aside = hadoop.Path(path), hadoop.Path(f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp")
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(to):
        raise Conflict(f"{path} exists")
    try:
        export_buckets(df, str(aside), keys, parts)
        back = spark.read.schema(df.schema).parquet(str(aside)).select(*df.columns)
        if contents(back) != held:
            raise Conflict("the export reads back other rows")
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(str(aside))
        tail = F.regexp_extract("path", r"(bucket=[^/]+/[^/]+)$", 1)
        index = {r.name: r.sha for r in files.select(tail.alias("name"), F.sha2("content", 256).alias("sha")).orderBy("name").collect()}  # a row a file
        _put(spark, f"{aside}/checksums.sha256", "".join(f"{sha}  {name}\n" for name, sha in index.items()), over=False)
        if not fs.rename(aside, to):
            raise Conflict(f"{path} appeared")
    finally:
        fs.delete(aside, True)
    return index


def check_export(spark: SparkSession, path: str) -> list[str]:
    """Files of an export that are missing, altered or not in its index."""
    text = _get(spark, f"{path.rstrip('/')}/checksums.sha256")
    if text is None:
        return ["checksums.sha256"]
    said = {name: sha for sha, name in (line.split("  ", 1) for line in text.splitlines())}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    found = {r.name: r.sha for r in files.select(F.regexp_extract("path", r"(bucket=[^/]+/[^/]+)$", 1).alias("name"), F.sha2("content", 256).alias("sha")).collect()}
    return sorted(n for n in said.keys() | found.keys() if said.get(n) != found.get(n))
