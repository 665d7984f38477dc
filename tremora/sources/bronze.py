"""Raw objects with manifests: immutable writes, verification, quarantine, archive inventories and members."""

from __future__ import annotations

import hashlib
import io
import json
import os
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a manifest must state as checked before its object may be read.
CHECKS = ("structure_valid", "checksum_valid", "length_valid", "schema_valid", "readback_valid")
#: Columns of an archive inventory, in the order of the file.
INVENTORY = "archive_id string, source_system string, file_name string, url string, period_start string, period_end string, release string, released_at string, compressed_bytes long, uncompressed_bytes long, sha256 string, member_name string, etag string, last_modified string"
#: Limits of one archive member.
MEMBER_BYTES = 512 << 20


def put(root: str, key: str, payload: bytes, reason: str | None = None, **facts: object) -> dict:
    """Writes an object once, reads it back, and leaves a manifest beside it; the same bytes again are no error.

    With a reason the object goes to quarantine, where inputs() doesn't look.
    """
    folder = Path(root) / ("quarantine" if reason else "raw") / key
    folder.mkdir(parents=True, exist_ok=True)
    digest, path = hashlib.sha256(payload).hexdigest(), folder / "object.bin"
    aside = folder / f"_{uuid.uuid4().hex}.tmp"
    aside.write_bytes(payload)
    try:
        os.link(aside, path)  # one step, and only if there is none yet
    except FileExistsError:
        if hashlib.sha256(path.read_bytes()).hexdigest() != digest:
            raise ValueError(f"{key} exists with other bytes") from None
    finally:
        aside.unlink()
    back = path.read_bytes()
    status = "Quarantined" if reason else "BronzeReady"
    manifest = {"manifest_id": f"man_{digest[:24]}", "uri": str(path), "sha256": digest, "length": len(payload), "status": status, "reason": reason} | dict.fromkeys(CHECKS, back == payload and not reason) | facts
    (folder / "manifest.json").write_text(json.dumps(manifest, sort_keys=True))
    return manifest


MANIFEST = "manifest_id string, uri string, sha256 string, length long, status string, reason string, source_system string, " + ", ".join(f"{c} boolean" for c in CHECKS)


def manifests(spark: SparkSession, root: str, area: str = "raw") -> DataFrame:
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json").json(f"{root}/{area}")


def inputs(spark: SparkSession, root: str) -> DataFrame:
    """(manifest columns, content) of the ready objects; fails if one is missing or differs from its manifest."""
    pinned = manifests(spark, root).where("status = 'BronzeReady'").where(" and ".join(CHECKS))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "object.bin").load(f"{root}/raw")
    files = files.select(F.regexp_replace("path", "^file:/*", "/").alias("uri"), "content", F.col("length").alias("_length"), F.sha2("content", 256).alias("_sha"))
    both = pinned.join(files, "uri", "left")
    wrong = both.where("_sha is null or _sha <> sha256 or _length <> length")
    if not wrong.isEmpty():
        raise ValueError(f"objects differ from their manifests: {[r.uri for r in wrong.select('uri').limit(5).collect()]}")
    return both.drop("_sha", "_length")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """An archive inventory; the header must be INVENTORY's."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(INVENTORY).csv(path)


def zip_members(archives: DataFrame) -> DataFrame:
    """(uri, manifest_id, sha256, member, content, problem) of archives (…, content): one safe member each, checked.

    A problem is reported instead of content: not one member, an unsafe name, a member above MEMBER_BYTES, a bad checksum.
    """

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for f in pdf.itertuples(index=False):
                member, content, problem = None, None, None
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(f.content))) as z:
                        names = [i for i in z.infolist() if not i.is_dir()]
                        if len(names) != 1:
                            problem = "NOT_ONE_MEMBER"
                        elif names[0].filename.startswith("/") or ".." in names[0].filename.split("/"):
                            problem = "UNSAFE_MEMBER"
                        elif names[0].file_size > MEMBER_BYTES:
                            problem = "MEMBER_SIZE_LIMIT"
                        else:
                            member, content = names[0].filename, z.read(names[0])
                except (zipfile.BadZipFile, RuntimeError):
                    problem = "BAD_ARCHIVE"
                out.append((f.uri, f.manifest_id, f.sha256, member, content, problem))
            yield pd.DataFrame(out, columns=["uri", "manifest_id", "sha256", "member", "content", "problem"])

    return archives.select("uri", "manifest_id", "sha256", "content").mapInPandas(unzip, "uri string, manifest_id string, sha256 string, member string, content binary, problem string")


def changed_records(old: DataFrame, new: DataFrame, *columns: str) -> DataFrame:
    """Months in which the record hashes of two archive releases differ: (month)."""
    cols = columns or ("record_hash", "month")
    a, b = old.select(*cols), new.select(*cols)
    return a.exceptAll(b).unionAll(b.exceptAll(a)).select("month").distinct()
