"""Deterministic identities, and a sort key that orders release names as people read them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sha(*parts: Column) -> Column:
    """SHA-256 of the parts with bars between; a null part makes the whole null."""
    joined = parts[0]
    for p in parts[1:]:
        joined = F.concat(joined, F.lit("|"), p)
    return F.sha2(joined, 256)


def feed_revision_key(updated_ms: Column, record_hash: Column) -> Column:
    return F.concat(F.coalesce(updated_ms.cast("string"), F.lit("null")), F.lit(":"), record_hash)


def bulletin_revision_key(release: Column, record_hash: Column) -> Column:
    return F.concat(F.coalesce(F.nullif(F.trim(release), F.lit("")), F.lit("unversioned")), F.lit(":"), record_hash)


def bulletin_record_key(line: Column) -> Column:
    """From the columns that identify a record: agency, origin time, latitude, longitude."""
    cut = lambda a, b: F.trim(F.substring(line, a, b - a + 1))
    return F.concat(F.lit("jma_k1_"), F.substring(_sha(cut(1, 1), cut(2, 17), cut(22, 28), cut(33, 40)), 1, 24))


def observation_id(system: Column, key: Column, revision: Column) -> Column:
    return F.concat(F.lit("obs_"), _sha(system, key, revision))


def canonical_id(system: Column, key: Column) -> Column:
    return F.concat(F.lit("evt_"), F.substring(_sha(F.lit("CANONICAL"), system, key), 1, 32))


def link_id(model: Column, left: Column, right: Column) -> Column:
    """The same whichever way round the pair is."""
    return F.concat(F.lit("lnk_"), F.substring(_sha(F.trim(model), F.trim(F.least(left, right)), F.trim(F.greatest(left, right))), 1, 32))


def release_order(release: Column, inventory: Sequence[str] = ()) -> Column:
    """A struct that sorts releases upwards: listed ones by place, then by what kind of version the name holds.

    Unlisted names come before listed ones; a time stamp in the name, a version number and a dotted version are compared
    as such, other names as text without regard to case. Null comes first. A sort key needs one order over all names
    where comparing pairs may skip rules; between kinds the order is text, dotted, numbered, stamped.
    """
    name = F.trim(release)
    lower = F.lower(name)
    stamp = F.regexp_extract(F.upper(name), r"(?i)(?:lm|retrieved)[-_](\d{8}T\d{6}Z)", 1)
    number = F.regexp_extract(lower, r"^(?:release[-_]?)?v?(\d+)$", 1).try_cast("long")
    dotted = F.regexp_extract(lower, r"^v?(\d+(?:\.\d+)+)$", 1)
    parts = F.transform(F.split(dotted, r"\."), lambda p: F.coalesce(p.try_cast("long"), F.lit(0)))
    # trailing zeros don't tell versions apart
    zeros = F.regexp_replace(F.array_join(F.transform(parts, lambda p: F.lpad(p.cast("string"), 19, "0")), "."), r"(\.0{19})+$", "")
    place = F.coalesce(*(F.when(lower == r.strip().lower(), i) for i, r in enumerate(inventory)), F.lit(-1)) if inventory else F.lit(-1)
    kind = F.when(stamp != "", 3).when(number.isNotNull(), 2).when(dotted != "", 1).otherwise(0)
    return F.when(release.isNotNull(), F.struct(place.alias("place"), kind.alias("kind"), stamp.alias("stamp"), F.coalesce(number, F.lit(-1)).alias("number"), zeros.alias("dotted"), lower.alias("lower"), name.alias("name")))
