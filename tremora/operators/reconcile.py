"""Reconciliation of a catalogue put together from imported shards: events, the bridge to their sources, and links.

Each rule counts what breaks it; a catalogue is whole if all counts are 0. Rows that repeat as a whole are one row (shards
overlap at their borders), rows that repeat a key with other contents are a conflict and never resolved here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep

# The codes of the rules, in the order in which they are judged.
RULES = (
    "GLOBAL_INPUT_COUNT_PIN_MISMATCH",
    "INVALID_GLOBAL_EVENT",
    "BOUNDARY_CANONICAL_CONFLICT",
    "CANONICAL_MODEL_VERSION_CONFLICT",
    "INVALID_GLOBAL_BRIDGE",
    "BOUNDARY_OBSERVATION_CONFLICT",
    "GLOBAL_REVISION_CONFLICT_REQUIRES_SOURCE_RESOLUTION",
    "ORPHAN_GLOBAL_BRIDGE",
    "EVENT_WITHOUT_BRIDGE",
    "MULTIPLE_CURRENT_MEMBERS_FROM_ONE_SOURCE",
    "GLOBAL_PRIMARY_OR_SOURCE_COUNT_UNBALANCED",
    "GLOBAL_PRIMARY_ID_MISMATCH",
    "INVALID_GLOBAL_SOURCE_LINK",
    "BOUNDARY_SOURCE_LINK_CONFLICT",
    "GLOBAL_LINK_ENDPOINT_MISSING",
    "GLOBAL_LINK_DECISION_MEMBERSHIP_CONFLICT",
    "BRIDGE_REFERS_TO_NON_ACCEPTED_LINK",
    "SUPPORTING_MEMBER_WITHOUT_ACCEPTED_LINK",
    "BRIDGE_LINK_ENDPOINT_MISMATCH",
    "GLOBAL_ACCEPTED_LINK_RECONCILIATION_FAILED",
)
SYSTEMS, DECISIONS, STATUSES = ("USGS", "JMA_BULLETIN"), ("ACCEPTED", "REJECTED", "AMBIGUOUS"), ("VALID", "WARNING")


@dataclass(frozen=True)
class Pins:
    """What the import's manifest says: rows of each input, repeats included, and the period, half-open."""

    events: int
    bridge: int
    links: int
    start: str = "2000-01-01 00:00:00"
    end: str = "2024-01-01 00:00:00"


class Unreconciled(ValueError):
    """Names the first rule that the catalogue breaks."""


def _blank(*names: str) -> Column:
    bad = F.lit(False)
    for n in names:
        bad = bad | F.col(n).isNull() | (F.trim(n) == "")
    return bad


def _outside(name: str, values: tuple[str, ...]) -> Column:
    return F.col(name).isNull() | ~F.col(name).isin(*values)


def _sum(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0)).cast("long")


def _flat(one: DataFrame) -> DataFrame:
    """(rule, violations) from one row with a column a rule."""
    pairs = F.array(*(F.struct(F.lit(c).alias("rule"), F.col(c).cast("long").alias("violations")) for c in one.columns))
    return one.select(F.inline(pairs))


def _repeats(df: DataFrame, rule: str, *keys: str) -> DataFrame:
    return _flat(df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias(rule)))


def violations(events: DataFrame, bridge: DataFrame, links: DataFrame, pins: Pins) -> DataFrame:
    """(rule, place, violations) of every rule, whatever others are broken.

    The bridge is brought together once by event and once by observation; links meet the second twice, and the bridge
    meets the accepted links once. Whatever is counted is counted in the executors: a row a rule is all that is left.
    A null event or observation id meets nothing, so its bridge row is an orphan.
    """
    c = F.col
    e, b, k = keep(events.dropDuplicates(), "events"), keep(bridge.dropDuplicates(), "bridge"), keep(links.dropDuplicates(), "links")

    raw = [df.agg(F.count("*").alias(n)) for df, n in ((events, "e"), (bridge, "b"), (links, "k"))]
    pinned = raw[0].crossJoin(raw[1]).crossJoin(raw[2])  # a row each
    parts = [_flat(pinned.select(F.when((c("e") == pins.events) & (c("b") == pins.bridge) & (c("k") == pins.links), 0).otherwise(1).alias(RULES[0])))]

    late = (c("event_time_utc") < F.lit(pins.start).cast("timestamp")) | (c("event_time_utc") >= F.lit(pins.end).cast("timestamp"))
    absent = c("event_time_utc").isNull() | c("source_count").isNull() | c("has_usgs").isNull() | c("has_jma").isNull()
    bad_event = _blank("canonical_event_id", "primary_observation_id", "canonical_model_version") | absent | _outside("quality_status", STATUSES) | F.coalesce(late, F.lit(True))
    version = c("canonical_model_version")
    kinds = (F.min(version) != F.max(version)) | ((F.count(version) > 0) & (F.count_if(version.isNull()) > 0))
    parts.append(_flat(e.agg(F.count_if(bad_event).alias("INVALID_GLOBAL_EVENT"), F.coalesce(kinds, F.lit(False)).cast("int").alias("CANONICAL_MODEL_VERSION_CONFLICT"))))
    parts.append(_repeats(e, "BOUNDARY_CANONICAL_CONFLICT", "canonical_event_id"))

    bad_member = _blank("canonical_event_id", "source_observation_id", "source_system", "source_record_key", "bronze_manifest_id", "raw_object_uri") | c("is_primary").isNull() | _outside("source_system", SYSTEMS)
    lonely = F.coalesce(~c("is_primary"), F.lit(False)) & c("source_link_id").isNull()
    parts.append(_flat(b.agg(F.count_if(bad_member).alias("INVALID_GLOBAL_BRIDGE"), F.count_if(lonely).alias("SUPPORTING_MEMBER_WITHOUT_ACCEPTED_LINK"))))
    parts.append(_repeats(b, "GLOBAL_REVISION_CONFLICT_REQUIRES_SOURCE_RESOLUTION", "source_system", "source_record_key"))

    by_source = b.groupBy("canonical_event_id", "source_system").agg(F.count("*").alias("n"), F.count_if("is_primary").alias("p"), F.max(F.when(c("is_primary"), c("source_observation_id"))).alias("o"))
    held = by_source.groupBy(c("canonical_event_id").alias("held_id")).agg(
        F.sum("n").alias("n"), F.sum("p").alias("p"), F.max("o").alias("o"), F.count_if(c("n") > 1).alias("twice"),
        F.bool_or(c("source_system").eqNullSafe("USGS")).alias("u"), F.bool_or(c("source_system").eqNullSafe("JMA_BULLETIN")).alias("j"))
    star = e.withColumn("here", F.lit(True)).join(held, c("canonical_event_id") == c("held_id"), "full_outer")
    both = c("here") & c("n").isNotNull()
    unbalanced = both & ((c("p") != 1) | ~c("source_count").eqNullSafe(c("n")) | ~c("has_usgs").eqNullSafe(c("u")) | ~c("has_jma").eqNullSafe(c("j")))
    parts.append(_flat(star.agg(
        _sum(F.when(c("here").isNull(), c("n"))).alias("ORPHAN_GLOBAL_BRIDGE"), F.count_if(c("here") & c("n").isNull()).alias("EVENT_WITHOUT_BRIDGE"),
        F.count_if(unbalanced).alias("GLOBAL_PRIMARY_OR_SOURCE_COUNT_UNBALANCED"), F.count_if(both & (c("p") > 0) & ~c("primary_observation_id").eqNullSafe(c("o"))).alias("GLOBAL_PRIMARY_ID_MISMATCH"))))
    parts.append(_flat(held.agg(_sum(c("twice")).alias("MULTIPLE_CURRENT_MEMBERS_FROM_ONE_SOURCE"))))

    member = b.groupBy("source_observation_id").agg(F.count("*").alias("times"), F.min("canonical_event_id").alias("event"))
    parts.append(_flat(member.agg(F.count_if(c("times") > 1).alias("BOUNDARY_OBSERVATION_CONFLICT"))))
    ends = k
    for side in ("left", "right"):
        m = member.select(c("source_observation_id").alias(f"{side}_observation_id"), c("event").alias(f"{side}_event"), F.lit(True).alias(f"{side}_here"))
        ends = ends.join(m, f"{side}_observation_id", "left")
    ends = keep(ends, "ends")
    found, accepted = c("left_here") & c("right_here"), c("link_decision").eqNullSafe("ACCEPTED")
    torn = found & (accepted != c("left_event").eqNullSafe(c("right_event"))) & c("link_decision").isNotNull()
    bad_link = _blank("source_link_id", "left_observation_id", "right_observation_id") | _outside("link_decision", DECISIONS)
    counted = ends.agg(
        F.count_if(bad_link).alias("INVALID_GLOBAL_SOURCE_LINK"), (F.count_if(c("left_here").isNull()) + F.count_if(c("right_here").isNull())).alias("GLOBAL_LINK_ENDPOINT_MISSING"),
        F.count_if(torn).alias("GLOBAL_LINK_DECISION_MEMBERSHIP_CONFLICT"), F.count_if(found & accepted).alias("accepted"))
    parts.append(_flat(counted.drop("accepted")))
    parts.append(_repeats(k, "BOUNDARY_SOURCE_LINK_CONFLICT", "source_link_id"))
    rows = [df.agg(F.count("*").alias(n)) for df, n in ((b, "b"), (e, "e"))]
    sums = counted.select("accepted").crossJoin(rows[0]).crossJoin(rows[1])  # a row each
    parts.append(_flat(sums.select((c("accepted") != c("b") - c("e")).cast("int").alias("GLOBAL_ACCEPTED_LINK_RECONCILIATION_FAILED"))))

    agreed = ends.where(found & accepted).select("source_link_id", c("left_observation_id").alias("l"), c("right_observation_id").alias("r"), F.lit(True).alias("agreed"))
    referred = b.where("source_link_id is not null").join(agreed, "source_link_id", "left")
    elsewhere = c("agreed") & (c("source_observation_id") != c("l")) & (c("source_observation_id") != c("r"))
    parts.append(_flat(referred.agg(F.count_if(c("agreed").isNull()).alias("BRIDGE_REFERS_TO_NON_ACCEPTED_LINK"), F.count_if(elsewhere).alias("BRIDGE_LINK_ENDPOINT_MISMATCH"))))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("rule", F.array_position(F.array(*map(F.lit, RULES)), c("rule")).cast("int").alias("place"), "violations")


def reconcile(events: DataFrame, bridge: DataFrame, links: DataFrame, pins: Pins) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables without whole repeats, or Unreconciled with the first broken rule."""
    broken = violations(events, bridge, links, pins).where("violations > 0").orderBy("place").first()  # a row a rule
    if broken:
        raise Unreconciled(f"{broken.rule}: {broken.violations}")
    return events.dropDuplicates(), bridge.dropDuplicates(), links.dropDuplicates()


def with_event_month(bridge: DataFrame, events: DataFrame) -> DataFrame:
    """The bridge with event_month_utc, by which it is stored beside its events."""
    return bridge.join(events.select("canonical_event_id", F.date_format("event_time_utc", "yyyy-MM").alias("event_month_utc")), "canonical_event_id")


def relocate(rows: DataFrame, places: DataFrame, *keys: str, column: str = "raw_object_uri") -> DataFrame:
    """rows with the column taken from places (keys, column) where these know the keys: files that were moved.

    places has a row a file; a repeated key is refused, as it would multiply rows. Sizes decide whether it is broadcast.
    """
    if not places.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"{keys} have two places")
    moved = places.select(*keys, F.col(column).alias("moved_"))
    return rows.join(moved, list(keys), "left").withColumn(column, F.coalesce("moved_", column)).select(*rows.columns)
