"""State by months: which inputs are active, which months a new input touches, and what an as-of state may replace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import release_order


def month(time: Column | str) -> Column:
    return F.date_format(time, "yyyy-MM")


def judge_inputs(active: DataFrame, incoming: DataFrame, inventory: Sequence[str] = ()) -> DataFrame:
    """All inputs (manifest_uri, source_system, year, segment, catalog_release, sha256) with is_active and reason_code.

    Inputs of the first feed add up. Of the bulletin, the newest release of a slot (year and segment) is active, and a
    release may only be followed by a newer one, or by itself with the same bytes. Incoming ones have `position`, the
    order in which they are named. reason_code is null if an input is fine; any reason refuses the whole request.
    """
    c = F.col
    cols = ["manifest_uri", "source_system", "year", "segment", "catalog_release", "sha256"]
    rows = active.select(*cols, F.lit(-1).alias("position")).unionByName(incoming.select(*cols, c("position").cast("int")))
    pin = F.struct(*cols[1:])
    slot = [c("year"), c("segment")]
    of_uri = Window.partitionBy("manifest_uri").orderBy("position")
    order = release_order(c("catalog_release"), inventory)
    bulletin = c("source_system") == "JMA_BULLETIN"
    # a bulletin's slot, and each file of the other feed for itself: no feed is one group
    of_slot = Window.partitionBy("source_system", *slot, F.when(~bulletin, c("manifest_uri"))).orderBy("position", "manifest_uri")
    marked = rows.withColumns({
        "named": F.count_if(c("position") >= 0).over(of_uri.rowsBetween(Window.unboundedPreceding, 0)), "known": F.first(pin).over(of_uri.rowsBetween(Window.unboundedPreceding, 0)),
        "order": order, "before": F.lag(order).over(of_slot), "sha_before": F.lag("sha256").over(of_slot),
        "uri_after": F.lead("manifest_uri").over(of_slot),
    })
    older, same = c("before") > c("order"), c("sha_before") == c("sha256")
    late = bulletin & c("before").isNotNull()
    reason = (
        F.when((c("position") >= 0) & (c("named") > 1), "DUPLICATE_INPUT_PIN")
        .when(~c("known").eqNullSafe(pin), "SAME_URI_DIFFERENT_PIN")
        .when(late & ~same & ~(c("before") < c("order")), "JMA_RELEASE_IDENTITY_OR_ORDER_CONFLICT")
        .when(late & same & older, "OLDER_JMA_RELEASE_REJECTED")
    )
    # a repeated pin counts once: it is superseded by its later naming
    return marked.select(*cols, "position", c("uri_after").isNull().alias("is_active"), reason.alias("reason_code"))


def changed_months(old: DataFrame, new: DataFrame, registered: DataFrame, delta: DataFrame) -> DataFrame:
    """Months (month) that must be rebuilt: of records that came, went or have another revision, before and after.

    old and new are current observations; registered has the months already built, delta the manifests just added. A
    change counts if either month is registered, or if a new revision came with the delta.
    """
    key = ["source_system", "source_record_key"]
    sides = [df.select(*key, F.struct(F.col("source_observation_id").alias("id"), month("event_time_utc").alias("month"), F.col("bronze_manifest_id").alias("manifest")).alias(n)) for df, n in ((old, "o"), (new, "w"))]
    c = F.col
    changed = sides[0].join(sides[1], key, "full_outer").where(~c("o.id").eqNullSafe(c("w.id")))
    known = lambda side: registered.select(c("month").alias(f"{side}_month")).distinct().withColumn(f"{side}_known", F.lit(True))  # noqa: E731  a row a month
    rows = changed.select(c("o.month").alias("o_month"), c("w.month").alias("w_month"), c("w.manifest").alias("manifest"))
    rows = rows.join(known("o"), "o_month", "left").join(known("w"), "w_month", "left")
    rows = rows.join(delta.select(c("manifest_id").alias("manifest"), F.lit(True).alias("fresh")).distinct(), "manifest", "left")
    touched = rows.where(F.coalesce("o_known", "w_known", "fresh", F.lit(False)))
    return touched.select(F.explode(F.array("o_month", "w_month")).alias("month")).where("month is not null").distinct()


# The codes by which an as-of state is refused.
ASOF_RULES = ("ASOF_SOURCE_CHANGED_DURING_CAPTURE", "ASOF_UNEXPLAINED_MISSING_SOURCE_ID", "ASOF_MOVE_REQUIRES_EXPLICIT_CLOSURE", "ASOF_STALE_OR_AMBIGUOUS_REVISION", "ASOF_REVISION_ID_CONTENT_CONFLICT")


def asof_violations(before: DataFrame, captured: DataFrame, history: DataFrame, affected: Sequence[str]) -> DataFrame:
    """(rule, violations): what of a capture can't follow the state before it.

    before: current observations; history: all revisions; captured: the rows just read, with repeats; affected: the
    months asked for (a calendar's worth). A record of an affected month must still be there; one that changed must
    come from and go to affected months, with a later update; one id always has one content.
    """
    c, months = F.col, list(affected)
    inside = lambda time: F.coalesce(month(time).isin(months), F.lit(False))
    content = [c("raw_record_hash")]
    per_key = captured.groupBy("source_record_key").agg(F.count_distinct(*content).alias("contents"), F.min(F.struct("source_observation_id", "event_time_utc", "source_updated_at_utc")).alias("next"))
    pairs = before.select("source_record_key", F.struct("source_observation_id", "event_time_utc", "source_updated_at_utc").alias("prior")).join(per_key, "source_record_key", "full_outer")
    was, now = inside(c("prior.event_time_utc")), inside(c("next.event_time_utc"))
    revised = c("prior").isNotNull() & c("next").isNotNull() & (c("prior.source_observation_id") != c("next.source_observation_id"))
    later = c("next.source_updated_at_utc").isNotNull() & (c("prior.source_updated_at_utc").isNull() | (c("next.source_updated_at_utc") > c("prior.source_updated_at_utc")))
    rules = {
        ASOF_RULES[0]: c("contents") > 1,
        ASOF_RULES[1]: c("prior").isNotNull() & was & c("next").isNull(),
        ASOF_RULES[2]: revised & ~(was & now),
        ASOF_RULES[3]: revised & ~later,
    }
    counted = pairs.agg(*(F.count_if(F.coalesce(x, F.lit(False))).alias(n) for n, x in rules.items()))
    ids = history.select("source_observation_id", *content).unionByName(captured.select("source_observation_id", *content))
    torn = ids.groupBy("source_observation_id").agg(F.count_distinct(*content).alias("n")).agg(F.count_if(c("n") > 1).alias(ASOF_RULES[4]))
    flat = lambda one: one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("rule"), c(n).alias("violations")) for n in one.columns))))
    return flat(counted).unionByName(flat(torn))


def misaligned(observations: DataFrame, year: str = "event_year_utc", month_of: str = "event_month_utc") -> DataFrame:
    """Rows whose partition columns aren't the UTC year and month of their event."""
    t = F.col("event_time_utc")
    fits = F.col(year).cast("int").eqNullSafe(F.year(t)) & F.col(month_of).cast("int").eqNullSafe(F.month(t))
    return observations.where(t.isNull() | ~fits)
