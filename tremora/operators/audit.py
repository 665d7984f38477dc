"""Eligibility audit, magnitude of completeness (maximum curvature), and b-values."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands
from ..functions.numeric import bin_of, finite, half_up
from ..functions.reasons import all_reasons, first_reason

LOG10_E = math.log10(math.e)
DEPTH_STRATA = (("SHALLOW", None, 70.0), ("INTERMEDIATE", 70.0, 300.0), ("DEEP", 300.0, None))


def histogram(events: DataFrame, *by: str, width: float = 0.1, magnitude: str = "magnitude") -> DataFrame:
    """(by, bin, n): events with a finite magnitude by bin. Bins are few, whatever the number of events."""
    rows = events.where(finite(F.col(magnitude)))
    return rows.groupBy(*by, bin_of(F.col(magnitude), width).alias("bin")).agg(F.count("*").alias("n"))


def cumulative(bins: DataFrame, *by: str) -> DataFrame:
    """Bins with n_at_least: events of that magnitude or more."""
    w = Window.partitionBy(*by).orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return bins.withColumn("n_at_least", F.sum("n").over(w))


def completeness(bins: DataFrame, *by: str, width: float = 0.1, step: float = 0.2, least: int = 50) -> DataFrame:
    """(by, n_events, mc, mc_low, mc_high, is_reliable, n_above, b_value, b_std_error) by maximum curvature.

    The fullest bin, the lowest of equal ones, is Mc. The b-value is the maximum likelihood estimate from the bins from
    Mc on; it takes 10 events.
    """
    group = list(by)
    top = bins.groupBy(*group).agg(F.max(F.struct("n", (-F.col("bin")).alias("b"))).alias("top"), F.sum("n").alias("n_events"))
    top = top.select(*group, "n_events", (-F.col("top.b")).alias("mc"))
    joined = bins.join(top, group) if group else bins.crossJoin(top)  # top has a row a group
    above = F.col("bin") >= F.col("mc")
    stats = joined.groupBy(*group, "mc", "n_events").agg(F.sum(F.when(above, F.col("n"))).alias("n_above"), (F.sum(F.when(above, F.col("bin") * F.col("n"))) / F.sum(F.when(above, F.col("n")))).alias("mean_above"))
    gap = F.col("mean_above") - (F.col("mc") - width / 2)
    b = half_up(F.when((F.col("n_above") >= 10) & (gap > 0), LOG10_E / gap), 3)
    out = stats.withColumn("b_value", F.when(b > 0, b)).withColumn("b_std_error", half_up(F.col("b_value") / F.sqrt("n_above"), 3))
    return out.select(*group, "n_events", "mc", half_up(F.col("mc") - step, 3).alias("mc_low"), half_up(F.col("mc") + step, 3).alias("mc_high"), (F.col("n_events") >= least).alias("is_reliable"), "n_above", "b_value", "b_std_error")


def depth_stratum(depth: Column) -> Column:
    return F.when(depth < 70.0, "SHALLOW").when(depth < 300.0, "INTERMEDIATE").when(depth.isNotNull(), "DEEP")


@dataclass(frozen=True)
class AuditRules:
    period_start: str
    period_end: str
    source: str = "JMA_BULLETIN"
    era: str = "UNIFIED"
    fixed_mc: float | None = None
    bin_width: float = 0.1
    step: float = 0.2
    least_events: int = 50


def exclusions(rules: AuditRules) -> dict[str, Column]:
    """The rules that come before completeness, in their order."""
    c = F.col
    start, end = (F.lit(t).cast("timestamp") for t in (rules.period_start, rules.period_end))
    isnt = lambda name, value: ~c(name).eqNullSafe(value)
    outside = lambda name, most: ~finite(c(name)) | (F.abs(c(name)) > most)
    when = c("event_time_utc").cast("timestamp")
    return {
        "ML_MISSING_COORDINATE": outside("latitude", 90.0) | outside("longitude", 180.0),
        "ML_MISSING_DEPTH": ~finite(c("depth_km")),
        "ML_MISSING_MAGNITUDE": ~finite(c("magnitude")),
        "ML_NON_NATURAL_EVENT": isnt("is_natural_earthquake", True) | isnt("event_type_code", "EARTHQUAKE"),
        "ML_OUTSIDE_STUDY_AREA": isnt("is_in_study_area", True),
        "ML_SOURCE_NOT_COMPARABLE": isnt("canonical_source_system", rules.source),
        "ML_LEGACY_CATALOG_ERA": isnt("catalog_era", rules.era),
        "ML_OUTSIDE_TIME_RANGE": F.coalesce((when < start) | (when >= end), F.lit(True)),
    }


def audit(events: DataFrame, rules: AuditRules) -> tuple[DataFrame, DataFrame]:
    """(events with exclusion_reason, all_reasons and is_eligible; the completeness estimate they rest on).

    Without a reliable estimate and a fixed one, no event is eligible: a threshold is never guessed. The estimate is one
    row, and so joins by broadcast.
    """
    early = exclusions(rules)
    fine = first_reason(early).isNull()
    estimate = completeness(histogram(events.where(fine), width=rules.bin_width), width=rules.bin_width, step=rules.step, least=rules.least_events)
    if rules.fixed_mc is not None:
        threshold = events.sparkSession.createDataFrame([(float(rules.fixed_mc),)], "mc_applied double")
    else:
        threshold = estimate.agg(F.max(F.when(F.col("is_reliable"), F.col("mc"))).alias("mc_applied"))  # a row even without events
    rows = events.crossJoin(F.broadcast(threshold))
    mc = F.col("mc_applied")
    below = finite(F.col("magnitude")) & F.coalesce(F.col("magnitude") < mc, F.lit(False))
    unknown = fine & mc.isNull()
    rows = rows.withColumn("exclusion_reason", first_reason(early | {"ML_MC_UNRELIABLE": unknown, "ML_BELOW_COMPLETENESS": below}))
    rows = rows.withColumn("all_reasons", all_reasons(early | {"ML_BELOW_COMPLETENESS": below, "ML_MC_UNRELIABLE": unknown}))
    return rows.withColumn("is_eligible", F.col("exclusion_reason").isNull()), estimate


def audit_counts(audited: DataFrame) -> dict[str, DataFrame]:
    """by_reason, by_any_reason, by_year, by_depth_band, by_magnitude_band."""
    split = (F.count("*").alias("input_count"), F.count_if("is_eligible").alias("eligible_count"), F.count_if(~F.col("is_eligible")).alias("excluded_count"))
    return {
        "by_reason": audited.where("exclusion_reason is not null").groupBy("exclusion_reason").agg(F.count("*").alias("n")),
        "by_any_reason": audited.select(F.explode("all_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")),
        "by_year": audited.groupBy(F.year(F.col("event_time_utc").cast("timestamp")).alias("year")).agg(*split),
        "by_depth_band": audited.groupBy(bands.depth_band(F.col("depth_km")).alias("depth_band")).agg(*split),
        "by_magnitude_band": audited.groupBy(bands.magnitude_band(F.col("magnitude")).alias("magnitude_band")).agg(*split),
    }


#: Dates at which the catalogue's network or its use changed.
MILESTONES = (
    ("JMA Unified Catalog Era", "1997-10-01 00:00:00"),
    ("Hi-net Seismic Network Expansion", "2000-10-01 00:00:00"),
    ("Tohoku Mw 9.0 Earthquake Crisis", "2011-03-11 05:46:00"),
    ("Reproduction to Extension Split", "2018-10-01 00:00:00"),
)


def network_shift(events: DataFrame, milestones: tuple[tuple[str, str], ...] = MILESTONES, days: int = 365, time: str = "event_time_utc") -> DataFrame:
    """(milestone, before, after, ratio, assessment): events in `days` before and after each, those without any left out.

    One scan: each milestone is two conditional counts, since milestones are a handful of literals.
    """
    t = F.col(time).cast("timestamp")
    aggs = []
    for i, (_, at) in enumerate(milestones):
        m = F.lit(at).cast("timestamp")
        span = F.expr(f"interval {days} days")
        aggs += [F.count_if((t >= m - span) & (t < m)).alias(f"b{i}"), F.count_if((t >= m) & (t < m + span)).alias(f"a{i}")]
    rows = F.array(*(F.struct(F.lit(n).alias("milestone"), F.col(f"b{i}").alias("before"), F.col(f"a{i}").alias("after")) for i, (n, _) in enumerate(milestones)))
    out = events.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*").where("before > 0 or after > 0")
    ratio = F.when(F.col("before") > 0, F.col("after") / F.col("before"))
    grade = F.when(ratio.isNull(), "NEW_PHASE").when(ratio > 2.0, "SURGE").when(ratio < 0.5, "DECREASE").otherwise("STABLE")
    return out.withColumns({"ratio": ratio, "assessment": grade})
