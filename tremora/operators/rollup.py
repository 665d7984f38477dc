"""Daily and monthly aggregates of natural earthquakes in the study area, additive and honest about nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = ("region_key", "region_name", "region_category", "magnitude_band_code", "depth_band_code", "source_coverage_code")
#: Columns that identify a row besides its day or month.
GRAIN = ("region_key", "magnitude_band_code", "depth_band_code", "source_coverage_code")
STRONG = 5.0


def _stated(name: str) -> Column:
    """A code that is neither null, blank nor `none`."""
    return F.coalesce(~F.lower(F.trim(name)).isin("", "none"), F.lit(False))


def measures() -> dict[str, Column]:
    c = F.col
    return {
        "event_count": F.count("*"),
        "magnitude_non_null_count": F.count("magnitude"),
        "magnitude_sum": F.sum("magnitude"),
        "magnitude_max": F.max("magnitude"),
        "depth_non_null_count": F.count("depth_km"),
        "depth_sum": F.sum("depth_km"),
        "strong_earthquake_count": F.count_if(c("magnitude") >= STRONG),
        "tsunami_flagged_count": F.count_if(c("tsunami_flag")),
        "alerted_event_count": F.count_if(_stated("alert_level")),
        "intensity_reported_count": F.count_if(_stated("max_intensity_code")),
        "offshore_or_unknown_count": F.count_if(c("region_category").isin("OFFSHORE", "UNKNOWN")),
    }


def _with_averages(df: DataFrame) -> DataFrame:
    """Averages as sum / count, null where nothing was counted."""
    return df.withColumns({f"{x}_avg": F.when(F.col(f"{x}_non_null_count") > 0, F.col(f"{x}_sum") / F.col(f"{x}_non_null_count")) for x in ("magnitude", "depth")})


def daily(events: DataFrame, run_id: str | None = None, honest_unknowns: bool = False) -> DataFrame:
    """One row for each JST day and grain. With honest_unknowns, null dimensions become UNKNOWN, as the serving view has them."""
    rows = events.where("is_natural_earthquake and is_in_study_area")
    if honest_unknowns:
        rows = rows.na.fill({"region_key": "UNKNOWN", "region_name": "Unknown", "region_category": "UNKNOWN", "magnitude_band_code": "UNKNOWN", "depth_band_code": "UNKNOWN"})
    month = F.floor(F.col("event_date_key_jst") / 100).cast("int").alias("year_month_jst")
    out = _with_averages(rows.groupBy("event_date_key_jst", "event_date_jst", month, *DIMENSIONS).agg(*(m.alias(n) for n, m in measures().items())))
    return out if run_id is None else out.withColumn("gold_run_id", F.lit(run_id))


def monthly(days: DataFrame) -> DataFrame:
    """Months from days, by adding up: averages are of all events, not of days."""
    added = [F.max(n).alias(n) if n.endswith("_max") else F.sum(n).alias(n) for n in measures()]
    if "gold_run_id" in days.columns:
        added.append(F.max("gold_run_id").alias("gold_run_id"))
    out = _with_averages(days.groupBy("year_month_jst", *DIMENSIONS).agg(*added))
    ym = F.col("year_month_jst")
    return out.withColumns({"year_jst": F.floor(ym / 100).cast("int"), "month_jst": (ym % 100).cast("int")})


def yearly_cube(days: DataFrame) -> DataFrame:
    """An extension: counts by year and month with subtotals, in one pass."""
    ym = F.col("year_month_jst")
    return days.withColumns({"year_jst": F.floor(ym / 100).cast("int"), "month_jst": (ym % 100).cast("int")}).rollup("year_jst", "month_jst").agg(F.sum("event_count").alias("event_count"))


def parity(a: DataFrame, b: DataFrame, keys: list[str], exact: list[str], near: list[str], tolerance: float = 1e-4) -> DataFrame:
    """Rows of two aggregates that differ: missing on a side, another exact value, or a number beyond the tolerance."""
    left, right = a.alias("a"), b.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = left.withColumn("_a", F.lit(True)).alias("a").join(right.withColumn("_b", F.lit(True)).alias("b"), on, "full_outer")
    differ = F.col("_a").isNull() | F.col("_b").isNull()
    for n in exact:
        differ = differ | ~F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
    for n in near:
        x, y = F.col(f"a.{n}"), F.col(f"b.{n}")
        differ = differ | (x.isNull() != y.isNull()) | F.coalesce(F.abs(x - y) > tolerance, F.lit(False))
    shown = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys]
    return both.where(differ).select(*shown, *(F.col(f"{s}.{n}").alias(f"{s}_{n}") for n in (*exact, *near) for s in "ab"))


def dishonest_nulls(aggregate: DataFrame) -> DataFrame:
    """Rows whose counts are missing or negative, or whose sums, averages and maxima don't go with the counts."""
    c = F.col
    counts = [n for n in measures() if n.endswith("_count") and n != "event_count"]
    wrong = F.coalesce(c("event_count") <= 0, F.lit(True))
    for n in counts:
        wrong = wrong | F.coalesce(c(n) < 0, F.lit(True))
    for count, values in (("magnitude_non_null_count", ("magnitude_avg", "magnitude_max", "magnitude_sum")), ("depth_non_null_count", ("depth_avg", "depth_sum"))):
        for v in values:
            wrong = wrong | (c(v).isNull() != (c(count) == 0))
    return aggregate.where(wrong)


def repeated_grain(aggregate: DataFrame, period: str) -> DataFrame:
    return aggregate.groupBy(period, *GRAIN).agg(F.count("*").alias("row_occurrences")).where("row_occurrences > 1")
