"""Half-open bands of magnitude and depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values: (code, label, upper bound; None is open). Band dimensions put UNKNOWN first.
MAGNITUDE = (("LT_3", "Below 3.0", 3.0), ("M3_TO_LT4", "3.0–<4.0", 4.0), ("M4_TO_LT5", "4.0–<5.0", 5.0), ("M5_TO_LT6", "5.0–<6.0", 6.0), ("M6_TO_LT7", "6.0–<7.0", 7.0), ("GE_7", "7.0 or greater", None))
DEPTH = (("NEGATIVE", "Negative/above datum", 0.0), ("SHALLOW", "Shallow", 70.0), ("INTERMEDIATE", "Intermediate", 300.0), ("DEEP", "Deep", None))
Bands = Sequence[tuple[str, str, float | None]]


def band(x: Column, bands: Bands) -> Column:
    out = F.when(x.isNull(), "UNKNOWN")
    for code, _, upper in bands:
        out = out.otherwise(code) if upper is None else out.when(x < upper, code)
    return out


def magnitude_band(x: Column) -> Column:
    return band(x, MAGNITUDE)


def depth_band(x: Column) -> Column:
    return band(x, DEPTH)


def dimension(spark: SparkSession, bands: Bands) -> DataFrame:
    rows = [("UNKNOWN", "Unknown"), *((c, label) for c, label, _ in bands)]
    return spark.createDataFrame([(c, label, i) for i, (c, label) in enumerate(rows)], "band_code string, band_label string, sort_order int")
