"""Distances, planar offsets, the study area and the magnitude-dependent space-time window laws, all as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
EARTH_KM, KM_PER_DEG_LAT, KM_PER_DEG_LON = 6371.0, 110.57, 111.32
STUDY_LAT, STUDY_LON = (20.0, 50.0), (120.0, 155.0)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda x: F.sin(F.radians(x) / 2.0)
    a = half(lat2 - lat1) * half(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon2 - lon1) * half(lon2 - lon1)
    return EARTH_KM * 2.0 * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))


def offsets_km(lat0: Column, lon0: Column, lat: Column, lon: Column) -> tuple[Column, Column]:
    """(dx, dy) of a point from an origin, in the plane that touches the origin."""
    return KM_PER_DEG_LON * F.cos(F.radians(lat0)) * (lon - lon0), KM_PER_DEG_LAT * (lat - lat0)


def in_study_area(lat: Column, lon: Column) -> Column:
    return lat.between(*STUDY_LAT) & lon.between(*STUDY_LON)


@dataclass(frozen=True)
class WindowLaw:
    """radius = radius_a * base^(radius_b * M) km and days = days_a * base^(days_b * M), each under its cap.

    The time before the mainshock is a share of that after it, with a minimum and, if given, a cap.
    """

    version: str
    base: float | None
    radius: tuple[float, float]
    days: tuple[float, float]
    pre_ratio: float = 0.1
    pre_least: float = 168.0
    pre_most: float | None = None
    post_most: float | None = None
    radius_most: float | None = None

    def dimensions(self, magnitude: Column, latitude: Column) -> dict[str, Column]:
        """pre_window_hours, post_window_hours, search_radius_km, delta_lat_deg, delta_lon_deg."""
        grow = (lambda e: F.exp(e)) if self.base is None else (lambda e: F.pow(F.lit(self.base), e))
        cap = lambda x, most: x if most is None else F.least(x, F.lit(most))
        law = lambda ab: grow(ab[0] + ab[1] * magnitude)
        radius = cap(law(self.radius), self.radius_most)
        post = cap(law(self.days) * 24.0, self.post_most)
        pre = cap(F.greatest(F.lit(self.pre_least), post * self.pre_ratio), self.pre_most)
        shrink = F.cos(F.radians(latitude))
        polar = (F.abs(latitude) >= 89.0) | (F.abs(shrink) < 1e-4)
        lon = F.when(polar, 180.0).otherwise(F.least(F.lit(180.0), radius / (KM_PER_DEG_LON * shrink)))
        return {"pre_window_hours": pre, "post_window_hours": post, "search_radius_km": radius, "delta_lat_deg": radius / KM_PER_DEG_LAT, "delta_lon_deg": lon}


@dataclass(frozen=True)
class ScaledLaw(WindowLaw):
    """Factors before the power instead of summands in the exponent."""

    def dimensions(self, magnitude: Column, latitude: Column) -> dict[str, Column]:
        import math

        a, b = ((math.log(x), y) for x, y in (self.radius, self.days))
        plain = WindowLaw(self.version, None, a, b, self.pre_ratio, self.pre_least, self.pre_most, self.post_most, self.radius_most)
        return plain.dimensions(magnitude, latitude)


#: Published laws, and their caps.
UHRHAMMER = WindowLaw("wm_uhrhammer_v1.0", None, (-1.024, 0.804), (-2.870, 1.235))
GARDNER_KNOPOFF = WindowLaw("wm_gardner_knopoff_v1.0", 10.0, (0.983, 0.1238), (-0.547, 0.5409))
EXPANDED = ScaledLaw("wm_expanded_v1.0", None, (0.359, 0.804), (0.0567, 1.235), pre_ratio=0.15, pre_most=720.0, post_most=17520.0, radius_most=250.0)
LAWS = {"UHRHAMMER": UHRHAMMER, "GARDNER_KNOPOFF": GARDNER_KNOPOFF, "EXPANDED": EXPANDED}
