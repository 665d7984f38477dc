"""How well two observations of different feeds match: thresholds with reason codes, and a weighted score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import link_id
from .numeric import half_up


@dataclass(frozen=True)
class LinkRules:
    seconds: float = 16.0
    km: float = 100.0
    depth_km: float | None = 50.0
    magnitude: float | None = 1.0
    ambiguity: float = 0.15
    least_score: float = 0.60
    model: str = "link_v1.0"
    canonical_model: str = "canon_v1.0"


#: Weights of time, distance, depth and magnitude.
WEIGHTS = (0.40, 0.40, 0.10, 0.10)


def match_score(seconds: Column, km: Column, depth: Column, magnitude: Column, rules: LinkRules) -> Column:
    """Weighted closeness in [0, 1] to four places; what is missing on one side takes no weight."""
    total, weights = F.lit(0.0), F.lit(0.0)
    for value, most, weight in zip((seconds, km, depth, magnitude), (rules.seconds, rules.km, rules.depth_km, rules.magnitude), WEIGHTS):
        if most:
            near = 1.0 - F.least(F.lit(1.0), F.greatest(F.lit(0.0), value / most))
            total = total + F.when(value.isNotNull(), weight * near).otherwise(0.0)  # least() and greatest() skip nulls
            weights = weights + F.when(value.isNotNull(), weight).otherwise(0.0)
    return half_up(total / weights, 4)


def threshold_reasons(seconds: Column, km: Column, depth: Column, magnitude: Column, score: Column, rules: LinkRules) -> dict[str, Column]:
    """Codes of the thresholds that a pair fails; the score counts only if no other does."""
    over = lambda x, most: F.lit(False) if most is None else F.coalesce(x > most, F.lit(False))
    out = {"TIME_DELTA_EXCEEDED": over(seconds, rules.seconds), "DISTANCE_EXCEEDED": over(km, rules.km), "DEPTH_DELTA_EXCEEDED": over(depth, rules.depth_km), "MAGNITUDE_DELTA_EXCEEDED": over(magnitude, rules.magnitude)}
    any_other = F.lit(False)
    for c in out.values():
        any_other = any_other | c
    return out | {"SCORE_BELOW_MINIMUM": ~any_other & (score < rules.least_score)}


__all__ = ["WEIGHTS", "LinkRules", "link_id", "match_score", "threshold_reasons"]
