"""Relative four-dimensional features of window candidates, with a reason code for whatever makes a row unfit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import blank, finite
from ..functions.reasons import reasons_of
from ..session import keep
from .windows import RIM, few, relative, repeated, role, weight

VECTOR = ("x_scaled", "y_scaled", "z_scaled", "time_scaled")


@dataclass(frozen=True)
class Scaling:
    """Scales in km and hours; ADAPTIVE_WINDOW takes the window's radius and length after the mainshock instead."""

    version: str = "scaling-global-dev-v1"
    mode: str = "GLOBAL"
    space_km: float = 50.0
    depth_km: float = 30.0
    time_hours: float = 720.0
    most_candidates: int = 10_000
    km_tolerance: float = 1e-8
    hour_tolerance: float = 1e-12
    #: Whether rows of windows above the limit that the guard only FLAGGED are fit; those of REJECTED windows never are.
    keep_flagged: bool = False

    @property
    def statuses(self) -> tuple[str, ...]:
        return ("PASS", "FLAGGED") if self.keep_flagged else ("PASS",)


PLACE = ("time", "latitude", "longitude", "depth_km", "magnitude")
SCALES = ("space_scale_km", "depth_scale_km", "time_scale_hours")
#: Each component of VECTOR: a relative coordinate and its scale.
SCALED = {"x_scaled": ("dx_km", SCALES[0]), "y_scaled": ("dy_km", SCALES[0]), "z_scaled": ("dz_km", SCALES[1]), "time_scaled": ("delta_time_hours", SCALES[2])}


class _Row:
    """Columns of a candidate that carries its mainshock's with a prefix, and the relative coordinates taken anew with another."""

    def __init__(self, scaling: Scaling):
        self.scaling = scaling
        self.known = F.col("_known").isNotNull()
        self.self_ = F.col("candidate_event_id") == F.col("mainshock_event_id")
        self.anew = {n: F.col(f"_anew_{n}") for n in ("dx_km", "dy_km", "dz_km", "distance_3d_km", "delta_time_hours")}

    def __getitem__(self, name: str) -> Column:
        return F.col(name)

    def main(self, name: str) -> Column:
        return F.col(f"_main_{name}")

    def shock(self, name: str) -> Column:
        return self.main(f"mainshock_{name}")

    def event(self, name: str) -> Column:
        return F.col(f"candidate_{name}")

    def numbers(self) -> list[Column]:
        """All that has to be a finite number, on either side."""
        sides = [side(n) for side in (self.event, self.shock) for n in PLACE[1:]]
        return [*sides, *(self.main(n) for n in ("mc_value", "pre_window_hours", "post_window_hours", "search_radius_km")), *(self[n] for n in ("mainshock_magnitude", "mc_value", *self.anew))]


def on_earth(side: Callable[[str], Column]) -> list[Column]:
    return [side("latitude").between(-90.0, 90.0), side("longitude").between(-180.0, 180.0)]


#: What is wrong with a row if one of its conditions does not hold (null counts as not), in the fixed order of the codes.
RULES: dict[str, Callable[[_Row], list[Column]]] = {
    "ML_INVALID_ID": lambda r: [~blank(r["mainshock_event_id"].cast("string")), ~blank(r["candidate_event_id"].cast("string"))],
    "ML_MISSING_MAINSHOCK": lambda r: [r.known],
    "ML_DUPLICATE_GRAIN": lambda r: [r["_grain"] == 1],
    "ML_SELF_PRESENCE_INVALID": lambda r: [r["_self"] == 1],
    "ML_CANDIDATE_COUNT_CONFLICT": lambda r: [r["_n"] == r.main("candidate_count")],
    "ML_RESOURCE_LIMIT_EXCEEDED": lambda r: [(r["_n"] <= r.scaling.most_candidates) | F.lit(r.scaling.keep_flagged), r.main("resource_guard_status").isin(*r.scaling.statuses)],
    "ML_NON_FINITE_FEATURE": lambda r: [finite(x) for x in r.numbers()],
    "ML_MAINSHOCK_RULE_INVALID": lambda r: [r.shock("depth_km").between(50.0, 200.0), r.shock("magnitude") > 5.5, r.main("pre_window_hours") >= 0, r.main("post_window_hours") > 0, r.main("search_radius_km") > 0, *on_earth(r.shock)],
    "ML_SELF_SOURCE_MISMATCH": lambda r: [~r.self_ | r.event(n).eqNullSafe(r.shock(n)) for n in PLACE],
    "ML_RELATIVE_COORDINATE_CONFLICT": lambda r: [F.abs(r[n] - r.anew[n]) <= (r.scaling.hour_tolerance if n == "delta_time_hours" else r.scaling.km_tolerance) for n in r.anew],
    "ML_EVENT_ROLE_MISMATCH": lambda r: [r["is_mainshock"] == r.self_, r["relative_time_role"] == role(r.self_, r.anew["delta_time_hours"]), r.event("time").isNotNull()],
    "ML_WINDOW_MEMBERSHIP_INVALID": lambda r: [r.anew["delta_time_hours"] >= -r.main("pre_window_hours") - r.scaling.hour_tolerance, r.anew["delta_time_hours"] <= r.main("post_window_hours") + r.scaling.hour_tolerance, F.hypot(r.anew["dx_km"], r.anew["dy_km"]) <= r.main("search_radius_km") + RIM, *on_earth(r.event)],
    "ML_CANDIDATE_LINEAGE_CONFLICT": lambda r: [r["mainshock_magnitude"].eqNullSafe(r.shock("magnitude")), r["mc_value"].eqNullSafe(r.main("mc_value")), r["window_model_version"].eqNullSafe(r.main("window_model_version")), r.event("magnitude") >= r.main("mc_value")],
    "ML_INVALID_SCALED_FEATURE": lambda r: [*(finite(r[v]) for v in VECTOR), *(finite(r[k]) & (r[k] > 0) for k in SCALES)],
}

#: How many rules are compiled at once: a method of more than 8,000 bytes is never compiled by the JVM.
PART = 3


def features(mains: DataFrame, cands: DataFrame, scaling: Scaling | None = None) -> DataFrame:
    """Candidates with VECTOR, the scales, and feature_reason_codes (empty for valid rows).

    Each row carries its mainshock's columns; relative coordinates are taken anew from both, by the function that made
    the candidates, and compared with those that the row has. Few mainshocks are broadcast with their windows' counts, so
    that candidates stay where they are; else counts come from the partitioning of the join. Candidates of classes keep
    what they stand for, and are counted by it.
    """
    s = scaling or Scaling()
    main = mains.select("mainshock_event_id", F.lit(True).alias("_known"), *(F.col(n).alias(f"_main_{n}") for n in mains.columns if n != "mainshock_event_id"))
    row = _Row(s)
    window = Window.partitionBy("mainshock_event_id")
    pair = F.count("*").over(Window.partitionBy("mainshock_event_id", "candidate_event_id"))
    copies = weight(cands, "copies")
    n, selves = F.sum(copies), F.sum(F.when(row.self_, copies).otherwise(0))
    per = keep(cands.groupBy("mainshock_event_id").agg(n.alias("_n"), selves.alias("_self")), "window_counts")
    main = keep(main, "mainshocks")
    if few(main) and few(per):
        times = F.coalesce(F.count("_known").over(window), F.lit(1))
        known = per.join(main, "mainshock_event_id", "left").withColumn("_k", F.greatest(times, F.lit(1)))
        known = known.withColumns({"_n": F.col("_n") * F.col("_k"), "_self": F.col("_self") * F.col("_k")})
        rows = cands.join(F.broadcast(known), "mainshock_event_id", "left")
        rows = rows.withColumn("_grain", pair if not repeated(cands, per).isEmpty() else F.coalesce("_k", F.lit(1)))
    else:
        rows = cands.join(main, "mainshock_event_id", "left").withColumns({"_n": n.over(window), "_self": selves.over(window), "_grain": pair})
    # by a generator, through which no filter pulls it: written out wherever a code needs it, the codes are too long to compile
    rows = rows.select("*", F.inline(F.array(F.struct(*(x.alias(f"_anew_{n}") for n, x in relative(row.shock, row.event).items())))))
    own = s.mode == "ADAPTIVE_WINDOW"
    scales = row.main("search_radius_km") if own else F.lit(s.space_km), F.lit(s.depth_km), row.main("post_window_hours") if own else F.lit(s.time_hours)
    rows = rows.withColumns(dict(zip(SCALES, scales)))
    rows = rows.withColumns({v: F.when(row.self_, 0.0).otherwise(F.try_divide(row.anew[n], k)) for v, (n, k) in SCALED.items()})
    # a bit for each code, a few of them at a time, again by a generator: it has each part compiled into a method of its own
    bits = [F.when(_all(rule(row)), 0).otherwise(1 << i) for i, rule in enumerate(RULES.values())]
    parts = [f"_bits{i}" for i in range(0, len(bits), PART)]
    for i, name in zip(range(0, len(bits), PART), parts):
        rows = rows.withColumn(name, F.explode(F.array(reduce(Column.bitwiseOR, bits[i : i + PART]))))
    rows = rows.withColumn("feature_reason_codes", reasons_of(reduce(Column.bitwiseOR, map(F.col, parts)), list(RULES)))
    return rows.select(*cands.columns, *VECTOR, *SCALES, F.lit("relative-4d-v1").alias("feature_version"), F.lit(s.version).alias("scaling_config_version"), "feature_reason_codes")


def _all(conditions: list[Column]) -> Column:
    """True only if each condition is: null counts as false."""
    return reduce(and_, (F.coalesce(x, F.lit(False)) for x in conditions))


def window_problems(mains: DataFrame, cands: DataFrame) -> DataFrame:
    """(mainshock_event_id, reason) of mainshocks that no features can be made for: repeated ones, and empty windows."""
    again = mains.groupBy("mainshock_event_id").agg(F.count("*").alias("n")).where("n > 1")
    empty = mains.join(cands.select("mainshock_event_id"), "mainshock_event_id", "left_anti")
    return again.select("mainshock_event_id", F.lit("ML_DUPLICATE_MAINSHOCK_GRAIN").alias("reason")).unionByName(empty.select("mainshock_event_id", F.lit("ML_EMPTY_WINDOW").alias("reason")).distinct())


def require_windows(mains: DataFrame, cands: DataFrame) -> None:
    """Fails with the reason if a mainshock is repeated or has no candidates."""
    if bad := window_problems(mains, cands).orderBy("reason", "mainshock_event_id").first():
        raise ValueError(f"{bad.reason}: {bad.mainshock_event_id}")


def valid(feats: DataFrame) -> DataFrame:
    return feats.where("size(feature_reason_codes) = 0").drop("feature_reason_codes")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same rows, as multisets."""
    cols = sorted(a.columns)
    x, y = a.select(*cols), b.select(*cols)
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
