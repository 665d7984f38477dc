"""Space-time windows around mainshocks: a bucketed range join, with guards, coverage policy and invariants."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from operator import and_, mul

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.geo import UHRHAMMER, WindowLaw, offsets_km
from ..functions.numeric import finite
from ..session import keep
from .validate import violations

HOUR = 3_600_000_000.0
DAY = 86_400_000_000
#: Tolerance of the radius test, in km.
RIM = 1e-5


@dataclass(frozen=True)
class Selection:
    period_start: str
    period_end: str
    mc: float
    above: float = 5.5
    depth: tuple[float, float] = (50.0, 200.0)
    most_candidates: int = 50_000
    reject_excess: bool = False
    law: WindowLaw = UHRHAMMER


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _period(s: Selection) -> tuple[Column, Column]:
    return _micros(F.lit(s.period_start)), _micros(F.lit(s.period_end))


def usable(events: DataFrame, s: Selection) -> DataFrame:
    """Eligible events of the period from Mc on."""
    start, end = _period(s)
    t = _micros(F.col("event_time_utc"))
    return events.where(F.col("is_eligible") & (F.col("magnitude") >= s.mc) & (t >= start) & (t < end))


#: Members of a class, at most; further ones make another class, so that no task has to unfold all of a large one.
MEMBERS = 1024
#: What candidates of classes have beside: the candidate's class, how many candidates a row stands for (for each mainshock),
#: mainshocks (for each candidate) and pairs, and the ids on either side.
FOLDED = ("candidate_class", "copies", "shocks", "pairs", "mainshock_members", "candidate_members")


def alike(events: DataFrame, s: Selection, *by: Column) -> DataFrame:
    """Usable events as classes: a row for events that differ in nothing but their ids (nor in `by`), with the least id
    as its own, all ids as members, in order, and their number as copies.

    A pair of classes stands for all pairs of their members. Where an id is null or occurs twice each row is its own class.
    """
    c, names = F.col, ("event_time_utc", "latitude", "longitude", "depth_km", "magnitude")
    rows = usable(events, s).select("canonical_event_id", *names, *(x.alias(f"_by{i}") for i, x in enumerate(by)))
    if rows.groupBy("canonical_event_id").count().where("canonical_event_id is null or count > 1").isEmpty():
        rows = rows.groupBy(*names, *(f"_by{i}" for i in range(len(by)))).agg(F.sort_array(F.collect_list("canonical_event_id")).alias("_ids"))
        parts = F.sequence(F.lit(0), ((F.size("_ids") - 1) / MEMBERS).cast("int"))
        rows = rows.withColumn("members", F.explode(F.transform(parts, lambda i: F.slice("_ids", i * MEMBERS + 1, F.lit(MEMBERS)))))
    else:
        rows = rows.withColumn("members", F.array("canonical_event_id"))
    return keep(rows.select(c("members")[0].alias("canonical_event_id"), *names, F.lit(True).alias("is_eligible"), "members", F.size("members").cast("long").alias("copies")), "alike")


#: Events to a place, on the mean, from which candidates are counted by place and time and not paired one by one.
SHARED = 8
#: What runs have beside: their first and last event's time, the mainshock's id where it lies among them and isn't counted,
#: and the mainshock's time.
RUN = ("run_from_us", "run_to_us", "run_without", "mainshock_us")


def settled(events: DataFrame, s: Selection, *by: Column) -> DataFrame | None:
    """Usable events with the number of their place: events of one place have coordinates and depth in common (and `by`,
    and whether the magnitude is a number). None where an id is null or occurs twice, or events share too few places.

    Candidates of settled events are runs: all events of a place in a part of the mainshock's window. What a row says but
    for the time is the same for all of a run, and so is what holds of it; its row has the time that is nearest to breaking
    a rule. Events at the very bounds of a window are runs of their own, as the bounds are rounded.
    """
    c, names = F.col, ("latitude", "longitude", "depth_km")
    rows = usable(events, s).select("canonical_event_id", "event_time_utc", *names, "magnitude", F.lit(True).alias("is_eligible"), F.when(~finite(c("magnitude")), c("magnitude")).alias("_by"), *(x.alias(f"_by{i}") for i, x in enumerate(by)))
    if not rows.groupBy("canonical_event_id").count().where("canonical_event_id is null or count > 1").isEmpty():
        return None
    keys = [*names, "_by", *(f"_by{i}" for i in range(len(by)))]
    places = keep(rows.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("place", F.monotonically_increasing_id()), "places")
    n, k = places.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")).first()
    if k * SHARED > n:
        return None
    same = reduce(and_, (rows[x].eqNullSafe(places[x]) for x in keys))
    return keep(rows.join(places, same).select(*(rows[x] for x in rows.columns if not x.startswith("_by")), "place"), "settled")


def weight(rows: DataFrame, name: str) -> Column:
    """How many copies, shocks or pairs a row stands for: one where rows aren't of classes."""
    return F.col(name) if name in rows.columns else F.lit(1)


def each_member(rows: DataFrame, classes: DataFrame, id_: str) -> DataFrame:
    """A row for each member of the class that id_ names, in place of one for the class."""
    of = classes.select(F.col("canonical_event_id").alias(id_), F.col("members").alias("_of"))
    return rows.join(of, id_).withColumn(id_, F.explode("_of")).drop("_of")


def each_pair(rows: DataFrame) -> DataFrame:
    """Candidates of classes as the pairs that they stand for: with itself a class has its members' own rows and all others."""
    if "pairs" not in rows.columns:
        return rows
    m, k = F.col("mainshock_event_id"), F.col("candidate_event_id")
    out = rows.withColumn("_self", m.eqNullSafe(k)).withColumn("_m", F.explode("mainshock_members")).withColumn("_k", F.explode("candidate_members"))
    own = {"mainshock_event_id": F.col("_m").alias("mainshock_event_id"), "candidate_event_id": F.col("_k").alias("candidate_event_id")}
    return out.where(F.col("_m").eqNullSafe(F.col("_k")) == F.col("_self")).select(*(own.get(n, n) for n in rows.columns if n not in FOLDED))


def mainshocks(events: DataFrame, s: Selection) -> DataFrame:
    """Usable events above the threshold and in the depth range, with their window's dimensions and bounds (in micros)."""
    rows = usable(events, s).where((F.col("magnitude") > s.above) & F.col("depth_km").between(*s.depth))
    rows = rows.select(F.col("canonical_event_id").alias("mainshock_event_id"), F.col("event_time_utc").alias("mainshock_time"), *(F.col(c).alias(f"mainshock_{c}") for c in ("latitude", "longitude", "depth_km", "magnitude", "members", "copies", "place") if c in events.columns))
    rows = rows.withColumns(s.law.dimensions(F.col("mainshock_magnitude"), F.col("mainshock_latitude")))
    t = _micros(F.col("mainshock_time"))
    span = lambda name: F.round(F.col(name) * HOUR).cast("long")
    return rows.withColumns({"start_us": t - span("pre_window_hours"), "end_us": t + span("post_window_hours")})


def coverage_reason(s: Selection) -> Column:
    """Which side of a window leaves the period, null for none. Window ends are inclusive, the period's end isn't."""
    start, end = _period(s)
    pre, post = F.col("start_us") < start, F.col("end_us") >= end
    return F.when(pre & post, "PRE_AND_POST_OUTSIDE_SPLIT").when(pre, "PRE_OUTSIDE_SPLIT").when(post, "POST_OUTSIDE_SPLIT")


def covered(mains: DataFrame, s: Selection) -> DataFrame:
    """The strict policy: windows that cross the split go as a whole."""
    return mains.where(coverage_reason(s).isNull())


#: Cells of a window, at most, before the next coarser grid takes it; grids; bits by which time and space grow from grid to grid.
CELLS, GRIDS, TIME_BITS, SPACE_BITS = 256, 4, 3, 2
#: The same for windows that are broadcast, and how many rows these may be, or mainshocks with what is known of each.
FEW_CELLS, FEW = 8, 1 << 18


def few(rows: DataFrame) -> bool:
    """Whether so few rows are there that they may be broadcast; looks at FEW + 1 of them at most."""
    return rows.limit(FEW + 1).count() <= FEW


def range_join(windows: DataFrame, points: DataFrame, time: tuple[str, str, str], boxes: list[tuple[str, str, str]], width_us: int = DAY, cell: float = 1.0, deal: str | None = None) -> DataFrame:
    """Windows joined with the points inside, bounds included.

    time: (start, end, point) in micros; boxes: (low, high, point) in degrees. A window lies on the finest grid of which
    it touches at most CELLS cells, and is repeated for each of them; a point lies in one cell of each grid that some
    window is on (GRIDS at most, in practice one or two). So the join is an equi-join on cells, and no pair meets twice.

    With `deal`, a column of the points, windows of FEW cells in all are broadcast, on grids where each touches FEW_CELLS
    where it can, and points are dealt out by that column. Pairs then lie where their point does: what groups them by that
    column moves none of them. More windows are joined as without it.
    """
    axes = [(*time, width_us, TIME_BITS), *((*b, cell, SPACE_BITS) for b in boxes)]
    place = lambda x, unit, bits, grid: F.floor(F.col(x) / (unit * F.pow(F.lit(2.0), bits * grid)))
    cells = lambda g: reduce(mul, (place(hi, u, n, F.lit(g)) - place(lo, u, n, F.lit(g)) + 1 for lo, hi, _, u, n in axes))
    def gridded(most: int) -> DataFrame:
        grid = F.lit(GRIDS - 1)
        for g in reversed(range(GRIDS - 1)):
            grid = F.when(cells(g) <= most, g).otherwise(grid)
        return windows.withColumn("_g", grid)

    def held() -> bool:
        of = F.lit(0.0)
        for g in range(GRIDS):
            of = F.when(F.col("_g") == g, cells(g).cast("double")).otherwise(of)
        return (gridded(FEW_CELLS).agg(F.sum(of)).first()[0] or 0.0) <= FEW

    hold = deal is not None and held()
    a = gridded(FEW_CELLS if hold else CELLS)
    if hold:
        grids = [x[0] for x in a.select("_g").distinct().collect()] or [0]  # GRIDS rows at most
        b = points.withColumn("_g", F.explode(F.array(*map(F.lit, grids))))
    else:
        b = points.crossJoin(F.broadcast(a.select("_g").distinct()))  # GRIDS rows at most
    inside = F.lit(True)
    for i, (low, high, p, unit, bits) in enumerate(axes):
        a = a.withColumn(f"_c{i}", F.explode(F.sequence(place(low, unit, bits, F.col("_g")), place(high, unit, bits, F.col("_g")))))
        b = b.withColumn(f"_c{i}", place(p, unit, bits, F.col("_g")))
        inside = inside & (F.col(p) >= F.col(low)) & (F.col(p) <= F.col(high))
    keys = ["_g", *(f"_c{i}" for i in range(len(axes)))]
    if hold:
        # by number: few points make many pairs; a few a core, since each writes a file for each part of a shuffle after it
        spark = points.sparkSession
        parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        return b.repartition(parts, deal).join(F.broadcast(a), keys).where(inside).drop(*keys)  # FEW rows at most
    return a.join(b, keys).where(inside).drop(*keys)


def relative(shock: Callable[[str], Column], event: Callable[[str], Column]) -> dict[str, Column]:
    """Coordinates of an event relative to a mainshock; both give their columns (time, latitude, ...) by name."""
    dx, dy = offsets_km(shock("latitude"), shock("longitude"), event("latitude"), event("longitude"))
    dz = event("depth_km") - shock("depth_km")
    hours = (_micros(event("time")) - _micros(shock("time"))).cast("double") / HOUR
    return {"dx_km": dx, "dy_km": dy, "dz_km": dz, "distance_3d_km": F.sqrt(dx * dx + dy * dy + dz * dz), "delta_time_hours": hours}


def role(self_: Column, hours: Column) -> Column:
    return F.when(self_, "MAINSHOCK").when(hours < 0, "PRE").otherwise("POST")


#: What candidates have.
COLUMNS = ("mainshock_event_id", "candidate_event_id", "candidate_time", "candidate_latitude", "candidate_longitude", "candidate_depth_km", "candidate_magnitude", "mainshock_magnitude", "relative_time_role", "is_mainshock", "dx_km", "dy_km", "dz_km", "delta_time_hours", "distance_3d_km", "mc_value", "window_model_version")


def _boxed(mains: DataFrame, s: Selection) -> DataFrame:
    """Mainshocks with the bounds of their windows, clipped to the period and the globe."""
    start, end = _period(s)
    c = F.col
    boxed = mains.withColumns({"_s": F.greatest("start_us", start), "_e": F.least("end_us", end - 1)})
    for axis, delta, edge in (("latitude", "delta_lat_deg", 90.0), ("longitude", "delta_lon_deg", 180.0)):
        boxed = boxed.withColumns({f"_{axis}_lo": F.greatest(c(f"mainshock_{axis}") - c(delta), F.lit(-edge)), f"_{axis}_hi": F.least(c(f"mainshock_{axis}") + c(delta), F.lit(edge))})
    boxed = boxed.where("_s <= _e")
    return boxed


def candidates(events: DataFrame, mains: DataFrame, s: Selection) -> DataFrame:
    """A row for each mainshock and usable event in its window and radius, with role and relative coordinates.

    The event's cell search is clipped to the period; bounds themselves are not. Of classes (both of `alike`) there is a
    row for each pair of them, FOLDED with it; a class of several with itself has two, one for the members' own rows. Of
    settled events there is a row for each run of them, with RUN and what FOLDED says but the members.
    """
    if "place" in events.columns:
        return _runs(events, mains, s)
    c, boxed = F.col, _boxed(mains, s)
    points = usable(events, s).select(c("canonical_event_id").alias("candidate_event_id"), c("event_time_utc").alias("candidate_time"), *(c(n).alias(f"candidate_{n}") for n in ("latitude", "longitude", "depth_km", "magnitude", "members", "copies") if n in events.columns), _micros(c("event_time_utc")).alias("_t"))
    pairs = range_join(boxed, points, ("_s", "_e", "_t"), [(f"_{x}_lo", f"_{x}_hi", f"candidate_{x}") for x in ("latitude", "longitude")], deal="candidate_event_id")
    self_ = c("candidate_event_id") == c("mainshock_event_id")
    pairs = pairs.withColumns(relative(lambda n: c(f"mainshock_{n}"), lambda n: c(f"candidate_{n}")))
    pairs = pairs.where(F.sqrt(c("dx_km") * c("dx_km") + c("dy_km") * c("dy_km")) <= c("search_radius_km") + RIM)
    if folded := "members" in events.columns:
        same, n, k = F.coalesce(self_, F.lit(False)), c("mainshock_copies"), c("candidate_copies")
        pairs = pairs.withColumns({"candidate_class": c("candidate_event_id"), "_self": F.explode(F.when(same & (k > 1), F.array(F.lit(True), F.lit(False))).otherwise(F.array(self_)))})
        self_, same = c("_self"), F.coalesce(c("candidate_class") == c("mainshock_event_id"), F.lit(False))
        stands = lambda apart, one, others: F.when(~same, apart).when(self_, one).otherwise(others)
        pairs = pairs.withColumns({"copies": stands(k, F.lit(1), k - 1), "shocks": stands(n, F.lit(1), n - 1), "pairs": stands(n * k, n, n * (n - 1)), "candidate_event_id": F.when(same & ~self_, F.element_at("candidate_members", -1)).otherwise(c("candidate_event_id"))})
    pairs = pairs.withColumns({n: F.when(self_, F.lit(0.0)).otherwise(c(n)) for n in ("dx_km", "dy_km", "dz_km", "distance_3d_km", "delta_time_hours")})
    pairs = pairs.withColumns({"is_mainshock": self_, "relative_time_role": role(self_, c("delta_time_hours")), "mc_value": F.lit(s.mc), "window_model_version": F.lit(s.law.version)})
    return pairs.select(*COLUMNS, *(FOLDED if folded else ()))


class _Sorted:
    """Rows of places in the order of place and time, and where in it moments at places are."""

    def __init__(self, rows: pa.Table):
        place, t = rows["place"].to_numpy(), rows["_t"].to_numpy()
        order = np.lexsort((t, place))
        self.rows, self.t = rows.take(pa.array(order)), t[order]
        self.moments, at = np.unique(self.t, return_inverse=True)
        self.places, of = np.unique(place[order], return_inverse=True)
        self.key = of * (len(self.moments) + 1) + at

    def before(self, place: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The first row of each place that isn't before t."""
        key = np.searchsorted(self.places, place) * (len(self.moments) + 1) + np.searchsorted(self.moments, t)
        return np.searchsorted(self.key, key)

    def of_ids(self, ids: pa.ChunkedArray) -> np.ndarray:
        return pd.Index(self.rows["candidate_event_id"].to_pandas()).get_indexer(pd.Index(ids.to_pandas())) if len(ids) else np.empty(0, int)


def _by_place(rows: DataFrame, events: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: StructType) -> DataFrame:
    """f of rows and events that share a place, many places at a time."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df: df.withColumn("_b", F.pmod(F.hash("place"), F.lit(parts))).groupBy("_b")
    return dealt(rows).cogroup(dealt(events)).applyInArrow(f, schema)


def _points(events: DataFrame) -> DataFrame:
    c = F.col
    return events.select("place", c("canonical_event_id").alias("candidate_event_id"), c("event_time_utc").alias("candidate_time"), c("magnitude").alias("candidate_magnitude"), _micros(c("event_time_utc")).alias("_t"))


def _find_runs(left: pa.Table, right: pa.Table) -> pa.Table:
    """The runs of each mainshock at each place: at its window's start, before it, from it on, and at the end; and itself."""
    events, (place, at, start, end) = _Sorted(right), (left[n].to_numpy() for n in ("place", "_at", "start_us", "end_us"))
    cuts = [events.before(place, x) for x in (start, np.minimum(start + 1, at), at, np.maximum(end, at), end + 1)]
    own = np.flatnonzero(left["_own"].to_numpy().astype(bool))
    here = np.full(len(left), -1)
    here[own] = events.of_ids(left["mainshock_event_id"].take(pa.array(own)))
    runs = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        within = (here >= a) & (here < b)  # the mainshock has a row of its own
        n = b - a - within
        some = np.flatnonzero(n > 0)
        nearest = b - 1 if i == 1 else a + (here == a)
        runs.append([x[some] for x in (np.arange(len(left)), nearest, n, a, b - 1, within)] + [np.zeros(len(some), bool)])
    selves = np.flatnonzero((here >= cuts[0]) & (here < cuts[-1]))
    me = here[selves]
    runs.append([selves, me, np.ones(len(selves), int), me, me, np.zeros(len(selves), bool), np.ones(len(selves), bool)])
    of, nearest, n, first, last, within, self_ = (np.concatenate(x) for x in zip(*runs))
    out = left.drop_columns(["_b", "_at", "_own", "start_us", "end_us"]).take(pa.array(of))
    for name in ("candidate_event_id", "candidate_time", "candidate_magnitude"):
        out = out.append_column(name, events.rows[name].take(pa.array(nearest)))
    out = out.append_column("copies", pa.array(n, "int64")).append_column("_self", pa.array(self_))
    out = out.append_column(RUN[0], pa.array(events.t[first], "int64")).append_column(RUN[1], pa.array(events.t[last], "int64"))
    out = out.append_column(RUN[2], left["mainshock_event_id"].take(pa.array(of, mask=~within)))
    return out.append_column(RUN[3], pa.array(at[of], "int64"))


def _runs(events: DataFrame, mains: DataFrame, s: Selection) -> DataFrame:
    c, points = F.col, _points(usable(events, s))
    at = usable(events, s).groupBy("place").agg(*(F.first(n).alias(f"candidate_{n}") for n in ("latitude", "longitude", "depth_km")), F.min(_micros(c("event_time_utc"))).alias("_first"), F.max(_micros(c("event_time_utc"))).alias("_last"))
    # places have no time to meet in, so time has one cell; a place whose events all lie outside goes after
    reach = range_join(_boxed(mains, s).withColumns({"_s": F.lit(0), "_e": F.lit(0)}), at.withColumn("_t", F.lit(0)), ("_s", "_e", "_t"), [(f"_{x}_lo", f"_{x}_hi", f"candidate_{x}") for x in ("latitude", "longitude")])
    dx, dy = offsets_km(c("mainshock_latitude"), c("mainshock_longitude"), c("candidate_latitude"), c("candidate_longitude"))
    reach = reach.where((F.sqrt(dx * dx + dy * dy) <= c("search_radius_km") + RIM) & (c("_first") <= c("end_us")) & (c("_last") >= c("start_us")))
    reach = reach.select("mainshock_event_id", *(f"mainshock_{n}" for n in ("time", "latitude", "longitude", "depth_km", "magnitude")), *(f"candidate_{n}" for n in ("latitude", "longitude", "depth_km")), "place", "start_us", "end_us", _micros(c("mainshock_time")).alias("_at"), F.coalesce(c("mainshock_place") == c("place"), F.lit(False)).alias("_own"))
    schema = StructType([x for x in reach.schema if x.name not in ("_at", "_own", "start_us", "end_us")] + [x for x in points.schema if x.name.startswith("candidate_")])
    schema = schema.add("copies", "long").add("_self", "boolean").add(RUN[0], "long").add(RUN[1], "long").add(RUN[2], reach.schema["mainshock_event_id"].dataType).add(RUN[3], "long")
    runs = _by_place(reach, points, _find_runs, schema)
    runs = runs.withColumns(relative(lambda n: c(f"mainshock_{n}"), lambda n: c(f"candidate_{n}")))
    runs = runs.withColumns({n: F.when(c("_self"), F.lit(0.0)).otherwise(c(n)) for n in ("dx_km", "dy_km", "dz_km", "distance_3d_km", "delta_time_hours")})
    runs = runs.withColumns({"is_mainshock": c("_self"), "relative_time_role": role(c("_self"), c("delta_time_hours")), "mc_value": F.lit(s.mc), "window_model_version": F.lit(s.law.version), "candidate_class": c("place"), "shocks": F.lit(1).cast("long"), "pairs": c("copies")})
    return keep(runs.select(*COLUMNS, "candidate_class", "copies", "shocks", "pairs", *RUN), "runs")


def _count_covers(left: pa.Table, right: pa.Table) -> pa.Table:
    events = _Sorted(right)
    self_ = left["self"].to_numpy().astype(bool)
    count = lambda at: np.bincount(at[at >= 0], minlength=len(right) + 1)
    runs = left.filter(pa.array(~self_))
    place, first, last = (runs[n].to_numpy() for n in ("place", RUN[0], RUN[1]))
    posts = np.cumsum(count(events.before(place, first)) - count(events.before(place, last + 1)))[:-1]
    posts -= count(events.of_ids(runs[RUN[2]].drop_null()))[:-1]
    all_ = posts + count(events.of_ids(left["candidate_event_id"].filter(pa.array(self_))))[:-1]
    return pa.table({"candidate_event_id": events.rows["candidate_event_id"], "sequences": pa.array(all_, "int64"), "posts": pa.array(posts, "int64")})


def covers(events: DataFrame, members: DataFrame) -> DataFrame:
    """(candidate_event_id, sequences, posts) of each settled event: how many of the members' runs hold it, and how many
    without its own row."""
    c = F.col
    runs = members.select(c("candidate_class").alias("place"), "candidate_event_id", *RUN, F.coalesce(c("candidate_event_id") == c("mainshock_event_id"), F.lit(False)).alias("self"))
    schema = StructType().add("candidate_event_id", events.schema["canonical_event_id"].dataType).add("sequences", "long").add("posts", "long")
    return _by_place(runs, _points(events).drop("candidate_time", "candidate_magnitude"), _count_covers, schema)


def _hundredths(x: np.ndarray) -> np.ndarray:
    """x in hundredths, rounded as Spark's round(x, 2) does: halves of the shortest decimal go up."""
    y = x * 100.0
    out = np.floor(y + 0.5).astype(np.int64)
    for i in np.flatnonzero(np.abs(y - np.floor(y) - 0.5) < 1e-6):
        out[i] = int((Decimal(repr(float(x[i]))) * 100).quantize(Decimal(1), ROUND_HALF_UP))
    return out


def _find_nearest(left: pa.Table, right: pa.Table) -> pa.Table:
    """Mainshocks as far from a place as each other are nearer to its events the later they are, so the last two that hold
    an event tell the best and whether it ties."""
    events, (place, apart, at, first, last) = _Sorted(right), (left[n].to_numpy() for n in ("place", "apart", "at", "first", "last"))
    count = lambda x: np.bincount(x, minlength=len(right) + 1)
    n = np.cumsum(count(events.before(place, first)) - count(events.before(place, last + 1)))[:-1]
    best, ties, winner = np.full(len(right), np.iinfo(np.int64).max), np.zeros(len(right), np.int64), np.full(len(right), -1)
    order = np.lexsort((at, apart, place))
    place, apart, at, first, last = (x[order] for x in (place, apart, at, first, last))
    edges = np.flatnonzero((place[1:] != place[:-1]) | (apart[1:] != apart[:-1])) + 1
    for a, b in zip([0, *edges], [*edges, len(order)]) if len(order) else ():
        lo, hi = events.before(place[a : a + 1], first[a:b].min())[0], events.before(place[a : a + 1], last[a:b].max() + 1)[0]
        t, (m, f, e) = events.t[lo:hi], (x[a:b] for x in (at, first, last))
        k = np.searchsorted(m, t, "right") - 1
        for _ in range(2):
            while (past := (k >= 0) & ((t < f[k]) | (t > e[k]))).any():
                k = k - past
            some = np.flatnonzero(k >= 0)
            hours = (t[some] - m[k[some]]).astype(float) / HOUR / 720.0
            d, some = _hundredths(np.sqrt(apart[a] + hours * hours)), some + lo
            ties[some] = np.where(d < best[some], 1, ties[some] + (d == best[some]))
            winner[some] = np.where(d < best[some], order[a + k[some - lo]], winner[some])
            best[some] = np.minimum(d, best[some])
            k = np.maximum(k - 1, -1)
    held = np.flatnonzero(n > 0)
    out = events.rows.select(["candidate_event_id"]).take(pa.array(held))
    out = out.append_column("sequences", pa.array(n[held], "int64")).append_column("ties", pa.array(ties[held], "int64"))
    return out.append_column("first_choice", left["mainshock_event_id"].take(pa.array(winner[held], mask=ties[held] != 1)))


def nearest(events: DataFrame, members: DataFrame) -> DataFrame:
    """(candidate_event_id, sequences, ties, first_choice) of each settled event in a sequence, of the members' runs with
    their features on global scales: how many hold it, and the one whose distance to two places is least, if no other's is
    the same. Of ties no more are counted than tell one from several."""
    c = F.col
    runs = members.groupBy(c("candidate_class").alias("place"), "mainshock_event_id").agg(F.min(RUN[0]).alias("first"), F.max(RUN[1]).alias("last"), F.max(RUN[3]).alias("at"), F.max(c("x_scaled") * c("x_scaled") + c("y_scaled") * c("y_scaled") + c("z_scaled") * c("z_scaled")).alias("apart"))
    key = events.schema["canonical_event_id"].dataType
    schema = StructType().add("candidate_event_id", key).add("sequences", "long").add("ties", "long").add("first_choice", key)
    return _by_place(runs, _points(events).drop("candidate_time", "candidate_magnitude"), _find_nearest, schema)


def guarded(mains: DataFrame, cands: DataFrame, s: Selection) -> DataFrame:
    """Mainshocks with candidate_count and its guard: PASS, else FLAGGED or REJECTED with a reason; nothing is cut."""
    counts = cands.groupBy("mainshock_event_id").agg(F.sum(weight(cands, "copies")).alias("candidate_count"))
    out = mains.join(counts, "mainshock_event_id", "left").na.fill({"candidate_count": 0})
    over = F.col("candidate_count") > s.most_candidates
    return out.withColumns({"resource_guard_status": F.when(over, "REJECTED" if s.reject_excess else "FLAGGED").otherwise("PASS"), "resource_reason_code": F.when(over, "ML_RESOURCE_LIMIT_EXCEEDED"), "mc_value": F.lit(s.mc), "window_model_version": F.lit(s.law.version)})


def nested_counts(mains: DataFrame, cands: DataFrame) -> DataFrame:
    """(mainshock_event_id, nested_mainshocks): candidates of a window that are mainshocks themselves, it itself apart."""
    ids = mains.select(F.col("mainshock_event_id").alias("candidate_event_id"))
    return cands.where("not is_mainshock").join(ids, "candidate_event_id", "left_semi").groupBy("mainshock_event_id").agg(F.count("*").alias("nested_mainshocks"))


def _dealt(cands: DataFrame) -> list[str]:
    """What candidates lie dealt out by, as a key that spares a shuffle."""
    return [n for n in ("candidate_class",) if n in cands.columns]


def repeated(cands: DataFrame, ids: DataFrame) -> DataFrame:
    """Candidates of pairs that occur twice, as (candidate_event_id, ...); ids has the few mainshocks of cands, one row each.

    Mainshocks are numbered, and a candidate has a bit for each of them in words of 64: a word with fewer bits than rows
    has a pair twice. So groups are a candidate's words, not its pairs.
    """
    numbered = F.broadcast(ids.select("mainshock_event_id", F.monotonically_increasing_id().alias("_i")))
    same = cands["mainshock_event_id"].eqNullSafe(numbered["mainshock_event_id"])
    words = cands.join(numbered, same).groupBy(*_dealt(cands), "candidate_event_id", F.expr("_i div 64").alias("_w")).agg(F.count("*").alias("n"), F.expr("bit_or(shiftleft(1L, cast(_i % 64 as int)))").alias("bits"))
    return words.where(F.col("n") > F.bit_count("bits"))


def broken_invariants(mains: DataFrame, cands: DataFrame) -> dict[str, int]:
    """How often each invariant of the two snapshots is broken: grain, self once, zero self vector, role against time."""
    c = F.col
    zero = (c("dx_km") == 0) & (c("dy_km") == 0) & (c("dz_km") == 0) & (c("delta_time_hours") == 0) & (c("distance_3d_km") == 0)
    copies, pairs = weight(cands, "copies"), weight(cands, "pairs")
    rules = {"self vector": c("is_mainshock") & ~zero, "role": ((c("relative_time_role") == "PRE") & (c("delta_time_hours") >= 0)) | ((c("relative_time_role") == "POST") & (c("delta_time_hours") < 0)), "self role": c("is_mainshock") != (c("relative_time_role") == "MAINSHOCK")}
    # in one pass, what is counted and what is broken of each window
    per = cands.groupBy("mainshock_event_id").agg(F.sum(F.when(c("is_mainshock"), copies)).alias("s"), F.sum(copies).alias("n"), *(F.sum(F.when(x, pairs)).alias(k) for k, x in rules.items()))
    per = keep(per, "window_counts")
    row = per.agg(*(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in rules)).first()
    out = row.asDict()
    again = cands
    if few(per):
        again = keep(repeated(cands, per).select("candidate_event_id").distinct(), "repeated")
        again = cands.join(F.broadcast(again) if few(again) else again, cands["candidate_event_id"].eqNullSafe(again["candidate_event_id"]), "left_semi")
    # the class is among the keys, since candidates lie dealt out by it
    grain = again.groupBy("mainshock_event_id", *_dealt(cands), "candidate_event_id").agg(F.count("*").alias("rows"), F.max(pairs).alias("pairs"))
    out |= violations(grain, {"grain": c("rows") > 1}, c("pairs"))
    both = mains.select("mainshock_event_id", "candidate_count", weight(mains, "mainshock_copies").alias("of")).join(per.select("mainshock_event_id", "s", "n"), "mainshock_event_id", "full_outer")
    return out | violations(both, {"self once": F.coalesce(c("s"), F.lit(0)) != 1, "count": ~c("candidate_count").eqNullSafe(c("n"))}, F.coalesce("of", F.lit(1)))
