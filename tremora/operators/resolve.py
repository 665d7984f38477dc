"""Entity resolution between two feeds: candidate pairs by time bucket, scores, ambiguity, one-to-one matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..functions.ids import canonical_id, link_id
from ..functions.reasons import all_reasons
from ..functions.score import LinkRules, match_score, threshold_reasons
from ..session import keep

SIDE = ("source_observation_id", "event_time_utc", "latitude", "longitude", "depth_km", "magnitude")


def current_or_all(observations: DataFrame) -> DataFrame:
    """Current revisions; if none is marked as current, all."""
    anything = observations.where("is_current_source_revision").isEmpty()
    return observations if anything else observations.where("is_current_source_revision")


def time_pairs(left: DataFrame, right: DataFrame, seconds: float, time: str = "event_time_utc", prefix: tuple[str, str] = ("l_", "r_")) -> DataFrame:
    """All pairs at most `seconds` apart, as an equi-join on time buckets of that width.

    Each right row lies in one bucket and each left row looks into its own and both neighbours, so a pair meets once.
    """
    millis = lambda p: F.unix_millis(F.col(f"{p}{time}").cast("timestamp"))
    width = max(1, int(seconds * 1000))
    a, b = (df.select(*(F.col(c).alias(p + c) for c in df.columns)).withColumn("_slot", F.floor(millis(p) / F.lit(width))) for df, p in zip((left, right), prefix))
    a = a.withColumn("_slot", F.explode(F.array(F.col("_slot") - 1, F.col("_slot"), F.col("_slot") + 1)))
    delta = F.abs(millis(prefix[0]) - millis(prefix[1])) / 1000.0
    return a.join(b, "_slot").withColumn("time_delta_seconds", delta).where(F.col("time_delta_seconds") <= seconds).drop("_slot")


def pair_measures(pairs: DataFrame, rules: LinkRules) -> DataFrame:
    """Pairs (l_ and r_ columns) with distances, score and reject_reasons."""
    c = lambda side, name: F.col(f"{side}_{name}")
    gap = lambda name: F.abs(c("l", name) - c("r", name))
    out = pairs.withColumns({"distance_km": haversine_km(c("l", "latitude"), c("l", "longitude"), c("r", "latitude"), c("r", "longitude")), "depth_delta_km": gap("depth_km"), "magnitude_delta": gap("magnitude")})
    measures: tuple[Column, ...] = tuple(F.col(n) for n in ("time_delta_seconds", "distance_km", "depth_delta_km", "magnitude_delta"))
    out = out.withColumn("match_score", match_score(*measures, rules))
    return out.withColumn("reject_reasons", all_reasons(threshold_reasons(*measures, F.col("match_score"), rules)))


def ambiguous_pairs(qualifying: DataFrame, margin: float) -> DataFrame:
    """Pairs with `ambiguous`: an end belongs to an observation whose two best scores are less than the margin apart.

    Such an observation makes itself and all its partners ambiguous, and that isn't passed on.
    """
    out = qualifying
    for side in ("l", "r"):
        me = Window.partitionBy(f"{side}_source_observation_id")
        rank = F.row_number().over(me.orderBy(F.col("match_score").desc()))
        out = out.withColumn("_rank", rank)
        best, next_best = (F.max(F.when(F.col("_rank") == k, F.col("match_score"))).over(me) for k in (1, 2))
        out = out.withColumn(f"_close_{side}", F.coalesce(best - next_best < margin, F.lit(False)))
    for side in ("l", "r"):
        # flagged itself, or partner of a flagged one
        me = Window.partitionBy(f"{side}_source_observation_id")
        out = out.withColumn(f"_flag_{side}", F.max(F.col("_close_l") | F.col("_close_r")).over(me))
    return out.withColumn("ambiguous", F.col("_flag_l") | F.col("_flag_r")).drop("_rank", "_close_l", "_close_r", "_flag_l", "_flag_r")


def match_one_to_one(pairs: DataFrame, order: list[Column], left: str, right: str) -> DataFrame:
    """The pairs that greedy matching in the given total order accepts.

    A pair that comes first for both its ends is what greedy matching takes; taking all such pairs at once, dropping
    pairs that touch them and going on gives the same result in few rounds. Rounds go to the checkpoint folder, and end
    by themselves: the first of all pairs left is best for both its ends. A null end matches nothing.
    """
    left_over, taken = pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()), None
    while True:
        first = lambda key: F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1
        marked = left_over.withColumn("_best", first(left)).withColumn("_best", F.col("_best") & first(right))
        marked = keep(marked, "match")
        best = marked.where("_best").drop("_best")
        taken = best if taken is None else taken.unionByName(best)
        rest = marked.where("not _best").drop("_best")
        for key in (left, right):
            rest = rest.join(best.select(key), key, "left_anti")
        left_over = rest.select(*pairs.columns)
        if left_over.isEmpty():
            return taken.select(*pairs.columns)


def evaluate_links(feed: DataFrame, bulletin: DataFrame, rules: LinkRules) -> DataFrame:
    """Every pair within the time threshold with its link_decision ACCEPTED, REJECTED or AMBIGUOUS and reason codes."""
    extra = ("source_record_key", "quality_status", "determining_agency_code")
    cols = [c for c in (*SIDE, *extra) if c in feed.columns]
    pairs = pair_measures(time_pairs(feed.select(*cols), bulletin.select(*cols), rules.seconds), rules)
    pairs = pairs.withColumn("source_link_id", link_id(F.lit(rules.model), F.col("l_source_observation_id"), F.col("r_source_observation_id")))
    pairs = keep(pairs, "pairs")
    good = keep(ambiguous_pairs(pairs.where("size(reject_reasons) = 0"), rules.ambiguity), "qualifying")
    order = [F.col("match_score").desc(), F.col("l_event_time_utc"), F.col("l_source_observation_id"), F.col("r_event_time_utc"), F.col("r_source_observation_id")]
    clear = good.where("not ambiguous").drop("ambiguous")
    taken = match_one_to_one(clear, order, "l_source_observation_id", "r_source_observation_id").select("source_link_id").withColumn("_taken", F.lit(True))
    code = lambda x: F.array(F.lit(x))
    good = good.join(taken, "source_link_id", "left")
    good = good.withColumn("link_decision", F.when(F.col("ambiguous"), "AMBIGUOUS").when(F.col("_taken"), "ACCEPTED").otherwise("REJECTED"))
    good = good.withColumn("reject_reasons", F.when(F.col("ambiguous"), code("AMBIGUOUS_SOURCE_MATCH")).when(F.col("_taken"), F.col("reject_reasons")).otherwise(code("SUBOPTIMAL_CANDIDATE")))
    failed = pairs.where("size(reject_reasons) > 0").withColumn("link_decision", F.lit("REJECTED"))
    return failed.unionByName(good.drop("ambiguous", "_taken"))


def memberships(observations: DataFrame, links: DataFrame, rules: LinkRules) -> DataFrame:
    """(canonical_event_id, source_observation_id, membership_status, source_link_id, canonical_model_version).

    An accepted pair is one event, primary the bulletin's observation if that is valid and of a preferred agency. All
    others are primary in an event of their own.
    """
    pairs = links.where("link_decision = 'ACCEPTED'")
    preferred = F.coalesce((F.upper("r_quality_status") == "VALID") & F.upper("r_determining_agency_code").isin("J", "K"), F.lit(False))
    event = F.when(preferred, canonical_id(F.lit("JMA_BULLETIN"), F.col("r_source_record_key"))).otherwise(canonical_id(F.lit("USGS"), F.col("l_source_record_key")))
    status = lambda primary: F.when(primary, "PRIMARY").otherwise("SUPPORTING")
    ends = F.array(F.struct(F.col("l_source_observation_id").alias("id"), status(~preferred).alias("status")), F.struct(F.col("r_source_observation_id").alias("id"), status(preferred).alias("status")))
    paired = pairs.select(event.alias("canonical_event_id"), "source_link_id", F.explode(ends).alias("e"))
    paired = paired.select("canonical_event_id", F.col("e.id").alias("source_observation_id"), F.col("e.status").alias("membership_status"), "source_link_id")
    alone = observations.join(paired.select("source_observation_id"), "source_observation_id", "left_anti")
    alone = alone.select(canonical_id(F.col("source_system"), F.col("source_record_key")).alias("canonical_event_id"), "source_observation_id", F.lit("PRIMARY").alias("membership_status"), F.lit(None).cast("string").alias("source_link_id"))
    return paired.unionByName(alone).withColumn("canonical_model_version", F.lit(rules.canonical_model))


def resolve(observations: DataFrame, rules: LinkRules | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, memberships) of the current observations of both feeds."""
    rules = rules or LinkRules()
    now = current_or_all(observations)
    links = evaluate_links(now.where("upper(source_system) = 'USGS'"), now.where("upper(source_system) = 'JMA_BULLETIN'"), rules)
    return links, memberships(now, links, rules)


def match_report(observations: DataFrame, links: DataFrame, members: DataFrame) -> DataFrame:
    """One row of counts, and the identity 2 * matched + single = current as a column."""
    by_event = members.join(observations.select("source_observation_id", "source_system"), "source_observation_id").groupBy("canonical_event_id").agg(F.bool_or(F.col("source_system") == "USGS").alias("u"), F.bool_or(F.col("source_system") == "JMA_BULLETIN").alias("j"), F.count("*").alias("n"))
    events = by_event.agg(F.count("*").alias("canonical_events"), F.count_if(F.col("u") & F.col("j")).alias("matched_events"), F.count_if(F.col("u") & ~F.col("j")).alias("usgs_only"), F.count_if(F.col("j") & ~F.col("u")).alias("jma_only"), F.sum("n").alias("observations"))
    decisions = links.agg(F.count("*").alias("candidate_pairs"), *(F.count_if(F.col("link_decision") == d).alias(d.lower()) for d in ("ACCEPTED", "REJECTED", "AMBIGUOUS")))
    return events.crossJoin(decisions).withColumn("balanced", F.expr("2 * matched_events + usgs_only + jma_only = observations and matched_events = accepted"))  # one row each
