"""Serving views and verification queries over the star and over experiment results.

Views are registered for SQL users; verification queries return the rows that break a rule, so an empty result passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollup
from ..operators.windows import each_member, each_pair, weight
from ..session import keep

PUBLISHED = ("CANDIDATE", "APPROVED")
GATE = "experiment_status IN ('CANDIDATE', 'APPROVED')"


def register_gold(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Registers event_current, v_event_daily and v_event_monthly; returns the two aggregates."""
    days = rollup.daily(events, honest_unknowns=True)
    months = rollup.monthly(days)
    for df, name in ((events, "event_current"), (days, "v_event_daily"), (months, "v_event_monthly")):
        df.createOrReplaceTempView(name)
    return days, months


def gold_checks(events: DataFrame, days: DataFrame, months: DataFrame) -> dict[str, DataFrame]:
    """Seven checks of the aggregates: totals, double counts, monthly and daily parity, honest nulls, grain."""
    facts = events.where("is_natural_earthquake and is_in_study_area")
    total = facts.agg(F.count("*").alias("fact_event_count")).crossJoin(days.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("daily_agg_event_count")))
    per_day = facts.groupBy("event_date_key_jst").agg(F.count_distinct("canonical_event_id").alias("event_count"))
    counts = [n for n in rollup.measures() if n.endswith("_count")]
    near = ["magnitude_sum", "magnitude_avg", "magnitude_max", "depth_sum", "depth_avg"]
    return {
        "total_delta": total.withColumn("delta", F.col("fact_event_count") - F.col("daily_agg_event_count")),
        "double_count": rollup.parity(per_day, days.groupBy("event_date_key_jst").agg(F.sum("event_count").alias("event_count")), ["event_date_key_jst"], ["event_count"], []),
        "monthly_parity": rollup.parity(rollup.monthly(days), months, ["year_month_jst", *rollup.GRAIN], ["region_name", "region_category", *counts], near),
        "daily_parity": rollup.parity(rollup.daily(events, honest_unknowns=True), days, ["event_date_key_jst", *rollup.GRAIN], counts, near),
        "honest_nulls": rollup.dishonest_nulls(days).select("year_month_jst", *rollup.GRAIN).withColumn("source_view", F.lit("v_event_daily")).unionByName(rollup.dishonest_nulls(months).select("year_month_jst", *rollup.GRAIN).withColumn("source_view", F.lit("v_event_monthly"))),
        "daily_grain": rollup.repeated_grain(days, "event_date_key_jst"),
        "monthly_grain": rollup.repeated_grain(months, "year_month_jst"),
    }


def blockers(events: DataFrame, bridge: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(blocker, violations) that keep a run from being published; all must be 0.

    Dimensions are small tables and broadcast by size; fact and bridge meet once, on the event.
    """
    c = F.col
    unique = lambda df, *keys: df.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("violations"))
    per_event = bridge.groupBy("canonical_event_id").agg(F.count("*").alias("n"), F.count_if("is_primary").alias("p"), F.max(F.when(c("is_primary"), c("source_observation_id"))).alias("o"), F.bool_or(c("source_system") == "USGS").alias("u"), F.bool_or(c("source_system") == "JMA_BULLETIN").alias("j"))
    star = events.join(per_event, "canonical_event_id", "full_outer")
    rules = {
        "required_fields": c("event_time_utc").isNull() | c("latitude").isNull() | c("longitude").isNull(),
        "bridge_lineage": c("n").isNull() | c("event_time_utc").isNull(),
        "source_counts": ~(c("n").eqNullSafe(c("source_count")) & c("u").eqNullSafe(c("has_usgs")) & c("j").eqNullSafe(c("has_jma"))),
        "primary_provenance": (c("p") != 1) | ~c("o").eqNullSafe(c("primary_observation_id")),
        "utc_jst": (F.unix_seconds(F.to_timestamp(c("event_time_jst"))) - F.unix_seconds("event_time_utc")) != 9 * 3600,
    }
    counted = star.agg(*(F.count_if(F.coalesce(r, F.lit(True))).alias(n) for n, r in rules.items()))
    out = counted.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, rules)), F.array(*rules))).alias("blocker", "violations"))
    for name, (df, key, fact_keys) in {n: (dims[n], k, f) for n, k, f in (("dim_date", "date_key", ("event_date_key_utc", "event_date_key_jst")), ("dim_region", "region_key", ("region_key",)), ("dim_magnitude_band", "band_code", ("magnitude_band_code",)), ("dim_depth_band", "band_code", ("depth_band_code",)))}.items():
        out = out.unionByName(unique(df, key).withColumn("blocker", F.lit(f"unique_{name}")))
        for fk in fact_keys:
            missing = events.join(df.select(c(key).alias(fk)), fk, "left_anti").agg(F.count("*").alias("violations"))
            out = out.unionByName(missing.withColumn("blocker", F.lit(f"{name}_{fk}")))
    out = out.unionByName(unique(events, "canonical_event_id").withColumn("blocker", F.lit("unique_event")))
    return out.unionByName(unique(bridge, "source_observation_id").withColumn("blocker", F.lit("unique_observation")))


EXPERIMENT_VIEWS = {
    "v_experiment_runs": f"SELECT e.*, d.dataset_split, d.feature_version, d.scaling_config_version FROM experiment_run e JOIN dataset_manifest d USING (dataset_id) WHERE {GATE}",
    "v_algorithm_comparison": f"""
        SELECT e.experiment_run_id, e.dataset_id, e.algorithm_name, count(*) AS total_windows,
               count_if(s.window_result_status = 'SUCCESS') AS success_windows, count_if(s.window_result_status = 'FAILED') AS failure_windows,
               count_if(s.window_result_status = 'SKIPPED') AS skipped_windows, try_divide(count_if(s.window_result_status = 'FAILED'), count(*)) AS failure_rate,
               sum(s.candidate_count) AS total_candidates, sum(s.sequence_member_count) AS total_sequence_members, sum(s.aftershock_count) AS raw_aftershock_memberships,
               sum(s.foreshock_candidate_count) AS total_foreshock_candidates, avg(s.noise_ratio) AS avg_noise_ratio, avg(s.dbcv_score) AS avg_dbcv_score, count(s.dbcv_score) AS dbcv_computed_windows,
               avg(s.omori_p) AS avg_omori_p, count(s.omori_p) AS omori_fitted_windows
        FROM experiment_run e JOIN sequence_summary s USING (experiment_run_id) WHERE {GATE} GROUP BY ALL""",
    "v_failure_windows": f"SELECT s.dataset_id, s.experiment_run_id, s.algorithm_name, s.mainshock_event_id, s.window_result_status, s.failure_reason_code, s.candidate_count FROM sequence_summary s LEFT SEMI JOIN (SELECT * FROM experiment_run WHERE {GATE}) e USING (experiment_run_id) WHERE s.window_result_status IN ('FAILED', 'SKIPPED')",
    "v_sequence_memberships_resolved": f"SELECT m.*, coalesce(m.is_sequence_member AND m.event_role_candidate = 'POST' AND m.resolution_rank = 1, false) AS is_resolved_unique_aftershock FROM sequence_membership m LEFT SEMI JOIN (SELECT * FROM experiment_run WHERE {GATE}) e USING (experiment_run_id)",
}

EXPERIMENT_CHECKS = {
    "gate_leak": f"SELECT experiment_run_id FROM v_experiment_runs WHERE NOT {GATE}",
    "denominator": "SELECT s.experiment_run_id, s.mainshock_event_id, s.candidate_count, coalesce(sum(w.candidates), 0) AS n FROM sequence_summary s LEFT JOIN window_membership w USING (experiment_run_id, mainshock_event_id) GROUP BY ALL HAVING s.candidate_count <> n",
    "aftershock_count": "SELECT s.experiment_run_id, s.mainshock_event_id, s.aftershock_count, coalesce(sum(w.posts), 0) AS n FROM sequence_summary s LEFT JOIN window_membership w USING (experiment_run_id, mainshock_event_id) WHERE s.window_result_status = 'SUCCESS' GROUP BY ALL HAVING coalesce(s.aftershock_count, 0) <> n",
    "failure_reason": "SELECT experiment_run_id, mainshock_event_id FROM sequence_summary WHERE window_result_status IN ('FAILED', 'SKIPPED') AND failure_reason_code IS NULL",
    "window_dbcv": "SELECT experiment_run_id, mainshock_event_id FROM sequence_summary WHERE algorithm_name = 'WINDOW' AND dbcv_score IS NOT NULL",
    "resolved_unique": "SELECT experiment_run_id, candidate_event_id FROM first_choices WHERE n > 1",
    "orphan_lineage": "SELECT e.experiment_run_id FROM experiment_run e LEFT ANTI JOIN dataset_manifest d USING (dataset_id)",
}


def register_experiments(spark: SparkSession, runs: DataFrame, manifests: DataFrame, members: DataFrame | None, summaries: DataFrame, classes: DataFrame | None = None, checked: bool = False, counted: DataFrame | None = None, firsts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Registers the tables and the four views of results; the gate shows candidate and approved runs only.

    Members may be those of `classes`. Of them the checks take counts by window and by candidate, so that members never
    meet the summaries row by row. `checked`: the checks follow, so what several of them read is kept. `counted`: the
    members with what the counts need only; with `firsts` (experiment_run_id, candidate_event_id, n: how often a candidate
    after the mainshock is first) these may be runs, and without members their view and that of the resolved ones are left out.
    """
    rows = members if counted is None else counted
    post = F.col("is_sequence_member") & (F.col("event_role_candidate") == "POST")
    copies, shocks = weight(rows, "copies"), weight(rows, "shocks")
    count = lambda x, w: F.coalesce(F.sum(F.when(x, w)), F.lit(0))
    per = rows.groupBy("experiment_run_id", "mainshock_event_id").agg(count(F.col("candidate_event_id").isNotNull(), copies).alias("candidates"), count(post, copies).alias("posts"))
    if firsts is None:
        who = F.col("candidate_event_id" if classes is None else "candidate_class").alias("candidate_event_id")
        firsts = rows.where(post & (F.col("resolution_rank") == 1)).groupBy("experiment_run_id", who).agg(F.sum(shocks).alias("n"))
    if classes is not None:
        per, firsts = each_member(per, classes, "mainshock_event_id"), each_member(firsts, classes, "candidate_event_id")
    if checked:
        summaries, per = keep(summaries, "summaries"), keep(per, "window_membership")
    if members is not None:
        each_pair(members).createOrReplaceTempView("sequence_membership")
    for df, name in ((runs, "experiment_run"), (manifests, "dataset_manifest"), (summaries, "sequence_summary"), (per, "window_membership"), (firsts, "first_choices")):
        df.createOrReplaceTempView(name)
    out = {}
    for name, sql in EXPERIMENT_VIEWS.items():
        if members is None and "FROM sequence_membership " in sql:
            continue
        out[name] = spark.sql(sql)
        out[name].createOrReplaceTempView(name)
    return out


def experiment_checks(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.sql(sql) for name, sql in EXPERIMENT_CHECKS.items()}


def result_contract(members: DataFrame, summaries: DataFrame) -> dict[str, int]:
    """How often the result bundle's rules are broken."""
    from ..operators.validate import violations

    c = F.col
    p = c("membership_probability")
    rows = violations(members, {
        "role": ~F.coalesce(c("event_role_candidate").isin("MAINSHOCK", "PRE", "POST"), F.lit(False)),
        "probability": p.isNotNull() & ~p.between(0.0, 1.0),
        "noise_and_cluster": c("is_noise").isNotNull() & (c("is_noise") != (c("cluster_id") < 0)),
        "status": ~F.coalesce(c("multi_sequence_status").isin("UNIQUE", "MULTIPLE", "AMBIGUOUS", "NOT_MEMBER"), F.lit(False)),
        "rank_of_non_member": ~c("is_sequence_member") & c("resolution_rank").isNotNull(),
        "distance": ~F.coalesce(c("normalized_distance") >= 0, F.lit(False)),
    })
    counts = members.groupBy("mainshock_event_id").agg(F.count("*").alias("n"), F.count_if("is_sequence_member").alias("m"))
    both = summaries.join(counts, "mainshock_event_id", "full_outer")
    return rows | violations(both, {"candidate_count": ~c("candidate_count").eqNullSafe(c("n")), "member_count": (c("window_result_status") == "SUCCESS") & ~c("sequence_member_count").eqNullSafe(c("m")), "failed_has_counts": (c("window_result_status") == "FAILED") & c("sequence_member_count").isNotNull()})


def kpis(spark: SparkSession, events: DataFrame, **slicers: str | int | None) -> DataFrame:
    """One row of key figures under slicers year, month, region, magnitude_band, depth_band, coverage; None doesn't filter."""
    events.createOrReplaceTempView("kpi_events")
    names = ("year", "month", "region", "magnitude_band", "depth_band", "coverage")
    args = {n: slicers.get(n) for n in names}
    ym = "event_date_key_jst div 100"
    return spark.sql(
        f"""SELECT count(DISTINCT canonical_event_id) AS events, avg(magnitude) AS avg_magnitude, max(magnitude) AS max_magnitude, avg(depth_km) AS avg_depth_km,
        count_if(magnitude >= 5) AS strong_events, count_if(tsunami_flag) AS tsunami_events FROM kpi_events
        WHERE is_natural_earthquake AND is_in_study_area AND (:year IS NULL OR {ym} div 100 = :year) AND (:month IS NULL OR {ym} % 100 = :month)
        AND (:region IS NULL OR region_key = :region) AND (:magnitude_band IS NULL OR magnitude_band_code = :magnitude_band)
        AND (:depth_band IS NULL OR depth_band_code = :depth_band) AND (:coverage IS NULL OR source_coverage_code = :coverage)""",
        args=args,
    )


def register_gated(df: DataFrame, view: str, status: DataFrame, publication: str) -> DataFrame:
    """Registers a view of df that has rows only while `status` (publication_id, verify_status) says that the publication passed.

    The gate is read with every query of the view, so a publication that is withdrawn empties it without a new view.
    """
    source, gate = f"{view}_rows", f"{view}_status"
    df.createOrReplaceTempView(source)
    status.createOrReplaceTempView(gate)
    spark = df.sparkSession
    quoted = publication.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS SELECT * FROM {source} WHERE EXISTS (SELECT 1 FROM {gate} WHERE publication_id = '{quoted}' AND verify_status = 'PASSED')")
    return spark.table(view)


def scope_violations(before: DataFrame, after: DataFrame, days: DataFrame, month: Column, affected: list[str]) -> DataFrame:
    """(blocker, violations) of a publication that claims to change some months only.

    outside_scope_removed and _added: rows of other months that only one of the snapshots has, repeats counted;
    aggregate_count: natural events in the area less the events of the daily aggregate, without sign. A row without a
    month lies outside.
    """
    outside = F.coalesce(~month.isin(affected), F.lit(True))
    digest = sorted(set(before.columns) & set(after.columns))
    if len(digest) != len(before.columns) or len(digest) != len(after.columns):
        raise ValueError("the snapshots have other columns")
    sides = [df.where(outside).select(*digest, F.lit(x).alias("side_")) for df, x in ((before, -1), (after, 1))]
    # grouping holds nulls equal; one shuffle for both directions
    net = sides[0].unionByName(sides[1]).groupBy(*digest).agg(F.sum("side_").alias("net_"))
    found = net.agg(*(F.coalesce(F.sum(F.greatest(x, F.lit(0))), F.lit(0)).cast("long").alias(n) for n, x in (("outside_scope_removed", -F.col("net_")), ("outside_scope_added", F.col("net_")))))
    facts = after.where("is_natural_earthquake and is_in_study_area").agg(F.count("*").alias("n"))
    held = days.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("m"))
    one = found.crossJoin(facts).crossJoin(held).withColumn("aggregate_count", F.abs(F.col("n") - F.col("m")))  # a row each
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("blocker"), F.col(n).cast("long").alias("violations")) for n in ("outside_scope_removed", "outside_scope_added", "aggregate_count")))))
