"""Members of several sequences, and mainshocks nested in another's sequence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-6


def resolve_sequences(members: DataFrame, eps: float = EPS) -> DataFrame:
    """Members with multi_sequence_status UNIQUE, MULTIPLE, AMBIGUOUS or NOT_MEMBER and resolution_rank.

    A candidate in one sequence is UNIQUE. In several, the best rows (probability, then distance, each within eps of the
    best) decide: one row wins rank 1, a tie makes the candidate AMBIGUOUS. Lower ranks go on in the same way until a
    tie, from where the mainshock's id decides.

    "Within eps" is no order, but where each run of probabilities less than eps apart spans at most eps (all real cases),
    taking the best row again and again is sorting by (run, distance) up to the first neighbours in a run whose distances
    tie. That is two sorted windows over a candidate's rows. Candidates with a longer run are folded row by row.
    """
    c = F.col
    names = [n for n in members.columns if n not in ("multi_sequence_status", "resolution_rank")]
    # a member's columns go along as one, so that they can't clash with those made here
    member = members.where("is_sequence_member").select("candidate_event_id", "mainshock_event_id", F.coalesce("membership_probability", F.lit(0.0)).alias("p"), F.coalesce("normalized_distance", F.lit(0.0)).alias("d"), F.struct(*names).alias("all"))
    mine = Window.partitionBy("candidate_event_id")
    # where no probabilities of a candidate are further apart than eps, all its rows are one run
    apart = not member.groupBy("candidate_event_id").agg((F.max("p") - F.min("p") > eps).alias("apart")).where("apart").isEmpty()
    if apart:
        by_p = mine.orderBy(c("p").desc())
        rows = member.withColumn("_new", F.when(F.lag("p").over(by_p) - c("p") <= eps, 0).otherwise(1))
        rows = rows.withColumn("run", F.sum("_new").over(by_p.rowsBetween(Window.unboundedPreceding, 0)))
        in_run = Window.partitionBy("candidate_event_id", "run")
        rows = rows.withColumn("odd", F.max("p").over(in_run) - F.min("p").over(in_run) > eps)
        rows = rows.withColumn("odd", F.bool_or("odd").over(mine))
    else:
        rows = member.withColumns({"run": F.lit(1), "odd": F.lit(False)})
    best_first = mine.orderBy("run", "d", "mainshock_event_id")
    tied = (F.lead("run").over(best_first) == c("run")) & (F.lead("d").over(best_first) - c("d") <= eps)
    rows = rows.withColumn("at", F.row_number().over(best_first)).withColumn("tied", F.coalesce(tied, F.lit(False)))
    rows = rows.withColumns({"stop": F.min(F.when(c("tied"), c("at"))).over(mine), "n": F.count("*").over(mine)})
    late = F.coalesce(c("at") >= c("stop"), F.lit(False))
    rows = rows.withColumn("rank", F.when(~late, c("at")).otherwise(c("stop") - 1 + F.row_number().over(Window.partitionBy("candidate_event_id", late).orderBy("mainshock_event_id"))))
    rank = F.when((c("stop") == 1) & (c("n") > 1), None).otherwise(c("rank")).cast("int")
    ids = c("candidate_event_id").isNotNull() & c("mainshock_event_id").isNotNull()
    ranked = rows.where("not odd").select("all", F.when(ids, c("n")).alias("n"), F.when(ids, rank).alias("rank"))
    if apart:
        odd = rows.where("odd")
        ranked = ranked.unionByName(odd.drop("n", "rank").join(_fold_ranks(odd, eps), ["candidate_event_id", "mainshock_event_id"], "left").select("all", "n", "rank"))
    status = F.when(c("n") == 1, "UNIQUE").when(c("rank").isNull(), "AMBIGUOUS").otherwise("MULTIPLE")
    out = ranked.select("all.*", status.alias("multi_sequence_status"), c("rank").alias("resolution_rank"))
    others = members.where(~F.coalesce("is_sequence_member", F.lit(False)))
    said = F.when(~c("is_sequence_member"), "NOT_MEMBER").otherwise("AMBIGUOUS")
    return out.unionByName(others.select(*names, said.alias("multi_sequence_status"), F.lit(None).cast("int").alias("resolution_rank")))


def _fold_ranks(rows: DataFrame, eps: float) -> DataFrame:
    """Ranks of the candidates whose probabilities form a run that is longer than eps, one row after the other."""
    kind = dict(rows.dtypes)["candidate_event_id"], dict(rows.dtypes)["mainshock_event_id"]

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("mainshock_event_id", kind="stable").reset_index(drop=True)
        left, out = list(range(len(pdf))), []
        p, d = pdf["p"].to_numpy(), pdf["d"].to_numpy()
        while left:
            top = [i for i in left if max(p[left]) - p[i] <= eps]
            best = [i for i in top if d[i] - min(d[top]) <= eps]
            if len(best) > 1:
                break
            out += best
            left.remove(best[0])
        ranks = {i: k for k, i in enumerate(out + left, 1)} if out else {}
        return pd.DataFrame({"candidate_event_id": pdf["candidate_event_id"], "mainshock_event_id": pdf["mainshock_event_id"], "n": len(pdf), "rank": pd.array([ranks.get(i) for i in range(len(pdf))], dtype="Int32")})

    return rows.select("candidate_event_id", "mainshock_event_id", "p", "d").groupBy("candidate_event_id").applyInPandas(rank, f"candidate_event_id {kind[0]}, mainshock_event_id {kind[1]}, n long, rank int")


def nested_mainshocks(resolved: DataFrame, mains: DataFrame, eps: float = EPS) -> DataFrame:
    """(mainshock_event_id, is_nested, parent_mainshock_event_id, nested_probability, reason) for each mainshock.

    Nested: a member of another mainshock's sequence. Its parent is the sequence that it has rank 1 in, else the best
    of the others; if these tie there is no parent, but a reason.
    """
    c = F.col
    inside = resolved.where("is_sequence_member and candidate_event_id <> mainshock_event_id").join(mains.select(c("mainshock_event_id").alias("candidate_event_id")).distinct(), "candidate_event_id", "left_semi")
    w = Window.partitionBy("candidate_event_id")
    p, d = F.coalesce("membership_probability", F.lit(0.0)), F.coalesce("normalized_distance", F.lit(0.0))
    rows = inside.withColumn("top", F.max(p).over(w) - p <= eps)
    rows = rows.withColumn("near", c("top") & (d - F.min(F.when(c("top"), d)).over(w) <= eps))
    pick = F.struct("mainshock_event_id", "membership_probability")
    agg = rows.groupBy("candidate_event_id").agg(F.max(F.when(c("resolution_rank") == 1, pick)).alias("first"), F.max(F.when(c("near"), pick)).alias("best"), F.count_if("near").alias("k"))
    parent = F.coalesce("first", F.when(c("k") == 1, c("best")))
    agg = agg.select(c("candidate_event_id").alias("mainshock_event_id"), parent["mainshock_event_id"].alias("parent_mainshock_event_id"), parent["membership_probability"].alias("nested_probability"), F.when(parent.isNull(), "AMBIGUOUS_NESTED_PARENT_TIE").alias("reason"), F.lit(True).alias("is_nested"))
    return mains.select("mainshock_event_id").join(agg, "mainshock_event_id", "left").withColumn("is_nested", F.coalesce("is_nested", F.lit(False)))


def reconciliation(resolved: DataFrame) -> DataFrame:
    """One row of counts whose identities hold: raw = unique and first + ambiguous + taken out as duplicates."""
    c = F.col
    member, post = c("is_sequence_member"), c("event_role_candidate") == "POST"
    multi = c("multi_sequence_status").isin("MULTIPLE", "AMBIGUOUS")
    first = member & post & (c("resolution_rank") == 1)
    unclear = member & post & (c("multi_sequence_status") == "AMBIGUOUS")
    out = resolved.agg(F.count("*").alias("total_raw_memberships"), F.count_if(member).alias("raw_sequence_members"), F.count_if(member & post).alias("raw_aftershocks"), F.count_distinct(F.when(multi, c("candidate_event_id"))).alias("candidates_in_several"), F.count_if(first).alias("resolved_unique_aftershocks"), F.count_distinct(F.when(c("multi_sequence_status") == "AMBIGUOUS", c("candidate_event_id"))).alias("ambiguous_candidates"), F.count_if(unclear).alias("ambiguous_aftershocks"))
    return out.withColumn("deduplicated_aftershocks", c("raw_aftershocks") - c("resolved_unique_aftershocks") - c("ambiguous_aftershocks"))
