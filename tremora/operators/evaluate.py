"""Evaluation of sequence models: validity, decay law, stability under jitter, comparisons and split profiles."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import density
from .features import VECTOR
from .models import ModelConfig, fit_window, with_parameters

REPEATS, SIGMA, SEED = 5, 0.01, 42
SUPERVISED = ("accuracy", "precision", "recall", "f1", "roc_auc", "confusion_matrix")


def window_validity(feats: DataFrame, members: DataFrame) -> DataFrame:
    """(mainshock_event_id, dbcv_score, dbcv_reason, silhouette) of each window's clusters."""
    kind = dict(feats.dtypes)["mainshock_event_id"]
    rows = feats.select("mainshock_event_id", "candidate_event_id", *VECTOR).join(members.select("mainshock_event_id", "candidate_event_id", F.coalesce("cluster_id", F.lit(-1)).alias("label")), ["mainshock_event_id", "candidate_event_id"])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        x, label = pdf[list(VECTOR)].to_numpy(float), pdf["label"].to_numpy()
        score, reason = density.dbcv(x, label)
        return pd.DataFrame({"mainshock_event_id": [pdf["mainshock_event_id"].iloc[0]], "dbcv_score": [score], "dbcv_reason": [reason], "silhouette": [density.silhouette(x, label)]})

    return rows.groupBy("mainshock_event_id").applyInPandas(one, f"mainshock_event_id {kind}, dbcv_score double, dbcv_reason string, silhouette double")


def omori_fits(feats: DataFrame, members: DataFrame) -> DataFrame:
    """(mainshock_event_id, omori_k, omori_c, omori_p, omori_fit_metric, reason, n) of each window's aftershocks."""
    kind = dict(feats.dtypes)["mainshock_event_id"]
    post = members.where("is_sequence_member and event_role_candidate = 'POST'").select("mainshock_event_id", "candidate_event_id")
    rows = feats.select("mainshock_event_id", "candidate_event_id", "delta_time_hours").join(post.withColumn("_post", F.lit(True)), ["mainshock_event_id", "candidate_event_id"], "left")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        hours = pdf.loc[pdf["_post"].notna(), "delta_time_hours"].to_numpy(float)
        return pd.DataFrame([{"mainshock_event_id": pdf["mainshock_event_id"].iloc[0]} | density.fit_omori(hours)])

    return rows.groupBy("mainshock_event_id").applyInPandas(one, f"mainshock_event_id {kind}, omori_k double, omori_c double, omori_p double, omori_fit_metric double, reason string, n long")


def stability(feats: DataFrame, config: ModelConfig, repeats: int = REPEATS, sigma: float = SIGMA, seed: int = SEED) -> DataFrame:
    """How far a window's members and clusters hold when features are jittered: pairwise Jaccard and adjusted Rand.

    Each repeat of a window is a group of its own, fitted with the window's parameters; only labels meet again. Noise is
    drawn in the order of candidate ids, four numbers a candidate and none for the mainshock, which isn't moved. A repeat
    that fails is counted, never replaced. Without its mainshock a window has nothing to compare: METRIC_NOT_APPLICABLE;
    with fewer than two valid repeats the reason is METRIC_FIT_FAILED.
    """
    if repeats < 2 or not np.isfinite(sigma) or sigma < 0:
        raise ValueError("stability takes at least 2 repeats and a finite sigma >= 0")
    kind = dict(feats.dtypes)["mainshock_event_id"]
    stats = [f"{s}_{m}" for m in ("jaccard", "ari") for s in ("mean", "std", "min", "max")]
    rows = with_parameters(feats, config).withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("candidate_event_id", kind="stable").reset_index(drop=True)
        shock, r = pdf["mainshock_event_id"].iloc[0], int(pdf["repeat"].iloc[0])
        moves = (pdf["candidate_event_id"] != shock).to_numpy()
        out = {"mainshock_event_id": shock, "whole": not moves.all(), "labels": None, "members": None}
        if out["whole"]:
            x = pdf[list(VECTOR)].to_numpy(float)
            if sigma:
                x[moves] += np.random.RandomState(seed + 100 * r).normal(0.0, sigma, (moves.sum(), x.shape[1]))
            try:
                out["labels"], out["members"] = fit_window(config, x, ~moves, pdf["relative_time_role"].to_numpy(), int(pdf["size"].iloc[0]), int(pdf["samples"].iloc[0]))
            except (ValueError, FloatingPointError):
                pass
        return pd.DataFrame([out])

    fitted = rows.groupBy("mainshock_event_id", "repeat").applyInPandas(one, f"mainshock_event_id {kind}, whole boolean, labels array<int>, members array<boolean>")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        runs = [(np.array(a), frozenset(np.flatnonzero(m))) for a, m in zip(pdf["labels"], pdf["members"]) if a is not None]
        pairs = list(itertools.combinations(runs, 2))
        values = {"jaccard": [density.jaccard(a, b) for (_, a), (_, b) in pairs], "ari": [density.adjusted_rand(a, b) for (a, _), (b, _) in pairs]}
        whole = bool(pdf["whole"].iloc[0])
        row = {"mainshock_event_id": pdf["mainshock_event_id"].iloc[0], "valid_repeats": len(runs), "failed_repeats": len(pdf) - len(runs) if whole else 0, "valid_pairs": len(pairs)}
        row["reason"] = None if pairs else "METRIC_FIT_FAILED" if whole else "METRIC_NOT_APPLICABLE"
        for m, v in values.items():
            for name, f in (("mean", np.mean), ("std", np.std), ("min", np.min), ("max", np.max)):
                row[f"{name}_{m}"] = float(f(v)) if v else None
        return pd.DataFrame([row])

    schema = f"mainshock_event_id {kind}, valid_repeats int, failed_repeats int, valid_pairs int, reason string, " + ", ".join(f"{s} double" for s in stats)
    return fitted.groupBy("mainshock_event_id").applyInPandas(compare, schema)


def evaluate_model(feats: DataFrame, members: DataFrame, summary: DataFrame) -> DataFrame:
    """One row for each algorithm. Failed windows stay in the denominator; metrics average the windows that have them."""
    scored = summary.join(window_validity(feats, members), "mainshock_event_id", "left").join(omori_fits(feats, members).select("mainshock_event_id", "omori_p"), "mainshock_event_id", "left")
    c = F.col
    window = c("algorithm_name") == "WINDOW"
    return scored.groupBy("algorithm_name").agg(
        F.count("*").alias("total_windows"),
        F.count_if(c("window_result_status") == "SUCCESS").alias("success_windows"),
        (F.count_if(c("window_result_status") == "FAILED") / F.count("*")).alias("failure_rate"),
        F.sum("aftershock_count").alias("aftershocks"),
        F.avg("noise_ratio").alias("avg_noise_ratio"),
        F.avg(F.when(~window, c("dbcv_score"))).alias("avg_dbcv_score"),
        F.count(F.when(~window, c("dbcv_score"))).alias("dbcv_windows"),
        F.avg("omori_p").alias("avg_omori_p"),
        F.count("omori_p").alias("omori_windows"),
    )


def comparison(evaluated: DataFrame) -> DataFrame:
    """The rows of evaluate_model as text, N/A for what a model has no value of."""
    text = lambda n, places: F.coalesce(F.format_number(n, places), F.lit("N/A")).alias(n)
    return evaluated.select("algorithm_name", F.concat(F.format_number(F.col("failure_rate") * 100, 1), F.lit("%")).alias("failure_rate"), F.coalesce(F.col("aftershocks").cast("string"), F.lit("N/A")).alias("aftershocks"), text("avg_dbcv_score", 4), text("avg_omori_p", 2))


def distribution(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Minimum, quartile, median, mean, 95th percentile and maximum, with linear interpolation."""
    q = F.percentile(column, F.array(*map(F.lit, (0.25, 0.5, 0.95))))
    out = df.groupBy(*by).agg(F.count(column).alias("n"), F.min(column).alias("min"), q.alias("q"), F.avg(column).alias("mean"), F.max(column).alias("max"))
    return out.select(*by, "n", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("median"), "mean", F.col("q")[2].alias("p95"), "max")


def split_profile(reproduction: DataFrame, extension: DataFrame, metrics: list[str], key: str = "algorithm_name", tolerance: float = 0.1) -> DataFrame:
    """Metrics of two splits side by side with their change, and whether the first one's failure rate carries over."""
    a, b = (df.select(key, *(F.col(m).alias(f"{p}_{m}") for m in metrics)) for p, df in (("repro", reproduction), ("ext", extension)))
    out = a.join(b, key, "full_outer").withColumns({f"delta_{m}": F.col(f"ext_{m}") - F.col(f"repro_{m}") for m in metrics})
    delta = F.col(f"delta_{metrics[0]}")
    return out.withColumn("generalization", F.when(delta.isNull(), "NOT_COMPARABLE").when(F.abs(delta) <= tolerance, "STABLE").when(delta > 0, "DEGRADED").otherwise("IMPROVED"))


def refuse_supervised(metrics: list[str]) -> None:
    """There is no ground truth for sequences, so metrics that need one are an error."""
    if bad := sorted({m.lower() for m in metrics} & set(SUPERVISED)):
        raise ValueError(f"no labels exist for {bad}")
