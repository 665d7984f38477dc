"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Each source gets a target number of words. Complete epochs over a source come first; the rest of its target is drawn
without replacement: every document has an exponential key whose rate is its quality weight, keys are sorted within the
source and sizes are summed along them until the budget is spent. The last document is cut at the budget.

The prefix sums are distributed: keys fall into BUCKETS ranges of about equal probability, sums over the ranges of a
source are summed first, and only within a range are rows sorted. A source with a third of all rows is BUCKETS pieces.

Defined cases: a null text has size 0; a null source is a source and comes last; documents of size 0 take 0; no words at
all: every target is 0; rows that share an id are drawn separately, in the order of their sizes and checksums; no rows: no rows. Columns other
than doc_id, text, source and the named weight are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, workspace

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
#: A source is repeated at most so many times.
EPOCHS = 2
BUCKETS = 4096
SEED = "mix-1"
#: Words, and signs that mark junk in a text.
WORD, JUNK = r"[^\x20\x09-\x0D]+", r"[$%&*#|!]"


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Weights repeat over the sources in code point order, null last. Targets stop at epochs * source_size, and what is
    above is shared out again by weight until none is above. In the order of limit / weight the sources at their limit
    come first, so the common level of all others follows from sums over that order.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("w", weight).withColumn("cap", epochs * F.col("source_size").cast("double"))
    by = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everywhere = Window.partitionBy(F.lit(0))
    s = s.withColumn("place", F.row_number().over(by))
    total = share * F.sum("source_size").over(everywhere)
    before = F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (total - before) / rest).withColumn("full", F.col("level") > F.col("cap") / F.col("w"))
    level = F.min(F.when(~F.col("full"), F.struct("place", "level"))).over(everywhere)["level"]
    return s.withColumn("target", F.round(F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * level), 6)).select("source", "source_size", "target")


def keyed(docs: DataFrame, seed: str = SEED, quality: str | None = None) -> DataFrame:
    """Size, quality weight and exponential key of each document; tie breaks rows of one id.

    quality: a column with the weights, such as the quality classifier's scores; 1e-6 at least, and for nulls. Without one
    the weight falls with the signs of junk per word.
    """
    text = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.regexp_count(text, F.lit(JUNK)).alias("junk"), F.crc32(text).alias("tie"), (F.col(quality).cast("double") if quality else F.lit(1.0)).alias("given"))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double")
    weight = F.greatest(F.lit(1e-6), F.coalesce(F.nanvl("given", F.lit(0.0)), F.lit(0.0))) if quality else F.when(F.col("size") > 0, 1.0 / (1.0 + F.col("junk") / F.col("size"))).otherwise(1.0)
    return sized.select("doc_id", "source", "size", "tie", weight.alias("weight"), (-F.log((bits + 0.5) / float(2**52)) / weight).alias("key"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED, quality: str | None = None) -> DataFrame:
    """(doc_id, source, size, tie, weight, key, source_size, target, epochs, extra, taken) for each document.

    epochs: complete passes over its source. extra: words that the fractional draw takes of it. taken: both, in words.
    """
    with workspace() as w:
        rows = keyed(docs, seed, quality).withColumn("bucket", F.least(F.lit(BUCKETS - 1), F.floor(BUCKETS * (1 - F.exp(-F.col("key"))))).cast("int"))
        rows = materialize(rows, "mix-keys")
        parts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
        aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs)
        parts, aims = parts.select(F.col("source").alias("s1"), F.col("bucket").alias("b1"), "before"), aims.withColumnRenamed("source", "s2")
        parts = parts.join(aims, F.col("s1").eqNullSafe(F.col("s2"))).drop("s2")
        inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        rows = rows.join(parts, F.col("source").eqNullSafe(F.col("s1")) & (F.col("bucket") == F.col("b1")))
        passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
        rows = rows.withColumn("epochs", passes)
        budget = F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5)
        extra = F.greatest(F.lit(0), F.least("size", budget - F.col("before") - F.col("inside"))).cast("long")
        rows = rows.withColumn("extra", extra).withColumn("taken", F.col("epochs") * F.col("size") + F.col("extra"))
        return w.result(rows.select("doc_id", "source", "size", "tie", "weight", "key", "source_size", "target", "epochs", "extra", "taken"), "mix-result")

ORACLE = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
k AS (SELECT doc_id, source, size, -ln((CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / {float(2**52)})
  / CASE WHEN size > 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + len(regexp_extract_all(text, '{JUNK}'))::DOUBLE / size) ELSE 1.0::DOUBLE END AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS place, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / w, source ASC NULLS LAST)),
t AS (SELECT source, source_size, round(CASE WHEN level > cap / w THEN cap ELSE w * (SELECT min_by(level, place) FROM l WHERE NOT level > cap / w) END, 6) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
r AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, floor(e.target - e.epochs * e.source_size + 0.5) AS budget,
  coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, budget - before)) AS BIGINT) AS taken FROM r
"""
