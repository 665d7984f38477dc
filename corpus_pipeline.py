"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

toxicity: documents that the severity model rejects go. similarity: of each component of documents linked by similar sets
of shingles, one stays. decontamination: documents that cover a benchmark item go. mixing: documents are repeated or left
out so that the sources come near their target weights. sharding: documents are dealt to shards. All stages but the last
return the columns of documents, and carry further columns along whatever their names.

Defined cases: of a component the row with the smallest id stays, one without an id only if no row has one, then the one
of the smallest text digest; rows that share id and text are one document, of which one row stays (the first by language
and source); texts without words are linked with nothing. Rows without an id pass the other stages like any. The mix takes
rows that share id, source and text together, as often as the one that it takes most. A document at the end of a source's
budget is kept whole. No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremora.llm import decontamination, mixing, ngram_join, sharding, toxicity
from tremora.llm.common import forget, table, workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labels of what documents are left, and keeps those that the model doesn't reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind as keep it from being a column of df."""
    while name in df.columns:
        name += "_"
    return name


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component. The rest of its rows, and rows that repeat it, go."""
    del spark, sf_dir
    digest = F.md5(F.coalesce("text", F.lit("")))
    # sorts like the id, ids first, then the digest: rows without an id are told apart by their texts
    shifted = F.col("doc_id").cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    name = F.concat(F.coalesce(F.lpad(shifted.cast("string"), 20, "0"), F.lit("~")), digest)
    found = ngram_join.similar_sets(docs.select(name.alias("doc_id"), "text"))
    kept = free_name(docs, "kept")
    keep = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(kept)).agg(F.count("*").alias("n"))
    out = docs.join(keep.select(kept), name == F.col(kept), "left_semi")
    if keep.where("n > 1").isEmpty():
        return out
    place = free_name(docs, "place")
    first = Window.partitionBy(name).orderBy("lang", "source")  # rows of one id and text
    return out.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it, the one at the end of the budget as a whole."""
    del spark, sf_dir
    mixed = mixing.mix(docs).where("taken > 0")
    times = F.max(F.col("epochs") + (F.col("extra") > 0).cast("int")).cast("int")
    name, source, tie, n, copy = (free_name(docs, c) for c in ("mixed_id", "mixed_source", "mixed_tie", "copies", "copy"))
    copies = mixed.groupBy(F.col("doc_id").alias(name), F.col("source").alias(source), F.col("tie").alias(tie)).agg(times.alias(n))
    same = F.col("doc_id").eqNullSafe(F.col(name)) & F.col("source").eqNullSafe(F.col(source)) & (F.crc32(F.coalesce("text", F.lit(""))) == F.col(tie))
    kept = docs.join(copies, same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
    return kept.select(*docs.columns)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    return sharding.shard(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_similar),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: SQL cannot express the fitted model or the tiling; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with workspace() as w:
            before, docs = docs, w.result(stage(spark, docs, sf_dir), f"pipeline-{name}")
        forget(before)
    return docs
