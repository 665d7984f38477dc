"""Bounded samples of labelled documents, for the classifiers. Labels stay small until they meet the texts."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class WordCache(dict):
    """What a function gives for a word, kept for up to `most` words of up to `length` characters."""

    def __init__(self, f: Callable[[str], Any], most: int = 400_000, length: int = 64):
        self.f, self.most, self.length = f, most, length

    def __missing__(self, word: str) -> Any:
        value = self.f(word)
        if len(word) <= self.length:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value


def sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most per_class documents of each label 0 and 1, the same at every run; and the labels' counts.

    keep: a condition on doc_id. The chosen labels are at most 2 * per_class rows, and so are broadcast to the texts.
    Documents whose labels contradict each other count as 1.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(keep).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    order = F.xxhash64("doc_id", F.lit("sample")), F.col("doc_id")
    chosen = [known.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))
    return docs.select(F.col("doc_id").cast("long"), "text").join(chosen, "doc_id"), counts
