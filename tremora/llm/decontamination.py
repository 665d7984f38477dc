"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are sequences of word hashes (case and ASCII punctuation don't count). A running Karp-Rabin
hash over TILE words finds the seeds that a text shares with an item; seeds in a row on one diagonal are a maximal match.
Tiling marks the longest match, cuts the others by what is marked, and goes on while a match has TILE unmarked words on
both sides. Covered words of the item, wherever they stand in the text, count: a reordered passage is still found.

Items are a stated query set: their index goes to the tasks if it has at most BLOCK words, else block after block of
items does, each against all texts, and the driver holds one block at a time. Seeds that occur often on both sides give
many pairs of places: beyond HITS pairs at once, matches are followed along the diagonals, and only these are held.

Defined cases: null texts and texts or items of fewer than TILE words have no tile; equal rows give equal rows; items that
repeat are separate items; an empty benchmark or no documents give no rows. keep_clean keeps all columns whatever their
names; leaks looks at doc_id and text only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix, small_batches, text_chunks, word_hashes, workspace

TILE = 5
#: Share of an item's words that tiles must cover.
COVERAGE = 0.5
#: Words of items that a task holds at a time, and pairs of places.
BLOCK, HITS = 500_000, 1_000_000

_PLACE = np.random.default_rng(99).integers(0, 2**63, TILE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _rolled(words: np.ndarray, k: int = TILE) -> np.ndarray:
    out = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        out += words[j : j + len(out)] * _PLACE[j]
    return mix(out)


class Index:
    """The seeds of a block of items: sorted hashes, and for each the item and the place in it."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        seeds, owners, places, self.length = [], [], [], []
        for n, (_, text) in enumerate(items):
            data = np.frombuffer((text or "").encode(), np.uint8)
            words, _ = word_hashes(data, np.array([0, len(data)]), punctuation=False)
            rolled = _rolled(words)
            self.length.append(len(words))
            seeds.append(rolled)
            owners.append(np.full(len(rolled), n, np.int32))
            places.append(np.arange(len(rolled), dtype=np.int32))
        seed, self.owner, self.place = (np.concatenate(x) if items else np.zeros(0, np.int32) for x in (seeds, owners, places))
        order = np.argsort(seed, kind="stable")
        self.seed, self.owner, self.place = seed[order].astype(np.uint64), self.owner[order], self.place[order]

    def shared(self, rolled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, first entry, number of entries) of the text's seeds that items have."""
        a, b = np.searchsorted(self.seed, rolled, "left"), np.searchsorted(self.seed, rolled, "right")
        at = np.flatnonzero(b > a)
        return at, a[at], (b - a)[at]


def _matches(text_at: np.ndarray, item_at: np.ndarray, k: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal matches (place in the text, place in the item, words) from all shared seeds of a text and an item."""
    diagonal = text_at - item_at
    order = np.lexsort((item_at, diagonal))
    d, p = diagonal[order], item_at[order]
    starts = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)])
    return p[starts] + d[starts], p[starts], np.diff(np.r_[starts, len(d)]) + k - 1


def _followed(text_at: np.ndarray, text_seed: np.ndarray, item_at: np.ndarray, item_seed: np.ndarray, k: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same from the places and seeds of each side, in memory of a text and its matches whatever the pairs of places.

    From the item's last place on, the length of the match that begins at (t, i) is one more than that at (t + 1, i + 1).
    """
    order = np.argsort(text_seed, kind="stable")
    by_seed = text_seed[order]
    size = int(text_at.max()) + 2
    seed_at = np.zeros(size + 1, np.uint64)  # of text place t at t + 1; which places have one
    has = np.zeros(size + 1, bool)
    seed_at[text_at + 1], has[text_at + 1] = text_seed, True
    length, after = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    own = dict(zip(item_at.tolist(), item_seed))
    out, last = [], np.zeros(0, np.int64)
    for i in range(int(item_at.max()), -1, -1):
        at = np.zeros(0, np.int64)
        if i in own:
            a, b = np.searchsorted(by_seed, own[i], "left"), np.searchsorted(by_seed, own[i], "right")
            at = text_at[order[a:b]]
            length[at] = after[at + 1] + 1
            begins = ~has[at] | (seed_at[at] != own[i - 1]) if i - 1 in own else np.ones(len(at), bool)
            first = at[begins]
            out.append((first, np.full(len(first), i), length[first] + k - 1))
        after[last] = 0
        length, after, last = after, length, at
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def tile(matches: tuple[np.ndarray, np.ndarray, np.ndarray], item_words: int, k: int = TILE) -> tuple[int, int, int]:
    """(covered words of the item, tiles, longest tile) from the maximal matches of a text and an item."""
    text_at, item_at, words = matches
    order = np.lexsort((text_at, item_at, -words))  # longest first, then by place
    base = int(text_at.min())
    item_free, text_free = np.ones(item_words, bool), np.ones(int((text_at + words).max()) - base, bool)
    cut: list[tuple[int, int, int]] = []  # what is left of matches that were marked in part
    covered = tiles = longest = at = 0
    while item_words - covered >= k:
        whole = (-int(words[order[at]]), int(item_at[order[at]]), int(text_at[order[at]]) - base) if at < len(order) else None
        if whole and (not cut or whole < cut[0]):
            n, i, t = whole
            at += 1
        elif cut:
            n, i, t = heapq.heappop(cut)
        else:
            break
        n = -n
        free = item_free[i : i + n] & text_free[t : t + n]
        if free.all():
            item_free[i : i + n] = text_free[t : t + n] = False
            covered, tiles, longest = covered + n, tiles + 1, max(longest, n)
            continue
        edges = np.flatnonzero(np.diff(np.r_[False, free, False]))
        for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):  # runs of unmarked words
            if y - x >= k:
                heapq.heappush(cut, (-(y - x), i + x, t + x))
    return covered, tiles, longest


def _touched(matches: tuple[np.ndarray, np.ndarray, np.ndarray], item_words: int) -> int:
    """Words of the item that any match covers: no tiling covers more."""
    _, at, n = matches
    steps = np.bincount(at, minlength=item_words + 1) - np.bincount(at + n, minlength=item_words + 1)
    return int((np.cumsum(steps)[:item_words] > 0).sum())


def _by_item(index: Index, at: np.ndarray, first: np.ndarray, n: np.ndarray, rolled: np.ndarray) -> Iterator[tuple[int, tuple]]:
    """(item, maximal matches) of one text's shared seeds."""
    if n.sum() <= HITS:
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        item, place, t = index.owner[entry], index.place[entry].astype(np.int64), np.repeat(at, n)
        order = np.argsort(item, kind="stable")
        cuts = np.flatnonzero(np.r_[True, item[order][1:] != item[order][:-1]])
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
            these = order[x:y]
            yield int(item[these[0]]), _matches(t[these], place[these])
        return
    seeds, where = np.unique(rolled[at], return_index=True)
    of, m = first[where], n[where]
    entry = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(of, m)
    entry = entry[np.argsort(index.owner[entry], kind="stable")]
    item = index.owner[entry]
    for these in np.split(entry, np.flatnonzero(item[1:] != item[:-1]) + 1):
        mine = np.isin(rolled[at], index.seed[these])
        yield int(index.owner[these[0]]), _followed(at[mine], rolled[at[mine]], index.place[these].astype(np.int64), index.seed[these])


def _found(index: Index, texts: pa.Array, share: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, coverage, tiles, longest) of the pairs that reach the share."""
    for a, _, data, offsets in text_chunks(texts):
        words, counts = word_hashes(data, offsets, punctuation=False)
        rolled = _rolled(words)
        at, first, n = index.shared(rolled)
        if not len(at):
            continue
        ends = np.cumsum(counts)
        row = np.searchsorted(ends, at, "right")
        whole = at + TILE <= ends[row]  # seeds that don't run on into the next text
        at, first, n, row = at[whole], first[whole], n[whole], row[whole]
        cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)])
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(row)]):
            for i, matches in _by_item(index, at[x:y], first[x:y], n[x:y], rolled):
                words_of = index.length[i]
                if _touched(matches, words_of) < share * words_of:
                    continue
                covered, tiles, longest = tile(matches, words_of)
                if covered >= share * words_of:
                    yield a + int(row[x]), i, covered / words_of, tiles, longest


def block_conditions(benchmark: DataFrame, limit: int = BLOCK) -> list[Column]:
    """Conditions on items that deal them to blocks of about `limit` words."""
    words = benchmark.agg(F.coalesce(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))), F.lit(0))).first()[0]
    n = -(-words // limit)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n)))
    return [part == b for b in range(n)]


def _index(benchmark: DataFrame, block: Column) -> Index:
    """The index of one block: about BLOCK words, or one item."""
    return Index([(r.item_id, r.text) for r in benchmark.where(block).select("item_id", "text").orderBy("item_id", "text").collect()])


OUT = "doc_id long, item_id long, coverage double, tiles int, longest int"


def _leaks_of(texts: DataFrame, index: Index, share: float) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [(ids[r], index.ids[i], c, n, m) for r, i, c, n, m in _found(index, batch.column(1), share)]
            cols = list(zip(*found)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()))], ["doc_id", "item_id", "coverage", "tiles", "longest"])

    return texts.mapInArrow(rows, OUT)


def _clean_of(docs: DataFrame, index: Index, share: float) -> DataFrame:
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[r for r, *_ in _found(index, batch.column(at), share)]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(rows, docs.schema)


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = COVERAGE, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, coverage, tiles, longest) of the pairs of a text and an item whose words it covers."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    parts = block_conditions(benchmark, block)
    if len(parts) == 1:
        return _leaks_of(texts, _index(benchmark, parts[0]), share)
    out = docs.sparkSession.createDataFrame([], OUT)
    with workspace() as w:
        for part in parts:  # what is found is written, and the block's index can go
            out = out.unionByName(materialize(_leaks_of(texts, _index(benchmark, part), share), "tiles"))
        return w.result(out, "leaks")


def keep_clean(docs: DataFrame, benchmark: DataFrame, share: float = COVERAGE, block: int = BLOCK) -> DataFrame:
    """The rows of docs, with all their columns, whose text covers no item. Each block but the last costs a table of them."""
    small_batches(docs.sparkSession)
    parts = block_conditions(benchmark, block)
    if len(parts) < 2:
        return _clean_of(docs, _index(benchmark, parts[0]), share) if parts else docs
    with workspace() as w:
        for part in parts[:-1]:
            docs = materialize(_clean_of(docs, _index(benchmark, part), share), "clean")
        return w.result(_clean_of(docs, _index(benchmark, parts[-1]), share), "clean")
