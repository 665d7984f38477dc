"""Similarity join of documents on their sets of word shingles, by signature trees; exact for 64-bit shingle hashes.

1. A pass over the texts gives each document its number of shingles and a 128-bit digest of the set. Documents with one
   digest are a class; from here on a class counts once, however many copies it has. Classes go by the first half of
   their digest; where two share it, all but one get another number (see common.aliases).
2. Shingles are counted over classes, in buckets of the hash range. A class keeps only its shared shingles (in another
   class too) with their counts: a set of n shingles of which fewer than 0.8 n are shared links with nothing and ends here.
3. Two sets that link share one of their rarest n - ceil(0.8 n) + 1 shingles, whatever the (fixed) order. With the order
   by count, unshared ones first, those of the few sets left are rare. The sets that have such a shingle are its list; lists
   with the same members are one. A pair that links is in a common list.
4. Each set is compared with the first of each of its lists. That settles lists of two, and connects most of a group of
   near copies: lists whose members are all connected are done.
5. The others make up cells, by the members that they share. In a cell, or in each list of a large cell, a signature tree
   holds, for each node, the OR of its sets' token bitmaps and the range of their sizes. A dual traversal from (root, root)
   drops node pairs by size, by the largest overlap that their bitmaps admit, or as already connected; pairs of sets that
   remain are intersected exactly. Above CELL sets, cells and lists are cut into blocks by size and hash, and block pairs
   are traversed as tasks of their own: one block against all others first, then the pairs that are not yet in one component.

No pair is ever dropped by a cap: only proofs (size, bitmap bound, rare shingles) and connectedness remove pairs. With
links=True connectedness removes none: every link is found in the list of the least shingle of its common lists, counted,
and weighted with copies; that takes time with the square of a group's different texts.

Shingles that HOT documents share go last in the order and aren't gathered by shingle at all.

Defined cases: null or blank texts have an empty set, are linked with nothing and are their own component; equal rows
are copies; rows without an id belong to the component of their text; fewer than five words are one shingle; no rows: no
rows. Columns other than doc_id and text are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Alias, aliases, components, materialize, renamed, shingles, small_batches, text_chunks, trim, workspace

WORDS = 5
#: Links need 100 * overlap >= PERCENT * union.
PERCENT = 80
#: Shingles of so many documents are hot. What a run of documents (RUN shingles) has more than FEW times adds to that count.
HOT, RUN, FEW = 1_000_000, 4_000_000, 7
#: Shingles a bucket, classes a group, and sets a tree or pair of blocks, that one task gathers.
BUCKET, GROUP, CELL = 2_500_000, 2000, 1024
#: Buckets at least: 7 bytes then hold a shingle.
BUCKETS = 256

_NEVER = np.uint32(0xFFFFFFFF)

def _digest(tokens: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """(class, check): the halves of a digest; `bits` of the first."""
    d = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    first = int.from_bytes(d[:8], "little", signed=True)
    return (first if bits == 64 else first % (1 << bits)), int.from_bytes(d[8:], "little", signed=True)


def _ids(docs: DataFrame) -> str:
    """The type of ids: strings, or else long."""
    return "string" if docs.schema["doc_id"].dataType.typeName() == "string" else "long"


def set_rows(docs: DataFrame, k: int = WORDS, bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, cls, check, hot, hot_counts): a row a document, and rows with the frequent shingles of runs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}  # copies count once
        size = 0

        def frequent() -> list[dict]:
            if len(held) <= FEW:
                return []
            tokens, counts = np.unique(np.concatenate(list(held.values())), return_counts=True)
            keep = counts > FEW
            return [{"hot": tokens[keep].tobytes(), "hot_counts": counts[keep].astype(np.int64).tobytes()}] if keep.any() else []

        for batch in batches:
            of = batch.column(0).to_pylist()
            for a, _, data, offsets in text_chunks(batch.column(1)):
                out = []
                for i, tokens in enumerate(shingles(data, offsets, k)):
                    d = _digest(tokens, bits) if len(tokens) else (None, None)
                    out.append({"doc_id": of[a + i], "n_shingles": len(tokens), "cls": d[0], "check": d[1]})
                    if len(tokens) and d not in held:
                        held[d] = tokens
                        size += len(tokens)
                if size > RUN:
                    out += frequent()
                    held.clear()
                    size = 0
                yield pa.RecordBatch.from_pylist(out, schema)
            trim()
        yield pa.RecordBatch.from_pylist(frequent(), schema)

    ids = _ids(docs)
    schema = pa.schema([("doc_id", pa.string() if "string" in ids else pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64()), ("check", pa.int64()), ("hot", pa.binary()), ("hot_counts", pa.binary())])
    return docs.select(F.col("doc_id").cast(ids), "text").mapInArrow(rows, f"doc_id {ids}, n_shingles long, cls long, check long, hot binary, hot_counts binary")


def _hot_tokens(sets: DataFrame, hot: int) -> np.ndarray:
    """Shingles of at least `hot` documents: at most the number of all shingles of all documents / hot, 8 bytes each."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(t, np.int64)), pa.array(np.frombuffer(c, np.int64))], ["t", "c"])

    found = sets.where("hot is not null").select("hot", "hot_counts").mapInArrow(unpack, "t long, c long")
    found = found.groupBy("t").agg(F.sum("c").alias("c")).where(F.col("c") >= hot).select("t")
    return np.sort(found.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))


def _start(bucket: int, buckets: int) -> int:
    """The least shingle of a bucket: those whose upper half, times the buckets, is from bucket * 2^32 on."""
    return -(-(bucket << 32) // buckets) << 32


def _width(buckets: int) -> int:
    """Bytes that hold a shingle's distance from its bucket's start."""
    return ((-(-(1 << 32) // buckets) << 32) - 1).bit_length() + 7 >> 3


def _token_rows(docs: DataFrame, hot: np.ndarray, copies: dict[int, int], alias: Alias, buckets: int, k: int, bits: int) -> DataFrame:
    """(bucket, cls, sizes, lengths, tokens) of runs of documents, packed: classes, their set sizes, how many of their tokens
    are in the bucket, and these, as _width bytes from the bucket's start on. Hot ones have 8 bytes and buckets of their own."""
    starts = np.array([_start(b, buckets) for b in range(buckets)], np.uint64)
    width = _width(buckets)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, _, data, offsets in text_chunks(batch.column(1)):
                cls, sets = [], []
                for i, tokens in enumerate(shingles(data, offsets, k)):
                    if len(tokens):
                        d = _digest(tokens, bits)
                        c = alias.get(d, d[0])
                        if copies.get(c, ids[a + i]) == ids[a + i]:
                            cls.append(c)
                            sets.append(tokens)
                if not sets:
                    continue
                tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
                cls_of, size_of = np.array(cls, np.int64), np.array([len(s) for s in sets], np.int32)
                bucket = (((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
                name = tokens - starts[bucket]
                if len(hot):
                    is_hot = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens
                    bucket[is_hot] = buckets + cls_of[owner[is_hot]] % buckets
                    name[is_hot] = tokens[is_hot]
                order = np.argsort(bucket, kind="stable")
                bucket, name, owner = bucket[order], name[order], owner[order]
                cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
                out: list[tuple] = []
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    b, part = int(bucket[x]), owner[x:y]
                    # an entry for each class, and for each 65535 tokens of one
                    first = np.flatnonzero(np.r_[True, np.diff(part) != 0])
                    first = np.concatenate([np.arange(i, j, 0xFFFF) for i, j in zip(first, np.r_[first[1:], len(part)])]) if len(part) > 0xFFFF else first
                    lengths = np.diff(np.r_[first, len(part)]).astype(np.uint16)
                    raw = name[x:y].tobytes() if b >= buckets else np.ascontiguousarray(name[x:y].view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
                    out.append((b, cls_of[part[first]].tobytes(), size_of[part[first]].tobytes(), lengths.tobytes(), raw))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), *[pa.binary()] * 4))], ["bucket", "cls", "sizes", "lengths", "tokens"])
            trim()

    return docs.select(F.col("doc_id").cast(_ids(docs)), "text").mapInArrow(rows, "bucket long, cls binary, sizes binary, lengths binary, tokens binary")


def _joined(part: pa.Table, column: str, kind: type) -> np.ndarray:
    """The bytes of a binary column end to end, as they lie in Arrow's buffer."""
    values = part.column(column).combine_chunks()
    if not len(values):
        return np.zeros(0, kind)
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind)


def _shared_rows(rows: DataFrame, buckets: int, groups: int) -> DataFrame:
    """(grp, cls, sizes, lengths, tokens, counts): for each bucket and group of classes, packed, the tokens of each class
    that another class has too, with the number of classes."""
    width = _width(buckets)

    def count(key: tuple, part: pa.Table) -> pa.Table:
        b = key[0].as_py()
        lengths = _joined(part, "lengths", np.uint16)
        known, index = np.unique(_joined(part, "cls", np.int64), return_index=True)
        size = _joined(part, "sizes", np.int32)[index]
        owner = np.repeat(np.searchsorted(known, _joined(part, "cls", np.int64)).astype(np.int32), lengths)
        if b >= buckets:
            token = _joined(part, "tokens", np.uint64)
        else:
            wide = np.zeros((len(owner), 8), np.uint8)
            wide[:, :width] = _joined(part, "tokens", np.uint8).reshape(-1, width)
            token = wide.view(np.uint64).ravel() + np.uint64(_start(b, buckets))
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        del order
        new = np.r_[True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])][: len(token)]
        if not new.all():
            token, owner = token[new], owner[new]  # copies of a class count once
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]][: len(token)])
        n = np.diff(np.r_[starts, len(token)]).astype(np.uint32)
        keep = np.repeat(n > 1, n) if b < buckets else np.ones(len(token), bool)
        counts = np.repeat(n[n > 1], n[n > 1]) if b < buckets else np.full(len(token), _NEVER)
        token, owner = token[keep], owner[keep]
        group = (known % groups)[owner]
        order = np.lexsort((owner, group))
        token, owner, counts, group = token[order], owner[order], counts[order], group[order]
        cuts = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)]), len(group)]
        out: list[tuple] = []
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            first = np.r_[0, np.flatnonzero(np.diff(owner[x:y])) + 1]
            mine = owner[x:y][first]
            out.append((int(group[x]), known[mine].tobytes(), size[mine].tobytes(), np.diff(np.r_[first, y - x]).astype(np.int32).tobytes(), token[x:y].tobytes(), counts[x:y].tobytes()))
        cols = list(zip(*out)) if out else [[]] * 6
        trim()
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), *[pa.binary()] * 5))], names=["grp", "cls", "sizes", "lengths", "tokens", "counts"])

    return rows.groupBy("bucket").applyInArrow(count, "grp long, cls binary, sizes binary, lengths binary, tokens binary, counts binary")


def _prefixes(shared: DataFrame, percent: int) -> DataFrame:
    """(cls, n, tokens, prefix) of the classes with enough shared tokens: these in order, and of the rarest as many as
    prove a link, as far as shared."""

    def rows(key: tuple, part: pa.Table) -> pa.Table:
        lengths = _joined(part, "lengths", np.int32)
        cls, size = _joined(part, "cls", np.int64), _joined(part, "sizes", np.int32)
        tokens, counts = _joined(part, "tokens", np.uint64), _joined(part, "counts", np.uint32)
        order = np.lexsort((tokens, counts, np.repeat(cls, lengths)))
        tokens = tokens[order]
        known, index = np.unique(cls, return_index=True)
        held = np.zeros(len(known), np.int64)
        np.add.at(held, np.searchsorted(known, cls), lengths)
        ends = np.cumsum(held)
        out = []
        for c, n, s, e in zip(known.tolist(), size[index].tolist(), held.tolist(), ends.tolist()):
            if 100 * s >= percent * n:
                mine = tokens[e - s : e]
                need = n - -(-percent * n // 100) + 1 - (n - s)
                out.append((c, n, np.sort(mine).tobytes(), mine[: max(0, need)].view(np.int64).tolist()))
        cols = list(zip(*out)) if out else [[]] * 4
        trim()
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())))], names=["cls", "n", "tokens", "prefix"])

    return shared.groupBy("grp").applyInArrow(rows, "cls long, n long, tokens binary, prefix array<long>")


class SignatureTree:
    """Sets in the order of their sizes, and above them nodes with OR-combined bitmaps and size ranges."""

    LEAF, FAN = 16, 8

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        most = max(map(len, sets))
        bits = min(1 << 16, max(512, 1 << int(4 * most - 1).bit_length()))
        rows = np.zeros((len(sets), bits // 8), np.uint8)
        flags = np.zeros(bits, bool)
        for row, s in zip(rows, sets):
            at = (s & np.uint64(bits - 1)).astype(np.int64)
            flags[at] = True
            row[:] = np.packbits(flags)
            flags[at] = False
        rows = rows.view(np.uint64)
        slack = np.array([len(s) for s in sets]) - np.bitwise_count(rows).sum(1, dtype=np.int64)
        #: By level from the sets up: bitmaps, least and greatest size, most tokens that share a bit with another.
        self.levels = [(rows, sizes, sizes, slack)]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, sl = self.levels[-1]
            cut = np.arange(0, len(b), self.LEAF if len(self.levels) == 1 else self.FAN)
            self.levels.append((np.bitwise_or.reduceat(b, cut), np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.maximum.reduceat(sl, cut)))

    def span(self, level: int) -> int:
        """Sets below a node of a level."""
        return 1 if not level else self.LEAF * self.FAN ** (level - 1)

    def admits(self, level: int, xs: np.ndarray, ys: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs of a level may hold a link, as far as sizes and bitmaps say."""
        b, lo, hi, slack = self.levels[level]
        least, other = lo[xs][:, None], lo[ys][None, :]
        near = (100 * hi[xs][:, None] >= percent * other) & (100 * hi[ys][None, :] >= percent * least)
        most = np.bitwise_count(b[xs][:, None, :] & b[ys][None, :, :]).sum(2, dtype=np.int64) + np.minimum(slack[xs][:, None], slack[ys][None, :])
        return near & ((100 + percent) * most >= percent * (least + other)) | (xs[:, None] == ys[None, :])


def tree_links(sets: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray | None = None, sides: np.ndarray | None = None, percent: int = PERCENT, every: bool = False) -> list[tuple[int, int]]:
    """Links (i, j) that connect what is connected among the sets: a spanning forest of all links, or every one.

    sets: the shared tokens of each, in order; sizes: of the whole sets. Pairs of one label, or of one side (if given),
    are taken as done.
    """
    order = np.lexsort((np.array([s[0] if len(s) else 0 for s in sets], np.uint64), sizes))
    sets, sizes = [sets[i] for i in order], sizes[order]
    label = np.arange(len(sets)) if labels is None else np.unique(labels[order], return_inverse=True)[1]
    side = None if sides is None else sides[order]
    tree, links = SignatureTree(sets, sizes), []
    top = len(tree.levels) - 1
    stack = [(top, 0, 0)]
    while stack:
        level, x, y = stack.pop()
        span = tree.span(level)
        a, b = label[x * span : (x + 1) * span], label[y * span : (y + 1) * span]
        if a[0] == b[0] and (a == a[0]).all() and (b == b[0]).all():
            continue
        if level == 0:
            if x != y:
                overlap = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if (100 + percent) * overlap >= percent * int(sizes[x] + sizes[y]):
                    links.append((int(order[x]), int(order[y])))
                    if not every:
                        label[label == label[y]] = label[x]
            continue
        fan, n = (tree.LEAF if level == 1 else tree.FAN), len(tree.levels[level - 1][0])
        xs, ys = np.arange(x * fan, min(n, (x + 1) * fan)), np.arange(y * fan, min(n, (y + 1) * fan))
        ok = tree.admits(level - 1, xs, ys, percent)
        if x == y:
            ok &= xs[:, None] <= ys[None, :]
        if level == 1:
            ok &= label[xs][:, None] != label[ys][None, :]
            if side is not None:
                ok &= side[xs][:, None] != side[ys][None, :]
        found = np.argwhere(ok)
        found = found[np.argsort(found[:, 0] != found[:, 1], kind="stable")] if x == y else found
        stack += [(level - 1, int(xs[i]), int(ys[j])) for i, j in found[::-1]]
    return links


def _forest(rows: DataFrame, by: str, percent: int, every: bool = False) -> DataFrame:
    """(a, b): links that connect the sets of each group of rows (group, cls, n, tokens, cell[, label, side]).

    every: all links whose least common shingle among the prefixes is the cell, which needs the column prefix.
    """
    extra = [c for c in ("label", "side") if c in rows.columns]

    def links(key: tuple, part: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        cell = part.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            if len(at) < 2:
                continue
            got = part.take(pa.array(at))
            cls = got.column("cls").to_numpy()
            sets = [np.frombuffer(t, np.uint64) for t in got.column("tokens").to_pylist()]
            more = [got.column(c).to_numpy() if c in extra else None for c in ("label", "side")]
            pairs = tree_links(sets, got.column("n").to_numpy(), *more, percent, every)
            if every and pairs:
                prefix = [np.array(p, np.int64) for p in got.column("prefix").to_pylist()]
                pairs = [(i, j) for i, j in pairs if np.intersect1d(prefix[i], prefix[j]).min() == cell[at[0]]]
            out += [(int(cls[i]), int(cls[j])) for i, j in pairs]
        trim()
        return pa.table([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return rows.select(by, "cls", "n", "tokens", "cell", *extra, *(["prefix"] if every else [])).groupBy(by).applyInArrow(links, "a long, b long")


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (cls, low, n, n_low, tokens, tokens_low) that link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n, m, s, t = (batch.column(i).to_pylist() for i in range(6))
            ok = [
                100 * min(p, q) >= percent * max(p, q) and (100 + percent) * len(np.intersect1d(np.frombuffer(u, np.uint64), np.frombuffer(v, np.uint64), assume_unique=True)) >= percent * (p + q)
                for p, q, u, v in zip(n, m, s, t)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, k in zip(side, ok) if k], pa.int64()) for side in (x, y)], ["a", "b"])

    return pairs.select("cls", "low", "n", "n_low", "tokens", "tokens_low").mapInArrow(rows, "a long, b long")


def _blocks(rows: DataFrame, percent: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Lists too long for a task, cut: their rows with block, and the block pairs (x, y, phase) that may hold a link.

    A list is cut by bands of sizes (links stay in a band or pass to the next) and in each by hash. Phase 0: within a
    block, 1: with the first block of a band, 2: the rest.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    rows = rows.withColumn("band", band)
    counts = rows.groupBy("cell", "band").agg(F.ceil(F.count("*") / max(1, limit // 4)).cast("int").alias("cuts"))
    rows = rows.join(counts, ["cell", "band"]).withColumn("cut", F.pmod(F.xxhash64("cls", F.lit("block")), F.col("cuts")).cast("int"))
    rows = materialize(rows.withColumn("block", F.xxhash64("cell", "band", "cut")), "ngram-blocks")
    blocks = materialize(rows.select("cell", "band", "cut", "block").distinct(), "ngram-block-list")
    near = F.expr("x.cell = y.cell and (x.band = y.band and x.cut <= y.cut or y.band = x.band + 1)")
    pairs = blocks.alias("x").join(blocks.alias("y"), near)
    phase = F.expr("case when x.block = y.block then 0 when x.cut = 0 or y.cut = 0 then 1 else 2 end")
    return rows, pairs.select(F.col("x.block").alias("x"), F.col("y.block").alias("y"), phase.alias("phase"))


def _block_tasks(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of each block pair as a task; side tells the blocks apart."""
    ends = pairs.select(F.xxhash64("x", "y").alias("task"), F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    return rows.join(ends, "block").withColumn("side", F.col("block"))


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with label: the component of their class by the links so far."""
    tops = components(links, "ngram-labels").select(F.col("id").alias("cls"), "component")
    return rows.drop("label").join(tops, "cls", "left").withColumn("label", F.coalesce("component", "cls")).drop("component")


def _long_links(rows: DataFrame, links: DataFrame, percent: int, limit: int) -> DataFrame:
    """Links so far and those of the long lists: phase after phase, leaving out block pairs that are one component."""
    rows, pairs = _blocks(rows, percent, limit)
    for phase in range(3):
        held = materialize(_labelled(rows, links), "ngram-labelled")
        pure = held.groupBy("block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        ends = [pure.select(F.col("block").alias(c), F.col("lo").alias(f"{c}l"), F.col("hi").alias(f"{c}h")) for c in "xy"]
        todo = pairs.where(F.col("phase") == phase).join(ends[0], "x").join(ends[1], "y").where("not (xl = xh and yl = yh and xl = yl)")
        tasks = _block_tasks(held, todo)
        found = _forest(tasks.drop("side") if phase == 0 else tasks, "task", percent)
        links = materialize(links.unionByName(found), "ngram-links")
    return links


def _trees(todo: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """(cls, label, cell, c): which sets go to a tree, c of them; and whether some c are above the limit.

    Lists that share members make up a cell. One tree takes a whole cell of up to `limit` sets, so that each is sent once.
    A larger cell is cut into blocks as a whole, or each of its lists is a tree, whichever sends fewer sets: groups of near
    copies have long lists, and are cut; long chains have short ones, and aren't.
    """
    first = todo.groupBy("cell").agg(F.min("cls").alias("low"))
    tops = components(todo.join(first, "cell").select(F.col("cls").alias("a"), F.col("low").alias("b")), "ngram-cells")
    tops = tops.select(F.col("id").alias("cls"), "component")
    sent = lambda c: F.when(F.col(c) <= limit, 1).otherwise(F.ceil(F.col(c) / max(1, limit // 4)))
    placed = materialize(todo.join(tops, "cls"), "ngram-placed")
    sizes = placed.groupBy("component").agg(F.count_distinct("cls").alias("size"), F.sum(sent("c")).alias("by_lists"))
    whole = sizes.where(F.col("size") * sent("size") <= F.col("by_lists")).select("component", "size")
    rows = placed.join(whole, "component").select("cls", "label", F.col("component").alias("cell"), F.col("size").alias("c")).distinct()
    rows = materialize(rows.unionByName(placed.join(whole, "component", "left_anti").select("cls", "label", "cell", "c")), "ngram-trees")
    return rows, not rows.where(F.col("c") > limit).isEmpty()


def _every_link(members: DataFrame, sets: DataFrame, percent: int, cell: int, packs: Column) -> DataFrame:
    """(a, b): each link between two classes, once."""
    rows = members.select("cls", F.col("token").alias("cell"), "c").join(sets, "cls")
    out = _forest(rows.where(F.col("c") <= cell).withColumn("pack", packs), "pack", percent, every=True)
    cut, pairs = _blocks(rows.where(F.col("c") > cell), percent, cell)
    inside, across = (_block_tasks(cut, pairs.where(f"phase {op} 0")) for op in ("=", ">"))
    return out.unionByName(_forest(inside.drop("side"), "task", percent, every=True)).unionByName(_forest(across, "task", percent, every=True))


def similar_sets(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, cell: int = CELL, bucket: int = BUCKET, hot: int = HOT, links: bool = False, bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id[, n_links]) for each row of docs.

    Ids are numbers or strings. component_id is the smallest id reachable by links; n_links, with links=True, the number of other rows linked directly.
    bits: how much of a digest numbers a class.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with workspace() as w:
        sets = materialize(set_rows(docs, words, bits), "ngram-sets")
        per_doc = sets.where("n_shingles is not null").select("doc_id", "n_shingles", "cls", "check")
        classes = per_doc.where("cls is not null").groupBy("cls", "check").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.count("*").alias("copies"))
        classes = materialize(classes, "ngram-classes")
        alias = aliases(classes)
        classes, per_doc = renamed(classes, alias), renamed(per_doc, alias)
        n_classes, n_docs, total = classes.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        # at most 1000 classes can hold a thousandth of all documents each
        large = {r.cls: r.rep for r in classes.where((F.col("copies") >= max(64, n_docs / 1000)) & F.col("rep").isNotNull()).select("cls", "rep").collect()}
        buckets = max(BUCKETS, -(-total // bucket))
        groups = max(12, -(-n_classes // GROUP))
        tokens = _token_rows(docs, _hot_tokens(sets, hot), large, alias, buckets, words, bits)
        left = materialize(_prefixes(_shared_rows(tokens, buckets, groups), percent), "ngram-shared")

        posts = left.select("cls", F.explode("prefix").alias("token"))
        prints = [F.bit_xor(F.xxhash64("cls", F.lit(salt))).alias(salt) for salt in ("print", "other")]
        lists = posts.groupBy("token").agg(F.count("*").alias("c"), F.min("cls").alias("low"), *prints).where("c > 1")
        lists = lists.groupBy("c", "low", "print", "other").agg(F.min("token").alias("token"))
        members = materialize(posts.join(lists.select("token", "c", "low"), "token"), "ngram-members")

        one = left.select("cls", "n", "tokens")
        pairs = members.where("cls <> low").select("cls", "low").distinct()
        pairs = pairs.join(one, "cls").join(one.toDF("low", "n_low", "tokens_low"), "low")
        found = materialize(_verified(pairs, percent), "ngram-star")
        todo = _labelled(members.where("c > 2").select("cls", "c", F.col("token").alias("cell")), found)
        mixed = todo.groupBy("cell").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
        todo = materialize(todo.join(mixed.select("cell"), "cell", "left_semi"), "ngram-mixed")
        n_todo = todo.select("cls").distinct().count()
        packs = F.pmod(F.xxhash64("cell"), F.lit(max(12, -(-n_todo // 500))))
        if n_todo:
            rows, large_cells = _trees(todo, cell)
            rows = rows.join(one, "cls")
            found = materialize(found.unionByName(_forest(rows.where(F.col("c") <= cell).withColumn("pack", packs), "pack", percent)), "ngram-links")
            if large_cells:
                found = _long_links(rows.where(F.col("c") > cell), found, percent, cell)
        linked = components(found, "ngram-components").select(F.col("id").alias("cls"), "component")

        tops = classes.select("cls", "rep", "copies").join(linked, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        lowest = tops.groupBy("component").agg(F.min("rep").alias("component_id"))
        tops = tops.join(lowest, "component").select("cls", "component_id", "copies")
        wanted = ["doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")]
        if links:
            packs = F.pmod(F.xxhash64("cell"), F.lit(max(12, -(-members.count() // 1000))))
            pairs = materialize(_every_link(members, left, percent, cell, packs), "ngram-every-link")
            ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
            others = ends.join(classes.select(F.col("cls").alias("b"), F.col("copies").alias("k")), "b").groupBy(F.col("a").alias("cls")).agg(F.sum("k").alias("others"))
            tops = tops.join(others, "cls", "left")
            wanted.append((F.when(F.col("n_shingles") > 0, F.coalesce("others", F.lit(0)) + F.col("copies") - 1).otherwise(0)).cast("long").alias("n_links"))
        return w.result(per_doc.join(tops, "cls", "left").select(*wanted), "ngram-result")
