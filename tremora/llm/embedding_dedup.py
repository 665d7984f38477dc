"""Near-duplicate vectors: random-hyperplane signs hashed in several tables, exact cosines, connected components.

Equal vectors are one class, which counts with the number of its copies. Each class gets a code of sign bits in each
table; classes that share a code in a table are candidates and their cosine is taken in double precision. The number of
bits follows the number of classes, which keeps buckets at about 16 on spread data, and the number of tables follows
from the bits so that a pair at the threshold is found with probability RECALL.

What is dealt to the buckets is class ids and a sketch of SKETCH further sign bits. A bucket of at most SMALL classes
gives the pairs whose sketches differ in no more bits than a pair at the threshold does (and MARGIN standard deviations);
each pair then fetches its two vectors once, whatever the tables that found it. Only a larger bucket gets the vectors: it
is cut by hash to pieces of half a BLOCK, each pair of which goes to a task, and a count of links a class and a spanning
star leave the task, never its pairs. A pair counts in its first common table only, which both ways find from the vectors.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, their own copies
included; vectors of different lengths don't link; repeated rows are vectors of their own; rows without an id keep their
links, and give their component no id; no rows: no rows. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aliases, components, materialize, renamed, small_batches, workspace

COSINE = 0.9
RECALL = 0.99
#: Classes of a bucket that gives pairs; classes that one task compares with each other, of larger ones.
SMALL, BLOCK = 64, 2048
#: Rows of buckets a task takes at a time.
PACK = 32_768
SKETCH, MARGIN = 128, 4.5
SEED = 7


def tables_for(classes: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): buckets of about 16 on spread data, and `recall` for a pair of just that cosine."""
    bits = max(8, math.ceil(math.log2(max(2, classes))) - 4)
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def sketch_limit(cosine: float = COSINE) -> int:
    """Bits of a sketch that a pair of that cosine differs in, at most: the mean and MARGIN standard deviations."""
    p = math.acos(cosine) / math.pi
    return math.floor(SKETCH * p + MARGIN * math.sqrt(SKETCH * p * (1 - p)))


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the vectors of one length each that can be compared."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == d)
        flat = column.take(pa.array(rows)).flatten()
        m = np.array(flat.to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)  # null: NaN
        ok = np.isfinite(m).all(1) & (np.abs(m).max(1) > 0)
        yield rows[ok], m[ok]


def vector_rows(vectors: DataFrame, bits: int = 64) -> DataFrame:
    """(vec_id, cls, check, vector): the vector at length 1, and a digest of its bytes; null where nothing can link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls: list[int | None] = [None] * batch.num_rows
            check: list[int | None] = [None] * batch.num_rows
            vec: list[bytes | None] = [None] * batch.num_rows
            for at, m in _matrix(batch.column(1)):
                m = m / np.abs(m).max(1, keepdims=True)  # so that squares neither overflow nor vanish
                m = m / np.sqrt((m * m).sum(1, keepdims=True))
                for i, v in zip(at.tolist(), m + 0.0):
                    vec[i] = v.tobytes()
                    d = hashlib.blake2b(vec[i], digest_size=16).digest()
                    cls[i], check[i] = (int.from_bytes(h, "little", signed=True) for h in (d[:8], d[8:]))
                    if bits < 64:
                        cls[i] %= 1 << bits
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cls, pa.int64()), pa.array(check, pa.int64()), pa.array(vec, pa.binary())], ["vec_id", "cls", "check", "vector"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(rows, "vec_id long, cls long, check long, vector binary")


class _Planes:
    """Sign codes of unit vectors of any length."""

    def __init__(self, bits: int, tables: int):
        self.bits, self.tables, self.held = bits, tables, {}

    def of(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        if d not in self.held:
            rng = np.random.default_rng([SEED, d])
            self.held[d] = rng.standard_normal((d, self.tables * self.bits)), rng.standard_normal((d, SKETCH))
        return self.held[d]

    def codes(self, m: np.ndarray) -> np.ndarray:
        """A code for each vector and table."""
        signs = (m @ self.of(m.shape[1])[0] > 0).reshape(len(m), self.tables, self.bits)
        return (signs * (1 << np.arange(self.bits, dtype=np.int64))).sum(2)

    def sketches(self, m: np.ndarray) -> np.ndarray:
        return np.packbits(m @ self.of(m.shape[1])[1] > 0, axis=1)


def _codes(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """(cls, d, sketch, codes): a code of sign bits for each table; d: the vector's length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _Planes(bits, tables)
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            lengths = np.array([len(v) // 8 for v in vectors])
            codes, sketch = np.zeros((len(vectors), tables), np.int64), [b""] * len(vectors)
            for d in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == d)
                m = np.frombuffer(b"".join(vectors[i] for i in at), np.float64).reshape(-1, d)
                codes[at] = planes.codes(m)
                for i, s in zip(at.tolist(), planes.sketches(m)):
                    sketch[i] = s.tobytes()
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * tables, pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int32()), pa.array(sketch, pa.binary()), flat], ["cls", "d", "sketch", "codes"])

    return classes.select("cls", "vector").mapInArrow(rows, "cls long, d int, sketch binary, codes array<long>")


def _cuts(col: dict[str, np.ndarray], names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows sorted by the columns, and where a new combination begins in that order."""
    order = np.lexsort([col[c] for c in reversed(names)])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in names:
        new[1:] |= col[c][order][1:] != col[c][order][:-1]
    return order, np.flatnonzero(new)


def _near_pairs(posts: DataFrame, limit: int) -> DataFrame:
    """(a, b, t): pairs a < b of small buckets, rows (pack, t, code, d, cls, sketch), whose sketches are near."""

    def pairs(key: tuple, part: pa.Table) -> pa.Table:
        col = {c: part.column(c).to_numpy() for c in ("t", "code", "d", "cls")}
        order, first = _cuts(col, ("t", "code", "d"))
        cls, t = col["cls"][order], col["t"][order]
        sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint64).reshape(-1, SKETCH // 64)[order]
        ends = np.repeat(np.r_[first[1:], len(order)], np.diff(np.r_[first, len(order)]))
        at, out = np.arange(len(order)), []
        for step in range(1, int(np.diff(np.r_[first, len(order)]).max(initial=0))):
            i = at[at + step < ends]
            i = i[np.bitwise_count(sketch[i] ^ sketch[i + step]).sum(1, dtype=np.int64) <= limit]
            out.append((np.minimum(cls[i], cls[i + step]), np.maximum(cls[i], cls[i + step]), t[i]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32()))], names=["a", "b", "t"])

    return posts.groupBy("pack").applyInArrow(pairs, "a long, b long, t int")


def _verified(pairs: DataFrame, cosine: float, bits: int, tables: int) -> DataFrame:
    """(cls, links, root) of pairs (a, b, t, copies_a, copies_b, vector_a, vector_b) that link and have no table before t."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _Planes(bits, tables)
        for batch in batches:
            col = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            u, v = batch.column(5).to_pylist(), batch.column(6).to_pylist()
            lengths, out = np.array([len(x) // 8 for x in u]), []
            for d in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == d)
                x, y = (np.frombuffer(b"".join(side[i] for i in at), np.float64).reshape(-1, d) for side in (u, v))
                ok = (x * y).sum(1) >= cosine
                at, x, y = at[ok], x[ok], y[ok]
                at = at[(planes.codes(x) == planes.codes(y)).argmax(1) == col[2][at]]
                a, b, _, m, n = (c[at] for c in col)
                out += [(a, n, a), (b, m, a)]
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["cls", "links", "root"])

    return pairs.select("a", "b", "t", "copies_a", "copies_b", "vector_a", "vector_b").mapInArrow(rows, "cls long, links long, root long")


def _linked(posts: DataFrame, cosine: float, bits: int, tables: int) -> DataFrame:
    """(cls, links, root) from rows (pack, t, code, d, x, y, side, cls, copies, vector) of large buckets: new links of each class."""

    def links(key: tuple, part: pa.Table) -> pa.Table:
        names = ("t", "code", "d", "x", "y")
        col = {c: part.column(c).to_numpy() for c in (*names, "side", "cls", "copies")}
        vectors, planes = part.column("vector").to_pylist(), _Planes(bits, tables)
        order, first = _cuts(col, names)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in np.split(order, first[1:]):
            if len(at) < 2:
                continue
            m = np.frombuffer(b"".join(vectors[i] for i in at), np.float64).reshape(len(at), -1)
            i, j = np.nonzero(np.triu(m @ m.T >= cosine, 1))
            if col["x"][at[0]] != col["y"][at[0]]:
                cross = col["side"][at[i]] != col["side"][at[j]]
                i, j = i[cross], j[cross]
            some = np.unique(np.r_[i, j])
            codes = np.zeros((len(at), int(col["t"][at[0]])), np.int64)
            codes[some] = planes.codes(m[some])[:, : codes.shape[1]]
            new = np.ones(len(i), bool)
            for earlier in codes.T:
                new &= earlier[i] != earlier[j]
            i, j = i[new], j[new]
            if not len(i):
                continue
            copies = col["copies"][at]
            n = np.bincount(i, copies[j], len(at)) + np.bincount(j, copies[i], len(at))
            label = np.argsort(np.argsort(col["cls"][at]))  # ranks of the class ids
            while True:
                low = np.minimum(label[i], label[j])
                before = label.copy()
                np.minimum.at(label, i, low)
                np.minimum.at(label, j, low)
                if (label == before).all():
                    break
            some, by_rank = np.flatnonzero(n), np.sort(col["cls"][at])
            out.append((col["cls"][at[some]], n[some].astype(np.int64), by_rank[label[some]]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["cls", "links", "root"])

    return posts.groupBy("pack").applyInArrow(links, "cls long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, block: int = BLOCK, small: int = SMALL, id_bits: int = 64) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors. id_bits: how much of a digest numbers a class."""
    small_batches(vectors.sparkSession)
    with workspace() as w:
        rows = materialize(vector_rows(vectors, id_bits), "vector-rows")
        classes = rows.where("cls is not null").groupBy("cls", "check").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        classes = materialize(classes, "vector-classes")
        alias = aliases(classes.select("cls", "check"))
        rows, classes = renamed(rows.select("vec_id", "cls", "check"), alias), renamed(classes, alias)
        n = classes.count()
        bits, tables = tables_for(n, cosine, recall)
        coded = materialize(_codes(classes, bits, tables), "vector-codes")
        posts = coded.select("cls", "d", "sketch", F.posexplode("codes").alias("t", "code"))
        bucket = ["t", "code", "d"]
        large = materialize(posts.groupBy(*bucket).agg(F.count("*").alias("c")).where(F.col("c") > small), "vector-large")
        # pieces of at most about half a block: a pair of them makes one
        large = large.select(*bucket, F.when(F.col("c") <= block, 1).otherwise(F.ceil(F.col("c") * 2 / block)).cast("int").alias("cuts"))

        near = posts.join(large, bucket, "left_anti").withColumn("pack", F.pmod(F.xxhash64(*bucket), F.lit(max(12, n * tables // PACK))))
        pairs = _near_pairs(near, sketch_limit(cosine)).groupBy("a", "b").agg(F.min("t").alias("t"))
        one = classes.select("cls", "copies", "vector")
        pairs = pairs.join(one.toDF("a", "copies_a", "vector_a"), "a").join(one.toDF("b", "copies_b", "vector_b"), "b")
        found = _verified(pairs, cosine, bits, tables)

        cut = posts.drop("sketch").join(large, bucket).withColumn("side", F.pmod(F.xxhash64("cls", F.lit("cut")), F.col("cuts")).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        cut = cut.withColumns({"x": F.least("side", "other"), "y": F.greatest("side", "other")}).join(one, "cls")
        cut = cut.withColumn("pack", F.pmod(F.xxhash64(*bucket, "x", "y"), F.lit(max(12, n * tables // 8192))))
        found = materialize(found.unionByName(_linked(cut.drop("other", "cuts"), cosine, bits, tables)), "vector-links")

        linked = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")), "vector-components").select(F.col("id").alias("cls"), "component")
        counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
        tops = classes.select("cls", "rep", "copies").join(linked, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        lowest = tops.groupBy("component").agg(F.min("rep").alias("component_id"))
        tops = tops.join(lowest, "component").join(counts, "cls", "left")
        tops = tops.select("cls", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
        out = rows.select("vec_id", "cls").join(tops, "cls", "left")
        out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
        return w.result(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))), "vector-result")
