"""What the operators of this subpackage share: storage that all executors see, word hashing, components of a graph.

Storage: intermediate tables go below the folder that the session names in ``spark.checkpoint.dir``. Only where that
setting is absent and all tasks run in this process (a local master, as in tests) a temporary folder stands in. An
operator's tables go when it returns: see workspace().
"""

from __future__ import annotations

import atexit
import ctypes
import hashlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from types import TracebackType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_OPEN: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables between jobs: that of ``spark.checkpoint.dir``, else one of this process."""
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    if not (master := spark.sparkContext.master).startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir is unset: on {master} tables between jobs need a folder that all executors see")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tremora-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return f"file://{_LOCAL[0]}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/tremora/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends here, and a lost executor costs no rerun."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tremora_path = path
    if _OPEN:
        _OPEN[-1].append(out)
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables that materialize() or a workspace wrote, once nothing reads them any more."""
    for t in tables:
        if path := t.__dict__.pop("_tremora_path", None):
            drop(t.sparkSession, path)


class workspace:
    """``with workspace() as w: ... return w.result(df, name)``: tables written inside go when the block ends, whichever way.

    The result is a table too, and stays: it belongs to the caller, who may forget() it, or to the workspace around this one.
    """

    def __enter__(self) -> workspace:
        self.mine: list[DataFrame] = []
        _OPEN.append(self.mine)
        return self

    def result(self, df: DataFrame, name: str) -> DataFrame:
        out = materialize(df, name)
        self.mine.pop()
        if len(_OPEN) > 1:
            _OPEN[-2].append(out)
        return out

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        _OPEN.pop()
        forget(*self.mine)


def drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded rows and bytes, so that long texts don't add up in a Python worker.

    The same for all operators: the settings are the session's, and hold when a frame runs, not when it is made.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def trim() -> None:
    """Gives freed memory back to the system: workers are kept for later tasks, and with them what they once needed."""
    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        give_back(0)


def fold(doc_id: Column | str, k: int) -> Column:
    """crc32 of the id as text, modulo k."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % k


def text_chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts; a run has at most `limit` bytes or is one text. Null: empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


_RNG = np.random.default_rng(20_240_611)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: What else ends a word where punctuation doesn't count: every ASCII byte but letters and digits.
_BREAK = _SPACE.copy()
_BREAK[[b for b in range(128) if not chr(b).isalnum()]] = True
_P = 0x9E3779B97F4A7C1B  # odd, and 3 modulo 8: powers of it differ in almost all bits
_PLACE = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)]) for x in (_P, pow(_P, -1, 2**64))]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, punctuation: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of bytes other than 09-0D and 20; A-Z as a-z) of texts that lie end to end.

    Returns the hashes in order, and the number of words of each text. Without punctuation, any ASCII byte that is no
    letter or digit ends a word.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    word = ~(_SPACE if punctuation else _BREAK)[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    starts = np.flatnonzero(word & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    up, down = _powers(n)
    sums = np.add.reduceat(np.where(word, _BYTE[data] * up[:n], np.uint64(0)), starts)
    counts = np.diff(np.searchsorted(starts, offsets))
    return mix(sums * down[starts]), counts


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingles (as 64-bit hashes) of each text; fewer words: the sequence as one; none: none."""
    words, counts = word_hashes(data, offsets)
    n = max(0, len(words) - k + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(k):
        rolled += words[j : j + n] * _PLACE[j]
    rolled = mix(rolled)
    a = 0
    for c in counts.tolist():
        if c >= k:
            yield np.unique(rolled[a : a + c - k + 1])
        elif c:
            yield mix((words[a : a + c] * _PLACE[:c]).sum(dtype=np.uint64, keepdims=True) + np.uint64(c))
        else:
            yield np.zeros(0, np.uint64)
        a += c


#: Edges that the driver connects by itself, at most (16 bytes each): rounds of so few cost more in tasks than in work.
FEW_EDGES = 1 << 18


def connect(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, component of each) of the nodes of edges, the component being its smallest id."""
    ids, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    top, x, y = np.arange(len(ids)), ends[: len(u)], ends[len(u) :]
    while True:
        a, b = top[x], top[y]
        if (a == b).all():
            return ids, ids[top]
        np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))  # roots below a lower one
        while not np.array_equal(up := top[top], top):
            top = up


def components(edges: DataFrame, name: str = "components", few: int = FEW_EDGES) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component), the component being its smallest id.

    Up to `few` edges are connected in the driver. Of more, rounds alternate the two star contractions of Kiveris et al.
    (2014): each points neighbours of a node to the smallest one. A round is an aggregate and a join on node ids, written
    to the shared folder; edges only shrink to stars, so the number of rows never exceeds twice the input. Rounds go on
    until one changes nothing or so few edges are left, about as many as the logarithm of the longest path squared. Nodes
    without edges don't occur in the result.
    """
    cur = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    seen, settled, n = None, False, cur.count()
    while not settled:
        if n <= few:
            pairs = cur.toArrow()  # `few` rows at most
            forget(cur)
            ids, tops = connect(*(pairs.column(c).to_numpy() for c in ("u", "v")))
            out = edges.sparkSession.createDataFrame(pa.table({"id": ids.astype(np.int64), "component": tops.astype(np.int64)}), "id long, component long")
            return materialize(out, f"{name}-few")
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        new = materialize(small, name)
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        forget(cur)
        cur, n = new, state[0]
        settled = state == seen or state[0] == state[2] and new.join(new.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
        seen = state
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


Alias = dict[tuple[int, int], int]


def aliases(classes: DataFrame) -> Alias:
    """Other numbers for classes (cls, check) that share their number with another: all but that of the least check.

    About m^2 / 2^65 classes of m do so (3 of ten billion), so their list is small; new numbers are tried until none is taken.
    """
    shared = classes.groupBy("cls").agg(F.count("*").alias("n"), F.min("check").alias("first")).where("n > 1").drop("n")
    left = {(r.cls, r.check) for r in classes.join(shared, "cls").where(F.col("check") != F.col("first")).select("cls", "check").collect()}
    out: Alias = {}
    salt = 0
    while left:
        tried = {at: int.from_bytes(hashlib.blake2b(f"{at}:{salt}".encode(), digest_size=8).digest(), "little", signed=True) for at in left}
        new = classes.sparkSession.createDataFrame([(x,) for x in set(tried.values())], "cls long")
        taken = {r.cls for r in classes.join(F.broadcast(new), "cls", "left_semi").select("cls").collect()} | set(out.values())
        for at in sorted(left):
            if tried[at] not in taken:
                out[at] = tried[at]
                taken.add(tried[at])
        left -= set(out)
        salt += 1
    return out


def renamed(rows: DataFrame, alias: Alias) -> DataFrame:
    """Rows (cls, check, ...) with the classes' final numbers."""
    if not alias:
        return rows
    new = rows.sparkSession.createDataFrame([(*k, v) for k, v in alias.items()], "cls long, check long, other long")
    return rows.join(F.broadcast(new), ["cls", "check"], "left").withColumn("cls", F.coalesce("other", "cls")).drop("other")
