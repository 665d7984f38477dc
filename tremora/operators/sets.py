"""Set operations on frames: snapshot differences, dimension merges, content fingerprints, islands and closures."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .validate import assert_empty


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of one snapshot only, with side OLD or NEW; columns are matched by name."""
    cols = sorted(set(old.columns) | set(new.columns))
    a, b = old.select(*cols), new.select(*cols)
    return a.subtract(b).withColumn("side", F.lit("OLD")).unionByName(b.subtract(a).withColumn("side", F.lit("NEW")))


def merge_dimension(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """old and the keys that are new; fails if a key that exists changes its attributes."""
    cols = old.columns
    changed = new.select(*cols).join(old.select(*keys), list(keys), "left_semi").select(*cols).subtract(old)
    assert_empty(changed, "a dimension row changed")
    return old.unionByName(new.select(*cols).join(old.select(*keys), list(keys), "left_anti").select(*cols))


def row_digest(df: DataFrame, *columns: str) -> Column:
    cols = sorted(columns or df.columns)
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def fingerprint(df: DataFrame) -> str:
    """SHA-256 over the sorted digests of all rows, streamed to the driver in order: for tables of a checked, small size."""
    h = hashlib.sha256()
    for r in df.select(row_digest(df).alias("d")).orderBy("d").toLocalIterator():
        h.update(r.d.encode())
    return h.hexdigest()


def fingerprint_parts(df: DataFrame) -> DataFrame:
    """An order-free fingerprint of any size: the number of rows, and sums and xor of 64-bit hashes. One pass, no sort.

    The hash passes over nulls, so which columns are null is hashed too: a value and a null may not change places unseen.
    """
    cols = sorted(df.columns)
    cols += [F.col(f"`{c}`").isNull() for c in cols]
    h, g = F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)
    return df.select(h.alias("h"), g.alias("g")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("sum_h"), F.bit_xor("g").alias("xor_g"))


def islands(df: DataFrame, start: str, end: str, *by: str) -> DataFrame:
    """Unions of half-open intervals that touch or overlap: (by, island_start, island_end, parts)."""
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(F.col(start) <= before, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*by, "_island").agg(F.min(start).alias("island_start"), F.max(end).alias("island_end"), F.count("*").alias("parts")).drop("_island")


def covers(df: DataFrame, start: str, end: str, need: DataFrame, *by: str) -> DataFrame:
    """need (by, need_start, need_end) with is_covered: a single island holds the whole interval."""
    found = islands(df, start, end, *by)
    inside = [F.col(f"n.{k}").eqNullSafe(F.col(f"i.{k}")) for k in by] + [F.col("i.island_start") <= F.col("n.need_start"), F.col("i.island_end") >= F.col("n.need_end")]
    condition = inside[0]
    for x in inside[1:]:
        condition = condition & x
    hit = need.alias("n").join(found.alias("i"), condition, "left")
    return hit.groupBy(*(F.col(f"n.{k}") for k in by), F.col("n.need_start"), F.col("n.need_end")).agg(F.bool_or(F.col("i.island_start").isNotNull()).alias("is_covered"))


def month_edges(links: DataFrame, months: DataFrame) -> DataFrame:
    """Distinct pairs of months that links (left_id, right_id) connect; months: (id, month). At most months squared rows."""
    a, b = (months.select(F.col("id").alias(f"{s}_id"), F.col("month").alias(s)) for s in ("left", "right"))
    return links.join(a, "left_id").join(b, "right_id").select("left", "right").where("left <> right").distinct()


def month_closure(affected: set[str], *edge_frames: DataFrame) -> set[str]:
    """All months that affected ones reach over the edges of all graphs. Months are few (a calendar), so this is a set."""
    near: dict[str, set[str]] = {}
    for frame in edge_frames:
        for r in frame.collect():
            near.setdefault(r[0], set()).add(r[1])
            near.setdefault(r[1], set()).add(r[0])
    out, todo = set(affected), list(affected)
    while todo:
        for m in near.get(todo.pop(), set()) - out:
            out.add(m)
            todo.append(m)
    return out


def place(df: DataFrame, key: Column, order: str, block: int = 1 << 16) -> DataFrame:
    """df with place: each row's number from 1 by key, then by the number in `order`.

    A row's place is its number in its group plus the rows of earlier groups. A group is a key and a block of `order`, so
    the only window without a partition is over a count a group, and no key's rows are sorted as a whole.
    """
    group = ["_key", "_block"]
    rows = df.withColumns({"_key": key, "_block": F.floor(F.col(order) / block)})
    held = rows.groupBy(*group).agg(F.count("*").alias("n"))
    starts = held.select(*(F.col(g).alias(f"{g}s") for g in group), (F.sum("n").over(Window.orderBy(*group)) - F.col("n")).alias("_start"))
    inside = rows.withColumn("_inside", F.row_number().over(Window.partitionBy(*group).orderBy(order)))
    same = F.col("_key").eqNullSafe(F.col("_keys")) & F.col("_block").eqNullSafe(F.col("_blocks"))
    return inside.join(starts, same).select(*df.columns, (F.col("_start") + F.col("_inside")).alias("place"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two array columns as sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def multiply(df: DataFrame, times: int, *keys: str) -> DataFrame:
    """The frame `times` over with numbered keys: a load generator for benchmarks."""
    copies = df.sparkSession.range(times).select(F.col("id").alias("_copy"))
    return df.crossJoin(copies).withColumns({k: F.concat(F.col(k).cast("string"), F.lit("#"), F.col("_copy").cast("string")) for k in keys}).drop("_copy")


def pack(items: DataFrame, size: str, order: str, most_size: int = 100_000, most_items: int = 128, most_shards: int = 64) -> DataFrame:
    """items with shard: next-fit in order, never splitting an item. Items are metadata rows (one a window).

    Next-fit is sequential, so it is a fold over an ordered array on one row; a shard above the limits starts the next.
    """
    rows = items.agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), F.col(size).cast("long").alias("s")))).alias("rows"))
    step = f"""(a, x) -> if(a.n + 1 > {most_items} or a.s + x.s > {most_size},
        named_struct('n', 1, 's', x.s, 'shard', a.shard + 1, 'out', concat(a.out, array(a.shard + 1))),
        named_struct('n', a.n + 1, 's', a.s + x.s, 'shard', a.shard, 'out', concat(a.out, array(a.shard))))"""
    shards = rows.withColumn("out", F.expr(f"aggregate(rows, named_struct('n', 0, 's', cast(0 as bigint), 'shard', 0, 'out', cast(array() as array<int>)), {step}, a -> a.out)"))
    flat = shards.selectExpr("inline(arrays_zip(rows, out))").selectExpr(f"rows.k AS {order}", f"rows.s AS {size}", "out AS shard")
    return flat.withColumn("fits", (F.col(size) <= most_size) & (F.col("shard") < most_shards))
