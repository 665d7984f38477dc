"""Mixing, sharding and URL filtering: against plain versions, and on awkward rows."""

import math
import zlib
from collections import defaultdict

import pytest
from helpers import DOCS, WORD, awkward_docs, rows
from pyspark.sql import functions as F

from tremora.llm import mixing, sharding, urlfilter
from tremora.llm.common import table


def shared_out(sizes, weights=(3, 1, 2), share=1.5):
    """Targets by repeating: what is above a limit is shared again among the sources below theirs."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(w[s] for s in open_)
        now = {s: left * w[s] / total for s in open_}
        above = [s for s in open_ if now[s] > 2 * sizes[s] + 1e-9]
        if not above:
            return full | now
        for s in above:
            full[s] = 2.0 * sizes[s]
            left -= 2.0 * sizes[s]


def check_mix(spark, data):
    docs = spark.createDataFrame(data, DOCS)
    out = mixing.mix(docs).collect()
    assert len(out) == len(data)
    sizes = defaultdict(int)
    for _, text, _, source, _ in data:
        sizes[source] += len(WORD.findall(text or ""))
    aims, taken, last = shared_out(sizes), defaultdict(int), defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(aims[r.source], abs=1e-5)
        assert 0 <= r.taken <= 2 * r.size
        assert r.epochs * r.size <= r.taken <= (r.epochs + 1) * r.size
        taken[r.source] += r.taken
        last[r.source] += 0 < r.extra < r.size
    for s, aim in aims.items():
        assert abs(taken[s] - aim) <= 1
        assert last[s] <= 1  # one document is cut at most
    assert rows(mixing.mix(docs.repartition(3))) == sorted((tuple(r) for r in out), key=repr)


def test_mix(spark, sf):
    check_mix(spark, [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()])


def test_mix_awkward(spark):
    check_mix(spark, awkward_docs())


def test_mix_prefers_quality(spark):
    """Over a fractional draw, documents of low weight are taken less often."""
    data = [(i, ("good word " * 20) if i % 2 else ("bad$$$ word### " * 20), None, "a" if i < 400 else "b", 0) for i in range(1200)]
    out = mixing.mix(spark.createDataFrame(data, DOCS)).where("source = 'b'")
    got = {r.odd: r.t for r in out.groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("extra").alias("t")).collect()}
    assert got[1] > 1.5 * got[0]


def test_mix_empty(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    assert [r.taken for r in mixing.mix(spark.createDataFrame([(1, None, None, None, None)], DOCS)).collect()] == [0]


@pytest.mark.parametrize("which", ["file", "awkward"])
def test_shard(spark, sf, which):
    data = awkward_docs() if which == "awkward" else [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    out = sharding.shard(spark.createDataFrame(data, DOCS)).collect()
    want = sorted((repr(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in data)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in out) == want
    places, loads, shards_of = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in out:
        places[r.shard].append(r.slot)
        loads[r.shard] += r.size
        shards_of[r.virtual_slot].add(r.shard)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(0 <= s < 24 for s in places)
    assert all(len(s) == 1 for s in shards_of.values())
    # no slot that was placed could have gone to a lighter shard
    assert max(loads.values()) - max(r.size for r in out) <= sum(loads.values()) / 24 + 1 or len(out) < 24


def test_shard_empty(spark):
    assert sharding.shard(spark.createDataFrame([], DOCS)).collect() == []


def test_rebalance_moves_little(spark, sf):
    rows_ = sharding.sized(table(spark, sf, "documents"), 256).persist()
    held = sharding.slot_bytes(rows_, 256)
    one = sharding.first_map(held, 8)
    two = sharding.rebalance(one, held, 9)
    both = one.select("virtual_slot", F.col("shard").alias("a")).join(two.select("virtual_slot", "version", F.col("shard").alias("b"), "bytes"), "virtual_slot").collect()
    assert len(both) == 256 and {r.version for r in both} == {2}
    assert {r.b for r in both if r.a != r.b} <= {8}  # slots only move to the new shard
    total = sum(r.bytes for r in both)
    assert sum(r.bytes for r in both if r.a != r.b) <= total / 9 + max(r.bytes for r in both)
    assert sum(r.bytes for r in both if r.b == 8) > 0


def test_a_stored_map_is_edited(spark, sf):
    """A second run takes the stored map; more shards add a version in which only moved slots differ."""
    from tremora.llm.common import scratch

    docs, store = table(spark, sf, "documents"), scratch(spark, "test-maps")
    runs = [sharding.shard(docs, n, 256, store).collect() for n in (8, 8, 9, 9)]
    assert [{r.map_version for r in run} for run in runs] == [{1}, {1}, {2}, {2}]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1])) and sorted(map(tuple, runs[2])) == sorted(map(tuple, runs[3]))
    shard_of = [{r.virtual_slot: r.shard for r in run} for run in (runs[0], runs[2])]
    moved = {s for s in shard_of[0] if shard_of[0][s] != shard_of[1][s]}
    assert moved and {shard_of[1][s] for s in moved} == {8}
    assert {r.doc_id for r in runs[0] if r.virtual_slot not in moved} == {r.doc_id for r in runs[2] if r.shard != 8}
    one, two = (spark.read.parquet(f"{store}/map-{v}") for v in (1, 2))
    assert one.count() == two.count() == 256
    heavy = spark.createDataFrame([(r.doc_id,) for r in runs[2] if r.shard == 0], "doc_id long").distinct()
    more = docs
    for _ in range(4):
        more = more.unionByName(docs.join(heavy, "doc_id", "left_semi"))  # rows that repeat share their slots
    assert {r.map_version for r in sharding.shard(more, 9, 256, store).collect()} == {3}


def test_first_map_is_largest_first(spark, sf):
    """The map against a plain loop."""
    held = sharding.slot_bytes(sharding.sized(table(spark, sf, "documents"), 300), 300)
    loads, want = [0] * 7, {}
    for r in sorted(held.collect(), key=lambda r: (-r.bytes, -r.virtual_slot)):
        s = loads.index(min(loads))
        loads[s] += r.bytes
        want[r.virtual_slot] = s
    assert {r.virtual_slot: r.shard for r in sharding.first_map(held, 7).collect()} == want


def test_other_columns_are_not_looked_at(spark):
    docs = spark.createDataFrame(awkward_docs(), DOCS)
    more = docs
    for name in ("size", "tie", "bucket", "key", "weight", "before", "inside", "target", "s1", "b1", "s2", "virtual_slot", "shard", "slot", "version", "n", "bytes", "start", "given", "junk"):
        more = more.withColumn(name, F.lit("x"))
    assert rows(mixing.mix(more)) == rows(mixing.mix(docs))
    assert rows(sharding.shard(more)) == rows(sharding.shard(docs))


def test_mix_by_a_given_weight(spark):
    """The classifier's scores as weights: null and NaN count as almost none."""
    data = [(i, "word " * 20, None, "a" if i < 400 else "b", 0) for i in range(1200)]
    docs = spark.createDataFrame(data, DOCS).withColumn("score", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 1, float("nan")).otherwise(0.9))
    out = mixing.mix(docs, quality="score").where("source = 'b'")
    got = {r.k: r.t for r in out.groupBy((F.col("doc_id") % 3).alias("k")).agg(F.sum("extra").alias("t")).collect()}
    assert got[2] > 3 * (got[0] + got[1]) or got[2] == max(got.values())


def test_many_rules_are_a_join(spark):
    """Any number of rules: the join gives what the expression gives."""
    cases = [(i, c[0]) for i, c in enumerate(RULE_CASES)]
    pages = spark.createDataFrame(cases, "page_id long, url string")
    host, path = urlfilter.host_and_path(F.col("url"))
    pages = pages.withColumns({"host": host, "path": path})
    many = [*urlfilter.RULES, *(("block" if i % 2 else "allow", f"host{i}.org/p{i}") for i in range(600)), ("allow", "host7.org/p7")]
    short = rows(urlfilter.with_rules(pages))
    assert rows(urlfilter.with_rules(pages, most=0)) == short
    more = pages.unionByName(spark.createDataFrame([(90, None, "x.host7.org", "/p7/a"), (91, None, "host599.org", "/p599")], "page_id long, url string, host string, path string"))
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.with_rules(more, many).collect()}
    assert got[90] == ("host7.org/p7", "block") and got[91] == ("host599.org/p599", "block")
    assert all(got[i] == (rule, verdict) for i, _, _, _, rule, verdict in short)


RULE_CASES = [
    ("http://www.example.com/en/x", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://blog.example.com/en/x", "blog.example.com", "/en/x", "example.com/en/", "block"),
    ("http://EXAMPLE.Com/fr/?q=/en/", "example.com", "/fr/", "com/", "allow"),
    ("https://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    ("https://net/fr/", "net", "/fr/", "net/fr/", "block"),
    ("https://xnet/fr/", "xnet", "/fr/", None, "allow"),
    ("https://a.com", "a.com", "", None, "allow"),
    ("https://a.org?x://b.com/en/", "a.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, c[0], None, "clash", "clash") for i, c in enumerate(RULE_CASES)], "page_id long, url string, html string, host string, rule string")
    out = urlfilter.judge(pages).orderBy("page_id").collect()
    for r, (_, host, path, rule, verdict) in zip(out, RULE_CASES, strict=True):
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def plain_propagation(edges, seeds, steps, restart):
    hosts = {h for e in edges for h in e} | set(seeds)
    out, into = defaultdict(int), defaultdict(int)
    for (s, d), n in edges.items():
        out[s] += n
        into[d] += n
    t = {h: restart * seeds.get(h, (0, 0))[0] for h in hosts}
    d = {h: restart * seeds.get(h, (0, 0))[1] for h in hosts}
    t0, d0 = dict(t), dict(d)
    for _ in range(steps):
        nt, nd = dict(t0), dict(d0)
        for (a, b), n in edges.items():
            nt[b] += (1 - restart) * t[a] * n / out[a]
            nd[a] += (1 - restart) * d[b] * n / into[b]
        t, d = nt, nd
    return {h: (t[h], d[h]) for h in hosts}


def test_propagation(spark):
    edges = {("good", "a"): 3, ("good", "b"): 1, ("a", "bad"): 2, ("c", "bad"): 5, ("c", "good"): 1, ("b", "c"): 2, ("bad", "d"): 1}
    seeds = {"good": (1.0, 0.0), "bad": (0.0, 1.0), "lonely": (0.5, 0.5)}
    got = urlfilter.propagate(spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long"), spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, good double, bad double"))
    want = plain_propagation(edges, seeds, urlfilter.ITERATIONS, urlfilter.RESTART)
    got = {r.host: (r.trust, r.distrust) for r in got.collect()}
    assert got.keys() == want.keys()
    for h, (t, d) in want.items():
        assert got[h][0] == pytest.approx(t, abs=1e-12) and got[h][1] == pytest.approx(d, abs=1e-12)


def test_links_to_blocked_hosts_block(spark):
    """A host without a rule that links to blocked hosts only is blocked; one that trusted hosts link to is not."""
    link = lambda *hosts: "".join(f"<a href='https://{h}/x'>" for h in hosts)
    pages = [(1, "http://spam.net/es/1", None), (2, "http://farm.org/1", link("spam.net")), (3, "http://ok.com/1", link("news.org")), (4, "http://news.org/1", link("ok.com")), (5, "http://alone.org/", "")]
    got = {r.page_id: r.verdict for r in urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


@pytest.mark.parametrize("farm", [1, 2, 100])
def test_farms_are_blocked_whatever_their_size(spark, farm):
    """Hosts that link to one blocked host only are blocked however many they are; a third of a host's links doesn't do."""
    link = lambda *hosts: "".join(f"<a href='https://{h}/x'>" for h in hosts)
    pages = [(0, "http://spam.net/es/1", None), *((i, f"http://farm{i}.org/1", link("spam.net")) for i in range(1, farm + 1))]
    pages += [(-1, "http://mixed.org/1", link("spam.net", "one.org", "two.org")), (-2, "http://one.org/", "")]
    got = {r.page_id: r.verdict for r in urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: "block" if i >= 0 else "allow" for i, *_ in pages}


def test_pages_empty(spark):
    assert urlfilter.judge(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_native_plans_have_no_python(spark, sf, monkeypatch):
    """Every table that is written on the way is planned without Python, and so is the result."""
    from tremora.llm import common

    plans, write = [], common.materialize

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    for module in (common, urlfilter, sharding):
        monkeypatch.setattr(module, "materialize", seen)
    for df in (urlfilter.judge(table(spark, sf, "pages")), sharding.shard(table(spark, sf, "documents"))):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        assert math.isfinite(df.count())
    assert len(plans) >= 7
    assert not any(word in plan for plan in plans for word in ("Python", "Arrow", "Cartesian"))
