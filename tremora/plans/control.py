"""Queries of the control operators: reconciliation, month state, publication gates. Their inputs are made from orders and
parts by SQL that both engines read, with faults of each kind in a share of the rows; the operators never see that SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import months, reconcile, rollup
from . import views
from .surrogate import STAR, star, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


# --- an imported catalogue ---------------------------------------------------------------------------------------------

_O = "(SELECT o_orderkey AS k, CAST(o_orderkey AS STRING) AS s, CAST(o_orderkey + 1 AS STRING) AS s1, o_orderkey % 101 AS f, o_orderstatus AS st, CAST(o_orderdate AS TIMESTAMP) AS t FROM orders) o"
_EVENT = "concat('ev', s) AS canonical_event_id, {primary} AS primary_observation_id, {version} AS canonical_model_version, t AS event_time_utc, CAST(CASE WHEN st = 'F' THEN 2 ELSE 1 END + {more} AS BIGINT) AS source_count, st <> 'P' AS has_usgs, st <> 'O' AS has_jma, {quality} AS quality_status"
_PRIMARY = "concat(CASE WHEN st = 'O' THEN 'u' ELSE 'j' END, s)"
_MEMBER = "{event} AS canonical_event_id, {obs} AS source_observation_id, '{system}' AS source_system, {key} AS source_record_key, 'm' AS bronze_manifest_id, {uri} AS raw_object_uri, {primary} AS is_primary, {link} AS source_link_id"


def _event(where: str, primary: str = _PRIMARY, version: str = "'v1'", more: str = "0", quality: str = "'VALID'") -> str:
    return f"SELECT {_EVENT.format(primary=primary, version=version, more=more, quality=quality)} FROM {_O} WHERE {where}"


def _member(where: str, system: str, event: str = "concat('ev', s)", obs: str = "", key: str = "concat('r', s)", uri: str = "'a'", primary: str = "", link: str = "") -> str:
    u = system == "USGS"
    cells = {"event": event, "obs": obs or f"concat('{'u' if u else 'j'}', s)", "key": key, "uri": uri, "primary": primary or ("st = 'O'" if u else "true"), "link": link or ("CASE WHEN st = 'F' THEN concat('l', s) END" if u else "CAST(NULL AS STRING)")}
    return f"SELECT {_MEMBER.format(system=system, **cells)} FROM {_O} WHERE {where}"


#: Whole and spoilt inputs. The last digits of a key choose its fault; a seventh of the events comes twice in both.
_CATALOGUE = {
    False: (
        " UNION ALL ".join((_event("true"), _event("k % 7 = 0"))),
        " UNION ALL ".join((_member("st <> 'P'", "USGS"), _member("st <> 'O'", "JMA_BULLETIN"))),
        f"SELECT concat('l', s) AS source_link_id, concat('u', s) AS left_observation_id, concat('j', s) AS right_observation_id, 'ACCEPTED' AS link_decision FROM {_O} WHERE st = 'F'",
    ),
    True: (
        " UNION ALL ".join((
            _event("f <> 4", primary=f"CASE WHEN f = 1 THEN ' ' ELSE {_PRIMARY} END", version="CASE WHEN f = 3 THEN 'v2' ELSE 'v1' END", more="CASE WHEN f = 6 THEN 1 ELSE 0 END"),
            _event("k % 7 = 0 AND f > 20"), _event("f = 2", quality="'WARNING'"),
        )),
        " UNION ALL ".join((
            _member("st <> 'P' AND f <> 5", "USGS", uri="CASE WHEN f = 7 THEN '' ELSE 'a' END", key="CASE WHEN f = 8 THEN 'same' ELSE concat('r', s) END", link="CASE WHEN st = 'F' THEN CASE WHEN f = 13 THEN concat('l', s1) ELSE concat('l', s) END END"),
            _member("st <> 'O' AND f <> 5", "JMA_BULLETIN"),
            _member("f = 9", "USGS", obs="concat('w', s)", key="concat('w', s)", primary="false", link="CAST(NULL AS STRING)"),
            _member("f = 14", "JMA_BULLETIN", event="concat('ev', s1)", key="concat('q', s)", primary="false"),
        )),
        f"SELECT concat('l', s) AS source_link_id, concat('u', s) AS left_observation_id, concat('j', s) AS right_observation_id, CASE WHEN f = 10 THEN 'MAYBE' ELSE 'ACCEPTED' END AS link_decision FROM {_O} WHERE st = 'F'"
        f" UNION ALL SELECT concat('l', s), concat('u', s), concat('j', s), 'AMBIGUOUS' FROM {_O} WHERE st = 'F' AND f = 11"
        f" UNION ALL SELECT concat('x', s), concat('u', s), concat('j', s1), CASE WHEN f = 12 THEN 'ACCEPTED' ELSE 'REJECTED' END FROM {_O} WHERE st = 'F'",
    ),
}


def imported(spark: SparkSession, sf_dir: str, spoilt: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    events, bridge, links = (spark.sql(sql.replace("FROM orders)", "FROM {orders})"), orders=orders) for sql in _CATALOGUE[spoilt])
    return events, bridge, links


PERIOD = ("1993-01-01 00:00:00", "2100-01-01 00:00:00")
_E, _B, _K = _CATALOGUE[True]
_BLANK = lambda *names: " OR ".join(f"{n} IS NULL OR trim({n}) = ''" for n in names)


@query(f"""WITH e AS (SELECT DISTINCT * FROM ({_E})), b AS (SELECT DISTINCT * FROM ({_B})), k AS (SELECT DISTINCT * FROM ({_K})),
  m AS (SELECT source_observation_id AS o, min(canonical_event_id) AS ev, count(*) AS n FROM b GROUP BY 1),
  p AS (SELECT k.*, l.ev AS le, r.ev AS re FROM k JOIN m l ON l.o = left_observation_id JOIN m r ON r.o = right_observation_id), a AS (SELECT * FROM p WHERE link_decision = 'ACCEPTED'),
  s AS (SELECT canonical_event_id, count(*) AS n, count(*) FILTER (is_primary) AS np, max(source_observation_id) FILTER (is_primary) AS po, bool_or(source_system = 'USGS') AS u, bool_or(source_system = 'JMA_BULLETIN') AS j FROM b GROUP BY 1),
  v AS (SELECT 'GLOBAL_INPUT_COUNT_PIN_MISMATCH' AS rule, 1 AS place, 1 AS violations
  UNION ALL SELECT 'INVALID_GLOBAL_EVENT', 2, count(*) FROM e WHERE {_BLANK('canonical_event_id', 'primary_observation_id', 'canonical_model_version')} OR event_time_utc < TIMESTAMP '{PERIOD[0]}' OR event_time_utc >= TIMESTAMP '{PERIOD[1]}'
  UNION ALL SELECT 'BOUNDARY_CANONICAL_CONFLICT', 3, count(*) FROM (SELECT 1 FROM e GROUP BY canonical_event_id HAVING count(*) > 1)
  UNION ALL SELECT 'CANONICAL_MODEL_VERSION_CONFLICT', 4, CASE WHEN count(DISTINCT canonical_model_version) > 1 THEN 1 ELSE 0 END FROM e
  UNION ALL SELECT 'INVALID_GLOBAL_BRIDGE', 5, count(*) FROM b WHERE {_BLANK('canonical_event_id', 'source_observation_id', 'source_record_key', 'bronze_manifest_id', 'raw_object_uri')}
  UNION ALL SELECT 'BOUNDARY_OBSERVATION_CONFLICT', 6, count(*) FROM m WHERE n > 1
  UNION ALL SELECT 'GLOBAL_REVISION_CONFLICT_REQUIRES_SOURCE_RESOLUTION', 7, count(*) FROM (SELECT 1 FROM b GROUP BY source_system, source_record_key HAVING count(*) > 1)
  UNION ALL SELECT 'ORPHAN_GLOBAL_BRIDGE', 8, count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.canonical_event_id = b.canonical_event_id)
  UNION ALL SELECT 'EVENT_WITHOUT_BRIDGE', 9, count(*) FROM e WHERE NOT EXISTS (SELECT 1 FROM b WHERE e.canonical_event_id = b.canonical_event_id)
  UNION ALL SELECT 'MULTIPLE_CURRENT_MEMBERS_FROM_ONE_SOURCE', 10, count(*) FROM (SELECT 1 FROM b GROUP BY canonical_event_id, source_system HAVING count(*) > 1)
  UNION ALL SELECT 'GLOBAL_PRIMARY_OR_SOURCE_COUNT_UNBALANCED', 11, count(*) FROM e JOIN s USING (canonical_event_id) WHERE np <> 1 OR source_count <> n OR has_usgs <> u OR has_jma <> j
  UNION ALL SELECT 'GLOBAL_PRIMARY_ID_MISMATCH', 12, count(*) FROM e JOIN s USING (canonical_event_id) WHERE np > 0 AND primary_observation_id <> po
  UNION ALL SELECT 'INVALID_GLOBAL_SOURCE_LINK', 13, count(*) FROM k WHERE link_decision NOT IN ('ACCEPTED', 'REJECTED', 'AMBIGUOUS')
  UNION ALL SELECT 'BOUNDARY_SOURCE_LINK_CONFLICT', 14, count(*) FROM (SELECT 1 FROM k GROUP BY source_link_id HAVING count(*) > 1)
  UNION ALL SELECT 'GLOBAL_LINK_ENDPOINT_MISSING', 15, count(*) FROM (SELECT left_observation_id AS o FROM k UNION ALL SELECT right_observation_id FROM k) WHERE o NOT IN (SELECT o FROM m)
  UNION ALL SELECT 'GLOBAL_LINK_DECISION_MEMBERSHIP_CONFLICT', 16, count(*) FROM p WHERE (link_decision = 'ACCEPTED') <> (le = re)
  UNION ALL SELECT 'BRIDGE_REFERS_TO_NON_ACCEPTED_LINK', 17, count(*) FROM b WHERE source_link_id IS NOT NULL AND source_link_id NOT IN (SELECT source_link_id FROM a)
  UNION ALL SELECT 'SUPPORTING_MEMBER_WITHOUT_ACCEPTED_LINK', 18, count(*) FROM b WHERE NOT is_primary AND source_link_id IS NULL
  UNION ALL SELECT 'BRIDGE_LINK_ENDPOINT_MISMATCH', 19, count(*) FROM b JOIN a USING (source_link_id) WHERE source_observation_id NOT IN (left_observation_id, right_observation_id)
  UNION ALL SELECT 'GLOBAL_ACCEPTED_LINK_RECONCILIATION_FAILED', 20, CASE WHEN (SELECT count(*) FROM a) <> (SELECT count(*) FROM b) - (SELECT count(*) FROM e) THEN 1 ELSE 0 END)
  SELECT rule, CAST(place AS INTEGER) AS place, CAST(violations AS BIGINT) AS violations FROM v""")
def reconciliation_spoilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An import with each fault in a hundredth of its events, against a manifest of other counts."""
    return reconcile.violations(*imported(spark, sf_dir, True), reconcile.Pins(0, 0, 0, *PERIOD))


@query(f"SELECT canonical_event_id, source_observation_id, strftime(event_time_utc, '%Y-%m') AS event_month_utc FROM ({_CATALOGUE[False][1]}) b JOIN (SELECT DISTINCT canonical_event_id, event_time_utc FROM ({_CATALOGUE[False][0]})) e USING (canonical_event_id)")
def bridge_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, bridge, _ = imported(spark, sf_dir, False)
    return reconcile.with_event_month(bridge, events.dropDuplicates()).select("canonical_event_id", "source_observation_id", "event_month_utc")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN o_orderstatus = 'F' THEN concat('moved/', l_orderkey) ELSE concat('old/', l_linenumber) END AS raw_object_uri FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def relocated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("old/"), F.col("l_linenumber").cast("string")).alias("raw_object_uri"))
    places = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.concat(F.lit("moved/"), F.col("o_orderkey").cast("string")).alias("raw_object_uri"))
    return reconcile.relocate(rows, places, "l_orderkey")


# --- month state -------------------------------------------------------------------------------------------------------

_BEFORE = "SELECT 'USGS' AS source_system, CAST(o_orderkey AS STRING) AS source_record_key, concat('o', CAST(o_orderkey AS STRING)) AS source_observation_id, CAST(o_orderdate AS TIMESTAMP) AS event_time_utc, CAST(o_orderdate AS TIMESTAMP) AS source_updated_at_utc, o_orderstatus AS raw_record_hash, 'm0' AS bronze_manifest_id FROM orders WHERE o_orderkey % 11 <> 6"
_NEXT = """SELECT 'USGS' AS source_system, CAST(o_orderkey AS STRING) AS source_record_key, concat(CASE WHEN o_orderkey % 11 IN (1, 2, 3) THEN 'n' ELSE 'o' END, CAST(o_orderkey AS STRING)) AS source_observation_id,
  CAST(o_orderdate AS TIMESTAMP) + CASE WHEN o_orderkey % 11 = 3 THEN INTERVAL '40' DAY ELSE INTERVAL '0' DAY END AS event_time_utc, CAST(o_orderdate AS TIMESTAMP) + CASE WHEN o_orderkey % 11 IN (1, 3) THEN INTERVAL '1' DAY ELSE INTERVAL '0' DAY END AS source_updated_at_utc,
  CASE WHEN o_orderkey % 11 = 5 THEN 'changed' ELSE o_orderstatus END AS raw_record_hash, CASE WHEN o_orderkey % 5 = 0 THEN 'm1' ELSE 'm0' END AS bronze_manifest_id FROM orders WHERE o_orderkey % 11 <> 0"""
_TWICE = _NEXT.replace("o_orderkey % 11 <> 0", "o_orderkey % 11 = 4").replace("CASE WHEN o_orderkey % 11 = 5 THEN 'changed' ELSE o_orderstatus END", "'again'")
YEAR = [f"1995-{m:02d}" for m in range(1, 13)]
_IN = "({})".format(", ".join(f"'{m}'" for m in YEAR))


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return tuple(spark.sql(sql.replace("FROM orders", "FROM {orders}"), orders=orders) for sql in (_BEFORE, _NEXT, f"{_NEXT} UNION ALL {_TWICE}"))


@query(f"""WITH b AS ({_BEFORE}), c AS ({_NEXT} UNION ALL {_TWICE}), n AS (SELECT source_record_key, min(source_observation_id) AS id, min(event_time_utc) AS t, min(source_updated_at_utc) AS u, count(DISTINCT raw_record_hash) AS h FROM c GROUP BY 1),
  j AS (SELECT b.source_observation_id AS id0, n.id, n.h, strftime(b.event_time_utc, '%Y-%m') IN {_IN} AS was, strftime(n.t, '%Y-%m') IN {_IN} AS is_in, n.u > b.source_updated_at_utc AS later FROM b FULL JOIN n USING (source_record_key))
  SELECT 'ASOF_SOURCE_CHANGED_DURING_CAPTURE' AS rule, count(*) FILTER (h > 1) AS violations FROM j UNION ALL SELECT 'ASOF_UNEXPLAINED_MISSING_SOURCE_ID', count(*) FILTER (was AND id IS NULL) FROM j
  UNION ALL SELECT 'ASOF_MOVE_REQUIRES_EXPLICIT_CLOSURE', count(*) FILTER (id0 <> id AND NOT (was AND is_in)) FROM j UNION ALL SELECT 'ASOF_STALE_OR_AMBIGUOUS_REVISION', count(*) FILTER (id0 <> id AND NOT later) FROM j
  UNION ALL SELECT 'ASOF_REVISION_ID_CONTENT_CONFLICT', count(*) FROM (SELECT source_observation_id FROM (SELECT source_observation_id, raw_record_hash FROM b UNION SELECT source_observation_id, raw_record_hash FROM c) GROUP BY 1 HAVING count(*) > 1)""")
def asof_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture with lost, moved, stale, repeated and altered records against the state before it."""
    before, _, captured = _states(spark, sf_dir)
    return months.asof_violations(before, captured, before, YEAR)


@query(f"""WITH b AS ({_BEFORE}), n AS ({_NEXT}), j AS (SELECT strftime(b.event_time_utc, '%Y-%m') AS x, strftime(n.event_time_utc, '%Y-%m') AS y, n.bronze_manifest_id AS m FROM b FULL JOIN n USING (source_record_key) WHERE b.source_observation_id IS DISTINCT FROM n.source_observation_id),
  h AS (SELECT * FROM j WHERE x IN {_IN} OR y IN {_IN} OR (m = 'm1' AND y < '1994')) SELECT DISTINCT month FROM (SELECT x AS month FROM h UNION ALL SELECT y FROM h) WHERE month IS NOT NULL""")
def affected_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months touched by changed records, given the months of a year and a manifest whose records end in 1993."""
    before, after, _ = _states(spark, sf_dir)
    late = (F.col("bronze_manifest_id") == "m1") & ~(months.month("event_time_utc") < "1994")
    after = after.withColumn("bronze_manifest_id", F.when(late, "m2").otherwise(F.col("bronze_manifest_id")))
    return months.changed_months(before, after, spark.createDataFrame([(m,) for m in YEAR], "month string"), spark.createDataFrame([("m1",)], "manifest_id string"))


@query("""WITH p AS (SELECT p_partkey AS k, p_partkey % 3 > 0 AS jma FROM part), a AS (SELECT k, concat('a', k) AS manifest_uri, jma, CAST(k % 5 AS INT) AS rel, k % 3 AS sha FROM p), n AS (SELECT k, CASE WHEN k % 7 = 0 THEN concat('a', k) ELSE concat('n', k) END AS manifest_uri, jma, CAST(k % 4 AS INT) AS rel, k % 2 AS sha FROM p)
  SELECT a.manifest_uri, -1 AS position, CASE WHEN a.jma THEN false ELSE k % 7 <> 0 END AS is_active, CAST(NULL AS VARCHAR) AS reason_code FROM a
  UNION ALL SELECT n.manifest_uri, 0, true, CASE WHEN n.manifest_uri = a.manifest_uri AND (n.rel <> a.rel OR n.sha <> a.sha) THEN 'SAME_URI_DIFFERENT_PIN' WHEN n.jma AND n.sha <> a.sha AND n.rel <= a.rel THEN 'JMA_RELEASE_IDENTITY_OR_ORDER_CONFLICT' WHEN n.jma AND n.sha = a.sha AND n.rel < a.rel THEN 'OLDER_JMA_RELEASE_REJECTED' END FROM n JOIN a USING (k)""")
def active_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slot a part: an active input and one that follows it, newer or older, with the same bytes or others, or at the same address."""
    k = F.col("p_partkey")
    text = lambda x: x.cast("string")
    p = table(spark, sf_dir, "part")

    def inputs(uri: Column, release: int, sha: int) -> DataFrame:
        return p.select(uri.alias("manifest_uri"), F.when(k % 3 > 0, "JMA_BULLETIN").otherwise("USGS").alias("source_system"), k.cast("int").alias("year"), F.lit("a").alias("segment"), F.concat(F.lit("v"), text(k % release)).alias("catalog_release"), text(k % sha).alias("sha256"), F.lit(0).alias("position"))

    old = F.concat(F.lit("a"), text(k))
    new = F.when(k % 7 == 0, old).otherwise(F.concat(F.lit("n"), text(k)))
    return months.judge_inputs(inputs(old, 5, 3), inputs(new, 4, 2)).select("manifest_uri", "position", "is_active", "reason_code")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 12 + 1 <> month(o_orderdate)")
def misaligned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("o_orderdate").cast("timestamp")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", t.alias("event_time_utc"), F.year(t).alias("event_year_utc"), (F.col("o_orderkey") % 12 + 1).alias("event_month_utc"))
    return months.misaligned(rows).select("o_orderkey")


# --- publication -------------------------------------------------------------------------------------------------------


@query("SELECT 'passed' AS publication, count(*) AS n FROM orders UNION ALL SELECT 'failed', 0 UNION ALL SELECT 'unknown', 0")
def gated_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a view behind a publication that passed, one that failed, and one that isn't known."""
    status = spark.createDataFrame([("passed", "PASSED"), ("failed", "FAILED")], "publication_id string, verify_status string")
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    counts = [views.register_gated(rows, f"gated_{p}", status, p).agg(F.lit(p).alias("publication"), F.count("*").alias("n")) for p in ("passed", "failed", "unknown")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(f"""WITH {STAR}, o AS (SELECT *, strftime(event_date_jst, '%Y-%m') NOT IN {_IN} AS out FROM st) SELECT 'outside_scope_removed' AS blocker, count(*) FILTER (out AND (canonical_event_id % 29 = 0 OR canonical_event_id % 31 = 0 AND depth_km IS NOT NULL)) AS violations FROM o
  UNION ALL SELECT 'outside_scope_added', count(*) FILTER (out AND canonical_event_id % 31 = 0 AND canonical_event_id % 29 <> 0 AND depth_km IS NOT NULL) FROM o
  UNION ALL SELECT 'aggregate_count', count(*) FILTER (canonical_event_id % 29 = 0 AND is_natural_earthquake AND is_in_study_area) FROM o""")
def publication_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A publication of one year that lost some events of all years and moved others, with an aggregate from before."""
    before, k = star(spark, sf_dir), F.col("canonical_event_id")
    moved = F.when((k % 31 == 0) & (k % 29 != 0), F.col("depth_km") + 1).otherwise(F.col("depth_km"))
    after = before.where(k % 29 != 0).withColumn("depth_km", moved)
    return views.scope_violations(before, after, rollup.daily(before), months.month("event_date_jst"), YEAR)
