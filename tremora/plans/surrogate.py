"""The engine's tables made from the driver's: a catalogue out of `events`, observations out of it, a star out of `orders`.

The formulas are plain arithmetic, and SQL says the same for the second engine (EVENTS, OBSERVATIONS, STAR).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import depth_band, magnitude_band
from ..functions.numeric import half_up
from ..operators.windows import Selection

SELECTION = Selection("2024-01-01 00:00:00", "2024-02-01 00:00:00", 3.5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with magnitude, depth and place; all natural, in the area and eligible."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    return e.select(
        i.alias("canonical_event_id"), F.col("ts").cast("timestamp").alias("event_time_utc"), "event_type", "user_id",
        half_up(F.log(1.0 + F.col("value")), 2).alias("magnitude"), (i % 200).cast("double").alias("depth_km"),
        (35.0 + (i * 7 % 100) / 100.0).alias("latitude"), (139.0 + (i * 13 % 100) / 100.0).alias("longitude"), F.lit(True).alias("is_eligible"),
    )


EVENTS = """ev AS (SELECT event_id, ts, event_type, user_id, floor(ln(1.0::DOUBLE + value) * 100 + 0.5) / 100 AS mag, CAST(event_id % 200 AS DOUBLE) AS depth,
  35.0::DOUBLE + CAST(event_id * 7 % 100 AS DOUBLE) / 100.0::DOUBLE AS lat, 139.0::DOUBLE + CAST(event_id * 13 % 100 AS DOUBLE) / 100.0::DOUBLE AS lon FROM events)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions: events of one user and type are revisions of a record; two types are the feeds."""
    c = F.col
    e = table(spark, sf_dir, "events").where("event_type in ('click', 'view')")
    feed = c("event_type") == "click"
    return e.select(
        F.when(feed, "USGS").otherwise("JMA_BULLETIN").alias("source_system"), (c("user_id") * 8 + c("event_id") % 8).cast("string").alias("source_record_key"),
        F.when(feed & (c("event_id") % 11 > 0), c("ts").cast("timestamp")).alias("source_updated_at_utc"), F.when(~feed, F.date_trunc("week", c("ts").cast("timestamp"))).alias("catalog_release_at_utc"),
        F.when(~feed, F.concat(F.lit("v"), c("event_id") % 12)).alias("catalog_release"), F.date_trunc("day", c("ts").cast("timestamp")).alias("processed_at_utc"),
        F.lpad((c("event_id") % 5).cast("string"), 4, "0").alias("raw_record_hash"), F.lpad(c("event_id").cast("string"), 12, "0").alias("source_observation_id"), c("ts").cast("timestamp").alias("event_time_utc"),
    )


OBSERVATIONS = """ob AS (SELECT CASE WHEN event_type = 'click' THEN 'USGS' ELSE 'JMA_BULLETIN' END AS source_system, CAST(user_id * 8 + event_id % 8 AS VARCHAR) AS source_record_key,
  CASE WHEN event_type = 'click' AND event_id % 11 > 0 THEN ts END AS updated, CASE WHEN event_type <> 'click' THEN date_trunc('week', ts) END AS released,
  CASE WHEN event_type <> 'click' THEN event_id % 12 END AS release_no, date_trunc('day', ts) AS processed, lpad(CAST(event_id % 5 AS VARCHAR), 4, '0') AS raw_record_hash,
  lpad(CAST(event_id AS VARCHAR), 12, '0') AS source_observation_id FROM events WHERE event_type IN ('click', 'view')),
rk AS (SELECT *, row_number() OVER (PARTITION BY source_system, source_record_key ORDER BY coalesce(updated, released) DESC NULLS LAST, release_no DESC NULLS LAST, processed DESC, raw_record_hash, source_observation_id) AS revision_rank FROM ob),
cl AS (SELECT *, CASE WHEN revision_rank = 1 THEN 'CURRENT' WHEN row_number() OVER (PARTITION BY source_system, source_record_key, raw_record_hash ORDER BY revision_rank) > 1 THEN 'DUPLICATE' ELSE 'SUPERSEDED' END AS revision_class FROM rk)"""


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as gold events: place from the customer's nation, magnitude and depth from price and key, with nulls."""
    c = F.col
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), c("n_regionkey") == c("r_regionkey"))
    customer = table(spark, sf_dir, "customer").join(F.broadcast(nation), c("c_nationkey") == c("n_nationkey"))  # a row a nation
    o = table(spark, sf_dir, "orders").join(customer, c("o_custkey") == c("c_custkey"))
    k = c("o_orderkey")
    magnitude = F.when(k % 13 > 0, half_up(F.log(1.0 + c("o_totalprice")) / 2.0, 2))
    depth = F.when(k % 17 > 0, (k % 700 - 20).cast("double"))
    day = F.to_date("o_orderdate")
    return o.select(
        k.alias("canonical_event_id"), day.alias("event_date_jst"), F.date_format(day, "yyyyMMdd").cast("int").alias("event_date_key_jst"), magnitude.alias("magnitude"), depth.alias("depth_km"),
        c("n_name").alias("region_key"), c("n_name").alias("region_name"), F.when(c("r_name") == "ASIA", "OFFSHORE").otherwise("PREFECTURE").alias("region_category"), magnitude_band(magnitude).alias("magnitude_band_code"), depth_band(depth).alias("depth_band_code"),
        F.when(c("o_orderstatus") == "F", "USGS_JMA").when(c("o_orderstatus") == "O", "USGS_ONLY").otherwise("JMA_ONLY").alias("source_coverage_code"),
        F.when(k % 10 == 0, True).when(k % 10 == 1, False).alias("tsunami_flag"), F.when(c("o_orderpriority") == "1-URGENT", "red").when(c("o_orderpriority") == "2-HIGH", " None ").alias("alert_level"), F.when(k % 4 == 0, (k % 7).cast("string")).alias("max_intensity_code"),
        (k % 19 > 0).alias("is_natural_earthquake"), (k % 23 > 0).alias("is_in_study_area"),
    )


def _bands(x: str, bands: str) -> str:
    cut = {"m": ((3, "LT_3"), (4, "M3_TO_LT4"), (5, "M4_TO_LT5"), (6, "M5_TO_LT6"), (7, "M6_TO_LT7"), (None, "GE_7")), "d": ((0, "NEGATIVE"), (70, "SHALLOW"), (300, "INTERMEDIATE"), (None, "DEEP"))}[bands]
    return f"CASE WHEN {x} IS NULL THEN 'UNKNOWN' " + " ".join(f"WHEN {x} < {u} THEN '{n}'" if u is not None else f"ELSE '{n}'" for u, n in cut) + " END"


STAR = f"""st0 AS (SELECT o_orderkey AS canonical_event_id, CAST(o_orderdate AS DATE) AS event_date_jst, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS event_date_key_jst,
  CASE WHEN o_orderkey % 13 > 0 THEN floor(ln(1.0::DOUBLE + o_totalprice) / 2.0::DOUBLE * 100 + 0.5) / 100 END AS magnitude, CASE WHEN o_orderkey % 17 > 0 THEN CAST(o_orderkey % 700 - 20 AS DOUBLE) END AS depth_km,
  n_name AS region_key, n_name AS region_name, CASE WHEN r_name = 'ASIA' THEN 'OFFSHORE' ELSE 'PREFECTURE' END AS region_category,
  CASE o_orderstatus WHEN 'F' THEN 'USGS_JMA' WHEN 'O' THEN 'USGS_ONLY' ELSE 'JMA_ONLY' END AS source_coverage_code, CASE o_orderkey % 10 WHEN 0 THEN true WHEN 1 THEN false END AS tsunami_flag,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'red' WHEN '2-HIGH' THEN ' None ' END AS alert_level, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 7 AS VARCHAR) END AS max_intensity_code,
  o_orderkey % 19 > 0 AS is_natural_earthquake, o_orderkey % 23 > 0 AS is_in_study_area
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
st AS (SELECT *, {_bands('magnitude', 'm')} AS magnitude_band_code, {_bands('depth_km', 'd')} AS depth_band_code FROM st0)"""

#: The windows of the surrogate catalogue's mainshocks, under the first law, and their candidates.
WINDOWS = f"""WITH {EVENTS},
us AS (SELECT * FROM ev WHERE mag >= 3.5 AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'),
ms0 AS (SELECT *, exp(-1.024 + 0.804 * mag) AS radius, exp(-2.870 + 1.235 * mag) * 24.0 AS post FROM us WHERE mag > 5.5 AND depth BETWEEN 50 AND 200),
ms1 AS (SELECT *, greatest(168.0::DOUBLE, post * 0.1) AS pre, radius / 110.57 AS dlat, least(180.0::DOUBLE, radius / (111.32 * cos(radians(lat)))) AS dlon FROM ms0),
ms AS (SELECT *, epoch_us(ts) - CAST(round(pre * 3600000000.0) AS BIGINT) AS s_us, epoch_us(ts) + CAST(round(post * 3600000000.0) AS BIGINT) AS e_us FROM ms1),
ca0 AS (SELECT m.event_id AS mid, c.event_id AS cid, m.mag AS mmag, c.mag AS cmag, m.ts AS mts, c.ts AS cts, m.radius, m.pre, m.post,
  111.32 * cos(radians(m.lat)) * (c.lon - m.lon) AS dx, 110.57 * (c.lat - m.lat) AS dy, c.depth - m.depth AS dz
  FROM ms m JOIN us c ON epoch_us(c.ts) BETWEEN m.s_us AND m.e_us AND c.lat BETWEEN m.lat - m.dlat AND m.lat + m.dlat AND c.lon BETWEEN m.lon - m.dlon AND m.lon + m.dlon),
ca AS (SELECT *, CASE WHEN mid = cid THEN 'MAINSHOCK' WHEN cts < mts THEN 'PRE' ELSE 'POST' END AS role, CASE WHEN mid = cid THEN 0.0 ELSE CAST(epoch_us(cts) - epoch_us(mts) AS DOUBLE) / 3600000000.0 END AS dt
  FROM ca0 WHERE sqrt(dx * dx + dy * dy) <= radius + 0.00001)"""
