"""The ``impressions`` view over the driver's tables (see FIXTURES.md §3).

events ⋈ customer ⋈ nation ⋈ region. nation and region are fixed-size dimension
tables (25 and 5 rows), so their join is broadcast; customer is broadcast only
behind a checked row count and is a shuffle join beyond it. The events scan is
spread by row key when it has fewer splits than the cluster has cores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalcast.plans.indexing import maybe_broadcast
from goalcast.session import read_table

IMPRESSION_COLUMNS = [
    "row_id", "timestamp", "day_ts", "timezone_offset", "exchange2", "loc_country", "loc_state",
    "loc_city", "publisher", "domain", "device_os", "app_site_ind", "category",
    "click", "buy", "register", "video_ad_start", "download", "score", "nation_key",
]

# Attribute / list columns of the fixture that exist among the raw-log feature columns.
FIXTURE_ATTRIBUTE_COLUMNS = [
    "app_site_ind", "domain", "publisher", "device_os", "loc_country", "country_state",
    "country_state_city", "HOW",
]
FIXTURE_LIST_COLUMNS = ["category"]
FIXTURE_GOALS = ["click", "download", "buy", "register", "video_ad_start"]
FIXTURE_RARITY = 50


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
    # customer is broadcast only behind a checked row count (parquet footers);
    # beyond it the join is a shuffle join chosen by the planner
    cust = maybe_broadcast(cust, c.count())
    e = spread_by_row(e, e.rdd.getNumPartitions(), "event_id")
    j = e.join(cust, e.user_id == cust.c_custkey)
    k = F.get_json_object("props", "$.k")
    ki = k.cast("int")
    uid = F.col("user_id")
    eid = F.col("event_id")
    et = F.col("event_type")
    out = j.select(
        eid.alias("row_id"),
        F.col("ts").alias("timestamp"),
        F.date_format("ts", "yyyyMMdd").alias("day_ts"),
        F.when(uid % 10 == 0, F.lit(None).cast("string"))
         .when(uid % 10 == 1, F.lit("\\N"))
         .otherwise((uid % 25 - 12).cast("string")).alias("timezone_offset"),
        F.when(eid % 3 == 0, F.lit("adx")).otherwise(F.lit("mopub")).alias("exchange2"),
        F.col("r_name").alias("loc_country"),
        F.when(eid % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("loc_state"),
        F.col("c_mktsegment").alias("loc_city"),
        F.concat(F.lit("p"), uid.cast("string")).alias("publisher"),
        F.concat(F.lit("d"), k).alias("domain"),
        F.concat(F.lit("os"), (eid % 4).cast("string")).alias("device_os"),
        F.lit("const").alias("app_site_ind"),
        F.when(ki % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("IAB"), (ki % 25).cast("string"), F.lit(".IAB"), (ki % 7).cast("string")))
         .alias("category"),
        (et == "click").cast("int").alias("click"),
        (et == "purchase").cast("int").alias("buy"),
        (et == "signup").cast("int").alias("register"),
        (et == "view").cast("int").alias("video_ad_start"),
        F.lit(0).alias("download"),
        F.col("value").alias("score"),
        F.col("c_nationkey").alias("nation_key"),
    )
    return out


def spread_by_row(df: DataFrame, scan_parts: int, key: str = "row_id") -> DataFrame:
    """Hash-partition by the row key when the scan yields fewer splits than the
    cluster has cores (a few large files with one row group each). On a cluster
    reading many files the scan is already wide and this adds nothing. Clustering
    by the row key also lets every later ``groupBy(row_id, ...)`` run without an
    exchange."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if scan_parts < target:
        return df.repartition(target, key)
    return df


# DuckDB text of the same view, for oracle queries (pre-registered tables).
IMPRESSIONS_SQL = r"""
impressions AS (
  SELECT e.event_id AS row_id, e.ts AS "timestamp", strftime(e.ts, '%Y%m%d') AS day_ts,
    CASE WHEN e.user_id % 10 = 0 THEN NULL WHEN e.user_id % 10 = 1 THEN '\N'
         ELSE CAST(e.user_id % 25 - 12 AS VARCHAR) END AS timezone_offset,
    CASE WHEN e.event_id % 3 = 0 THEN 'adx' ELSE 'mopub' END AS exchange2,
    r.r_name AS loc_country,
    CASE WHEN e.event_id % 50 = 0 THEN NULL ELSE n.n_name END AS loc_state,
    c.c_mktsegment AS loc_city,
    concat('p', CAST(e.user_id AS VARCHAR)) AS publisher,
    concat('d', json_extract_string(e.props, '$.k')) AS domain,
    concat('os', CAST(e.event_id % 4 AS VARCHAR)) AS device_os,
    'const' AS app_site_ind,
    CASE WHEN CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 17 = 0 THEN NULL
         ELSE concat('IAB', CAST(CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 25 AS VARCHAR),
                     '.IAB', CAST(CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 7 AS VARCHAR)) END AS category,
    CAST(e.event_type = 'click' AS INTEGER) AS click,
    CAST(e.event_type = 'purchase' AS INTEGER) AS buy,
    CAST(e.event_type = 'signup' AS INTEGER) AS register,
    CAST(e.event_type = 'view' AS INTEGER) AS video_ad_start,
    0 AS download,
    e.value AS score,
    c.c_nationkey AS nation_key
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""
