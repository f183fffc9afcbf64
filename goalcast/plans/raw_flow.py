"""Feature build from a raw `$` log (the older loader, SURVEY §3.2) as one Spark flow:
S4 scan with null tokens -> P3 labels -> F1/F2 location combinations -> F3 hour of week ->
F5 list and F4 attribute one-hot -> F6 concatenation -> F7 location patch -> split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalcast.functions import columns as C
from goalcast.plans.prepare import Prepared, prepare_encoded
from goalcast.sources.readers import read_raw_log

# Raw-log column order written by ``write_raw_log`` (strings only, as in the log format).
RAW_LOG_COLUMNS = ["row_id", "timestamp", "timezone_offset", "day_ts", "exchange2", "loc_country", "loc_state",
                   "loc_city", "publisher", "domain", "device_os", "app_site_ind", "category",
                   "impression_position_val", "impression_viewability", "formats", "device_language", "device_make",
                   "device_model", "device_osv", "zip", "datacenter", "browser", "banner", "ad_type", "banner_size",
                   "sub_account_id", "click", "download", "buy", "register", "video_ad_start"]


def typed_raw_log(raw: DataFrame, labels: list[str]) -> DataFrame:
    """All-string log -> typed rows: labels 0/1 (null -> 0), ISO timestamp parsed (UTC)."""
    cols = [F.col("row_id").cast("long").alias("row_id"), F.to_timestamp("timestamp").alias("timestamp")]
    cols += [F.col(c) for c in raw.columns if c not in ("row_id", "timestamp", *labels)]
    cols += [C.label_value(F.col(g)).alias(g) for g in labels]
    return raw.select(*cols)


def build_from_raw_log(spark: SparkSession, data_path: str, header_path: str, attribute_cols: list[str],
                       list_cols: list[str], labels: list[str], threshold: int,
                       families: list[str] | None = None) -> Prepared:
    raw = typed_raw_log(read_raw_log(spark, data_path, header_path), labels)
    return prepare_encoded(raw, attribute_cols, list_cols, labels, threshold, families)


def with_log_columns(impressions: DataFrame) -> DataFrame:
    """The log columns that the impressions view lacks, from its row id and exchange."""
    rid, none = F.col("row_id"), F.lit(None).cast("string")

    def level(prefix: str, n: int):
        return F.concat(F.lit(prefix), (rid % n).cast("string"))
    return impressions.withColumns({
        "impression_position_val": (rid % 3).cast("string"), "impression_viewability": none,
        "formats": F.when(rid % 2 == 0, F.lit("300x250")).otherwise(F.lit("320x50")),
        "device_language": level("l", 5), "device_make": level("m", 6), "device_model": level("mo", 11),
        "device_osv": level("v", 8), "zip": level("z", 40), "datacenter": F.col("exchange2"),
        "browser": F.when(rid % 4 == 0, F.lit("Chrome")), "banner": none,
        "ad_type": F.when(rid % 2 == 0, F.lit("nativead")).otherwise(F.lit("OTHER")), "banner_size": F.lit("300x250"),
        "sub_account_id": level("s", 3)})


# The same columns in DuckDB.
LOG_COLUMNS_SQL = """CAST(row_id % 3 AS VARCHAR) AS impression_position_val, NULL::VARCHAR AS impression_viewability,
    CASE WHEN row_id % 2 = 0 THEN '300x250' ELSE '320x50' END AS formats, 'l' || (row_id % 5) AS device_language,
    'm' || (row_id % 6) AS device_make, 'mo' || (row_id % 11) AS device_model, 'v' || (row_id % 8) AS device_osv,
    'z' || (row_id % 40) AS zip, exchange2 AS datacenter, CASE WHEN row_id % 4 = 0 THEN 'Chrome' END AS browser,
    NULL::VARCHAR AS banner, CASE WHEN row_id % 2 = 0 THEN 'nativead' ELSE 'OTHER' END AS ad_type,
    '300x250' AS banner_size, 's' || (row_id % 3) AS sub_account_id"""


def raw_log_rows(impressions: DataFrame) -> DataFrame:
    """The impressions as raw-log strings, with the null spellings of the format:
    ``\\N`` for missing values, ``nan`` and ``NULL`` in some rows, missing labels."""
    rid = F.col("row_id")
    out = []
    for c in RAW_LOG_COLUMNS:
        col = F.col(c)
        if c == "timestamp":
            col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        elif c == "category":
            col = F.when(rid % 13 == 0, F.lit("nan")).otherwise(col)
        elif c == "device_os":
            col = F.when(rid % 19 == 0, F.lit("NULL")).otherwise(col)
        elif c == "click":
            col = F.when(rid % 7 == 0, F.lit(None)).otherwise(col)
        out.append(col.cast("string").alias(c))
    return impressions.select(*out)


def write_raw_log(rows: DataFrame, data_path: str, header_path: str) -> None:
    (rows.write.mode("overwrite").option("sep", "$").option("quote", '"').option("escape", '"')
     .option("nullValue", "\\N").csv(data_path))
    rows.sparkSession.createDataFrame([tuple(rows.columns)], rows.columns).coalesce(1) \
        .write.mode("overwrite").option("header", "true").csv(header_path)
