"""Sinks: header + sparse rows (inverse of S1/S2), dense matrix export (K1) with case
weights (K2), score dumps (K3), keymap (K4), grid table (K5), run statistics (K6),
refresh descriptor (K7), Bayes model tables (K8 for the count-based family).

Every writer is a distributed DataFrame write; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goalcast.constants import KNOWN_LABELS


def header_line(names: DataFrame, labels: list[str] = KNOWN_LABELS) -> DataFrame:
    """One row: tab-joined feature names in index order, then the label names. The
    header format is one line by definition; its size is the dictionary size."""
    n = names.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "name"))),
                                           lambda s: s["name"]), "\t").alias("h"))
    return n.select(F.concat_ws("\t", F.col("h"), *[F.lit(x) for x in labels]).alias("value"))


def write_header(names: DataFrame, path: str, labels: list[str] = KNOWN_LABELS) -> None:
    header_line(names, labels).coalesce(1).write.mode("overwrite").text(path)


def sparse_lines(encoded: DataFrame, n_features: int, labels: list[str] = KNOWN_LABELS) -> Column:
    """Tab-joined indices of present features and labels (label k at n_features + k)."""
    lab = [F.when(F.col(g) == 1, F.lit(str(n_features + k))) for k, g in enumerate(labels)]
    feats = F.array_join(F.col("features").cast("array<string>"), "\t")
    return F.concat_ws("\t", F.when(F.size("features") > 0, feats), *lab)


def write_sparse(encoded: DataFrame, path: str, n_features: int, labels: list[str] = KNOWN_LABELS,
                 compression: str | None = None) -> None:
    line = sparse_lines(encoded, n_features, labels)
    w = encoded.select(line.alias("value")).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def dense_rows(n_features: int, y: str = "y") -> Column:
    """K1 line: 0/1 per feature in index order, then the label (dense, by design of the
    format: width = dictionary size + 1). Built by walking the row's sorted indices: the run
    of zeros before each one, then the tail."""
    f = F.col("features")
    ones = F.transform(f, lambda x, i: F.concat(
        F.repeat(F.lit("0\t"), x - F.when(i == 0, F.lit(0)).otherwise(F.get(f, i - 1) + 1)), F.lit("1\t")))
    tail = F.lit(n_features) - F.when(F.size(f) > 0, F.get(f, F.size(f) - 1) + 1).otherwise(F.lit(0))
    return F.concat(F.array_join(ones, ""), F.repeat(F.lit("0\t"), tail), F.col(y).cast("string"))


def write_matrix(encoded: DataFrame, names: DataFrame, path: str, n_features: int, y: str = "y") -> None:
    """K1 + K2 per set: ``header`` (one file, names + ``__label__``), ``rows/set=.../`` (gzip
    TSV, as wide as the header) and ``weights/set=.../`` (``row_id<TAB>%.5f``). Rows and
    weights carry the same ordering (by row id inside each part); the weight file names its row,
    so neither depends on how the other is split into parts."""
    header_line(names, ["__label__"]).coalesce(1).write.mode("overwrite").text(f"{path}/header")
    rows = encoded.sortWithinPartitions("set", "row_id")
    # runs of zeros: the fastest level takes half the time of the default one
    rows.select("set", dense_rows(n_features, y).alias("value")).write.mode("overwrite").partitionBy("set") \
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(f"{path}/rows")
    rows.select("set", F.concat_ws("\t", F.col("row_id").cast("string"), F.format_string("%.5f", F.col("weight"))).alias("value")) \
        .write.mode("overwrite").partitionBy("set").text(f"{path}/weights")


def write_scores(scored: DataFrame, path: str) -> None:
    """K3: probabilities, predictions and labels per set, keyed by row."""
    scored.select("row_id", "set", "prob", "pred", "y").write.mode("overwrite").partitionBy("set") \
        .option("header", "true").csv(path)


def keymap_lines(names: DataFrame, form: str = "pairs") -> DataFrame:
    """K4 in its three forms: ``pairs`` (boosted trees: ``name$$index`` lines from 0),
    ``forest`` (one line of names, one of 1-based indices, comma-joined: one row of dictionary
    size by format), ``linear`` (one JSON object per name with its 0-based index)."""
    if form == "pairs":
        return names.select(F.concat_ws("$$", F.col("name"), F.col("idx").cast("string")).alias("value"))
    if form == "linear":
        return names.select(F.to_json(F.struct("name", "idx")).alias("value"))
    if form == "forest":
        ordered = F.array_sort(F.collect_list(F.struct("idx", "name")))
        return names.agg(ordered.alias("m")).select(F.concat_ws(
            "\n", F.array_join(F.transform("m", lambda s: s["name"]), ","),
            F.array_join(F.transform("m", lambda s: (s["idx"] + 1).cast("string")), ",")).alias("value"))
    raise ValueError(f"unknown keymap form {form}")


#: Family -> form of its keymap.
KEYMAP_FORM = {"rf": "forest", "sgd": "linear", "lasso": "linear"}


def write_keymap(names: DataFrame, path: str, form: str = "pairs") -> None:
    out = keymap_lines(names, form)
    (out.coalesce(1) if form == "forest" else out).write.mode("overwrite").text(path)


def write_grid_table(grid: DataFrame, path: str) -> None:
    """K5: one row per configuration with params, metrics, validity and ``best``."""
    grid.write.mode("overwrite").option("header", "true").csv(path)


RUN_STATS_COLUMNS = ["Model_ID", "Algorithm", "Goal", "AUC", "LogLoss", "Accuracy", "Status", "Files"]


def run_stats(best: DataFrame, algorithm: str) -> DataFrame:
    """K6: one row per valid goal. ``Accuracy`` holds the test F1 (kept as named).
    ``best`` has one row per goal with ``valid`` and the best config's test metrics."""
    model_id = F.substring(F.md5(F.concat(F.lit(algorithm + ":"), F.col("goal"))), 1, 32)
    ok = F.col("valid")
    return best.select(
        model_id.alias("Model_ID"), F.lit(algorithm).alias("Algorithm"), F.col("goal").alias("Goal"),
        F.when(ok, F.col("roc_auc_test")).alias("AUC"), F.when(ok, F.col("log_loss_test")).alias("LogLoss"),
        F.when(ok, F.col("f1_test")).alias("Accuracy"),
        F.when(ok, F.lit("success")).otherwise(F.lit("invalid")).alias("Status"),
        F.when(ok, F.lit("model;keymap")).otherwise(F.lit("")).alias("Files"))


def write_run_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("overwrite").option("header", "true").csv(path)


def refresh_descriptor(best: DataFrame, params: dict, model_type: str) -> DataFrame:
    """K7 columns per goal: campaign ids as int, goal, exchanges, model id/type/file,
    extra (rarity threshold), one time frame as ISO dates; plus the JSON text."""
    camp = F.array(*[F.lit(int(c)) for c in params["Campaign"]])
    exch = F.array(*[F.lit(e) for e in params["Exchange"]])
    frm = F.date_format(F.to_timestamp(F.lit(params["From_Date"]), "yyyyMMdd"), "yyyy-MM-dd'T'HH:mm:ss")
    to = F.date_format(F.to_timestamp(F.lit(params["To_Date"]), "yyyyMMdd"), "yyyy-MM-dd'T'HH:mm:ss")
    model_id = F.substring(F.md5(F.concat(F.lit(model_type + ":"), F.col("goal"))), 1, 32)
    out = best.select(
        camp.alias("campaign_ids"), F.col("goal"), exch.alias("exchanges"), model_id.alias("model_id"),
        F.lit(model_type).alias("model_type"), F.concat(F.lit("model_"), model_id).alias("model_file_name"),
        F.struct(F.col("rarity_threshold").alias("rarity-threshold")).alias("extra"),
        F.array(F.struct(frm.alias("from"), to.alias("to"))).alias("time_frames"))
    return out.withColumn("descriptor", F.to_json(F.struct(*out.columns)))


def write_bayes_model(counts, scope: str, goal: str, threshold: int, names: DataFrame, path: str,
                      prefix: str = "historical") -> None:
    """K8 for the pair-count family: ``index``, ``positive_counts``, ``negative_counts``
    (``i,j<TAB>count``), ``label_counts`` (positive line then negative line)."""
    k = counts.keys.where(F.col(f"n_{scope}") >= threshold)
    pos = F.col(f"pos_{scope}_{goal}")
    neg = F.col(f"n_{scope}") - pos
    key = F.concat_ws(",", F.col("i").cast("string"), F.col("j").cast("string"))
    k.where(pos > 0).select(F.concat_ws("\t", key, pos.cast("string")).alias("value")) \
        .write.mode("overwrite").text(f"{path}/{prefix}/positive_counts")
    k.where(neg > 0).select(F.concat_ws("\t", key, neg.cast("string")).alias("value")) \
        .write.mode("overwrite").text(f"{path}/{prefix}/negative_counts")
    n = counts.totals[f"n_{scope}"]
    npos = counts.totals[f"pos_{scope}_{goal}"]
    spark = k.sparkSession
    # two ordered lines in one file: positive total first, then negative
    spark.createDataFrame([(f"positive\t{npos}\nnegative\t{n - npos}",)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/{prefix}/label_counts")
    names.select(F.concat_ws("\t", "name", F.col("idx").cast("string")).alias("value")) \
        .write.mode("overwrite").text(f"{path}/index")
