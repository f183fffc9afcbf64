"""Registered queries, part 2: file sources and sinks (written to the shared
checkpoint folder by Spark and read back), request features, serving, mixed and
Bernoulli Bayes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalcast.constants import DATA_ATTRIBUTE_COLUMNS, DATA_LIST_COLUMNS, HYPER_PARAMETERS, KNOWN_LABELS
from goalcast.functions import columns as C
from goalcast.operators import bayes as B
from goalcast.operators import metrics as M
from goalcast.operators import requests as RQ
from goalcast.operators import selection as S
from goalcast.operators import serving as SV
from goalcast.plans import training as TR
from goalcast.plans import requests_flow as RS
from goalcast.plans.catalog import _key, _memo
from goalcast.plans.catalog import SCORE_THRESHOLD, _grid, _scored, counts, features_text, goal_list, prepared, r
from goalcast.plans.fixtures import FIXTURE_GOALS, impressions
from goalcast.plans.indexing import maybe_broadcast
from goalcast.session import cut_lineage, read_table, scratch_path
from goalcast.sinks import writers as W
from goalcast.sources import readers as RD

# ---------------------------------------------------------------- sources


def q_header_scan(spark, sf_dir):
    p = prepared(spark, sf_dir)
    path = scratch_path(spark, "header")
    W.write_header(p.dictionary.names, path)
    h = RD.read_header(spark, path)
    return h.select("idx", "name", F.col("is_label").cast("int").alias("is_label"))


def _sparse_with_edge_lines(p, path, compression=None):
    """Every encoded row as a sparse line (rows whose id % 89 == 0 also carry an index
    above the last label, which the reader ignores), plus extra lines the reader must
    drop: a copy with a non-integer token (row id % 97 == 0) and an empty line
    (row id % 101 == 0)."""
    base = W.sparse_lines(p.encoded, p.dictionary.size)
    rid = F.col("row_id")
    main = p.encoded.select(F.when(rid % 89 == 0, F.concat_ws("\t", base, F.lit(str(p.dictionary.size + 10))))
                            .otherwise(base).alias("value"))
    bad_token = p.encoded.where(rid % 97 == 0).select(F.concat(base, F.lit("\tx")).alias("value"))
    empty = p.encoded.where(rid % 101 == 0).select(F.lit("").alias("value"))
    w = main.unionByName(bad_token).unionByName(empty).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def _sparse_roundtrip(spark, sf_dir, compression=None):
    p = prepared(spark, sf_dir)
    hpath, dpath = scratch_path(spark, "header"), scratch_path(spark, "sparse")
    W.write_header(p.dictionary.names, hpath)
    _sparse_with_edge_lines(p, dpath, compression)
    rows = RD.read_sparse(spark, RD.read_header(spark, hpath), dpath)
    return rows.select(features_text().alias("features"), *KNOWN_LABELS)


def q_sparse_scan(spark, sf_dir):
    return _sparse_roundtrip(spark, sf_dir)


def q_gzip_scan(spark, sf_dir):
    return _sparse_roundtrip(spark, sf_dir, compression="gzip")


def q_train_from_sparse(spark, sf_dir):
    """The main path: sparse log folders (header, train, test) -> data group -> goal filter ->
    grid -> selection -> refit and outputs; returns the run statistics."""
    p = prepared(spark, sf_dir)
    base = scratch_path(spark, "sparse-log")
    W.write_header(p.dictionary.names, f"{base}/header")
    for s in ("train", "test"):
        W.write_sparse(p.encoded.where(F.col("set") == s), f"{base}/{s}", p.dictionary.size)
    run = TR.train_from_sparse(spark, f"{base}/header", {s: f"{base}/{s}" for s in ("train", "test")},
                               [g.upper() for g in FIXTURE_GOALS], f"{base}/run", "NB", run_params(spark, sf_dir))
    return run_stats_rounded(run.stats)


RAW_COLUMNS = ["row_id", "exchange2", "loc_state", "timezone_offset", "category", "device_os", "click"]


def q_raw_log_scan(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    rid = F.col("row_id")
    raw = imp.select(
        rid.cast("string").alias("row_id"), "exchange2",
        F.when(rid % 23 == 0, F.concat(F.lit('a$"'), F.col("loc_state"), F.lit('"$b'))).otherwise(F.col("loc_state")).alias("loc_state"),
        "timezone_offset",
        F.when(rid % 13 == 0, F.lit("nan")).otherwise(F.col("category")).alias("category"),
        F.when(rid % 19 == 0, F.lit("NULL")).otherwise(F.col("device_os")).alias("device_os"),
        F.col("click").cast("string").alias("click"))
    dpath, hpath = scratch_path(spark, "rawlog"), scratch_path(spark, "rawhead")
    from goalcast.plans.raw_flow import write_raw_log
    write_raw_log(raw, dpath, hpath)
    return RD.read_raw_log(spark, dpath, hpath).select(*RAW_COLUMNS)


def _param_files(spark, sf_dir) -> DataFrame:
    """One parameter file per region, built from the tables: date range, exchanges,
    campaigns (nation keys), an empty value, quoted lists and a duplicated key."""
    per = impressions(spark, sf_dir).groupBy(F.col("loc_country").alias("region")).agg(
        F.min("day_ts").alias("d0"), F.max("day_ts").alias("d1"),
        F.array_sort(F.collect_set("exchange2")).alias("ex"),
        F.array_sort(F.collect_set(F.col("nation_key").cast("string"))).alias("camp"))

    def quoted(a):
        return F.concat(F.lit('"'), F.array_join(F.transform(a, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ","), F.lit('"'))
    text = F.concat_ws("\n",
                       F.concat(F.lit("From_Date="), F.col("d0")), F.concat(F.lit("To_Date="), F.col("d1")),
                       F.concat(F.lit("Exchange="), quoted(F.col("ex"))), F.concat(F.lit("Campaign="), quoted(F.col("camp"))),
                       F.lit("iOS_OSV="), F.lit(""), F.lit("  Goal=\"'CLICK','BUY'\"  "), F.lit("Algorithm=\"'NB'\""),
                       F.lit("Algorithm=\"'XGB'\""), F.lit("Model='poly'"))
    return per.select("region", text.alias("value"))


def q_params_scan(spark, sf_dir):
    path = scratch_path(spark, "params")
    _param_files(spark, sf_dir).write.mode("overwrite").partitionBy("region").text(path)
    p = RD.read_parameter_files(spark, path, lower_values=False, pattern="part-*")
    region = F.url_decode(F.regexp_extract("file", r"region=([^/]+)", 1))
    return p.select(region.alias("region"), "key", F.array_join("values", ",").alias("value_text"),
                    F.col("is_list").cast("int").alias("is_list"), F.size("values").alias("n_values"))


PREDICTION_FILE_ROWS = 2000


def q_prediction_scan(spark, sf_dir):
    """Forest prediction files of up to 2000 rows written from the events (layouts ``0 1``,
    ``1 0`` and no ``1`` column in turn), read back line by line."""
    e = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), (F.col("value") / 500.0).alias("p"))
    part = F.floor(F.col("row_id") / PREDICTION_FILE_ROWS)
    b = part % 4
    rows = e.select(part.alias("part"), F.col("row_id").alias("line_no"),
                    F.when(b < 2, F.concat_ws(" ", (1.0 - F.col("p")).cast("string"), F.col("p").cast("string")))
                     .when(b == 2, F.concat_ws(" ", F.col("p").cast("string"), (1.0 - F.col("p")).cast("string")))
                     .otherwise(F.lit("1")).alias("value"))
    # the first row of a file carries the three head lines before it
    first = rows.groupBy("part").agg(F.min("line_no").alias("line_no")).withColumn("head", F.lit(True))
    layout = F.when(F.col("part") % 4 < 2, F.lit("0 1 ")).when(F.col("part") % 4 == 2, F.lit("1 0")).otherwise(F.lit("0"))
    head = F.concat(F.lit("Class predictions, one sample per row.\n"), layout, F.lit("\n\n"))
    path = scratch_path(spark, "pred")
    (rows.join(first, ["part", "line_no"], "left")
     .select("part", "line_no", F.when(F.col("head"), F.concat(head, "value")).otherwise(F.col("value")).alias("value"))
     .repartition("part").sortWithinPartitions("part", "line_no")
     .select("part", "value").write.mode("overwrite").partitionBy("part").text(path))
    out = RD.read_predictions(spark, path)
    return out.select(F.regexp_extract("file", r"part=(\d+)", 1).cast("long").alias("part"), "row", "prob", "pred")


def q_bayes_model_scan(spark, sf_dir):
    p = prepared(spark, sf_dir)
    c = counts(spark, sf_dir)
    path = scratch_path(spark, "model")
    W.write_bayes_model(c, "train", "click", SCORE_THRESHOLD, p.dictionary.names, path)
    m = RD.read_bayes_model(spark, path)
    if RD.read_bayes_model(spark, path, "recent") is not None:
        raise AssertionError("recent part must be absent")
    t = m["totals"]
    return m["keys"].select("i", "j", "pos", "neg", F.lit(t["pos"]).cast("long").alias("total_pos"),
                            F.lit(t["neg"]).cast("long").alias("total_neg"))


def q_raw_log_features(spark, sf_dir):
    """Feature build from a raw `$` log written from the tables, over all 22 attribute columns
    of the log (S4 -> P3 -> F1-F7 -> U1)."""
    from goalcast.plans import raw_flow as RF
    from goalcast.plans.fixtures import FIXTURE_RARITY
    dpath, hpath = scratch_path(spark, "rawlog-full"), scratch_path(spark, "rawlog-head")
    RF.write_raw_log(RF.raw_log_rows(RF.with_log_columns(impressions(spark, sf_dir))), dpath, hpath)
    p = RF.build_from_raw_log(spark, dpath, hpath, DATA_ATTRIBUTE_COLUMNS, DATA_LIST_COLUMNS, FIXTURE_GOALS, FIXTURE_RARITY)
    return p.encoded.select("row_id", "set", features_text().alias("features"), "click")


def q_config_grid(spark, sf_dir):
    """All families' grids as files, scanned and expanded for every valid goal."""
    import json
    goals = goal_list(spark, sf_dir)
    frames = []
    for fam, space in HYPER_PARAMETERS.items():
        path = scratch_path(spark, f"grid-{fam}")
        spark.createDataFrame([(json.dumps(space),)], "value string").write.mode("overwrite").text(path)
        g = RD.read_grid(spark, path, list(space))
        params = F.concat_ws(";", *[F.concat(F.lit(k + "="), F.col(k).cast("string")) for k in space])
        frames.append(g.select(F.lit(fam).alias("family"), "config_id", params.alias("params")))
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    return every.select(F.explode(F.array(*[F.lit(g) for g in goals])).alias("goal"), "family", "config_id", "params")


# ---------------------------------------------------------------- sinks (K4, K6, K7)


def q_keymap(spark, sf_dir):
    """The keymap in its three forms, written and read back: (form, name, idx)."""
    names = prepared(spark, sf_dir).dictionary.names
    out = {}
    for form in ("pairs", "forest", "linear"):
        path = scratch_path(spark, f"keymap-{form}")
        W.write_keymap(names, path, form)
        out[form] = spark.read.text(path, wholetext=form == "forest")
    parts = F.split(F.col("value"), r"\$\$")
    pairs = out["pairs"].select(F.lit("pairs").alias("form"), parts[0].alias("name"), parts[1].cast("int").alias("idx"))
    linear = out["linear"].select(F.lit("linear").alias("form"), F.from_json("value", "name string, idx int").alias("m")) \
        .select("form", "m.name", "m.idx")
    lines = F.split("value", "\n")
    forest = out["forest"].select(F.explode(F.arrays_zip(F.split(lines[0], ",").alias("name"), F.split(lines[1], ",").alias("idx"))).alias("m")) \
        .select(F.lit("forest").alias("form"), "m.name", F.col("m.idx").cast("int").alias("idx"))
    return pairs.unionByName(linear).unionByName(forest)


def _best_per_goal(spark, sf_dir):
    sel = S.select_best(_grid(spark, sf_dir), ["goal"]).withColumnRenamed("threshold", "rarity_threshold")
    return TR._best_rows(sel, ["rarity_threshold"])


def run_stats_rounded(st: DataFrame) -> DataFrame:
    return st.select("Model_ID", "Algorithm", "Goal", r(F.col("AUC").cast("double")).alias("AUC"),
                     r(F.col("LogLoss").cast("double")).alias("LogLoss"), r(F.col("Accuracy").cast("double")).alias("Accuracy"),
                     "Status", "Files")


def q_run_stats(spark, sf_dir):
    return run_stats_rounded(W.run_stats(_best_per_goal(spark, sf_dir), "NB"))


def run_params(spark, sf_dir) -> dict:
    """Run parameters derived from the data: date window, exchanges, campaigns."""
    row = impressions(spark, sf_dir).agg(F.min("day_ts").alias("d0"), F.max("day_ts").alias("d1"),
                F.array_sort(F.collect_set("exchange2")).alias("ex"),
                F.array_sort(F.collect_set("nation_key")).alias("camp")).collect()[0]  # one row
    return {"From_Date": row["d0"], "To_Date": row["d1"], "Exchange": list(row["ex"]),
            "Campaign": [str(c) for c in row["camp"]]}


def q_refresh_descriptor(spark, sf_dir):
    best = _best_per_goal(spark, sf_dir).where("valid")
    d = W.refresh_descriptor(best, run_params(spark, sf_dir), "NB")
    tf = F.col("time_frames")[0]
    path = scratch_path(spark, "refresh")
    d.select("goal", "descriptor").write.mode("overwrite").partitionBy("goal").text(path)
    return d.select("goal", F.array_join(F.col("campaign_ids").cast("array<string>"), ",").alias("campaign_ids"),
                    F.array_join("exchanges", ",").alias("exchanges"), "model_type",
                    F.col("extra.rarity-threshold").alias("rarity_threshold"),
                    tf["from"].alias("time_from"), tf["to"].alias("time_to"))


# ---------------------------------------------------------------- requests


def request_frame(spark, sf_dir) -> DataFrame:
    """Bid requests as JSON text built from the impressions rows."""
    imp = impressions(spark, sf_dir)
    rid = F.col("row_id")
    is_site = F.col("exchange2") == "mopub"
    empty = F.array().cast("array<int>")
    banner = F.struct((rid % 3).alias("pos"),
                      F.when(rid % 5 == 0, empty).otherwise(F.array(F.lit(300), F.lit(320))).alias("w"),
                      F.when(rid % 5 == 0, empty).otherwise(F.array(F.lit(250), F.lit(50))).alias("h"))
    imp_arr = F.array(F.struct(banner.alias("banner"),
                               F.when(rid % 2 == 0, F.lit("nativead")).otherwise(F.lit("banner")).alias("imp_type")))
    cat = F.split(F.col("category"), "[.]")
    pub = F.struct(F.col("publisher").alias("id"))
    site = F.when(is_site, F.struct(pub.alias("publisher"),
                                     F.concat(F.lit("https://"), F.col("domain"), F.lit(".example.com/p?i="),
                                              rid.cast("string")).alias("page"), cat.alias("cat")))
    app = F.when(~is_site, F.struct(pub.alias("publisher"), F.concat(F.lit("com."), F.col("domain")).alias("bundle"),
                                    cat.alias("cat")))
    tz = F.when(F.col("timezone_offset").isNotNull(), C.offset_hours("timezone_offset"))
    device = F.struct(F.col("device_os").alias("os"),
                      F.struct(F.concat(F.substring("domain", 2, 10), F.lit(" "), (rid % 90).cast("string")).alias("zip")).alias("geo"),
                      F.struct(F.when(rid % 9 != 0, tz).alias("timezone_offset")).alias("ext"),
                      F.when(rid % 4 == 0, F.lit("Chrome")).alias("browser"))
    ext = F.struct(F.when(rid % 6 == 0, F.array("loc_country", "loc_city")).alias("locationSegments"))
    js = F.to_json(F.struct(F.col("exchange2").alias("dc_log"), imp_arr.alias("imp"), site.alias("site"),
                            app.alias("app"), device.alias("device"), ext.alias("ext"),
                            F.when(rid % 9 == 0, tz).alias("timezone")))
    # agents: sub account, format and a category of their own, one JSON object each
    agent = lambda k: F.to_json(F.struct(
        F.concat(F.lit("s"), ((rid + k) % 3).cast("string")).alias("subAccount"), F.lit("300x250").alias("format"),
        F.concat(F.lit("IAB"), ((rid + 5 * k) % 25).cast("string")).alias("cat")))
    agents = F.transform(F.sequence(F.lit(0), (rid % 3).cast("int")), agent)
    return imp.select(rid.alias("request_id"), F.col("timestamp").alias("ts"), js.alias("request"), agents.alias("agents"))


def q_request_features(spark, sf_dir):
    return RQ.extract_features(request_frame(spark, sf_dir), "request_id", "request", "ts", RQ.REQUEST_SPEC)


def q_domain_feature(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", C.domain_feature("domain", F.col("url")).alias("feature"))


def q_hour_of_week_mod(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    return imp.select("row_id", C.hour_of_week_mod("timestamp", C.offset_hours("timezone_offset")).alias("how"))


def q_time_of_day(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    return imp.select("row_id", C.time_of_day("timestamp", C.offset_hours("timezone_offset")).alias("tod"))


def q_registered_feature(spark, sf_dir):
    """A feature function plugged in beside the scorer's own: the first category of the app
    or site, upper level only."""
    def top_category(name, acc, field, ts):
        first = F.try_element_at(acc.array(field), F.lit(1))
        return F.when(first.isNotNull(), F.concat(F.lit(name), F.regexp_extract(first, r"^([A-Z]+)", 1)))
    RQ.register_feature("top_category", top_category, {"": "array"})
    spec = [{"name": "top", "field": "site.cat", "other_field": "app.cat", "type": 2, "function_name": "top_category"}]
    return RQ.extract_features(request_frame(spark, sf_dir), "request_id", "request", "ts", spec)


# ---------------------------------------------------------------- serving (H2-H6)

CR_THRESHOLDS = [0.3, 0.2, 0.1]
CR_RATES = [0.08, 0.07, 0.09, 0.13]


def q_cr_adapter(spark, sf_dir):
    s = _scored(spark, sf_dir, ["click"], [SCORE_THRESHOLD])
    return s.select("row_id", SV.cr_step(F.col("prob"), CR_THRESHOLDS, CR_RATES).alias("cr"))


def q_confusion_score(spark, sf_dir):
    """Rows scored once (written), then folded to the test rates and read again."""
    s = cut_lineage(_scored(spark, sf_dir, ["click"], [SCORE_THRESHOLD]).select("row_id", "set", "y", "prob", "pred"), "scored")
    test = M.confusion_counts(s.where(F.col("set") == "test"), []).select(*M.rate_columns())
    rate = test.collect()[0]  # one row
    return s.select("row_id", r(SV.confusion_score(F.col("pred"), F.lit(rate["true_positive"]),
                                                   F.lit(rate["false_negative"]))).alias("cr"))


def _agent_requests(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    per_turn = conv.select("conv_id", "turn", F.array(F.concat(F.lit("role"), F.col("role")),
                                                      F.concat(F.lit("len"), F.floor(F.length("text") / 100).cast("string")))
                           .alias("ap"), F.length("text").alias("n_chars"))
    req = per_turn.groupBy("conv_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", "ap"))), lambda s: s["ap"])).alias("agent_props"))
    return req.select("conv_id", F.array(F.concat(F.lit("conv"), (F.col("conv_id") % 7).cast("string"))).alias("request_props"),
                      "agent_props"), per_turn


def q_agent_fanout(spark, sf_dir):
    req, _ = _agent_requests(spark, sf_dir)
    fo = SV.fan_out(req, "conv_id", "agent_props", "request_props", 2)
    return fo.select("conv_id", "agent", F.array_join("props", " ").alias("props"))


def q_best_agent(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    from pyspark.sql import Window
    w = Window.partitionBy("conv_id").orderBy("turn")
    agents = conv.select("conv_id", (F.row_number().over(w) - 1).alias("agent"),
                         r(F.length("text") / 2000.0, 2).alias("prediction"))
    return SV.best_agent(agents, "conv_id")


def q_bayes_score_named(spark, sf_dir):
    p = prepared(spark, sf_dir)
    names = p.dictionary.names
    named = SV.indices_to_names(p.encoded, "row_id", names, p.dictionary.size)
    named = cut_lineage(named.select("row_id", F.concat("names", F.array(F.lit("zz_unknown_feature"))).alias("names")), "names")
    idx = cut_lineage(SV.names_to_indices(named, "row_id", "names", names, p.dictionary.size), "named-rows")
    used = F.array_join(F.sort_array(SV.used_combinations(F.col("features"), F.col("known"))), " ").alias("used")
    spec = B.ModelSpec("m", "train", "click", SCORE_THRESHOLD)
    sc = B.score_models(idx.withColumn("used", used), counts(spark, sf_dir), [spec], ["row_id", "used"]).scores
    return sc.select("row_id", r("prob").alias("prob"), "pred", "used")


def _recent_days(spark, sf_dir):
    """Condition for the last seven train days."""
    p = prepared(spark, sf_dir)
    days = sorted(r_["day_ts"] for r_ in p.encoded.where("set = 'train'").select("day_ts").distinct().collect())
    cutoff = days[-7] if len(days) >= 7 else days[0]  # day list: one row per day
    return (F.col("set") == "train") & (F.col("day_ts") >= F.lit(cutoff))


def _with_recent(spark, sf_dir) -> B.BayesCounts:
    """Counts of all train days and of the last seven."""
    return B.fit_counts(prepared(spark, sf_dir).encoded, ["click"], ("train", "recent"), predicates={"recent": _recent_days(spark, sf_dir)})


HIST, RECENT = (B.ModelSpec(s, s, "click", SCORE_THRESHOLD) for s in ("train", "recent"))


def q_combined_bayes(spark, sf_dir):
    c = _with_recent(spark, sf_dir)
    mixed = B.mixed_scores(prepared(spark, sf_dir).encoded, c, HIST, RECENT, ["row_id"], 0.7, c.totals["n_recent"] > 0)
    return mixed.select("row_id", r("prob").alias("prob"))


def q_incremental_bayes(spark, sf_dir):
    """Both models as sums of a count table by day, to which the last day is added on its own."""
    p, path = prepared(spark, sf_dir), scratch_path(spark, "day-counts")
    last = p.encoded.agg(F.max("day_ts")).collect()[0][0]      # one row
    B.write_day_counts(p.encoded.where(F.col("day_ts") < last), ["click"], path)
    B.write_day_counts(p.encoded.where(F.col("day_ts") == last), ["click"], path)
    c = B.counts_of_days(spark, path, ["click"], {"train": F.col("set") == "train", "recent": _recent_days(spark, sf_dir)})
    alpha, use = B.incremental_alpha(c.totals["pos_recent_click"])
    mixed = B.mixed_scores(p.encoded, c, HIST, RECENT, ["row_id"], alpha, use)
    return mixed.select("row_id", r("prob").alias("prob"))


def q_bernoulli_nb(spark, sf_dir):
    """All configurations of the grid over all rows: one explode, one join, a column per alpha."""
    p, c = prepared(spark, sf_dir), counts(spark, sf_dir)
    space = HYPER_PARAMETERS["NB"]
    fits = [B.bernoulli_nb_params(c, "train", "click", a, True, p.dictionary.size) for a in space["alpha"]]
    table = fits[0][0].select("i", *[F.col(x).alias(f"{x}0") for x in ("adjp", "adjn", "l1mp", "l1mn")])
    for k, (feats, _) in enumerate(fits[1:], start=1):
        table = table.join(feats.select("i", *[F.col(x).alias(f"{x}{k}") for x in ("adjp", "adjn", "l1mp", "l1mn")]), "i")
    table = cut_lineage(table, "bernoulli")
    sums = table.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"{x}{k}").alias(f"{x}{k}") for k in range(len(fits)) for x in ("l1mp", "l1mn")]) \
        .collect()[0]  # one row
    unseen = p.dictionary.size - sums["n"]
    rows = p.encoded.select("row_id", F.explode_outer("features").alias("i")).join(maybe_broadcast(table, sums["n"]), "i", "left")
    per = rows.groupBy("row_id").agg(*[F.coalesce(F.sum(f"{x}{k}"), F.lit(0.0)).alias(f"{x}{k}") for k in range(len(fits)) for x in ("adjp", "adjn")])
    import math
    n, pos = c.totals["n_train"], c.totals["pos_train_click"]
    out = []
    for k, (_, const) in enumerate(fits):
        for q, prior in enumerate(space["fit_prior"]):
            pp, pn = (math.log(pos / n), math.log((n - pos) / n)) if prior else (math.log(0.5), math.log(0.5))
            l1 = F.lit(sums[f"l1mp{k}"] + unseen * const["unseen_p"] + pp) + F.col(f"adjp{k}")
            l0 = F.lit(sums[f"l1mn{k}"] + unseen * const["unseen_n"] + pn) + F.col(f"adjn{k}")
            out.append(F.struct(F.lit(k * len(space["fit_prior"]) + q).alias("config_id"), r(B.probability(l1, l0)).alias("prob"),
                                (B.log_odds(l1, l0) > 0).cast("int").alias("pred")))
    return per.select("row_id", F.explode(F.array(*out)).alias("m")).select("row_id", "m.*")


# ---------------------------------------------------------------- the request chain


AGENT_FIELDS = RQ.AGENT_SPEC + [{"name": "category", "field": "cat"}]


def written_model(spark, sf_dir) -> str:
    """Model folder of the click model (train rows), written once per session."""
    k = _key(spark, "model-folder", sf_dir)
    if k not in _memo:
        path = scratch_path(spark, "click-model")
        W.write_bayes_model(counts(spark, sf_dir), "train", "click", SCORE_THRESHOLD, prepared(spark, sf_dir).dictionary.names, path)
        _memo[k] = path
    return _memo[k]


def q_score_requests(spark, sf_dir):
    """Bid requests through the whole chain with a model loaded from its folder: agent fan-out
    -> request and agent features -> indices -> probability -> CR step -> best agent."""
    out = RS.score_requests(request_frame(spark, sf_dir), written_model(spark, sf_dir), "click", "request_id", "request", "ts",
                            "agents", RQ.REQUEST_SPEC, AGENT_FIELDS, CR_THRESHOLDS, CR_RATES)
    return out.select("request_id", "agent", r("prob").alias("prob"), "cr")


QUERIES_MORE = {
    "header_scan": q_header_scan,
    "sparse_scan": q_sparse_scan,
    "gzip_scan": q_gzip_scan,
    "raw_log_scan": q_raw_log_scan,
    "params_scan": q_params_scan,
    "prediction_scan": q_prediction_scan,
    "bayes_model_scan": q_bayes_model_scan,
    "config_grid": q_config_grid,
    "raw_log_features": q_raw_log_features,
    "keymap": q_keymap,
    "run_stats": q_run_stats,
    "refresh_descriptor": q_refresh_descriptor,
    "request_features": q_request_features,
    "domain_feature": q_domain_feature,
    "hour_of_week_mod": q_hour_of_week_mod,
    "time_of_day": q_time_of_day,
    "cr_adapter": q_cr_adapter,
    "confusion_score": q_confusion_score,
    "agent_fanout": q_agent_fanout,
    "best_agent": q_best_agent,
    "bayes_score_named": q_bayes_score_named,
    "combined_bayes": q_combined_bayes,
    "incremental_bayes": q_incremental_bayes,
    "bernoulli_nb": q_bernoulli_nb,
    "train_from_sparse": q_train_from_sparse,
    "registered_feature": q_registered_feature,
    "score_requests": q_score_requests,
}
