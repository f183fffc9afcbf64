"""Pair-count Bayes: counts (L1), parameters (L2), mixing (L3), Bernoulli NB (L4),
scoring by index (H1).

Counting is one ``explode`` of each row's key array, then ``groupBy(i, j)`` with
map-side partial aggregation. Counts for several fit scopes (``train`` for the grid,
``unified`` for the final refit) and for all goals come out of that one aggregation
as conditional sums, so the rows are read once per run, not once per
(goal, configuration).

Scoring many models at once: a model is (scope, goal, rarity threshold). The
adjustment of a key depends on (scope, goal) only and its membership on
(scope, threshold), so all models are scored in one pass with a sum per model. Single
keys within the broadcast bound are summed row by row in the tasks, without exploding or
shuffling a row; pairs, and keys beyond the bound, by one explode, one key join and one
``groupBy(row)`` with a conditional sum per model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goalcast.plans.indexing import broadcast_rows, lookup_join, maybe_broadcast
from goalcast.session import cut_lineage, cut_lineage_observed


def key_array(features: Column, combinations: bool) -> Column:
    """Keys of a row: (i, i) for each feature and, with combinations, (i, j) for i < j.

    ``features`` is sorted and distinct, so every pair comes out with i <= j.
    """
    if not combinations:
        return F.transform(features, lambda x: F.struct(x.alias("i"), x.alias("j")))
    return F.flatten(F.transform(
        features,
        lambda x, k: F.transform(F.slice(features, k + 1, F.size(features) - k),
                                 lambda y: F.struct(x.alias("i"), y.alias("j")))))


@dataclass
class BayesCounts:
    """``keys``: (i, j, n_<scope>, pos_<scope>_<goal>...) ; ``totals``: one row,
    (n_<scope>, pos_<scope>_<goal>...)."""
    keys: DataFrame
    totals: dict
    goals: list[str]
    scopes: list[str]
    combinations: bool
    n_keys: int = 0


def _scope_pred(scope: str, predicates: dict[str, Column]) -> Column:
    if scope in predicates:
        return predicates[scope]
    if scope == "unified":
        return F.lit(True)
    return F.col("set") == F.lit(scope)


#: Buckets of a row of the count-min sketch, and its rows (two tables of this many rows are broadcast).
SKETCH, SKETCH_ROWS = 1 << 18, 2


def frequent_pairs(pairs: DataFrame, min_count: int, buckets: int = SKETCH) -> DataFrame:
    """``pairs`` (i, j, ...) without those that a count-min sketch shows to occur fewer than
    ``min_count`` times. A bucket counts all rows of its pairs, so it only overestimates: no pair
    of ``min_count`` rows leaves. The sketch costs one scan with map-side sums of at most
    ``SKETCH_ROWS`` x ``buckets`` rows a task."""
    def bucket(d):
        return F.pmod(F.xxhash64("i", "j", F.lit(d)), F.lit(buckets)).cast("int")
    cells = pairs.select(F.explode(F.array(*[F.struct(F.lit(d).alias("d"), bucket(d).alias("b")) for d in range(SKETCH_ROWS)])).alias("c"))
    heavy = cut_lineage(cells.groupBy("c.d", "c.b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).select("d", "b"), "sketch")
    for d in range(SKETCH_ROWS):
        side = F.broadcast(heavy.where(F.col("d") == d).select("b"))           # at most ``buckets`` rows
        pairs = pairs.withColumn("b", bucket(d)).join(side, "b", "left_semi").drop("b")
    return pairs


def fit_counts(encoded: DataFrame, goals: list[str], scopes=("train",), combinations: bool = False,
               min_count: int = 1, prune_singles: bool = True,
               predicates: dict[str, Column] | None = None, sketch: int = SKETCH) -> BayesCounts:
    """L1 for every scope and goal in one pass.

    ``predicates`` names extra fit scopes by row condition (e.g. a "recent" window of train
    days). ``min_count`` drops keys seen fewer times than the smallest threshold that will be
    used (exact: a threshold is applied on the same total). With combinations, a pair
    can only reach the threshold if both its singles do, so rare singles leave the rows
    (semi join against the single counts) before any pair is made; and of the pairs that are
    made, those in a bucket of a count-min ``sketch`` (buckets a row, 0: none) with too few rows
    leave before the shuffle by pair.
    """
    scopes = list(scopes)
    aggs, tot = [], []
    for s in scopes:
        pred = _scope_pred(s, predicates or {})
        aggs.append(F.sum(F.when(pred, 1).otherwise(0)).cast("long").alias(f"n_{s}"))
        tot.append(F.sum(F.when(pred, 1).otherwise(0)).cast("long").alias(f"n_{s}"))
        for g in goals:
            aggs.append(F.sum(F.when(pred, F.col(g)).otherwise(0)).cast("long").alias(f"pos_{s}_{g}"))
            tot.append(F.sum(F.when(pred, F.col(g)).otherwise(0)).cast("long").alias(f"pos_{s}_{g}"))
    carry = ["set", "day_ts"] if "day_ts" in encoded.columns else ["set"]
    rows = encoded.select(*carry, "features", *goals)
    totals_row = {k: int(v or 0) for k, v in rows.agg(*tot).collect()[0].asDict().items()}  # one row

    ns = [F.col(f"n_{s}") for s in scopes]
    keep = (ns[0] if len(ns) == 1 else F.greatest(*ns)) >= min_count
    if combinations and prune_singles and min_count > 1:
        singles = fit_counts(encoded, goals, scopes, False, min_count, False, predicates)
        ok = maybe_broadcast(singles.keys.select(F.col("i").alias("_f")), singles.n_keys)
        same = [F.first(c).alias(c) for c in (*carry, *goals)]
        rows = (encoded.select("row_id", *carry, *goals, F.explode("features").alias("_f")).join(ok, "_f", "left_semi")
                .groupBy("row_id").agg(*same, F.array_sort(F.collect_set("_f")).alias("features")))
    ex = rows.select(F.explode(key_array(F.col("features"), combinations)).alias("k"), *carry, *goals) \
             .select("k.i", "k.j", *carry, *goals)
    if combinations and min_count > 1 and sketch:
        ex = frequent_pairs(ex, min_count, sketch)
    keys, kstats = cut_lineage_observed(ex.groupBy("i", "j").agg(*aggs).where(keep), "counts",
                                        {"n_keys": F.count(F.lit(1))})
    return BayesCounts(keys=keys, totals=totals_row, goals=list(goals), scopes=scopes,
                       combinations=combinations, n_keys=int(kstats["n_keys"]))


def write_day_counts(encoded: DataFrame, goals: list[str], path: str, combinations: bool = False) -> None:
    """L3: counts of every day as a table partitioned by day: ``keys`` (day_ts, set, i, j, n,
    pos_<goal>...) and ``totals`` (day_ts, set, n, pos_<goal>...). A day that is written again
    replaces itself and leaves the other days alone, so a refresh writes the new day only."""
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(g).cast("long").alias(f"pos_{g}") for g in goals]]
    rows = encoded.select("day_ts", "set", "features", *goals)
    keys = (rows.select("day_ts", "set", F.explode(key_array(F.col("features"), combinations)).alias("k"), *goals)
            .groupBy("day_ts", "set", "k.i", "k.j").agg(*sums))
    for name, t in (("keys", keys), ("totals", rows.groupBy("day_ts", "set").agg(*sums))):
        # one shuffle partition holds whole (day, hash) groups, so a day has few files
        t = t.repartition("day_ts", F.pmod(F.xxhash64(*(["i", "j"] if name == "keys" else ["set"])), F.lit(16)))
        t.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day_ts").parquet(f"{path}/{name}")


def counts_of_days(spark, path: str, goals: list[str], predicates: dict[str, Column], combinations: bool = False,
                   min_count: int = 1) -> BayesCounts:
    """Counts of fit scopes as sums of days: ``predicates`` gives each scope by a condition on
    ``day_ts`` and ``set``. The same counts as ``fit_counts`` over the rows of those days."""
    schema = "set string, n long, " + ", ".join(f"pos_{g} long" for g in goals) + ", day_ts string"
    scopes = list(predicates)

    def sums():
        return [F.sum(F.when(pred, F.col(c)).otherwise(0)).cast("long").alias(f"{kind}_{s}{tail}")
                for s, pred in predicates.items()
                for c, kind, tail in [("n", "n", ""), *[(f"pos_{g}", "pos", f"_{g}") for g in goals]]]
    totals = spark.read.schema(schema).parquet(f"{path}/totals").agg(*sums()).collect()[0].asDict()   # one row
    keys = spark.read.schema("i int, j int, " + schema).parquet(f"{path}/keys")
    ns = [F.col(f"n_{s}") for s in scopes]
    keep = (ns[0] if len(ns) == 1 else F.greatest(*ns)) >= min_count
    out, stats = cut_lineage_observed(keys.groupBy("i", "j").agg(*sums()).where(keep), "day-counts", {"n_keys": F.count(F.lit(1))})
    return BayesCounts(keys=out, totals={k: int(v or 0) for k, v in totals.items()}, goals=list(goals), scopes=scopes,
                       combinations=combinations, n_keys=int(stats["n_keys"]))


@dataclass
class ModelSpec:
    """One Bayes model: fitted on ``scope`` for ``goal`` keeping keys with total >= threshold."""
    model_id: str
    scope: str
    goal: str
    threshold: int = 1


def _p(count: Column, total: float) -> Column:
    return (count + F.lit(1.0)) / F.lit(float(total) + 2.0)


def key_params(counts: BayesCounts) -> DataFrame:
    """L2 per key for every (scope, goal): ``adj = ln p - ln(1-p)`` and ``ln(1-p)`` for
    both classes with +1 smoothing: p = (c + 1) / (N_class + 2)."""
    cols = [F.col("i"), F.col("j")]
    for s in counts.scopes:
        n_s = counts.totals[f"n_{s}"]
        cols.append(F.col(f"n_{s}"))
        for g in counts.goals:
            npos = counts.totals[f"pos_{s}_{g}"]
            nneg = n_s - npos
            pp = _p(F.col(f"pos_{s}_{g}"), npos)
            pn = _p(F.col(f"n_{s}") - F.col(f"pos_{s}_{g}"), nneg)
            cols += [(F.ln(pp) - F.ln(1.0 - pp)).alias(f"adjp_{s}_{g}"),
                     (F.ln(pn) - F.ln(1.0 - pn)).alias(f"adjn_{s}_{g}"),
                     F.ln(1.0 - pp).alias(f"l1mp_{s}_{g}"),
                     F.ln(1.0 - pn).alias(f"l1mn_{s}_{g}")]
    return counts.keys.select(*cols)


def model_constants(counts: BayesCounts, params: DataFrame, specs: list[ModelSpec]) -> DataFrame:
    """(model_id, zero_p, zero_n, prior_p, prior_n): one small aggregation over keys."""
    aggs = []
    for m in specs:
        member = F.col(f"n_{m.scope}") >= m.threshold
        aggs += [F.sum(F.when(member, F.col(f"l1mp_{m.scope}_{m.goal}")).otherwise(0.0)).alias(f"zp__{m.model_id}"),
                 F.sum(F.when(member, F.col(f"l1mn_{m.scope}_{m.goal}")).otherwise(0.0)).alias(f"zn__{m.model_id}")]
    row = params.agg(*aggs)
    arr = []
    for m in specs:
        n = float(counts.totals[f"n_{m.scope}"])
        npos = float(counts.totals[f"pos_{m.scope}_{m.goal}"])
        nneg = n - npos
        arr.append(F.struct(
            F.lit(m.model_id).alias("model_id"),
            F.coalesce(F.col(f"zp__{m.model_id}"), F.lit(0.0)).alias("zero_p"),
            F.coalesce(F.col(f"zn__{m.model_id}"), F.lit(0.0)).alias("zero_n"),
            (F.ln(F.lit(npos + 1.0)) - F.ln(F.lit(n + 2.0))).alias("prior_p"),
            (F.ln(F.lit(nneg + 1.0)) - F.ln(F.lit(n + 2.0))).alias("prior_n")))
    return row.select(F.explode(F.array(*arr)).alias("m")).select("m.*")


# Log-odds are kept to this step: sums of the same terms in another order differ by about
# 1e-13, and rows with equal evidence must tie exactly for the rank metrics.
LOG_ODDS_STEP = 1e9


def log_odds(l1: Column, l0: Column) -> Column:
    return F.floor((l1 - l0) * LOG_ODDS_STEP + 0.5) / LOG_ODDS_STEP


def probability(l1: Column, l0: Column) -> Column:
    """P(class 1) = 1 / (1 + exp(l0 - l1)), from the log-odds."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds(l1, l0)))


@dataclass
class ScoredModels:
    scores: DataFrame  # (row keys..., model_id, y, l1, l0, prob, pred)
    constants: DataFrame


def _row_sums(rows: DataFrame, counts: BayesCounts, specs: list[ModelSpec], keep: list[str],
              combinations: bool | None, params: DataFrame) -> tuple[DataFrame, list[str]]:
    """(keep..., goals..., sp__<model>, sn__<model>...): sums in place for single keys within the
    broadcast bound, else one explode, one key join, one ``groupBy(row)`` for all models."""
    combos = counts.combinations if combinations is None else combinations
    needed = {"i", "j"}
    for m in specs:
        needed |= {f"n_{m.scope}", f"adjp_{m.scope}_{m.goal}", f"adjn_{m.scope}_{m.goal}"}
    scopes = sorted({m.scope for m in specs})
    keys = params.select(*sorted(needed))
    freq = F.greatest(*[F.col(f"n_{s}") for s in scopes]) if len(scopes) > 1 else F.col(f"n_{scopes[0]}")
    keys = keys.withColumn("_freq", freq)
    labels = [g for g in sorted({m.goal for m in specs}) if g in rows.columns and g not in keep]
    if not combos and counts.n_keys <= broadcast_rows(keys):
        return _sums_in_place(rows.select(*keep, *labels, "features"), keys, specs), labels
    ex = rows.select(*keep, *labels, F.explode_outer(key_array(F.col("features"), combos)).alias("k"))
    ex = ex.select("*", F.col("k.i").alias("i"), F.col("k.j").alias("j")).drop("k")
    total = max(int(counts.totals.get(f"n_{s}", 0) or 0) for s in counts.scopes)
    joined = lookup_join(ex, keys, ["i", "j"], counts.n_keys, "_freq", total, "left")
    aggs = []
    for m in specs:
        member = F.col(f"n_{m.scope}") >= m.threshold
        aggs += [F.sum(F.when(member, F.col(f"adjp_{m.scope}_{m.goal}")).otherwise(0.0)).alias(f"sp__{m.model_id}"),
                 F.sum(F.when(member, F.col(f"adjn_{m.scope}_{m.goal}")).otherwise(0.0)).alias(f"sn__{m.model_id}")]
    return joined.groupBy(*keep, *labels).agg(*aggs), labels


def _sums_in_place(rows: DataFrame, keys: DataFrame, specs: list[ModelSpec]) -> DataFrame:
    """``rows`` (row columns..., features) with the sums of every model instead of the features.
    ``keys`` must be within the broadcast bound: it is sent to the tasks."""
    t = keys.where((F.col("i") == F.col("j"))).drop("j", "_freq").toArrow()
    order = np.argsort(t["i"].to_numpy(), kind="stable")
    ids = t["i"].to_numpy()[order]
    column = {c: t[c].fill_null(0).to_numpy()[order] for c in t.column_names if c != "i"}
    names = [f"{kind}__{m.model_id}" for m in specs for kind in ("sp", "sn")]
    members = {(m.scope, m.threshold): column[f"n_{m.scope}"] >= m.threshold for m in specs}
    # models that add up the same column over the same members share a sum
    made, parts = {}, []
    for m in specs:
        member = members[m.scope, m.threshold]
        for kind in ("adjp", "adjn"):
            made.setdefault((f"{kind}_{m.scope}_{m.goal}", member.tobytes()), len(made))
            parts.append(made[f"{kind}_{m.scope}_{m.goal}", member.tobytes()])
    terms = np.zeros((len(made), len(ids) + 1))                # the last one: unknown keys
    for (name, member), at in made.items():
        terms[at, :-1] = np.where(np.frombuffer(member, bool), column[name], 0.0)
    sent = rows.sparkSession.sparkContext.broadcast((ids, terms))
    kept = [f for f in rows.schema.fields if f.name != "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            features = batch.column("features")
            size = np.nan_to_num(pc.list_value_length(features).to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = features.flatten()                          # leaves null lists out
            key = flat.fill_null(0).to_numpy()
            at = np.searchsorted(ids, key)
            known = (at < len(ids)) & flat.is_valid().to_numpy(zero_copy_only=False)
            known[known] = ids[at[known]] == key[known]
            at = np.where(known, at, len(ids))
            row = np.repeat(np.arange(len(size)), size)
            sums = [pa.array(np.bincount(row, x[at], len(size)).astype(np.float64)) for x in terms]  # counts nothing as integers
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *[sums[k] for k in parts]],
                                             names=[*[f.name for f in kept], *names])
    return rows.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{x}` double" for x in names]))


def score_models(rows: DataFrame, counts: BayesCounts, specs: list[ModelSpec], keep: list[str],
                 combinations: bool | None = None, params: DataFrame | None = None) -> ScoredModels:
    """H1 for many models in one pass.

    ``keep`` are row columns carried to the output (must identify the row). A row
    without a known key scores the baseline (``zero_total + prior``). ``y`` is the row's
    label where the rows have one.
    """
    params = params if params is not None else key_params(counts)
    consts = model_constants(counts, params, specs)
    per_row, labels = _row_sums(rows, counts, specs, keep, combinations, params)

    counted = dict(rows.dtypes)                                # labels of vector classes are sums

    def label(m):
        return F.col(m.goal).cast("long" if counted.get(m.goal) == "bigint" else "int") if m.goal in labels or m.goal in keep else F.lit(None).cast("int")
    arr = F.array(*[F.struct(F.lit(m.model_id).alias("model_id"), label(m).alias("y"),
                             F.col(f"sp__{m.model_id}").alias("sp"), F.col(f"sn__{m.model_id}").alias("sn"))
                    for m in specs])
    long = per_row.select(*keep, F.explode(arr).alias("_m")).select(*keep, "_m.*")
    long = long.join(F.broadcast(consts), "model_id")  # one row per model
    l1 = F.col("zero_p") + F.col("prior_p") + F.coalesce(F.col("sp"), F.lit(0.0))
    l0 = F.col("zero_n") + F.col("prior_n") + F.coalesce(F.col("sn"), F.lit(0.0))
    out = long.select(*keep, "model_id", "y", l1.alias("l1"), l0.alias("l0"))
    out = out.withColumn("prob", probability(F.col("l1"), F.col("l0"))) \
             .withColumn("pred", (log_odds(F.col("l1"), F.col("l0")) > 0).cast("int"))
    return ScoredModels(scores=out, constants=consts)


def mixed_scores(rows: DataFrame, counts: BayesCounts, hist: ModelSpec, recent: ModelSpec, keep: list[str],
                 alpha: float, use_recent: bool = True) -> DataFrame:
    """L3 in one scoring pass: both models' probabilities are columns of one row, mixed as
    ``alpha * p_hist + (1 - alpha) * p_recent``; the historical one alone when the recent
    model is absent or alpha >= 1. Output (keep..., prob)."""
    specs = [hist, recent] if use_recent and alpha < 1.0 else [hist]
    params = key_params(counts)
    per_row, _ = _row_sums(rows, counts, specs, keep, None, params)
    probs = []
    for m in model_constants(counts, params, specs).collect():  # one row per model
        l1 = F.lit(m["zero_p"]) + F.lit(m["prior_p"]) + F.coalesce(F.col(f"sp__{m['model_id']}"), F.lit(0.0))
        l0 = F.lit(m["zero_n"]) + F.lit(m["prior_n"]) + F.coalesce(F.col(f"sn__{m['model_id']}"), F.lit(0.0))
        probs.append((m["model_id"], probability(l1, l0)))
    prob = dict(probs)
    if len(specs) == 1:
        return per_row.select(*keep, prob[hist.model_id].alias("prob"))
    mixed = F.lit(alpha) * prob[hist.model_id] + F.lit(1.0 - alpha) * prob[recent.model_id]
    return per_row.select(*keep, mixed.alias("prob"))


def incremental_alpha(recent_positives: int) -> tuple[float, bool]:
    """L3, incremental variant: (alpha, use recent) - 0.5/0.5, used only when the recent model
    saw at least 20 positives; otherwise the historical probability alone."""
    from goalcast.constants import RECENT_MIN_POSITIVES, RECENT_WEIGHT_INCREMENTAL
    return 1.0 - RECENT_WEIGHT_INCREMENTAL, recent_positives >= RECENT_MIN_POSITIVES


def counts_from_model(model: dict, goal: str, scope: str = "model") -> BayesCounts:
    """A model read back from its folder (S7: keys with positive and negative counts, label
    totals) in the form that scoring takes."""
    keys = model["keys"].select("i", "j", (F.col("pos") + F.col("neg")).alias(f"n_{scope}"), F.col("pos").alias(f"pos_{scope}_{goal}"))
    size = keys.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("i") != F.col("j")).alias("pairs")).collect()[0]  # one row
    t = model["totals"]
    return BayesCounts(keys=keys, totals={f"n_{scope}": t["pos"] + t["neg"], f"pos_{scope}_{goal}": t["pos"]},
                       goals=[goal], scopes=[scope], combinations=size["pairs"] > 0, n_keys=size["n"])


def bernoulli_nb_params(counts: BayesCounts, scope: str, goal: str, alpha: float, fit_prior: bool,
                        n_features: int) -> tuple[DataFrame, dict]:
    """L4 Bernoulli NB on binary features: log P(x_i=1|c) = ln((c_i + a)/(n_c + 2a)).

    Returns per-feature (i, adjp, adjn, l1mp, l1mn) for features seen at least once
    and the constants; unseen features contribute ln(1 - a/(n_c+2a)) each to the
    zero totals, added from ``n_features``.
    """
    n = float(counts.totals[f"n_{scope}"])
    npos = float(counts.totals[f"pos_{scope}_{goal}"])
    nneg = n - npos
    pp = (F.col(f"pos_{scope}_{goal}") + alpha) / (npos + 2 * alpha)
    pn = (F.col(f"n_{scope}") - F.col(f"pos_{scope}_{goal}") + alpha) / (nneg + 2 * alpha)
    feats = counts.keys.where(F.col("i") == F.col("j")).select(
        "i", (F.ln(pp) - F.ln(1.0 - pp)).alias("adjp"), (F.ln(pn) - F.ln(1.0 - pn)).alias("adjn"),
        F.ln(1.0 - pp).alias("l1mp"), F.ln(1.0 - pn).alias("l1mn"))
    import math
    if fit_prior:
        prior_p, prior_n = math.log(npos / n), math.log(nneg / n)
    else:
        prior_p = prior_n = math.log(0.5)
    const = {"prior_p": prior_p, "prior_n": prior_n,
             "unseen_p": math.log(1.0 - alpha / (npos + 2 * alpha)),
             "unseen_n": math.log(1.0 - alpha / (nneg + 2 * alpha)),
             "n_features": n_features}
    return feats, const
