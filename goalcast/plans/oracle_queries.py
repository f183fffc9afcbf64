"""Oracle SQL (DuckDB) per registered query; same column names as the Spark side."""

from __future__ import annotations

from goalcast.constants import LOCATION_FAMILIES
from goalcast.plans.fixtures import FIXTURE_GOALS, IMPRESSIONS_SQL
from goalcast.plans.oracle_sql import (DAY_SETS_SQL, DERIVED_SQL, OFFSET_SQL, base_ctes, bayes_ctes,
                                       metrics_sql)

R = 6
GRID_THRESHOLDS = [1, 5, 10, 15, 20]
METRICS = ["roc_auc", "log_loss", "f1", "recall", "precision", "true_positive", "false_negative"]


def _w(*blocks) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks)


def _sets_pivot(group: list[str], rounded: bool = True) -> str:
    cols, rnd = [], "rnd" if rounded else ""
    for s in ("train", "test"):
        for m in METRICS:
            cols.append(f"{rnd}(max(CASE WHEN \"set\" = '{s}' THEN {m} END)) AS {m}_{s}")
    return f"SELECT {', '.join(group)}, {', '.join(cols)} FROM metrics GROUP BY {', '.join(group)}"


VALID_GOALS_CTE = """,
vg_cls AS (
  SELECT g.goal, e."set",
    sum(CASE WHEN (CASE g.goal WHEN 'click' THEN click WHEN 'buy' THEN buy WHEN 'download' THEN download
                   WHEN 'register' THEN register ELSE video_ad_start END) = 0 THEN 1 ELSE 0 END) AS zeros,
    sum(CASE WHEN (CASE g.goal WHEN 'click' THEN click WHEN 'buy' THEN buy WHEN 'download' THEN download
                   WHEN 'register' THEN register ELSE video_ad_start END) = 1 THEN 1 ELSE 0 END) AS ones
  FROM encoded e, (VALUES ('click'), ('download'), ('buy'), ('register'), ('video_ad_start')) g(goal)
  GROUP BY g.goal, e."set"
),
vg AS (SELECT goal FROM vg_cls GROUP BY goal HAVING bool_and(zeros >= 10 AND ones >= 10) AND count(DISTINCT "set") = 2)"""


def _grid_sql() -> str:
    """Metrics of every (valid goal, threshold), not rounded."""
    return (base_ctes() + bayes_ctes(FIXTURE_GOALS, GRID_THRESHOLDS) + VALID_GOALS_CTE + """,
scored3 AS (SELECT goal, threshold, "set", y, prob, pred FROM scored2 WHERE goal IN (SELECT goal FROM vg))"""
            + metrics_sql("scored3", ["goal", "threshold", '"set"']) + f""",
grid AS (
  SELECT *, CAST(list_position({GRID_THRESHOLDS}, threshold) - 1 AS INTEGER) AS config_id FROM (
    {_sets_pivot(['goal', 'threshold'], rounded=False)}
  )
)""")


SELECT_BEST_CTES = """,
sel AS (
  SELECT *, abs(1 - roc_auc_test / (roc_auc_train + 1e-11)) AS diff,
    coalesce(abs(1 - roc_auc_test / (roc_auc_train + 1e-11)) <= 0.4 AND roc_auc_test >= 0.5, false) AS valid_model
  FROM grid
),
rk AS (SELECT *, row_number() OVER (PARTITION BY goal ORDER BY valid_model DESC, roc_auc_test DESC NULLS LAST, config_id) AS rk FROM sel)"""

GRID_METRICS = ", ".join(f"rnd({m}_{s}) AS {m}_{s}" for s in ("train", "test") for m in METRICS)

SCORE_FRAME = """
sf AS (SELECT device_os, click AS y, score / 500.0 AS prob, CAST(score > 50 AS INTEGER) AS pred FROM impressions)"""


def expand_rounding(sql: str) -> str:
    """Inline ``rnd(x)`` / ``rnd10(x)`` as ``floor(x * 10^n + 0.5) / 10^n`` (the same IEEE
    arithmetic as the Spark side)."""
    for fn, scale in (("rnd10(", "1e10"), ("rnd(", "1e6")):
        while True:
            pos = sql.find(fn)
            while pos > 0 and (sql[pos - 1].isalnum() or sql[pos - 1] == "_"):
                pos = sql.find(fn, pos + 1)
            if pos < 0:
                break
            start = pos + len(fn)
            depth, k = 1, start
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[k], 0)
                k += 1
            inner = sql[start:k - 1]
            sql = sql[:pos] + f"(floor(({inner}) * {scale} + 0.5) / {scale})" + sql[k:]
    return sql


ORACLE = {
    "hour_of_week": _w(IMPRESSIONS_SQL, DERIVED_SQL) + "\nSELECT row_id, HOW FROM derived2",
    "location_combos": _w(IMPRESSIONS_SQL, DERIVED_SQL) + "\nSELECT row_id, country_state, country_state_city FROM derived2",
    "label_extract": _w(IMPRESSIONS_SQL) + """
SELECT row_id, coalesce(TRY_CAST(CASE WHEN row_id % 7 = 0 THEN NULL ELSE CAST(click AS VARCHAR) END AS INTEGER), 0) AS click
FROM impressions""",
    "rare_levels": base_ctes(with_encoded=False) + """
SELECT r.col, r.value, r.n, r.merged, CAST(k.column_kept AS INTEGER) AS column_kept
FROM rare r JOIN kept_cols k ON r.col = k.col""",
    "one_hot_attributes": base_ctes(list_cols=[], with_encoded=True) + """
SELECT row_id, array_to_string(features, ' ') AS features FROM encoded""",
    "one_hot_lists": base_ctes(attribute_cols=[], with_encoded=True) + """
SELECT row_id, array_to_string(features, ' ') AS features FROM encoded""",
    "feature_dictionary": base_ctes(with_encoded=False) + "\nSELECT idx, final_name AS name FROM indexed",
    "patch_location": base_ctes(families=LOCATION_FAMILIES, with_encoded=False) + "\nSELECT idx, final_name AS name FROM indexed",
    "constant_feature": base_ctes() + """,
dsize AS (SELECT CAST(count(*) AS INTEGER) AS n FROM indexed)
SELECT row_id, array_to_string(list_append(features, (SELECT n FROM dsize)), ' ') AS features FROM encoded""",
    "case_weights": base_ctes() + """,
cw AS (
  SELECT "set", round(CAST(count(*) AS DOUBLE) / (2.0 * (count(*) - sum(click))), 5) AS w0,
         round(CAST(count(*) AS DOUBLE) / (2.0 * sum(click)), 5) AS w1
  FROM encoded GROUP BY "set"
)
SELECT e.row_id, e."set", e.click AS y, CASE WHEN e.click = 1 THEN cw.w1 ELSE cw.w0 END AS weight
FROM encoded e JOIN cw ON e."set" = cw."set" """,
    "focus_goal": base_ctes() + """
SELECT row_id, "set", buy AS y FROM encoded WHERE "set" = 'test'""",
    "valid_goals": base_ctes() + """,
req AS (SELECT * FROM (VALUES ('click', 0), ('buy', 1), ('download', 2), ('register', 3), ('video_ad_start', 4)) t(goal, position)),
cls AS (
  SELECT g.goal, e."set",
    sum(CASE WHEN (CASE g.goal WHEN 'click' THEN click WHEN 'buy' THEN buy WHEN 'download' THEN download
                   WHEN 'register' THEN register ELSE video_ad_start END) = 0 THEN 1 ELSE 0 END) AS zeros,
    sum(CASE WHEN (CASE g.goal WHEN 'click' THEN click WHEN 'buy' THEN buy WHEN 'download' THEN download
                   WHEN 'register' THEN register ELSE video_ad_start END) = 1 THEN 1 ELSE 0 END) AS ones
  FROM encoded e, req g GROUP BY g.goal, e."set"
),
ok AS (SELECT goal, bool_and(zeros >= 10 AND ones >= 10) AND count(DISTINCT "set") = 2 AS v FROM cls GROUP BY goal)
SELECT r.goal, r.position, CAST(coalesce(ok.v, false) AS INTEGER) AS valid FROM req r LEFT JOIN ok ON r.goal = ok.goal""",
    "temporal_split": _w(IMPRESSIONS_SQL, DAY_SETS_SQL) + "\nSELECT day_ts, \"set\" FROM day_sets",
    "stratified_split": _w(IMPRESSIONS_SQL) + """,
h AS (SELECT row_id, click, CAST(CAST(('0x' || substr(md5(concat('0:', CAST(row_id AS VARCHAR))), 1, 8)) AS BIGINT) % 100 AS INTEGER) AS bucket FROM impressions)
SELECT row_id, click, bucket, CASE WHEN bucket < 75 THEN 'train' ELSE 'test' END AS "set" FROM h""",
    "stratified_exact": _w(IMPRESSIONS_SQL) + """,
h AS (SELECT row_id, click, CAST(('0x' || substr(md5(concat('0:', CAST(row_id AS VARCHAR))), 1, 15)) AS BIGINT) AS hv FROM impressions),
r AS (SELECT *, row_number() OVER (PARTITION BY click ORDER BY hv % 4096, hv, row_id) AS rn,
             count(*) OVER (PARTITION BY click) AS nc FROM h)
SELECT row_id, click, CASE WHEN rn <= nc - CAST(ceil(nc * 0.25) AS BIGINT) THEN 'train' ELSE 'test' END AS "set" FROM r""",
    "unified_set": base_ctes() + """
SELECT "set", count(*) AS n_rows, CAST(sum(click) AS BIGINT) AS n_click, CAST(sum(len(features)) AS BIGINT) AS n_features
FROM encoded GROUP BY "set"
UNION ALL
SELECT 'unified', count(*), CAST(sum(click) AS BIGINT), CAST(sum(len(features)) AS BIGINT) FROM encoded""",
    "single_counts": base_ctes() + """
SELECT i, count(*) AS n, CAST(sum(click) AS BIGINT) AS pos
FROM (SELECT unnest(features) AS i, click FROM encoded WHERE "set" = 'train') GROUP BY i""",
    "pair_counts": base_ctes() + """,
tr AS (SELECT features, click FROM encoded WHERE "set" = 'train'),
pairs AS (
  SELECT f.features[a.k] AS i, f.features[b.k] AS j, f.click
  FROM tr f, LATERAL (SELECT unnest(range(1, len(f.features) + 1)) AS k) a,
       LATERAL (SELECT unnest(range(1, len(f.features) + 1)) AS k) b
  WHERE a.k <= b.k
)
SELECT i, j, count(*) AS n, CAST(sum(click) AS BIGINT) AS pos FROM pairs GROUP BY i, j HAVING count(*) >= 20""",
    "bayes_params": base_ctes() + bayes_ctes(["click"], [5]) + """
SELECT i, rnd(adjp_click) AS adjp, rnd(adjn_click) AS adjn, rnd(l1mp_click) AS l1mp, rnd(l1mn_click) AS l1mn
FROM kparams WHERE n >= 5""",
    "bayes_score": base_ctes() + bayes_ctes(["click"], [5]) + """
SELECT row_id, rnd(l1) AS l1, rnd(l0) AS l0, rnd(prob) AS prob, pred FROM scored2""",
    "evaluate_sets": base_ctes() + bayes_ctes(["click"], [5]) + """,
scored3 AS (SELECT goal, "set", y, prob, pred FROM scored2)""" + metrics_sql("scored3", ["goal", '"set"'])
    + "\n" + _sets_pivot(["goal"]),
    "grid_search_bayes": _grid_sql() + f"\nSELECT goal, config_id, threshold, {GRID_METRICS} FROM grid",
    "select_best": _grid_sql() + SELECT_BEST_CTES + """
SELECT goal, config_id, rnd(roc_auc_test) AS roc_auc_test, rnd(diff) AS roc_auc_diff,
  CAST(valid_model AS INTEGER) AS valid_model, CAST(valid_model AND rk = 1 AS INTEGER) AS best FROM rk""",
    "roc_auc": _w(IMPRESSIONS_SQL, SCORE_FRAME) + metrics_sql("sf", ["device_os"]) + """
SELECT device_os, rnd(roc_auc) AS roc_auc FROM metrics""",
    "log_loss": _w(IMPRESSIONS_SQL, SCORE_FRAME) + metrics_sql("sf", ["device_os"]) + """
SELECT device_os, rnd(log_loss) AS log_loss FROM metrics""",
    "prf": _w(IMPRESSIONS_SQL, SCORE_FRAME) + metrics_sql("sf", ["device_os"]) + """
SELECT device_os, rnd(f1) AS f1, rnd(recall) AS recall, rnd(precision) AS precision FROM metrics""",
    "confusion_matrix": _w(IMPRESSIONS_SQL, SCORE_FRAME) + metrics_sql("sf", ["device_os"]) + """
SELECT device_os, tn, fp, fn, tp FROM metrics""",
    "confusion_rates": _w(IMPRESSIONS_SQL, SCORE_FRAME) + metrics_sql("sf", ["device_os"]) + """
SELECT device_os, rnd(true_positive) AS true_positive, rnd(false_negative) AS false_negative FROM metrics""",
}

ORACLE = {k: expand_rounding(v) for k, v in ORACLE.items()}
