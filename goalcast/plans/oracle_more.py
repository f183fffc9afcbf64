"""Oracle SQL (DuckDB), part 2: sources, sinks, requests, serving, mixed/Bernoulli Bayes."""

from __future__ import annotations

import itertools

from goalcast.constants import DATA_ATTRIBUTE_COLUMNS, HYPER_PARAMETERS, KNOWN_LABELS
from goalcast.plans.fixtures import FIXTURE_GOALS, IMPRESSIONS_SQL
from goalcast.plans.raw_flow import LOG_COLUMNS_SQL
from goalcast.plans.oracle_queries import (GRID_METRICS, SELECT_BEST_CTES, VALID_GOALS_CTE, _grid_sql, _w,
                                           expand_rounding)
from goalcast.plans.oracle_sql import LOG_ODDS, OFFSET_SQL, base_ctes, bayes_ctes, metrics_sql

LABELS_VALUES = ", ".join(f"({k}, '{g}')" for k, g in enumerate(KNOWN_LABELS))
def _java_text(value, as_double: bool) -> str:
    """A grid option as the JSON scan prints it (a list that mixes kinds is one of doubles)."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str) or not as_double:
        return str(value)
    x = float(value)
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return repr(x)
    mantissa, exponent = f"{x:e}".split("e")
    return f"{float(mantissa)!r}E{int(exponent)}"


def _grid_rows() -> str:
    rows = []
    for fam, space in HYPER_PARAMETERS.items():
        names = list(space)
        texts = [[_java_text(v, any(isinstance(x, float) for x in space[n])) for v in space[n]] for n in names]
        for cid, combo in enumerate(itertools.product(*texts)):
            rows.append("('%s', %d, '%s')" % (fam, cid, ";".join(f"{n}={v}" for n, v in zip(names, combo))))
    return ", ".join(rows)


SELECT_BEST_TAIL = SELECT_BEST_CTES + """,
anyv AS (SELECT goal, max(CAST(valid_model AS INTEGER)) AS v FROM rk GROUP BY goal),
bst AS (SELECT goal, threshold, roc_auc_test, log_loss_test, f1_test FROM rk WHERE valid_model AND rk = 1),
best AS (SELECT a.goal, a.v = 1 AS valid, b.threshold AS rarity_threshold, b.roc_auc_test, b.log_loss_test, b.f1_test
         FROM anyv a LEFT JOIN bst b ON a.goal = b.goal)"""

PARAMS_BASE = """,
ev AS (SELECT row_id, day_ts, exchange2, loc_country, nation_key AS c_nationkey FROM impressions)"""

REQ_CTE = f""",
req AS (SELECT row_id, exchange2, publisher, domain, device_os, category, loc_country, loc_city, timezone_offset,
               "timestamp" AS ts, {OFFSET_SQL} AS tz FROM impressions)"""

REQUEST_FEATURES_SQL = """SELECT row_id AS request_id, feature FROM (
  SELECT row_id, 'data_center' || exchange2 AS feature FROM req
  UNION ALL SELECT row_id, 'impression_position_val' || CAST(row_id % 3 AS VARCHAR) FROM req
  UNION ALL SELECT row_id, CASE WHEN row_id % 2 = 0 THEN 'ad_typenativead' ELSE 'ad_typeOTHER' END FROM req
  UNION ALL SELECT row_id, CASE WHEN row_id % 5 = 0 THEN 'formatsx' ELSE 'formats[300x250:320x50:' END FROM req
  UNION ALL SELECT row_id, CASE WHEN exchange2 = 'mopub' THEN 'app_site_indMWEB' ELSE 'app_site_indINAPP' END FROM req
  UNION ALL SELECT row_id, 'publisher' || publisher FROM req
  UNION ALL SELECT row_id, CASE WHEN exchange2 = 'mopub' THEN 'domain' || domain || '.example.com'
                               ELSE 'domaincom.' || domain END FROM req
  UNION ALL SELECT row_id, 'location' || substr(domain, 2, 10) || CAST(row_id % 90 AS VARCHAR) FROM req
  UNION ALL SELECT row_id, CASE WHEN row_id % 4 = 0 THEN 'browserChrome' ELSE 'browserOther' END FROM req
  UNION ALL SELECT row_id, 'device_os' || device_os FROM req
  UNION ALL SELECT row_id, 'location' || loc_country FROM req WHERE row_id % 6 = 0
  UNION ALL SELECT row_id, 'location' || loc_city FROM req WHERE row_id % 6 = 0
  UNION ALL SELECT row_id, 'category' || unnest(string_split(category, '.')) FROM req WHERE category IS NOT NULL
  UNION ALL SELECT row_id, 'HOW' || CAST((((dayofweek(ts) * 24 + hour(ts) + tz) % 168) + 168) % 168 AS VARCHAR)
    FROM req WHERE timezone_offset IS NOT NULL
  UNION ALL SELECT row_id, 'TOD' || CAST((((hour(ts) + tz) % 24) + 24) % 24 AS VARCHAR)
    FROM req WHERE timezone_offset IS NOT NULL
)"""

CR_SQL = ("CASE WHEN prob >= 0.3 THEN CAST(0.08 AS DOUBLE) WHEN prob >= 0.2 THEN CAST(0.07 AS DOUBLE) "
          "WHEN prob >= 0.1 THEN CAST(0.09 AS DOUBLE) ELSE CAST(0.13 AS DOUBLE) END")

# names of each (row, agent) -> known indices -> the click model's probability and rate
CHAIN_CTES = f""",
known AS (SELECT DISTINCT n.row_id, n.agent, i.idx FROM names n JOIN indexed i ON n.name = i.final_name),
ksums AS (SELECT k.row_id, k.agent, sum(CASE WHEN p.n >= 5 THEN p.adjp_click ELSE 0 END) AS sp,
                 sum(CASE WHEN p.n >= 5 THEN p.adjn_click ELSE 0 END) AS sn
          FROM known k JOIN kparams p ON k.idx = p.i GROUP BY k.row_id, k.agent),
chain AS (SELECT a.row_id, a.agent, c.zero_p + c.prior_p + coalesce(s.sp, 0) AS l1, c.zero_n + c.prior_n + coalesce(s.sn, 0) AS l0
          FROM agents a LEFT JOIN ksums s ON a.row_id = s.row_id AND a.agent = s.agent, mconsts c),
probs AS (SELECT row_id, agent, 1.0 / (1.0 + exp(-{LOG_ODDS})) AS prob FROM chain),
rated AS (SELECT *, {CR_SQL} AS cr FROM probs)"""

RECENT_CTES = base_ctes() + bayes_ctes(["click"], [5], p="h_") + bayes_ctes(
    ["click"], [5], p="r_",
    where="WHERE \"set\" = 'train' AND day_ts >= (SELECT day_ts FROM day_sets WHERE \"set\" = 'train' "
          "ORDER BY day_ts DESC LIMIT 1 OFFSET 6)")


def _bernoulli_sql() -> str:
    space = HYPER_PARAMETERS["NB"]
    alphas = ", ".join(f"({k}, CAST({a!r} AS DOUBLE))" for k, a in enumerate(space["alpha"]))
    priors = ", ".join(f"({q}, {str(p).lower()})" for q, p in enumerate(space["fit_prior"]))
    return base_ctes() + f""",
nb_tot AS (SELECT count(*) AS tn, sum(click) AS tp FROM encoded WHERE "set" = 'train'),
nb_cnt AS (SELECT i, count(*) AS n, sum(click) AS pos FROM (SELECT unnest(features) AS i, click FROM encoded WHERE "set" = 'train') GROUP BY i),
nb_f AS (
  SELECT k, x.idx AS i,
    (CAST(coalesce(c.pos, 0) AS DOUBLE) + a) / (CAST(t.tp AS DOUBLE) + 2 * a) AS pp,
    (CAST(coalesce(c.n, 0) - coalesce(c.pos, 0) AS DOUBLE) + a) / (CAST(t.tn - t.tp AS DOUBLE) + 2 * a) AS pn
  FROM indexed x LEFT JOIN nb_cnt c ON x.idx = c.i, nb_tot t, (VALUES {alphas}) al(k, a)
),
nb_p AS (SELECT k, i, ln(pp) - ln(1 - pp) AS adjp, ln(pn) - ln(1 - pn) AS adjn, ln(1 - pp) AS l1mp, ln(1 - pn) AS l1mn FROM nb_f),
nb_c AS (
  SELECT k, q, sum(l1mp) + CASE WHEN fit THEN ln(CAST(t.tp AS DOUBLE) / t.tn) ELSE ln(0.5) END AS c1,
    sum(l1mn) + CASE WHEN fit THEN ln(CAST(t.tn - t.tp AS DOUBLE) / t.tn) ELSE ln(0.5) END AS c0
  FROM nb_p, nb_tot t, (VALUES {priors}) pr(q, fit) GROUP BY k, q, fit, t.tp, t.tn
),
nb_rows AS (
  SELECT e.row_id, p.k, sum(p.adjp) AS sp, sum(p.adjn) AS sn
  FROM (SELECT row_id, unnest(features) AS i FROM encoded) e JOIN nb_p p ON e.i = p.i GROUP BY e.row_id, p.k
),
nb_s AS (SELECT e.row_id, c.k * {len(space["fit_prior"])} + c.q AS config_id, c.c1 + coalesce(r.sp, 0) AS l1, c.c0 + coalesce(r.sn, 0) AS l0
         FROM encoded e, nb_c c LEFT JOIN nb_rows r ON r.row_id = e.row_id AND r.k = c.k)
SELECT row_id, CAST(config_id AS INTEGER) AS config_id, rnd(1.0 / (1.0 + exp(-{LOG_ODDS}))) AS prob, CAST({LOG_ODDS} > 0 AS INTEGER) AS pred
FROM nb_s"""


TEST_CLICK = base_ctes() + bayes_ctes(["click"], [5])

def _raw_log_ctes() -> str:
    """base CTEs with the impressions as seen through the raw log: null tokens read as
    null, missing labels as 0."""
    text = base_ctes(attribute_cols=DATA_ATTRIBUTE_COLUMNS)
    raw = """impressions_raw AS (
  SELECT row_id, "timestamp", day_ts, CASE WHEN timezone_offset = '\\N' THEN NULL ELSE timezone_offset END AS timezone_offset,
    exchange2, loc_country, loc_state, loc_city, publisher, domain,
    CASE WHEN row_id % 19 = 0 THEN NULL ELSE device_os END AS device_os, app_site_ind,
    CASE WHEN row_id % 13 = 0 THEN NULL ELSE category END AS category,
    CASE WHEN row_id % 7 = 0 THEN 0 ELSE click END AS click, download, buy, register, video_ad_start, score,
    """ + LOG_COLUMNS_SQL + """
  FROM impressions
),
derived AS ("""
    text = text.replace("derived AS (", raw, 1)
    text = text.replace("  FROM impressions\n),\nderived2", "  FROM impressions_raw\n),\nderived2", 1)
    text = text.replace("FROM (SELECT DISTINCT day_ts FROM impressions WHERE", "FROM (SELECT DISTINCT day_ts FROM impressions_raw WHERE")
    text = text.replace("FROM impressions i JOIN encoded0 e", "FROM impressions_raw i JOIN encoded0 e")
    return text


ORACLE_MORE = {
    "raw_log_features": None,
    "header_scan": base_ctes(with_encoded=False) + f"""
SELECT idx, final_name AS name, 0 AS is_label FROM indexed
UNION ALL
SELECT CAST((SELECT count(*) FROM indexed) + k AS INTEGER), lbl, 1 FROM (VALUES {LABELS_VALUES}) t(k, lbl)""",
    "sparse_scan": base_ctes() + """
SELECT array_to_string(features, ' ') AS features, click, download, buy, register, video_ad_start
FROM encoded""",
    "raw_log_scan": _w(IMPRESSIONS_SQL) + r"""
SELECT CAST(row_id AS VARCHAR) AS row_id, exchange2,
  CASE WHEN row_id % 23 = 0 THEN 'a$"' || loc_state || '"$b' ELSE loc_state END AS loc_state,
  CASE WHEN timezone_offset = '\N' THEN NULL ELSE timezone_offset END AS timezone_offset,
  CASE WHEN row_id % 13 = 0 THEN NULL ELSE category END AS category,
  CASE WHEN row_id % 19 = 0 THEN NULL ELSE device_os END AS device_os,
  CAST(click AS VARCHAR) AS click
FROM impressions""",
    "params_scan": _w(IMPRESSIONS_SQL) + PARAMS_BASE + """,
per AS (SELECT loc_country AS region, min(day_ts) AS d0, max(day_ts) AS d1,
               list_sort(list(DISTINCT exchange2)) AS ex, list_sort(list(DISTINCT CAST(c_nationkey AS VARCHAR))) AS camp
        FROM ev GROUP BY loc_country)
SELECT region, 'From_Date' AS key, d0 AS value_text, 0 AS is_list, 1 AS n_values FROM per
UNION ALL SELECT region, 'To_Date', d1, 0, 1 FROM per
UNION ALL SELECT region, 'Exchange', array_to_string(ex, ','), 1, len(ex) FROM per
UNION ALL SELECT region, 'Campaign', array_to_string(camp, ','), 1, len(camp) FROM per
UNION ALL SELECT region, 'iOS_OSV', NULL, 0, NULL FROM per
UNION ALL SELECT region, 'Goal', 'CLICK,BUY', 1, 2 FROM per
UNION ALL SELECT region, 'Algorithm', 'XGB', 1, 1 FROM per
UNION ALL SELECT region, 'Model', 'poly', 0, 1 FROM per""",
    "prediction_scan": """
WITH e AS (SELECT event_id // 2000 AS part, event_id, value / 500.0 AS p FROM events)
SELECT part, CAST(row_number() OVER (PARTITION BY part ORDER BY event_id) - 1 AS INTEGER) AS row,
  CASE WHEN part % 4 = 3 THEN 0.0 ELSE p END AS prob, CASE WHEN part % 4 = 3 THEN 0 ELSE CAST(p > 0.5 AS INTEGER) END AS pred
FROM e""",
    "bayes_model_scan": TEST_CLICK + """
SELECT i, i AS j, CAST(pos_click AS BIGINT) AS pos, CAST(n - pos_click AS BIGINT) AS neg,
  (SELECT CAST(tpos_click AS BIGINT) FROM totals) AS total_pos, (SELECT CAST(tn - tpos_click AS BIGINT) FROM totals) AS total_neg
FROM kcounts WHERE n >= 5""",
    "config_grid": base_ctes() + VALID_GOALS_CTE + f""",
cfg AS (SELECT * FROM (VALUES {_grid_rows()}) t(family, config_id, params))
SELECT vg.goal, cfg.family, cfg.config_id, cfg.params FROM vg, cfg""",
    "keymap": base_ctes(with_encoded=False) + """
SELECT form, final_name AS name, CAST(idx + (form = 'forest')::INTEGER AS INTEGER) AS idx
FROM indexed, (VALUES ('pairs'), ('forest'), ('linear')) t(form)""",
    "run_stats": _grid_sql() + SELECT_BEST_TAIL + """
SELECT substr(md5(concat('NB:', goal)), 1, 32) AS Model_ID, 'NB' AS Algorithm, goal AS Goal,
  CASE WHEN valid THEN rnd(roc_auc_test) END AS AUC, CASE WHEN valid THEN rnd(log_loss_test) END AS LogLoss,
  CASE WHEN valid THEN rnd(f1_test) END AS Accuracy,
  CASE WHEN valid THEN 'success' ELSE 'invalid' END AS Status, CASE WHEN valid THEN 'model;keymap' ELSE '' END AS Files
FROM best""",
    "refresh_descriptor": _grid_sql() + SELECT_BEST_TAIL + PARAMS_BASE + """,
rp AS (SELECT min(day_ts) AS d0, max(day_ts) AS d1, list_sort(list(DISTINCT exchange2)) AS ex,
              list_sort(list(DISTINCT c_nationkey)) AS camp FROM ev)
SELECT b.goal, array_to_string(rp.camp, ',') AS campaign_ids, array_to_string(rp.ex, ',') AS exchanges,
  'NB' AS model_type, b.rarity_threshold,
  strftime(strptime(rp.d0, '%Y%m%d'), '%Y-%m-%dT%H:%M:%S') AS time_from,
  strftime(strptime(rp.d1, '%Y%m%d'), '%Y-%m-%dT%H:%M:%S') AS time_to
FROM best b, rp WHERE b.valid""",
    "request_features": _w(IMPRESSIONS_SQL) + REQ_CTE + "\n" + REQUEST_FEATURES_SQL,
    "domain_feature": """
SELECT page_id, 'domain' || coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1), ''), url) AS feature
FROM pages""",
    "hour_of_week_mod": _w(IMPRESSIONS_SQL) + f"""
SELECT row_id, CAST((((dayofweek("timestamp") * 24 + hour("timestamp") + {OFFSET_SQL}) % 168) + 168) % 168 AS INTEGER) AS how
FROM impressions""",
    "time_of_day": _w(IMPRESSIONS_SQL) + f"""
SELECT row_id, CAST((((hour("timestamp") + {OFFSET_SQL}) % 24) + 24) % 24 AS INTEGER) AS tod FROM impressions""",
    "cr_adapter": TEST_CLICK + f"""
SELECT row_id, {CR_SQL} AS cr FROM scored2""",
    "confusion_score": TEST_CLICK + """,
src AS (SELECT goal, "set", y, prob, pred FROM scored2)""" + metrics_sql("src", ["goal", '"set"']) + """
SELECT s.row_id, rnd(CASE WHEN s.pred = 1 THEN m.true_positive ELSE m.false_negative END) AS cr
FROM scored2 s JOIN metrics m ON m."set" = 'test' AND m.goal = s.goal""",
    "agent_fanout": """
WITH turns AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS agent,
    'role' || role AS a1, 'len' || CAST(CAST(floor(length(text) / 100) AS BIGINT) AS VARCHAR) AS a2
  FROM conversations
)
SELECT conv_id, CAST(agent AS INTEGER) AS agent, concat('conv', CAST(conv_id % 7 AS VARCHAR), ' ', a1, ' ', a2) AS props FROM turns""",
    "best_agent": """
WITH a AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS agent,
    floor(CAST(length(text) AS DOUBLE) / CAST(2000 AS DOUBLE) * 100.0 + 0.5) / 100.0 AS prediction
  FROM conversations
),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY prediction DESC, agent) AS rk FROM a)
SELECT conv_id, CAST(agent AS INTEGER) AS agent, prediction FROM r WHERE rk = 1""",
    "bayes_score_named": TEST_CLICK + """,
fe AS (SELECT row_id, unnest(features) AS idx, generate_subscripts(features, 1) AS pos FROM encoded),
fn AS (SELECT fe.row_id, fe.pos, i.final_name AS name FROM fe JOIN indexed i ON fe.idx = i.idx),
pairs AS (SELECT a.row_id, a.name || '&' || b.name AS u FROM fn a JOIN fn b ON a.row_id = b.row_id AND a.pos <= b.pos),
used AS (SELECT row_id, array_to_string(list_sort(list(u)), ' ') AS used FROM pairs GROUP BY row_id)
SELECT s.row_id, rnd(s.prob) AS prob, s.pred, coalesce(u.used, '') AS used
FROM scored2 s LEFT JOIN used u ON s.row_id = u.row_id""",
    "combined_bayes": RECENT_CTES + """
SELECT h.row_id, rnd(0.7 * h.prob + (1.0 - 0.7) * r.prob) AS prob FROM h_scored2 h JOIN r_scored2 r ON h.row_id = r.row_id""",
    "incremental_bayes": RECENT_CTES + """
SELECT h.row_id, rnd(CASE WHEN (SELECT tpos_click FROM r_totals) >= 20 THEN 0.5 * h.prob + 0.5 * r.prob ELSE h.prob END) AS prob
FROM h_scored2 h JOIN r_scored2 r ON h.row_id = r.row_id""",
    "bernoulli_nb": _bernoulli_sql(),
    "train_from_sparse": None,
    "registered_feature": _w(IMPRESSIONS_SQL) + """
SELECT row_id AS request_id, 'topIAB' AS feature FROM impressions WHERE category IS NOT NULL""",
    "score_requests": TEST_CLICK + REQ_CTE + """,
agents AS (SELECT row_id, unnest(range(0, row_id % 3 + 1)) AS agent FROM req),
names AS (
  SELECT a.row_id, a.agent, f.feature AS name FROM agents a JOIN (""" + REQUEST_FEATURES_SQL + """) f ON a.row_id = f.request_id
  UNION SELECT row_id, agent, 'categoryIAB' || CAST((row_id + 5 * agent) % 25 AS VARCHAR) FROM agents)""" + f"""{CHAIN_CTES}
SELECT row_id AS request_id, CAST(agent AS INTEGER) AS agent, rnd(prob) AS prob, cr FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY cr DESC, agent) AS rk FROM rated) WHERE rk = 1""",
    "stream_score": TEST_CLICK + REQ_CTE + """,
agents AS (SELECT row_id, 0 AS agent FROM req),
names AS (SELECT DISTINCT request_id AS row_id, 0 AS agent, feature AS name FROM (""" + REQUEST_FEATURES_SQL + f""")){CHAIN_CTES}
SELECT row_id AS request_id, rnd(prob) AS prob, cr FROM rated""",
}
ORACLE_MORE["train_from_sparse"] = ORACLE_MORE["train_all_goals"] = ORACLE_MORE["run_stats"]
ORACLE_MORE["gzip_scan"] = ORACLE_MORE["sparse_scan"]
ORACLE_MORE["raw_log_features"] = _raw_log_ctes() + """
SELECT row_id, "set", array_to_string(features, ' ') AS features, click FROM encoded"""


ORACLE_MORE = {k: expand_rounding(v) for k, v in ORACLE_MORE.items()}



def _goal_sizes(where: str = "") -> str:
    """(goal, n_rows, n_pos) of the encoded rows."""
    return " UNION ALL ".join(f"SELECT '{g}' AS goal, count(*) AS n_rows, CAST(sum({g}) AS BIGINT) AS n_pos FROM encoded {where}"
                              for g in FIXTURE_GOALS)


ORACLE_ML = {
    "matrix_export": expand_rounding(base_ctes() + """,
dsize AS (SELECT CAST(count(*) AS INTEGER) AS n FROM indexed),
cw AS (
  SELECT "set", round(CAST(count(*) AS DOUBLE) / (2.0 * (count(*) - sum(click))), 5) AS w0,
         round(CAST(count(*) AS DOUBLE) / (2.0 * sum(click)), 5) AS w1
  FROM encoded GROUP BY "set"
)
SELECT 'header' AS part, '' AS "set", (SELECT string_agg(final_name, chr(9) ORDER BY idx) FROM indexed) || chr(9) || '__label__' AS value
UNION ALL
SELECT 'rows', "set", array_to_string(list_transform(range(0, (SELECT n FROM dsize)),
         lambda i: CASE WHEN list_contains(features, CAST(i AS INTEGER)) THEN '1' ELSE '0' END), chr(9)) || chr(9) || CAST(click AS VARCHAR)
FROM encoded
UNION ALL
SELECT 'weights', e."set", CAST(e.row_id AS VARCHAR) || chr(9) || printf('%.5f', CASE WHEN e.click = 1 THEN cw.w1 ELSE cw.w0 END)
FROM encoded e JOIN cw ON e."set" = cw."set" """),
    "grid_table": expand_rounding(_grid_sql() + SELECT_BEST_CTES + f"""
SELECT goal, config_id, threshold, {GRID_METRICS}, CAST(valid_model AS INTEGER) AS valid_model, CAST(valid_model AND rk = 1 AS INTEGER) AS best
FROM rk"""),
    "score_export": expand_rounding(TEST_CLICK + """
SELECT row_id, "set", rnd(prob) AS prob, pred, y FROM scored2"""),
    "linear_optimality": base_ctes() + VALID_GOALS_CTE + f""",
size AS ({_goal_sizes("WHERE \"set\" = 'train'")})
SELECT vg.goal, penalty, alpha, 1 AS optimal, n_rows, n_pos
FROM vg JOIN size USING (goal), (VALUES ('l1'), ('l2'), ('elasticnet')) p(penalty),
  (VALUES (1e-15::DOUBLE), (1e-10), (1e-8), (1e-5), (1e-4), (1e-3), (1e-2), (1), (5), (10)) a(alpha)""",
    "forest_rules": base_ctes() + VALID_GOALS_CTE + """
SELECT goal, 100::BIGINT AS trees, 0::BIGINT AS too_small, 0::BIGINT AS pure, 0::BIGINT AS unequal FROM vg""",
    "refit_scores": base_ctes() + VALID_GOALS_CTE + f""",
size AS ({_goal_sizes()})
SELECT goal, family, 0::BIGINT AS differing, n_rows, n_pos FROM vg JOIN size USING (goal), (VALUES ('lasso'), ('rf')) f(family)""",
}
