"""DuckDB text for the oracle side of each registered query.

Building blocks are CTEs over the pre-registered tables; each query composes them.
Floating outputs are rounded identically on both sides.
"""

from __future__ import annotations

from goalcast.plans.fixtures import (FIXTURE_ATTRIBUTE_COLUMNS, FIXTURE_GOALS, FIXTURE_LIST_COLUMNS,
                                     FIXTURE_RARITY, IMPRESSIONS_SQL)

GOALS = FIXTURE_GOALS
GOAL_COLS = ", ".join(GOALS)

OFFSET_SQL = ("coalesce(TRY_CAST(CASE WHEN replace(timezone_offset, '\\', '') = 'N' THEN '0' "
              "ELSE replace(timezone_offset, '\\', '') END AS INTEGER), 0)")

DERIVED_SQL = f"""
derived AS (
  SELECT *,
    CASE WHEN coalesce(exchange2 = 'adx', false) THEN loc_state
         ELSE concat(coalesce(loc_country, 'nan'), ':', coalesce(loc_state, 'nan')) END AS country_state,
    "timestamp" + to_hours({OFFSET_SQL}) AS ts2
  FROM impressions
),
derived2 AS (
  SELECT *,
    CASE WHEN coalesce(exchange2 = 'adx', false) THEN loc_city
         ELSE concat(coalesce(country_state, 'nan'), ':', coalesce(loc_city, 'nan')) END AS country_state_city,
    CAST(dayofweek(ts2) * 24 + hour(ts2) AS VARCHAR) AS HOW
  FROM derived
)"""


def cells_sql(attribute_cols=FIXTURE_ATTRIBUTE_COLUMNS, list_cols=FIXTURE_LIST_COLUMNS) -> str:
    parts = [f"SELECT row_id, 0 AS grp, '{c}' AS col, coalesce(CAST({c} AS VARCHAR), 'OTHER') AS value FROM derived2"
             for c in attribute_cols]
    for j, c in enumerate(list_cols):
        parts.append(f"SELECT row_id, {j + 1} AS grp, '{c}' AS col, t AS value FROM "
                     f"(SELECT row_id, unnest(list_distinct(string_split(coalesce({c}, 'OTHER'), '.'))) AS t FROM derived2)")
    return "cells AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


def rename_sql(expr: str, families) -> str:
    out = expr
    for f in families:
        out = f"replace({out}, '{f}', 'location')"
    return out


def dictionary_sql(threshold: int = FIXTURE_RARITY, families=("zip",)) -> str:
    return f"""
levels AS (SELECT grp, col, value, count(*) AS n FROM cells GROUP BY grp, col, value),
rare AS (
  SELECT col, value, n, CASE WHEN n < {threshold} THEN 'OTHER' ELSE value END AS merged FROM levels WHERE grp = 0
),
kept_cols AS (SELECT col, count(DISTINCT merged) > 1 AS column_kept FROM rare GROUP BY col),
entries AS (
  SELECT * FROM (
    SELECT 0 AS grp, r.col, r.value, concat(r.col, r.value) AS name FROM rare r JOIN kept_cols k ON r.col = k.col
    WHERE k.column_kept AND r.n >= {threshold}
    UNION ALL
    SELECT grp, col, value, concat(col, value) AS name FROM levels WHERE grp > 0 AND n >= {threshold}
  ) WHERE NOT ends_with(name, 'OTHER')
),
slots AS (SELECT DISTINCT grp, name, {rename_sql('name', families)} AS final_name FROM entries),
slots_kept AS (
  SELECT grp, name, final_name FROM (
    SELECT *, count(*) OVER (PARTITION BY final_name) AS dup FROM slots) WHERE dup = 1
),
indexed AS (SELECT grp, name, final_name, CAST(row_number() OVER (ORDER BY grp, name) - 1 AS INTEGER) AS idx FROM slots_kept),
lookup AS (SELECT e.grp, e.col, e.value, i.idx FROM entries e JOIN indexed i ON e.grp = i.grp AND e.name = i.name)"""


DAY_SETS_SQL = """
day_rank AS (
  SELECT day_ts, row_number() OVER (ORDER BY CAST(day_ts AS BIGINT)) AS rn, count(*) OVER () AS nd
  FROM (SELECT DISTINCT day_ts FROM impressions WHERE day_ts IS NOT NULL)
),
day_sets AS (
  SELECT day_ts, CASE WHEN rn <= floor(0.75 * nd) THEN 'train' ELSE 'test' END AS "set" FROM day_rank
)"""


def encoded_sql() -> str:
    return f"""
encoded0 AS (
  SELECT c.row_id, list_sort(list_distinct(list(l.idx))) AS features
  FROM cells c LEFT JOIN lookup l ON c.grp = l.grp AND c.col = l.col AND c.value = l.value
  GROUP BY c.row_id
),
encoded AS (
  SELECT i.row_id, i.day_ts, d."set", coalesce(e.features, []::INTEGER[]) AS features, {', '.join('i.' + g for g in GOALS)}
  FROM impressions i JOIN encoded0 e ON i.row_id = e.row_id LEFT JOIN day_sets d ON i.day_ts = d.day_ts
)"""


def base_ctes(threshold: int = FIXTURE_RARITY, families=("zip",), attribute_cols=FIXTURE_ATTRIBUTE_COLUMNS,
              list_cols=FIXTURE_LIST_COLUMNS, with_encoded: bool = True) -> str:
    blocks = [IMPRESSIONS_SQL, DERIVED_SQL, cells_sql(attribute_cols, list_cols),
              dictionary_sql(threshold, families), DAY_SETS_SQL]
    if with_encoded:
        blocks.append(encoded_sql())
    return "WITH " + ",\n".join(b.strip() for b in blocks)


# log-odds to a fixed step, in the same arithmetic as the Spark side
LOG_ODDS = "(floor((l1 - l0) * 1e9 + 0.5) / 1e9)"


def bayes_ctes(goals, thresholds, scope_set: str | None = "train", p: str = "", where: str | None = None) -> str:
    """Single-key counts on ``scope_set`` (None = all rows), per-key params per goal,
    per (row, goal, threshold) log-likelihood sums."""
    if where is None:
        where = f"WHERE \"set\" = '{scope_set}'" if scope_set else ""
    pos = ", ".join(f"sum({g}) AS pos_{g}" for g in goals)
    tot = ", ".join(f"sum({g}) AS tpos_{g}" for g in goals)
    params = []
    for g in goals:
        pp = f"((CAST(k.pos_{g} AS DOUBLE) + 1) / (CAST(t.tpos_{g} AS DOUBLE) + 2))"
        pn = f"((CAST(k.n - k.pos_{g} AS DOUBLE) + 1) / (CAST(t.tn - t.tpos_{g} AS DOUBLE) + 2))"
        params.append(f"ln({pp}) - ln(1 - {pp}) AS adjp_{g}, ln({pn}) - ln(1 - {pn}) AS adjn_{g}, "
                      f"ln(1 - {pp}) AS l1mp_{g}, ln(1 - {pn}) AS l1mn_{g}")
    consts = []
    for g in goals:
        for t in thresholds:
            consts.append(
                f"SELECT '{g}' AS goal, {t} AS threshold, "
                f"coalesce((SELECT sum(l1mp_{g}) FROM {p}kparams WHERE n >= {t}), 0) AS zero_p, "
                f"coalesce((SELECT sum(l1mn_{g}) FROM {p}kparams WHERE n >= {t}), 0) AS zero_n, "
                f"ln(CAST(tpos_{g} AS DOUBLE) + 1) - ln(CAST(tn AS DOUBLE) + 2) AS prior_p, "
                f"ln(CAST(tn - tpos_{g} AS DOUBLE) + 1) - ln(CAST(tn AS DOUBLE) + 2) AS prior_n FROM {p}totals")
    sums = []
    for g in goals:
        for t in thresholds:
            sums.append(
                f"SELECT r.row_id, r.\"set\", '{g}' AS goal, {t} AS threshold, r.{g} AS y, "
                f"sum(CASE WHEN p.n >= {t} THEN p.adjp_{g} ELSE 0 END) AS sp, "
                f"sum(CASE WHEN p.n >= {t} THEN p.adjn_{g} ELSE 0 END) AS sn "
                f"FROM {p}rowkeys r LEFT JOIN {p}kparams p ON r.i = p.i GROUP BY r.row_id, r.\"set\", r.{g}")
    return f""",
{p}kcounts AS (
  SELECT i, count(*) AS n, {pos} FROM (SELECT unnest(features) AS i, {GOAL_COLS} FROM encoded {where}) GROUP BY i
),
{p}totals AS (SELECT count(*) AS tn, {tot} FROM encoded {where}),
{p}kparams AS (SELECT k.i, k.n, {', '.join(params)} FROM {p}kcounts k, {p}totals t),
{p}mconsts AS ({' UNION ALL '.join(consts)}),
{p}rowkeys AS (SELECT row_id, "set", {GOAL_COLS}, unnest(CASE WHEN len(features) = 0 THEN [NULL::INTEGER] ELSE features END) AS i FROM encoded),
{p}rowsums AS ({' UNION ALL '.join(sums)}),
{p}scored AS (
  SELECT s.row_id, s."set", s.goal, s.threshold, s.y,
    c.zero_p + c.prior_p + coalesce(s.sp, 0) AS l1, c.zero_n + c.prior_n + coalesce(s.sn, 0) AS l0
  FROM {p}rowsums s JOIN {p}mconsts c ON s.goal = c.goal AND s.threshold = c.threshold
),
{p}scored2 AS (
  SELECT *, 1.0 / (1.0 + exp(-{LOG_ODDS})) AS prob, CAST({LOG_ODDS} > 0 AS INTEGER) AS pred FROM {p}scored
)"""


def metrics_sql(src: str, group: list[str], y: str = "y", score: str = "prob", pred: str = "pred") -> str:
    """Metrics CTEs over ``src`` grouped by ``group``: yields ``metrics`` with
    roc_auc, log_loss, f1, recall, precision, true_positive, false_negative."""
    g = ", ".join(group)
    gj = " AND ".join(f"a.{c} = b.{c}" for c in group)
    return f""",
m_dist AS (
  SELECT {g}, {score} AS s, CAST(sum({y}) AS BIGINT) AS pos, CAST(sum(1 - {y}) AS BIGINT) AS neg
  FROM {src} WHERE {score} IS NOT NULL GROUP BY {g}, {score}
),
m_cum AS (
  SELECT *, coalesce(CAST(sum(neg) OVER (PARTITION BY {g} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS below
  FROM m_dist
),
m_auc AS (
  SELECT {g}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
    sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) * 0.5)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS roc_auc
  FROM m_cum GROUP BY {g}
),
m_cm AS (
  SELECT {g},
    CAST(sum(CASE WHEN {y} = 0 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
    CAST(sum(CASE WHEN {y} = 0 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(CASE WHEN {y} = 1 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
    CAST(sum(CASE WHEN {y} = 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    avg(-CASE WHEN {y} = 1 THEN ln(least(greatest({score}, 1e-15), 1 - 1e-15))
              ELSE ln(1 - least(greatest({score}, 1e-15), 1 - 1e-15)) END) AS log_loss
  FROM {src} GROUP BY {g}
),
metrics AS (
  SELECT a.*, b.roc_auc,
    coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
    CASE WHEN tp > 0 AND tn > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS true_positive,
    CASE WHEN tp > 0 AND tn > 0 THEN CAST(fn AS DOUBLE) / (fn + tn) ELSE 0.0 END AS false_negative
  FROM m_cm a LEFT JOIN m_auc b ON {gj}
)"""
