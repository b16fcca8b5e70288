"""DuckDB SQL twins of the named plans (same column names, same rounding)."""

from __future__ import annotations

from panelcast.params import TEST_PARAMS
from panelcast.plans.sqlparts import fixed_rounds, sql

P = TEST_PARAMS
H = P.horizon


def _naive_rows(src: str = "act") -> str:
    """Random-walk forecasts for horizons 1..H from ``src`` (entity, target, date, y)."""
    return "\n  UNION ALL ".join(
        f"SELECT entity, target, date, {h} AS horizon, y, "
        f"lag(y, {h}) OVER (PARTITION BY entity, target ORDER BY date) AS pred FROM {src}"
        for h in range(1, H + 1))


ORACLE: dict[str, str] = {}

ORACLE["naive_rmse_by_target_horizon"] = sql(f"""
, nf AS (
  {_naive_rows()}
)
SELECT target, horizon, round(sqrt(avg(power(y - pred, 2))), 6) AS rmse_naive,
       count(power(y - pred, 2)) AS n_obs
FROM nf, fb WHERE nf.date BETWEEN fb.test_lo AND fb.anchor
GROUP BY target, horizon""", "act", "fb")

ORACLE["monthly_panel"] = sql("""
SELECT entity, indicator, date, round(value, 6) AS value FROM pm""", "pm")

ORACLE["monthly_spine"] = sql("""
SELECT entity, indicator, date, round(value, 6) AS value FROM md""", "md")

ORACLE["join_sources"] = sql("""
SELECT entity, indicator, date, round(value, 6) AS value FROM mj""", "mj")

ORACLE["positivity_profile"] = sql("""
SELECT indicator, n_nonpos, transform FROM prof""", "prof")

ORACLE["chain_index"] = sql("""
, ix AS (
  SELECT entity, 'revenue_idx' AS indicator, date,
         round(100 * value / lag(value, 1) OVER (PARTITION BY entity ORDER BY date), 6) AS value
  FROM md WHERE indicator = 'revenue'
)
SELECT entity, indicator, date, round(value, 6) AS value,
       round(CASE WHEN value IS NOT NULL THEN 100 * product(value / 100) OVER (
         PARTITION BY entity, indicator ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END, 4) AS level
FROM ix""", "md")

ORACLE["yoy_log_diff"] = sql("""
SELECT entity, indicator, feature, date, round(value, 6) AS value
FROM mf WHERE features_type = 'd12' AND feature LIKE '%\\_log\\_d12' ESCAPE '\\'""", "mf")

ORACLE["yoy_level_diff"] = sql("""
SELECT entity, indicator, feature, date, round(value, 6) AS value
FROM mf WHERE features_type = 'd12' AND NOT feature LIKE '%\\_log\\_d12' ESCAPE '\\'""", "mf")

ORACLE["rolling_means"] = sql("""
SELECT entity, feature, width, date, round(value, 6) AS value FROM mf WHERE features_type = 'rolling'""", "mf")

ORACLE["month_of_quarter_pivot"] = sql("""
, q AS (
  SELECT entity, feature, features_type, CAST((month(date) - 1) % 3 + 1 AS INTEGER) AS miq,
         CAST(date_trunc('quarter', date) AS DATE) AS date, value FROM mf
)
SELECT entity, feature, features_type, q.date,
       round(max(value) FILTER (WHERE miq = 1), 6) AS m1,
       round(max(value) FILTER (WHERE miq = 2), 6) AS m2,
       round(max(value) FILTER (WHERE miq = 3), 6) AS m3
FROM q, fb WHERE q.date BETWEEN fb.first_q AND fb.anchor
GROUP BY entity, feature, features_type, q.date""", "mf", "fb")

ORACLE["quarterly_join"] = sql("""
, c AS (
  SELECT entity, date,
         count(value) FILTER (WHERE availability = 1) AS n_m1,
         count(value) FILTER (WHERE availability = 2) AS n_m2,
         count(value) FILTER (WHERE availability = 3) AS n_m3
  FROM fq WHERE features_type = 'd12' GROUP BY entity, date
)
SELECT t.entity, t.target, t.date, round(t.y, 6) AS y, c.n_m1, c.n_m2, c.n_m3
FROM tq t JOIN c ON t.entity = c.entity AND t.date = c.date""", "tq", "fq")

ORACLE["feature_lags"] = sql(f"""
, fl AS (
  {" UNION ALL ".join(
      f"SELECT entity, feature, features_type, availability, date, {k} AS lag, "
      + ("value" if k == 0 else f"lag(value, {k}) OVER (PARTITION BY entity, feature ORDER BY date)")
      + " AS value FROM fq" for k in range(H))}
)
SELECT entity, feature, features_type, availability, date, lag, round(value, 6) AS value
FROM fl WHERE date >= DATE '{P.start_date.isoformat()}'""", "fq")

ORACLE["target_lags"] = sql(f"""
SELECT entity, target, date, round(y, 6) AS y,
       {", ".join(f"round(lag(y, {k}) OVER (PARTITION BY entity, target ORDER BY date), 6) AS y_lag{k}" for k in range(1, H + 1))}
FROM al
QUALIFY date >= DATE '{P.start_date.isoformat()}'""", "al")


def _cell_sql(features_type: str, availability: int, target: str, horizon: int, strategy: str = "avail_only") -> str:
    months = f"availability = {availability}" if strategy == "avail_only" or features_type == "rolling" \
        else f"availability <= {availability}"
    k = horizon - 1
    col = f"feature || '_lag{k}'" if k else "feature"
    val = f"lag(value, {k}) OVER (PARTITION BY entity, feature ORDER BY date)" if k else "value"
    return sql(f"""
, feats AS (
  SELECT entity, date, {col} AS "column", {val} AS value
  FROM fq WHERE features_type = '{features_type}' AND {months}
), t AS (SELECT * FROM al WHERE target = '{target}'),
rows_t AS (
  SELECT entity, date, '{target}_lag{horizon}' AS "column",
         lag(y, {horizon}) OVER (PARTITION BY entity, target ORDER BY date) AS value FROM t
  UNION ALL SELECT entity, date, 'y', y FROM t
), u AS (
  SELECT * FROM feats f WHERE EXISTS (SELECT 1 FROM t WHERE t.entity = f.entity AND t.date = f.date)
  UNION ALL
  SELECT * FROM rows_t r WHERE EXISTS (SELECT 1 FROM feats f WHERE f.entity = r.entity AND f.date = r.date)
)
SELECT entity, date, "column", round(value, 6) AS value FROM u WHERE date >= DATE '{P.start_date.isoformat()}'""",
               "fq", "al")


ORACLE["cell_features"] = _cell_sql("d12", 2, "gmv_log_d4", 2)
ORACLE["cumulative_availability"] = _cell_sql("d12", 2, "gmv_log_d4", 1, "all")

ORACLE["grid_headers"] = sql("""
SELECT sheet, row_no, trim(c0) AS title FROM gh WHERE is_header""", "gh")

ORACLE["grid_long"] = sql(r"""
SELECT sheet, indicator, row_no, CAST(year_text AS INTEGER) AS year, month, raw
FROM gc WHERE regexp_matches(year_text, '^[0-9]+$') AND length(year_text) <= 4""", "gc")

ORACLE["grid_clean_values"] = sql("""
SELECT sheet, indicator, row_no, date, round(value, 6) AS value, round(value_strict, 6) AS value_strict
FROM grk WHERE dup_rank = 1""", "grk")

ORACLE["grid_pivot"] = sql("""
SELECT sheet, date,
  round(max(value) FILTER (WHERE indicator = 'AUTOMOBILE'), 6) AS automobile,
  round(max(value) FILTER (WHERE indicator = 'BUILDING'), 6) AS building,
  round(max(value) FILTER (WHERE indicator = 'FURNITURE'), 6) AS furniture,
  round(max(value) FILTER (WHERE indicator = 'HOUSEHOLD'), 6) AS household,
  round(max(value) FILTER (WHERE indicator = 'MACHINERY'), 6) AS machinery
FROM grk WHERE dup_rank = 1 GROUP BY sheet, date""", "grk")

ORACLE["grid_rejects"] = sql("""
SELECT sheet, row_no, indicator, month, raw,
  CASE WHEN NOT year_ok THEN 'bad_year' WHEN date IS NULL THEN 'bad_date' ELSE 'bad_value' END AS reason
FROM gp WHERE NOT year_ok OR date IS NULL OR value IS NULL
UNION ALL
SELECT sheet, row_no, indicator, month, raw, 'duplicate' FROM grk WHERE dup_rank > 1""", "gp", "grk")

_SPLIT = """CASE WHEN date BETWEEN fb.test_lo AND fb.anchor THEN 'test'
            WHEN date BETWEEN fb.valid_lo AND fb.valid_hi THEN 'valid'
            WHEN date < fb.valid_lo THEN 'train' END"""
START = f"DATE '{P.start_date.isoformat()}'"

ORACLE["chrono_split"] = sql(f"""
SELECT entity, target, date, round(y, 6) AS y, {_SPLIT} AS split
FROM al, fb WHERE date >= {START}""", "al", "fb")

ORACLE["rolling_origins"] = sql(f"""
, o AS (
  SELECT i AS origin_id,
         CAST(fb.anchor - to_months(CAST(3 * ({P.test_len - 2 + H} - i) AS INTEGER)) AS DATE) AS origin,
         CAST(fb.anchor - to_months(CAST(3 * ({P.test_len - 1} - i) AS INTEGER)) AS DATE) AS window_end
  FROM fb, (SELECT range AS i FROM range(0, {P.test_len + H - 1}))
), d AS (SELECT DISTINCT date FROM act)
SELECT o.origin_id, o.origin, o.window_end, d.date,
       row_number() OVER (PARTITION BY o.origin_id ORDER BY d.date) AS horizon
FROM o JOIN d ON d.date BETWEEN o.origin AND o.window_end""", "act", "fb")

_MV = f"""mv AS (
  SELECT mj.* FROM mj, fb WHERE mj.date >= {START} AND mj.date <= CAST(fb.anchor + INTERVAL 2 MONTH AS DATE)
)"""

ORACLE["vintage_cut"] = sql(f"""
, {_MV}, v AS (SELECT range AS vintage FROM range(0, {P.test_len + H + 1})),
ms AS (
  SELECT v.vintage, mv.entity, count(mv.value) AS n_m FROM mv, v, fb
  WHERE mv.date <= CAST(fb.anchor + INTERVAL 2 MONTH - to_months(CAST(3 * v.vintage AS INTEGER)) AS DATE)
  GROUP BY 1, 2
), qs AS (
  SELECT v.vintage, act.entity, count(act.y) AS n_q FROM act, v, fb
  WHERE act.date <= CAST(fb.anchor - to_months(CAST(3 * (v.vintage + 1) AS INTEGER)) AS DATE)
  GROUP BY 1, 2
)
SELECT ms.vintage, ms.entity,
  CAST(fb.anchor + INTERVAL 2 MONTH - to_months(CAST(3 * ms.vintage AS INTEGER)) AS DATE) AS m_end,
  CAST(fb.anchor - to_months(CAST(3 * (ms.vintage + 1) AS INTEGER)) AS DATE) AS q_end,
  ms.n_m, qs.n_q
FROM ms JOIN qs ON ms.vintage = qs.vintage AND ms.entity = qs.entity, fb""", "mj", "act", "fb")

ORACLE["ragged_edge_mask"] = sql(f"""
, {_MV}, mm AS (
  SELECT a.availability, mv.entity, mv.indicator, mv.date,
    CASE WHEN mv.date <= CAST(fb.anchor + INTERVAL 2 MONTH - to_months(3 - a.availability) AS DATE) THEN mv.value END AS value
  FROM mv, fb, (VALUES (1), (2), (3)) a(availability)
)
SELECT availability, entity, indicator, count(value) AS n_values,
       max(CASE WHEN value IS NOT NULL THEN date END) AS last_date
FROM mm GROUP BY 1, 2, 3""", "mj", "fb")

ORACLE["null_threshold_columns"] = sql(f"""
, {_MV}
SELECT 'm' AS kind, entity, indicator AS series, count(*) FILTER (WHERE value IS NULL) AS n_null,
       count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) <= {P.max_nulls_m} AS keep
FROM mv GROUP BY entity, indicator
UNION ALL
SELECT 'q', entity, target, count(*) FILTER (WHERE y IS NULL), count(*),
       count(*) FILTER (WHERE y IS NULL) <= {P.max_nulls_q}
FROM act GROUP BY entity, target""", "mj", "act", "fb")

ORACLE["complete_cases"] = sql(f"""
, {_MV}, keep AS (
  SELECT entity, indicator FROM mv GROUP BY 1, 2 HAVING count(*) FILTER (WHERE value IS NULL) <= {P.max_nulls_m}
), k AS (SELECT mv.* FROM mv JOIN keep USING (entity, indicator))
SELECT entity, date, count(value) AS n_values FROM k GROUP BY entity, date HAVING count(value) = count(*)""",
                               "mj", "fb")


def _split_cell_sql(features_type: str, availability: int, target: str, horizon: int) -> str:
    body = _cell_sql(features_type, availability, target, horizon)
    # the cell twin ends with a SELECT over u: wrap it to add the split column
    head, _, _ = body.rpartition("SELECT entity, date, \"column\", round(value, 6) AS value FROM u")
    return head + f"""SELECT u.entity, u.date, u."column", u.value, {_SPLIT} AS split
FROM u, fb WHERE u.date >= {START}"""


_PC = _split_cell_sql("d12", 1, "gmv_log_d4", 1)
ORACLE["null_free_features"] = _PC.replace("SELECT u.entity, u.date", ", sd AS (SELECT u.entity, u.date", 1) + """)
SELECT "column", count(*) FILTER (WHERE value IS NULL) AS n_null, count(*) AS n_rows,
       count(*) FILTER (WHERE value IS NULL) = 0 AS null_free
FROM sd WHERE split IN ('train', 'valid') GROUP BY "column\""""

ORACLE["standardise"] = _PC.replace("SELECT u.entity, u.date", ", sd AS (SELECT u.entity, u.date", 1) + """)
, d AS (SELECT * FROM sd WHERE "column" <> 'y'),
st AS (
  SELECT "column", avg(value) AS mu,
         CASE WHEN stddev_pop(value) > 0 THEN stddev_pop(value) ELSE 1.0 END AS sigma
  FROM d WHERE split = 'train' GROUP BY "column"
)
SELECT d.entity, d.date, d."column", d.split, round((d.value - st.mu) / st.sigma, 6) AS z
FROM d LEFT JOIN st USING ("column")"""

Z68 = 0.994457883209753
_W = "PARTITION BY entity, target ORDER BY date"
_W4 = f"{_W} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW"
_PF = "pfb AS (SELECT *, CASE WHEN count(y) OVER (" + _W4 + ") = 4 THEN CAST(sum(CAST(y AS DECIMAL(38,12))) OVER (" + _W4 + """) AS DOUBLE) / 4 END AS m4,
    CASE WHEN count(y) OVER (""" + _W4 + ") = 4 THEN stddev_pop(y) OVER (" + _W4 + """) END AS s4 FROM act),
pf0 AS (
  """ + "\n  UNION ALL ".join(
    f"SELECT 'naive' AS model, entity, target, date, {h} AS horizon, lag(y, {h}) OVER ({_W}) AS pred, "
    f"CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi FROM pfb"
    f"\n  UNION ALL SELECT 'snaive', entity, target, date, {h}, lag(y, {4 * ((h + 3) // 4)}) OVER ({_W}), NULL, NULL FROM pfb"
    f"\n  UNION ALL SELECT 'mean4', entity, target, date, {h}, lag(m4, {h}) OVER ({_W}), "
    f"lag(m4, {h}) OVER ({_W}) - {Z68} * lag(s4, {h}) OVER ({_W}), lag(m4, {h}) OVER ({_W}) + {Z68} * lag(s4, {h}) OVER ({_W}) FROM pfb"
    for h in range(1, H + 1)) + """
), pf AS (
  SELECT pf0.*, g.availability, g.features_type FROM pf0, fb,
    (VALUES (1, 'd12'), (1, 'rolling'), (2, 'd12'), (2, 'rolling'), (3, 'd12'), (3, 'rolling')) g(availability, features_type)
  WHERE pf0.date BETWEEN fb.test_lo AND fb.anchor
), nr AS (
  SELECT target, horizon, sqrt(avg(power(y - pred, 2))) AS rmse_naive FROM (
    """ + "\n    UNION ALL ".join(
    f"SELECT entity, target, date, {h} AS horizon, y, lag(y, {h}) OVER ({_W}) AS pred FROM act" for h in range(1, H + 1)) + """
  ) n, fb WHERE n.date BETWEEN fb.test_lo AND fb.anchor GROUP BY target, horizon
), rm AS (
  SELECT model, target, features_type, availability, horizon, sqrt(avg(power(pf.pred - act.y, 2))) AS rmse,
         count(power(pf.pred - act.y, 2)) AS n_obs
  FROM pf JOIN act USING (entity, target, date) GROUP BY 1, 2, 3, 4, 5
), ml AS (
  SELECT rm.horizon, rm.availability, rm.features_type, rm.rmse, rm.target, rm.model, nr.rmse_naive,
         CASE WHEN nr.rmse_naive <> 0 THEN rm.rmse / nr.rmse_naive END AS rel_rmse_naive
  FROM rm LEFT JOIN nr USING (target, horizon)
), qe AS (
  SELECT entity, CAST(date + INTERVAL 2 MONTH AS DATE) AS fcst_date, median, target AS variable, horizon, 3 AS p, a.availability
  FROM (""" + "\n    UNION ALL ".join(
    f"SELECT entity, target, date, {h} AS horizon, lag(m4, {h}) OVER ({_W}) AS median FROM pfb" for h in range(1, H + 2)) + """
  ) r, fb, (VALUES (1), (2), (3)) a(availability)
  WHERE r.date BETWEEN fb.test_lo AND fb.anchor AND r.median IS NOT NULL
), sh AS (
  SELECT CAST(fcst_date - INTERVAL 2 MONTH AS DATE) AS date, median AS pred, variable AS target, entity, horizon, availability
  FROM qe WHERE CAST(fcst_date - INTERVAL 2 MONTH AS DATE) IN (SELECT date FROM act, fb WHERE date BETWEEN fb.test_lo AND fb.anchor)
), vr AS (
  SELECT sh.horizon, sh.availability, 'd12' AS features_type, sqrt(avg(power(sh.pred - act.y, 2))) AS rmse,
         sh.target, 'mean4_quarter_end' AS model
  FROM sh JOIN act USING (entity, target, date) GROUP BY sh.horizon, sh.availability, sh.target
), mt AS (
  SELECT * FROM ml
  UNION ALL
  SELECT vr.horizon, vr.availability, vr.features_type, vr.rmse, vr.target, vr.model, nr.rmse_naive,
         CASE WHEN nr.rmse_naive <> 0 THEN vr.rmse / nr.rmse_naive END
  FROM vr JOIN nr USING (target, horizon)
)"""


def _score_sql(body: str) -> str:
    return sql(", " + _PF + "\n" + body, "act", "fb")


ORACLE["rmse_long"] = _score_sql("""
SELECT model, target, features_type, availability, horizon, round(rmse, 6) AS rmse, n_obs FROM rm""")

ORACLE["rel_rmse"] = _score_sql("""
SELECT rm.model, rm.target, rm.features_type, rm.availability, rm.horizon, round(rm.rmse, 6) AS rmse,
       round(nr.rmse_naive, 6) AS rmse_naive,
       round(CASE WHEN nr.rmse_naive <> 0 THEN rm.rmse / nr.rmse_naive END, 6) AS rel_rmse_naive
FROM rm LEFT JOIN nr USING (target, horizon)""")

ORACLE["metrics_table"] = _score_sql("""
SELECT horizon, availability, features_type, round(rmse, 6) AS rmse, target, model,
       round(rmse_naive, 6) AS rmse_naive, round(rel_rmse_naive, 6) AS rel_rmse_naive FROM mt""")

ORACLE["leaderboard"] = _score_sql("""
, rk AS (
  SELECT target, horizon, availability, round(rel_rmse_naive, 6) AS rel, model, features_type,
         row_number() OVER (PARTITION BY target, horizon, availability
                            ORDER BY round(rel_rmse_naive, 12), model, features_type) AS rn
  FROM mt WHERE rel_rmse_naive IS NOT NULL AND NOT isnan(rel_rmse_naive)
)
SELECT target, horizon, availability, rel AS best_rel_rmse_naive, model AS best_model,
       features_type AS best_features_type
FROM rk WHERE rn = 1""")

ORACLE["stored_scores"] = _score_sql("""
SELECT 'bench' AS run_id, horizon, availability, features_type, round(rmse, 6) AS rmse, target, model,
       round(rmse_naive, 6) AS rmse_naive, round(rel_rmse_naive, 6) AS rel_rmse_naive
FROM ml WHERE features_type = 'd12'""")

_CDF = """CASE WHEN z >= 0 THEN 1 - ({pdf_abs}) * ({poly}) ELSE ({pdf_abs}) * ({poly}) END"""


def _crps_sql() -> str:
    az = "abs(z)"
    t = f"(1 / (1 + 0.2316419 * {az}))"
    poly = (f"{t} * (0.31938153 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * "
            f"(-1.821255978 + {t} * 1.330274429))))")
    pdf = lambda x: f"(exp(-0.5 * {x} * {x}) / sqrt(2 * 3.141592653589793))"
    cdf = _CDF.format(pdf_abs=pdf(az), poly=poly)
    return _score_sql(f"""
, cs AS (
  SELECT pf.target, pf.horizon, act.y, pf.pred, (pf.hi - pf.lo) / (2 * {Z68}) AS sigma
  FROM pf JOIN act USING (entity, target, date)
  WHERE pf.model = 'mean4' AND pf.availability = 1 AND pf.features_type = 'd12'
), cz AS (SELECT *, (y - pred) / sigma AS z FROM cs WHERE sigma > 0)
SELECT target, horizon,
  round(avg(sigma * (z * (2 * ({cdf}) - 1) + 2 * {pdf('z')} - 1 / sqrt(3.141592653589793))), 6) AS crps,
  count(*) AS n_obs
FROM cz GROUP BY target, horizon""")


ORACLE["crps_gaussian"] = _crps_sql()

ORACLE["forecast_date_shift"] = _score_sql("""
SELECT entity, target, availability, horizon, date, round(pred, 6) AS pred FROM sh""")

ORACLE["top_h_steps"] = sql(f"""
, path AS (
  SELECT entity, target, date AS origin, y AS pred, k, CAST(date + to_months(CAST(3 * k AS INTEGER)) AS DATE) AS date
  FROM act, fb, (SELECT range AS k FROM range(1, {H + 4}))
  WHERE act.date BETWEEN fb.test_lo AND fb.anchor AND y IS NOT NULL
), r AS (SELECT *, row_number() OVER (PARTITION BY entity, target, origin ORDER BY date) AS horizon FROM path)
SELECT entity, target, origin, date, horizon, round(pred, 6) AS pred FROM r WHERE horizon <= {H}""", "act", "fb")

ORACLE["unpivot_targets"] = sql("""
SELECT entity, date, target, round(y, 6) AS y FROM act WHERE y IS NOT NULL""", "act")

ORACLE["raw_export"] = sql("""
SELECT 'm' AS freq, entity, indicator AS series, date, round(value, 6) AS value FROM mj
UNION ALL
SELECT 'q', entity, target, date, round(level, 6) FROM qd""", "mj", "qd")

# Same tie-exact rounding as the Spark plans (``round_fixed``).
ORACLE = {k: fixed_rounds(v) for k, v in ORACLE.items()}
