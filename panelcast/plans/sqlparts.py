"""Shared CTEs of the DuckDB twins (the independent oracle of every plan).

Each CTE is written straight from the operator definitions, not generated
from the Spark plans.  ``sql(body, *names)`` prepends the named CTEs and
everything they depend on, in dependency order.
"""

from __future__ import annotations

from panelcast.params import TEST_PARAMS, Params


def ctes(p: Params = TEST_PARAMS) -> dict[str, tuple[str, tuple[str, ...]]]:
    win = p.windows
    roll_cols = ",\n  ".join(
        f"CASE WHEN count(d12) OVER (PARTITION BY entity, indicator ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) = {k} "
        f"THEN CAST(sum(CAST(d12 AS DECIMAL(38,12))) OVER (PARTITION BY entity, indicator ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) / {k} END AS roll_{k}"
        for k in win)
    roll_union = "\n  UNION ALL ".join(
        f"SELECT entity, indicator, feature || '_roll_mean_{k}' AS feature, 'rolling' AS features_type, {k} AS width, date, roll_{k} AS value FROM ys"
        for k in win)
    c = {
        "ent": ("""SELECT c.c_custkey AS custkey, CAST(n.n_regionkey AS VARCHAR) || '|' || c.c_mktsegment AS entity
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""", ()),
        "om": (f"""SELECT e.entity, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS date,
    SUM(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS rev_c, COUNT(*) AS n_orders,
    SUM(CASE WHEN o.o_orderstatus = 'F' THEN CAST(round(o.o_totalprice * 100) AS BIGINT)
             WHEN o.o_orderstatus = 'O' THEN -CAST(round(o.o_totalprice * 100) AS BIGINT) ELSE 0 END) AS flow_c
  FROM orders o JOIN ent e ON o.o_custkey = e.custkey
  GROUP BY 1, 2""", ("ent",)),
        "pm": ("""SELECT entity, 'revenue' AS indicator, date, CAST(rev_c AS DOUBLE) / 100 AS value FROM om
  UNION ALL SELECT entity, 'orders', date, CAST(n_orders AS DOUBLE) FROM om
  UNION ALL SELECT entity, 'avg_ticket', date, round((CAST(rev_c AS DOUBLE) / 100) / n_orders, 6) FROM om
  UNION ALL SELECT entity, 'net_flow', date, CAST(flow_c AS DOUBLE) / 100 FROM om""", ("om",)),
        "mb": (f"""SELECT CAST(min(date_trunc('month', o_orderdate)) AS DATE) AS lo,
    CAST(max(date_trunc('month', o_orderdate)) AS DATE) AS hi,
    CAST(date_trunc('quarter', max(o_orderdate) + INTERVAL 1 DAY) - INTERVAL 3 MONTH AS DATE) AS full_q
  FROM orders""", ()),
        "mcal": ("""SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS date FROM mb""", ("mb",)),
        "md": ("""SELECT k.entity, k.indicator, c.date, p.value
  FROM (SELECT DISTINCT entity, indicator FROM pm) k CROSS JOIN mcal c
  LEFT JOIN pm p ON p.entity = k.entity AND p.indicator = k.indicator AND p.date = c.date""", ("pm", "mcal")),
        "src": ("""SELECT * FROM pm UNION ALL SELECT * FROM mk""", ("pm", "mk")),
        "mj": ("""SELECT k.entity, k.indicator, c.date, p.value
  FROM (SELECT DISTINCT s.entity, s.indicator FROM src s, mb WHERE s.date BETWEEN mb.lo AND mb.hi) k CROSS JOIN mcal c
  LEFT JOIN src p ON p.entity = k.entity AND p.indicator = k.indicator AND p.date = c.date""", ("src", "mcal", "mb")),
        "prof": ("""SELECT indicator, count(*) FILTER (WHERE value <= 0) AS n_nonpos,
    CASE WHEN count(*) FILTER (WHERE value <= 0) = 0 THEN 'log' ELSE 'level' END AS transform
  FROM mj GROUP BY indicator""", ("mj",)),
        "yx": ("""SELECT md.entity, md.indicator, md.date, md.value, pr.transform,
    CASE WHEN pr.transform = 'log' THEN (CASE WHEN md.value > 0 THEN ln(md.value) END) ELSE md.value END AS x,
    md.indicator || CASE WHEN pr.transform = 'log' THEN '_log_d12' ELSE '_d12' END AS feature
  FROM mj md JOIN prof pr ON md.indicator = pr.indicator""", ("mj", "prof")),
        "yd": ("""SELECT *, x - lag(x, 12) OVER (PARTITION BY entity, indicator ORDER BY date) AS d12 FROM yx""", ("yx",)),
        "ys": (f"""SELECT *,
  {roll_cols}
  FROM yd""", ("yd",)),
        "mf": (f"""SELECT entity, indicator, feature, 'd12' AS features_type, 0 AS width, date, d12 AS value FROM ys
  UNION ALL {roll_union}""", ("ys",)),
        "lq": (f"""SELECT l_orderkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date,
    SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS gmv_c,
    SUM(CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS net_c,
    SUM(CAST(l_quantity AS BIGINT)) AS qty,
    SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS ret_qty
  FROM lineitem GROUP BY 1, 2""", ()),
        "lm": (f"""SELECT l_orderkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
    SUM(CAST(l_quantity AS BIGINT)) AS qty, COUNT(*) AS n_lines,
    SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS ret_qty
  FROM lineitem GROUP BY 1, 2""", ()),
        "pqw": ("""SELECT e.entity, x.date, SUM(x.gmv_c) AS gmv_c, SUM(x.net_c) AS net_c, SUM(x.qty) AS qty
  FROM lq x JOIN orders o ON x.l_orderkey = o.o_orderkey JOIN ent e ON o.o_custkey = e.custkey
  GROUP BY 1, 2""", ("lq", "ent")),
        "mkw": ("""SELECT e.entity, x.date, SUM(x.qty) AS qty, SUM(x.ret_qty) AS ret_qty, SUM(x.n_lines) AS n_lines
  FROM lm x JOIN orders o ON x.l_orderkey = o.o_orderkey JOIN ent e ON o.o_custkey = e.custkey
  GROUP BY 1, 2""", ("lm", "ent")),
        "mk": ("""SELECT entity, 'shipped_lines' AS indicator, date, CAST(n_lines AS DOUBLE) AS value FROM mkw
  UNION ALL SELECT entity, 'return_share', date, round(CAST(ret_qty AS DOUBLE) / qty, 6) FROM mkw""", ("mkw",)),
        "pq": ("""SELECT entity, 'gmv' AS target, date, CAST(gmv_c AS DOUBLE) / 100 AS level FROM pqw
  UNION ALL SELECT entity, 'net_sales', date, CAST(net_c AS DOUBLE) / 100 FROM pqw
  UNION ALL SELECT entity, 'qty', date, CAST(qty AS DOUBLE) FROM pqw""", ("pqw",)),
        "qb": (f"""SELECT CAST(min(date_trunc('quarter', l_shipdate)) AS DATE) AS lo,
    CAST(max(date_trunc('quarter', l_shipdate)) AS DATE) AS hi,
    CAST(date_trunc('quarter', max(l_shipdate) + INTERVAL 1 DAY) - INTERVAL 3 MONTH AS DATE) AS full_q
  FROM lineitem""", ()),
        "qcal": ("""SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 3 MONTH)) AS DATE) AS date FROM qb""", ("qb",)),
        "qd": ("""SELECT k.entity, k.target, c.date, p.level
  FROM (SELECT DISTINCT entity, target FROM pq) k CROSS JOIN qcal c
  LEFT JOIN pq p ON p.entity = k.entity AND p.target = k.target AND p.date = c.date""", ("pq", "qcal")),
        "tq": ("""SELECT entity, target || '_log_d4' AS target, date, level,
    (CASE WHEN level > 0 THEN ln(level) END)
      - lag(CASE WHEN level > 0 THEN ln(level) END, 4) OVER (PARTITION BY entity, target ORDER BY date) AS y
  FROM qd""", ("qd",)),
        # first quarter with a month-1 row and with targets; anchor = last common quarter
        "fb": (f"""SELECT greatest(CASE WHEN CAST(date_trunc('quarter', mb.lo) AS DATE) = mb.lo THEN mb.lo
                     ELSE CAST(date_trunc('quarter', mb.lo) + INTERVAL 3 MONTH AS DATE) END, qb.lo) AS first_q,
    least(mb.full_q, qb.full_q) AS anchor,
    CAST(least(mb.full_q, qb.full_q) - INTERVAL {3 * (p.test_len - 1)} MONTH AS DATE) AS test_lo,
    CAST(least(mb.full_q, qb.full_q) - INTERVAL {3 * p.test_len} MONTH AS DATE) AS valid_hi,
    CAST(least(mb.full_q, qb.full_q)
         - INTERVAL {3 * (p.test_len + p.valid_len - 1)} MONTH AS DATE) AS valid_lo
  FROM mb, qb""", ("mb", "qb")),
        "al": ("""SELECT tq.entity, tq.target, tq.date, tq.level, tq.y FROM tq, fb
  WHERE tq.date BETWEEN fb.first_q AND fb.anchor""", ("tq", "fb")),
        "act": (f"""SELECT * FROM al WHERE date >= DATE '{p.start_date.isoformat()}'""", ("al",)),
        "fq": ("""SELECT mf.entity, mf.indicator, mf.feature AS base_feature,
    mf.feature || '_m' || CAST((month(mf.date) - 1) % 3 + 1 AS VARCHAR) AS feature,
    mf.features_type, mf.width, CAST((month(mf.date) - 1) % 3 + 1 AS INTEGER) AS availability,
    CAST(date_trunc('quarter', mf.date) AS DATE) AS date, mf.value
  FROM mf, fb
  WHERE CAST(date_trunc('quarter', mf.date) AS DATE) BETWEEN fb.first_q AND fb.anchor""", ("mf", "fb")),
    }
    return c


_FIXED = "CAST(round(TRY_CAST({e} AS DECIMAL(38,12)), {d}) AS DOUBLE)"


def fixed_rounds(text: str) -> str:
    """Every ``round(<expr>, d)`` of a twin -> the tie-exact rounding of ``round_fixed``."""
    out, i = [], 0
    while True:
        j = text.find("round(", i)
        if j < 0 or (j > 0 and (text[j - 1].isalnum() or text[j - 1] == "_")):
            if j < 0:
                out.append(text[i:])
                return "".join(out)
            out.append(text[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = text[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        if comma < 0:  # round(x): to an integer, no tie question for the cent amounts it is used on
            out.append(text[i:j] + "round(" + fixed_rounds(text[j + 6:k - 1]) + ")")
        else:
            inner, digits = text[j + 6:comma], text[comma + 1:k - 1].strip()
            out.append(text[i:j] + _FIXED.format(e=fixed_rounds(inner), d=digits))
        i = k


def sql(body: str, *names: str, p: Params = TEST_PARAMS) -> str:
    defs = ctes(p)
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in defs[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n  {defs[n][0]}\n)" for n in order) + "\n" + body


MONTHS = [f"c{m}" for m in range(1, 13)]
_M = ", ".join(MONTHS)
_NULLS = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in MONTHS)
_COMMA = r"regexp_replace(replace(printf('%.2f', v), '.', ','), '^(-?[0-9]+)([0-9]{3}),', '\1 \2,')"
_KEPT = r"replace(regexp_replace({src}, '[^0-9,.\-]', '', 'g'), ',', '.')"
_NUM = r"CASE WHEN regexp_matches({k}, '^-?([0-9]+\.?[0-9]*|\.[0-9]+)$') THEN TRY_CAST({k} AS DOUBLE) END"


def _clean(raw: str, strict: bool) -> str:
    src = raw if strict else rf"regexp_replace({raw}, '\s+[0-9]{{1,2}}\)\s*$', '')"
    plain = _NUM.format(k=_KEPT.format(src=src))
    if strict:
        return plain
    return rf"CASE WHEN regexp_matches({src}, '^\s*-?[0-9]+([.,][0-9]+)?[eE][-+]?[0-9]+\s*$') THEN TRY_CAST(replace(trim({src}), ',', '.') AS DOUBLE) ELSE {plain} END"


GRID_CTES = {
    "gcells": (f"""SELECT 'region_' || split_part(entity, '|', 1) AS sheet, split_part(entity, '|', 2) AS segment,
    CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(rev_c AS DOUBLE) / 100 AS v
  FROM om""", ("om",)),
    "gtxt": (f"""SELECT sheet, segment, year, month,
    CASE (year * 12 + month) % 6 WHEN 0 THEN printf('%.2f', v) WHEN 1 THEN {_COMMA}
      WHEN 2 THEN {_COMMA} || ' 1)' WHEN 3 THEN '(' || printf('%.2f', v) || ')'
      WHEN 4 THEN '…' ELSE ' ' || printf('%.2f', v) || ' ' END AS text
  FROM gcells""", ("gcells",)),
    "gyrs": ("SELECT sheet, segment, year, " + ", ".join(f"max(text) FILTER (WHERE month = {m}) AS c{m}" for m in range(1, 13))
             + " FROM gtxt GROUP BY sheet, segment, year", ("gtxt",)),
    "gblocks": ("""SELECT sheet, segment, dense_rank() OVER (PARTITION BY sheet ORDER BY segment) AS block
  FROM (SELECT DISTINCT sheet, segment FROM gyrs)""", ("gyrs",)),
    "gyb": ("""SELECT y.*, b.block, s.y0, s.y1 FROM gyrs y JOIN gblocks b USING (sheet, segment)
  JOIN (SELECT sheet, segment, min(year) AS y0, max(year) AS y1 FROM gyrs GROUP BY sheet, segment) s USING (sheet, segment)""",
            ("gyrs", "gblocks")),
    "grid": (f"""SELECT sheet, CAST(block * 1000 + 10 + year - 1990 AS INTEGER) AS row_no, CAST(year AS VARCHAR) AS c0, {_M} FROM gyb
  UNION ALL SELECT sheet, CAST(block * 1000 + 900 AS INTEGER), CAST(year AS VARCHAR) || '*', {_M} FROM gyb WHERE year = y0
  UNION ALL SELECT sheet, CAST(block * 1000 + 950 AS INTEGER), CAST(year AS VARCHAR), {_M} FROM gyb WHERE year = y1
  UNION ALL SELECT sheet, CAST(block * 1000 AS INTEGER), '  ' || segment || ' ', {_NULLS} FROM gblocks
  UNION ALL SELECT sheet, CAST(block * 1000 + 1 AS INTEGER), CAST(NULL AS VARCHAR), {_NULLS} FROM gblocks
  UNION ALL SELECT sheet, 0, 'Monthly revenue by segment', 'source: orders', {", ".join(f"CAST(NULL AS VARCHAR)" for _ in range(11))}
    FROM gblocks WHERE block = 1""", ("gyb", "gblocks")),
    "gh": (rf"""SELECT *, (c0 IS NOT NULL AND trim(c0) <> '' AND NOT regexp_matches(c0, '^\s*[0-9]+(\.0)?\s*$')
      AND coalesce({_M}) IS NULL) AS is_header FROM grid""", ("grid",)),
    "gs": ("""SELECT *, last_value(CASE WHEN is_header THEN trim(c0) END IGNORE NULLS) OVER (
      PARTITION BY sheet ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS indicator FROM gh""", ("gh",)),
    "gc": (f"""SELECT sheet, indicator, row_no, c0 AS year_text, CAST(substr(mcol, 2) AS INTEGER) AS month, raw
  FROM (UNPIVOT (SELECT sheet, indicator, row_no, c0, {_M} FROM gs
                 WHERE indicator IS NOT NULL AND NOT is_header AND coalesce(c0, {_M}) IS NOT NULL)
        ON {_M} INTO NAME mcol VALUE raw)
  WHERE c0 IS NOT NULL AND raw IS NOT NULL""", ("gs",)),
    "gp": (rf"""SELECT *, regexp_matches(year_text, '^[0-9]+$') AND length(year_text) <= 4 AS year_ok,
    CASE WHEN regexp_matches(year_text, '^[0-9]+$') AND length(year_text) <= 4
          AND CAST(year_text AS INTEGER) BETWEEN 1 AND 9999
         THEN make_date(CAST(year_text AS INTEGER), month, 1) END AS date,
    {_clean('raw', False)} AS value, {_clean('raw', True)} AS value_strict
  FROM gc""", ("gc",)),
    "grk": ("""SELECT *, row_number() OVER (PARTITION BY sheet, indicator, date ORDER BY row_no) AS dup_rank
  FROM gp WHERE year_ok AND date IS NOT NULL AND value IS NOT NULL""", ("gp",)),
}

_base_ctes = ctes


def ctes(p: Params = TEST_PARAMS) -> dict[str, tuple[str, tuple[str, ...]]]:  # noqa: F811
    c = _base_ctes(p)
    c.update(GRID_CTES)
    return c
