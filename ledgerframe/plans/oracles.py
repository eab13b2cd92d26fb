"""SQL counterparts of the registered queries, for DuckDB.

Each is a list of common table expressions the query needs, named below, followed by
its own statement. They are written independently of the operators: self-joins,
recursive expressions and unnested tokens instead of frames, folds and array functions.
"""

from __future__ import annotations

from ..operators import forecast, scenarios
from ..sources import dimensions, order_ledger
from . import params as p


def q(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def values(name: str, columns: str, rows) -> str:
    def cell(v) -> str:
        return q(v) if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def in_list(items) -> str:
    return "(" + ", ".join(q(i) for i in items) + ")"


def rnd(expr: str, digits: int) -> str:
    """Round a DOUBLE; adding 0.0 turns a negative zero into zero."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def ratio(num: str, den: str, digits: int = 6) -> str:
    return rnd(f"{dbl(num)} / nullif({dbl(den)}, 0)", digits)


def case(column: str, mapping) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items()) + " END"


AS_OF = f"DATE '{p.AS_OF}'"
ACCOUNTS = values(
    "acc", "gl_account, account_name, account_group, pnl_category, normal_balance",
    dimensions.CHART_OF_ACCOUNTS,
)
SHORT_CHART = f"short_acc AS (SELECT * FROM acc WHERE gl_account <> {q(p.ORPHAN_ACCOUNT)})"
SEGMENTS = values("seg", "profit_center, segment_name, segment_type", order_ledger.SEGMENT_ROWS)
CENTERS = values("cc", "cost_center, department, function", order_ledger.COST_CENTER_ROWS)
BASE_COST = values("base_cost", "cost_center, cost", order_ledger.LOADED_COST_ROWS)
RATIOS = values("ratios", "cost_center, gl_account, ratio", order_ledger.COST_RATIO_ROWS)
SPLIT = values("split_pay", "gl_account, ratio", dimensions.PAYROLL_SPLIT)
BUDGET_GROWTH = values(
    "growth", "fiscal_year, line_type, rate",
    [(y, line, f"{r:.6f}") for y, rates in p.BUDGET_GROWTH.items() for line, r in rates.items()],
)
SCENARIOS = values(
    "scen", "scenario, rg, cd, og", [r[:4] for r in dimensions.SCENARIOS]
)

LINE = f"""
home AS (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
line AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
         l_orderkey, l_linenumber, l_partkey, l_suppkey AS supplier, o_custkey AS customer,
         p_type AS profit_center, o_orderpriority AS cost_center,
         ch.r_name AS rev_company, sh.r_name AS exp_company,
         {case('l_returnflag', order_ledger.REVENUE_ACCOUNTS)} AS rev_account,
         CASE WHEN l_linestatus = 'F' THEN '{order_ledger.COGS_ACCOUNT}'
              ELSE {case('l_returnflag', order_ledger.EXPENSE_ACCOUNTS)} END AS exp_account,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
              * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS revenue,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
              * (CAST({order_ledger.COST_PERCENT / 100} AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2))), 2)
              AS DECIMAL(18,2)) AS expense
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN home ch ON c_nationkey = ch.n_nationkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN home sh ON s_nationkey = sh.n_nationkey),
post AS (
  SELECT period, 'Revenue' AS line_type, profit_center AS dim1, rev_company AS dim2,
         rev_account AS gl_account, revenue AS amount, l_orderkey, l_linenumber, l_partkey,
         supplier, revenue AS rev, expense AS exp, rev_account, exp_account
  FROM line
  UNION ALL
  SELECT period, 'Opex', cost_center, exp_company, exp_account, expense,
         l_orderkey, l_linenumber, l_partkey, supplier, revenue, expense, rev_account, exp_account
  FROM line),
act AS (
  SELECT period, dim1, dim2, gl_account, line_type, sum(amount) AS actual_amount
  FROM post GROUP BY ALL)"""



def _rev_fact(name: str, grain: dict[str, str]) -> str:
    """Customer counts by the grain's columns; nobody churns in the last month on record."""
    own = ", ".join(f"{c} AS {k}" for k, c in grain.items())
    same = " AND ".join(f"l.{c} = s.{k}" for k, c in grain.items())
    return f"""
{name}_sub AS (
  SELECT customer, {own}, min(period) AS first_month, max(period) AS last_month
  FROM line GROUP BY ALL),
{name} AS (
  SELECT l.period, {', '.join(f'l.{c} AS {k}' for k, c in grain.items())},
         CAST(count(DISTINCT l.customer) AS DOUBLE) AS customers,
         sum(l.revenue) AS revenue,
         CAST(count(DISTINCT CASE WHEN s.first_month = l.period THEN l.customer END) AS DOUBLE)
           AS new_logos,
         CAST(count(DISTINCT CASE WHEN s.last_month = l.period AND l.period <
              (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) FROM orders)
              THEN l.customer END) AS DOUBLE) AS churned_customers
  FROM line l JOIN {name}_sub s ON l.customer = s.customer AND {same}
  GROUP BY ALL)"""


REV_FACT = _rev_fact("rev_fact", {
    "profit_center": "profit_center", "company_code": "rev_company", "gl_account": "rev_account",
})
SEG_FACT = _rev_fact("seg_fact", {"profit_center": "profit_center"})

DRIVERS = """
drv AS (
  SELECT period, profit_center, sum(customers) AS customers, CAST(sum(revenue) AS DOUBLE) AS revenue,
         sum(new_logos) AS new_logos, sum(churned_customers) AS churned
  FROM seg_fact WHERE customers IS NOT NULL GROUP BY period, profit_center),
drv2 AS (
  SELECT *, revenue / nullif(customers, 0) AS arpu, churned / nullif(customers, 0) AS churn FROM drv),
adj AS (
  SELECT *, arpu * (1 + {a} / 100.0) AS arpu2,
         greatest(churn + {c} / 100.0, 0.0) AS churn2 FROM drv2),
adj2 AS (SELECT *, customers * (1 - (churn2 - churn)) AS cust2 FROM adj),
adj3 AS (SELECT *, cust2 * arpu2 AS rev2 FROM adj2)""".format(
    a=float(p.WHATIF_ARPU_PCT), c=p.WHATIF_CHURN_PP
)

HEADS = f"""
heads AS (
  SELECT period, cost_center, exp_company AS company_code,
         CAST(count(DISTINCT supplier) AS DOUBLE) AS headcount
  FROM line GROUP BY ALL),
head_fact AS (
  SELECT h.*, round(cost * (1 + 0.028 * ((year(period) - {order_ledger.FIRST_YEAR})
                                          + month(period) / 12.0)), 2) AS avg_fully_loaded_cost
  FROM heads h JOIN (SELECT cost_center, CAST(cost AS DOUBLE) AS cost FROM base_cost) b
    USING (cost_center))"""
# keep the arithmetic in DOUBLE: DuckDB reads 0.028 and 12.0 as decimals
HEADS = HEADS.replace("0.028", "CAST(0.028 AS DOUBLE)").replace("12.0", "CAST(12 AS DOUBLE)")

PNL = """
pnl0 AS (
  SELECT p.period,
    sum(CASE WHEN line_type = 'Revenue' THEN amount ELSE 0 END) AS rev,
    sum(CASE WHEN line_type = 'Opex' AND pnl_category = 'COGS' THEN amount ELSE 0 END) AS cogs,
    sum(CASE WHEN line_type = 'Opex' AND pnl_category = 'Opex' THEN amount ELSE 0 END) AS opex
  FROM post p LEFT JOIN acc a ON p.gl_account = a.gl_account
  GROUP BY p.period)"""


def margins(source: str, lead: str = "period", tail: str = "", where: str = "") -> str:
    return f"""SELECT {lead}, {dbl('rev')} AS total_revenue, {dbl('cogs')} AS total_cogs,
  {dbl('opex')} AS total_opex_below_gm, {dbl('rev - cogs')} AS gross_profit,
  {ratio('rev - cogs', 'rev')} AS gross_margin_pct, {dbl('rev - cogs - opex')} AS ebitda,
  {ratio('rev - cogs - opex', 'rev')} AS ebitda_margin_pct{tail}
FROM {source} {where}"""


BUDGET = f"""
bud AS (
  SELECT CAST(period + INTERVAL 12 MONTH AS DATE) AS period, dim1, dim2, gl_account, a.line_type,
         CAST(round(actual_amount * (1 + g.rate), 2) AS DECIMAL(18,2)) AS budget_amount
  FROM act a JOIN (SELECT fiscal_year, line_type, CAST(rate AS DECIMAL(8,6)) AS rate FROM growth) g
    ON g.fiscal_year = year(a.period) + 1 AND g.line_type = a.line_type),
var_b AS (
  SELECT b.*, a.actual_amount FROM bud b LEFT JOIN act a
    ON a.period = b.period AND a.dim1 = b.dim1 AND a.dim2 = b.dim2
   AND a.gl_account = b.gl_account AND a.line_type = b.line_type)"""

FORECAST = f"""
run AS (
  SELECT dim1, dim2, gl_account, line_type,
         CAST(sum(actual_amount) AS DOUBLE) / count(actual_amount) AS run_rate,
         CAST(CASE line_type WHEN 'Revenue' THEN {p.RUN_RATE_GROWTH['Revenue']}
              ELSE {p.RUN_RATE_GROWTH['Opex']} END AS DOUBLE) AS rate
  FROM act WHERE period > {AS_OF} - INTERVAL 3 MONTH AND period <= {AS_OF}
  GROUP BY dim1, dim2, gl_account, line_type),
fc AS (
  SELECT CAST({AS_OF} + to_months(CAST(i AS INTEGER)) AS DATE) AS period, dim1, dim2, gl_account,
         line_type,
         CAST(round(run_rate * pow(1 + rate, i), 2) AS DECIMAL(18,2)) AS forecast_amount
  FROM run CROSS JOIN range(1, {p.HORIZON + 1}) r(i)),
var_f AS (
  SELECT f.*, a.actual_amount FROM fc f LEFT JOIN act a
    ON a.period = f.period AND a.dim1 = f.dim1 AND a.dim2 = f.dim2
   AND a.gl_account = f.gl_account AND a.line_type = f.line_type)"""


def variance_sql(source: str, plan: str) -> str:
    diff = f"(coalesce(actual_amount, 0) - {plan})"
    return f"""SELECT period, dim1, dim2, gl_account, line_type, {dbl(plan)} AS {plan},
  {dbl('actual_amount')} AS actual_amount, {dbl(diff)} AS variance_abs,
  {ratio(diff, plan, 4)} AS variance_pct FROM {source}"""


def rollup_sql(source: str, plan: str, keys: str, group: str, tail: str = "", where: str = "") -> str:
    pl, ac = f"sum({plan})", "coalesce(sum(actual_amount), 0)"
    return f"""SELECT {keys}, {dbl(pl)} AS {plan}, {dbl(ac)} AS actual_amount,
  {dbl(f'{ac} - {pl}')} AS variance_abs, {ratio(f'{ac} - {pl}', pl)} AS variance_pct{tail}
FROM {source} {where} GROUP BY {group}"""


def _lrp() -> str:
    steps = []
    rev = opx = "1.0"
    for n, (year, r, o) in enumerate(p.LRP_GROWTH, 1):
        rev, opx = f"({rev} * (1 + {r!r}::DOUBLE))", f"({opx} * (1 + {o!r}::DOUBLE))"
        rev, opx = rev.replace("(1.0 * ", "(1.0::DOUBLE * "), opx.replace("(1.0 * ", "(1.0::DOUBLE * ")
        steps.append(f"SELECT {year} AS fiscal_year, {n} AS n, {rev} AS rf, {opx} AS of_")
    return f"""
steps AS ({' UNION ALL '.join(steps)}),
base0 AS (
  SELECT sum(CASE WHEN line_type = 'Revenue' THEN amount ELSE 0 END) AS rev,
         sum(CASE WHEN line_type = 'Opex' THEN amount ELSE 0 END) AS opex,
         count(DISTINCT period) AS months
  FROM post WHERE year(period) = {p.LRP_BASE_YEAR} AND period <= {AS_OF}),
base AS (
  SELECT {dbl('rev')} * (12::DOUBLE / months) AS rev, {dbl('opex')} * (12::DOUBLE / months) AS opex
  FROM base0),
lrp0 AS (
  SELECT fiscal_year, n, b.rev AS base_rev, b.rev * rf AS rev, b.opex * of_ AS opex
  FROM base b CROSS JOIN steps),
lrp AS (
  SELECT CAST(fiscal_year AS INTEGER) AS fiscal_year, round(rev, 0) AS plan_revenue,
         round(opex, 0) AS plan_opex, round(rev - opex, 0) AS plan_ebitda,
         {ratio('rev - opex', 'rev', 4)} AS plan_ebitda_margin,
         {rnd('pow(rev / base_rev, 1::DOUBLE / n) - 1', 6)} AS revenue_cagr
  FROM lrp0)"""


LRP = _lrp()


def flex(years: int) -> str:
    return f"""
flex AS (
  SELECT scenario,
         CAST(1 + CAST(rg AS DECIMAL(9,6)) * {years} - CAST(cd AS DECIMAL(9,6)) * {years}
              AS DECIMAL(9,6)) AS rf,
         CAST(1 + CAST(og AS DECIMAL(9,6)) * {years} AS DECIMAL(9,6)) AS of_
  FROM scen)"""


SCENARIO_PNL = """
fc_month AS (
  SELECT period,
    sum(CASE WHEN line_type = 'Revenue' THEN forecast_amount ELSE 0 END) AS r,
    sum(CASE WHEN line_type = 'Opex' THEN forecast_amount ELSE 0 END) AS o
  FROM fc GROUP BY period),
sp AS (
  SELECT scenario, period, round(r * rf, 2) AS revenue, round(o * of_, 2) AS opex,
         round(r * rf - o * of_, 2) AS ebitda_proxy
  FROM fc_month CROSS JOIN flex)"""

# ---------------------------------------------------------------- forecasting

PANEL = f"""
panel AS (
  SELECT profit_center, rev_company AS company_code, period, CAST(sum(revenue) AS DOUBLE) AS y
  FROM line WHERE period <= {AS_OF} GROUP BY ALL),
pt AS (
  SELECT *, row_number() OVER s - 1 AS t FROM panel
  WINDOW s AS (PARTITION BY profit_center, company_code ORDER BY period))"""


def _lag(k: int) -> str:
    return (
        f"LEFT JOIN pt l{k} ON l{k}.profit_center = c.profit_center "
        f"AND l{k}.company_code = c.company_code AND l{k}.t = c.t - {k}"
    )


FEATURES = f"""
feat AS (
  SELECT c.profit_center, c.company_code, c.period, c.y, c.t,
         CAST(month(c.period) AS INTEGER) AS month, CAST(quarter(c.period) AS INTEGER) AS quarter,
         l1.y AS lag_1, l2.y AS lag_2, l3.y AS lag_3, l12.y AS lag_12,
         (l1.y + l2.y + l3.y) / 3 AS rolling_mean_3,
         (l1.y + l2.y + l3.y + l4.y + l5.y + l6.y) / 6 AS rolling_mean_6
  FROM pt c {' '.join(_lag(k) for k in (1, 2, 3, 4, 5, 6, 12))}
  WHERE c.t >= 12),
split0 AS (
  SELECT *, row_number() OVER (PARTITION BY profit_center, company_code ORDER BY period DESC) AS age
  FROM feat),
tr AS (SELECT * FROM split0 WHERE age > {p.HOLDOUT}),
te AS (SELECT * FROM split0 WHERE age <= {p.HOLDOUT}),
fit AS (
  SELECT profit_center, company_code, arg_max(y, t) AS naive,
         avg(y) FILTER (WHERE age <= {p.HOLDOUT} + 3) AS ma3,
         regr_slope(y, CAST(t AS DOUBLE)) AS slope, regr_intercept(y, CAST(t AS DOUBLE)) AS level
  FROM tr GROUP BY ALL),
pred AS (
  SELECT profit_center, company_code, te.period, te.y AS actual, {q(forecast.NAIVE)} AS model,
         naive AS prediction
  FROM te JOIN fit USING (profit_center, company_code)
  UNION ALL
  SELECT profit_center, company_code, te.period, te.y, {q(forecast.MOVING_AVERAGE)}, ma3
  FROM te JOIN fit USING (profit_center, company_code)
  UNION ALL
  SELECT profit_center, company_code, te.period, te.y, {q(forecast.TREND)}, level + slope * te.t
  FROM te JOIN fit USING (profit_center, company_code))"""


def metrics(keys: str) -> str:
    lead = f"{keys}, model" if keys else "model"
    return f"""SELECT {lead},
  {rnd('avg(abs((prediction - actual) / nullif(actual, 0)))', 6)} AS "MAPE",
  {rnd('sqrt(avg((prediction - actual) * (prediction - actual)))', 4)} AS "RMSE",
  {rnd('avg(abs(prediction - actual))', 4)} AS "MAE"
FROM pred GROUP BY {lead}"""


def baseline(model: str) -> str:
    return f"""SELECT profit_center, company_code, period, actual, model,
  {rnd('prediction', 4)} AS prediction FROM pred WHERE model = {q(model)}"""


BEST = f"""
score AS (
  SELECT profit_center, company_code, model,
         round(avg(abs((prediction - actual) / nullif(actual, 0))), 9) AS mape
  FROM pred GROUP BY ALL),
best AS (
  SELECT profit_center, company_code, model FROM score
  QUALIFY row_number() OVER (PARTITION BY profit_center, company_code ORDER BY mape, model) = 1),
refit AS (
  SELECT profit_center, company_code, max(t) AS last_t, max(period) AS last_period,
         arg_max(y, t) AS naive, regr_slope(y, CAST(t AS DOUBLE)) AS slope,
         regr_intercept(y, CAST(t AS DOUBLE)) AS level
  FROM pt GROUP BY ALL),
refit3 AS (
  SELECT r.*, (SELECT avg(y) FROM pt WHERE pt.profit_center = r.profit_center
               AND pt.company_code = r.company_code AND pt.t > r.last_t - 3) AS ma3
  FROM refit r)"""

def _recursion(start: str, step: str) -> str:
    """Months ahead, each from the twelve values before it. ``start`` has the series with
    their coefficients ``c``, ``step`` is the forecast of the next month."""
    return f"""
hist AS (
  SELECT profit_center, company_code, max(t) AS last_t, max(period) AS last_period,
         list(y ORDER BY t)[-12:] AS h
  FROM pt GROUP BY ALL),
walk AS (
  SELECT profit_center, company_code, last_t, last_period, h, c, 0 AS i,
         CAST(NULL AS DOUBLE) AS forecast FROM {start}
  UNION ALL
  SELECT profit_center, company_code, last_t, last_period, list_append(h[2:], f) AS h, c, i + 1, f
  FROM (SELECT *, {step} AS f FROM walk WHERE i < {p.HORIZON}))"""


_MONTH, _QUARTER = "month(last_period + to_months(i + 1))", "quarter(last_period + to_months(i + 1))"
_MEAN_3 = "(h[-1] + h[-2] + h[-3]) / 3"
_MEAN_6 = "(h[-1] + h[-2] + h[-3] + h[-4] + h[-5] + h[-6]) / 6"
RECURSION = _recursion(
    "(SELECT *, CAST([] AS DOUBLE[]) AS c FROM hist)",
    f"{p.FIXED_INTERCEPT}::DOUBLE + " + " + ".join(
        f"{c}::DOUBLE * {x}" for c, x in zip(
            p.FIXED_COEFFICIENTS,
            ("(last_t + i + 1)", _MONTH, _QUARTER, "h[-1]", "h[-2]", "h[-3]", "h[-12]", _MEAN_3, _MEAN_6),
            strict=True,
        )
    ),
)

# ---------------------------------------------------------------- commentary

_CENTERS = [r[0] for r in order_ledger.COST_CENTER_ROWS]
DOCS = f"""
docs AS (
  SELECT doc_id, text,
         (CAST(1995 + (doc_id % {order_ledger.COMMENTARY_QUARTERS}) // 4 AS VARCHAR) || '-Q'
           || CAST((doc_id % {order_ledger.COMMENTARY_QUARTERS}) % 4 + 1 AS VARCHAR))
           AS fiscal_quarter,
         [{', '.join(q(c) for c in _CENTERS)}][doc_id % {len(_CENTERS)} + 1] AS cost_center
  FROM documents),
lab AS (
  SELECT doc_id, CASE quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS label
  FROM labels)"""

TONE = f"""
word AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-zA-Z'']+') AS w FROM docs)),
near AS (
  SELECT doc_id, w,
         coalesce(lag(w, 1) OVER o IN {in_list(p.TONE_NEGATIONS)}, false)
         OR coalesce(lag(w, 2) OVER o IN {in_list(p.TONE_NEGATIONS)}, false) AS negated
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
hit AS (
  SELECT doc_id,
    sum(CASE WHEN w IN {in_list(p.TONE_POSITIVE)} AND NOT negated THEN 1
             WHEN w NOT IN {in_list(p.TONE_POSITIVE)} AND w IN {in_list(p.TONE_NEGATIVE)}
                  AND negated THEN 1 ELSE 0 END) AS pos,
    sum(CASE WHEN w IN {in_list(p.TONE_POSITIVE)} AND negated THEN 1
             WHEN w NOT IN {in_list(p.TONE_POSITIVE)} AND w IN {in_list(p.TONE_NEGATIVE)}
                  AND NOT negated THEN 1 ELSE 0 END) AS neg
  FROM near GROUP BY doc_id),
sc0 AS (
  SELECT d.doc_id, fiscal_quarter, cost_center, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg,
         coalesce(CAST(pos - neg AS DOUBLE) / nullif(pos + neg, 0), 0.0::DOUBLE) AS s
  FROM docs d LEFT JOIN hit USING (doc_id)),
scored AS (
  SELECT doc_id, fiscal_quarter, cost_center, round_even(s, 3) + 0.0 AS sentiment_score,
         CASE WHEN s > 0.2::DOUBLE THEN 'Positive' WHEN s < -0.2::DOUBLE THEN 'Negative'
              ELSE 'Neutral' END AS predicted_tone,
         CAST(pos AS INTEGER) AS positive_hits, CAST(neg AS INTEGER) AS negative_hits
  FROM sc0)"""

TFIDF = f"""
tok AS (
  SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
  FROM (
    SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS pos
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM docs))
  WHERE t NOT IN {in_list(p.STOP_WORDS)}),
gram AS (
  SELECT doc_id, t AS term FROM tok
  UNION ALL
  SELECT a.doc_id, a.t || ' ' || b.t FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.i = a.i + 1),
vocab AS (
  SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (
    SELECT term, count(*) AS total FROM gram GROUP BY term ORDER BY total DESC, term
    LIMIT {p.MAX_FEATURES})),
tf AS (
  SELECT doc_id, term, idx, count(*) AS tf FROM gram JOIN vocab USING (term) GROUP BY ALL),
idf AS (
  SELECT term, ln((1 + (SELECT count(*) FROM docs)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf
  FROM tf GROUP BY term),
raw AS (SELECT doc_id, term, idx, tf * idf AS raw FROM tf JOIN idf USING (term)),
len AS (SELECT doc_id, sqrt(sum(raw * raw)) AS norm FROM raw GROUP BY doc_id),
weights AS (SELECT doc_id, term, idx, raw / norm AS weight FROM raw JOIN len USING (doc_id)),
top5 AS (
  SELECT doc_id, string_agg(term, ', ' ORDER BY r) AS top_keywords FROM (
    SELECT doc_id, term, row_number() OVER (
      PARTITION BY doc_id ORDER BY round(weight, 9) DESC, term) AS r FROM weights)
  WHERE r <= 5 GROUP BY doc_id)"""

def _lloyd(rounds: int = 10, starts: int = 10, seed: int = 42, k: int = 5) -> str:
    """Lloyd's rounds from several starts; every round is three tables."""
    parts = [
        "pts AS MATERIALIZED (SELECT doc_id, idx, CAST(round(weight * 1000000) AS BIGINT) AS x FROM weights "
        "WHERE round(weight * 1000000) > 0)",
        f"""seeds AS MATERIALIZED (
  SELECT start, doc_id, row_number() OVER (PARTITION BY start ORDER BY md5(doc_id || ':' || start), doc_id) - 1 AS c
  FROM docs, range({seed}, {seed + starts}) AS r(start) QUALIFY c < {k})""",
        "c0 AS MATERIALIZED (SELECT start, c, idx, x / 1e6::DOUBLE AS v FROM seeds JOIN pts USING (doc_id))",
    ]
    for r in range(rounds + 1):
        parts += [
            f"""d{r} AS MATERIALIZED (
  SELECT doc_id, start, c, CAST(round((cc - 2 * coalesce(d, 0)) * 1e9::DOUBLE) AS BIGINT) AS apart
  FROM docs CROSS JOIN (
    SELECT s.start, s.c, coalesce(sum(v * v), 0) AS cc FROM seeds s LEFT JOIN c{r} USING (start, c) GROUP BY ALL)
  LEFT JOIN (
    SELECT doc_id, start, c, sum(x / 1e6::DOUBLE * v) AS d FROM pts JOIN c{r} USING (idx) GROUP BY ALL)
  USING (doc_id, start, c))""",
            f"""a{r} AS MATERIALIZED (
  SELECT doc_id, start, c, apart FROM d{r}
  QUALIFY row_number() OVER (PARTITION BY doc_id, start ORDER BY apart, c) = 1)""",
        ]
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT start, c, idx, sum(x) / 1e6::DOUBLE / n AS v
  FROM a{r} JOIN pts USING (doc_id) JOIN (SELECT start, c, count(*) AS n FROM a{r} GROUP BY ALL) USING (start, c)
  GROUP BY start, c, idx, n
  UNION ALL
  SELECT start, c, idx, v FROM c{r} ANTI JOIN a{r} USING (start, c))""")
    return ",\n".join(
        [
            *parts,
            f"cheapest AS (SELECT start FROM a{rounds} GROUP BY start ORDER BY sum(apart), start LIMIT 1)",
            f"topic AS (SELECT doc_id, CAST(c AS INTEGER) AS topic_cluster FROM a{rounds} SEMI JOIN cheapest USING (start))",
            f"""topic_name AS (
  SELECT topic_cluster, coalesce(string_agg(term, ', ' ORDER BY r) FILTER (r <= 6), '') AS topic_cluster_label
  FROM (SELECT DISTINCT CAST(c AS INTEGER) AS topic_cluster FROM seeds SEMI JOIN cheapest USING (start)) LEFT JOIN (
    SELECT CAST(c AS INTEGER) AS topic_cluster, term,
      row_number() OVER (PARTITION BY c ORDER BY round(v, 9) DESC, term) AS r
    FROM c{rounds} SEMI JOIN cheapest USING (start) JOIN vocab USING (idx) WHERE v > 0) USING (topic_cluster)
  GROUP BY topic_cluster)""",
        ]
    )


TOPICS = _lloyd()

LINK = f"""
qs AS (
  SELECT fiscal_quarter, cost_center, avg(sentiment_score) AS avg_sentiment
  FROM scored GROUP BY ALL),
tone_rank AS (
  SELECT fiscal_quarter, cost_center, predicted_tone,
         row_number() OVER (PARTITION BY fiscal_quarter, cost_center
                            ORDER BY count(*) DESC, predicted_tone) AS r
  FROM scored GROUP BY fiscal_quarter, cost_center, predicted_tone),
qsent AS (
  SELECT qs.*, tr.predicted_tone AS predicted_tone_mode
  FROM qs JOIN tone_rank tr USING (fiscal_quarter, cost_center) WHERE tr.r = 1),
qvar AS ({rollup_sql(
    'var_b', 'budget_amount',
    "CAST(year(period) AS VARCHAR) || '-Q' || CAST(quarter(period) AS VARCHAR) AS fiscal_quarter, "
    "dim1 AS cost_center", '1, 2', where="WHERE line_type = 'Opex'")}),
link AS (SELECT * FROM qsent JOIN qvar USING (fiscal_quarter, cost_center))"""


ORACLES: dict[str, str] = {}


def oracle(name: str, ctes: list[str], body: str, recursive: bool = False) -> None:
    head = "WITH RECURSIVE " if recursive else "WITH "
    lead = head + ",\n".join(c.strip() for c in ctes) + "\n" if ctes else ""
    ORACLES[name] = lead + body


_LA = [ACCOUNTS, LINE]
oracle(
    "table_profile", [],
    "\nUNION ALL\n".join(
        f"SELECT {q(n)} AS table_name, (SELECT count(*) FROM {n}) AS row_count, "
        f"(SELECT count(*) FROM (DESCRIBE {n})) AS column_count"
        for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                  "events", "documents", "embeddings", "pages", "benchmark", "labels",
                  "conversations")
    ),
)
oracle(
    "revenue_fact", [LINE, REV_FACT],
    f"""SELECT period, profit_center, company_code, gl_account, customers,
  CAST(revenue AS DOUBLE) / customers AS arpu, {dbl('revenue')} AS revenue, new_logos, churned_customers
FROM rev_fact""",
)
oracle(
    "opex_fact", [LINE],
    f"""SELECT period, cost_center, exp_company AS company_code, exp_account AS gl_account,
  {dbl('sum(expense)')} AS amount FROM line GROUP BY 1, 2, 3, 4""",
)
oracle("csv_round_trip", [], ORACLES["opex_fact"])
oracle("csv_text_round_trip", [], """SELECT doc_id, nullif(text, '') AS text,
  nullif(lang, '') AS lang, nullif(source, '') AS source, n_chars FROM documents""")
oracle("table_round_trip", [], ORACLES["opex_fact"])
oracle("ledger_extract", [], ORACLES["opex_fact"])
oracle(
    "ledger_extract_by_year", [LINE],
    f"""SELECT CAST(year(period) AS INTEGER) AS fiscal_year, gl_account, {dbl('sum(amount)')} AS amount,
  count(*) AS n_rows
FROM (SELECT period, cost_center, exp_company, exp_account AS gl_account, sum(expense) AS amount
      FROM line GROUP BY 1, 2, 3, 4)
WHERE year(period) IN {p.FILTER_YEARS} GROUP BY 1, 2""",
)
oracle("headcount_fact", [BASE_COST, LINE, HEADS], "SELECT * FROM head_fact")
oracle(
    "calendar_dim", [],
    f"""SELECT CAST(m AS DATE) AS period, CAST(year(m) AS INTEGER) AS fiscal_year,
  'Q' || CAST(quarter(m) AS VARCHAR) AS fiscal_quarter, strftime(m, '%b-%Y') AS month_name,
  m <= {AS_OF} AS is_actual
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate))::TIMESTAMP,
                                    date_trunc('month', max(o_orderdate))::TIMESTAMP,
                                    INTERVAL 1 MONTH)) AS m FROM orders)""",
)
oracle(
    "gl_journal", [LINE],
    f"""SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, supplier, rev, exp,
    rev_account, exp_account, line_type DESC) AS document_number,
  l_linenumber AS document_line, CAST(period + to_days(CAST(l_partkey % 28 AS INTEGER)) AS DATE)
    AS posting_date,
  period, dim2 AS company_code, CASE WHEN line_type = 'Revenue' THEN dim1 END AS profit_center,
  CASE WHEN line_type = 'Opex' THEN dim1 END AS cost_center, gl_account,
  {dbl('amount')} AS amount,
  CASE line_type WHEN 'Revenue' THEN 'C' ELSE 'D' END AS debit_credit,
  CASE line_type WHEN 'Revenue' THEN 'RV' ELSE 'SA' END AS document_type,
  CASE line_type WHEN 'Revenue' THEN 'Billing' ELSE 'Payroll/AP' END AS source
FROM post""",
)
oracle(
    "gl_recon_check", [*_LA, SHORT_CHART],
    f"""SELECT p.period, CASE p.line_type WHEN 'Revenue' THEN 'C' ELSE 'D' END AS debit_credit,
  a.pnl_category, count(*) AS txn_count, {dbl('round(sum(amount), 2)')} AS gl_total_amount
FROM post p LEFT JOIN short_acc a ON p.gl_account = a.gl_account GROUP BY 1, 2, 3""",
)
oracle(
    "gl_orphan_accounts", [*_LA, SHORT_CHART],
    """SELECT DISTINCT p.gl_account FROM post p LEFT JOIN short_acc a ON p.gl_account = a.gl_account
WHERE a.gl_account IS NULL""",
)
oracle(
    "recon_revenue",
    [LINE, "g AS (SELECT period, sum(amount) AS gl FROM post WHERE line_type = 'Revenue' "
           f"AND NOT (period = DATE '{p.LEDGER_GAP[0]}' AND gl_account = {q(p.LEDGER_GAP[1])}) GROUP BY 1)",
     "f AS (SELECT period, sum(revenue) AS src FROM line GROUP BY 1)"],
    f"""SELECT coalesce(g.period, f.period) AS period, {dbl('gl')} AS gl_revenue,
  {dbl('src')} AS source_revenue,
  {dbl('round(coalesce(gl, 0) - coalesce(src, 0), 2)')} AS variance
FROM g FULL OUTER JOIN f ON g.period = f.period""",
)
oracle(
    "dq_negative_revenue", [LINE],
    f"""SELECT l_orderkey AS document_number, l_linenumber AS document_line, period, profit_center,
  rev_account AS gl_account, {dbl('signed')} AS revenue
FROM (SELECT *, CASE WHEN rev_account = {q(order_ledger.REVENUE_ACCOUNTS['R'])} THEN -revenue ELSE revenue END
      AS signed FROM line) WHERE signed < 0""",
)
oracle(
    "dq_negative_net_new", [LINE, SEG_FACT, DRIVERS],
    """SELECT period, profit_center, new_logos - churned AS net_new_customers FROM drv
WHERE new_logos - churned < 0""",
)
oracle(
    "dq_null_dimensions", [LINE, DOCS],
    """SELECT 'opex' AS table_name, count(*) AS null_rows FROM line WHERE cost_center IS NULL
UNION ALL SELECT 'revenue', count(*) FROM line WHERE profit_center IS NULL
UNION ALL SELECT 'line_without_order', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
UNION ALL SELECT 'authored_label', count(*) FROM docs LEFT JOIN lab USING (doc_id)
WHERE label IS NULL""",
)
ENTITIES = values(
    "ent", "company_code, entity_name",
    [("AFRICA", "Africa entity"), ("AMERICA", "America entity"), ("ASIA", "Asia entity"),
     ("EUROPE", "Europe entity"), ("MIDDLE EAST", "Middle East entity")],
)
oracle(
    "pnl_cube", [ENTITIES, *_LA, SEGMENTS, CENTERS],
    f"""SELECT r.period, strftime(r.period, '%Y') AS fiscal_year, r.rev_company AS company_code,
  e.entity_name, r.profit_center, s.segment_name, 'Revenue' AS pnl_line,
  r.rev_account AS gl_account, a.account_name, {dbl('round(sum(r.revenue), 2)')} AS amount
FROM line r JOIN ent e ON r.rev_company = e.company_code JOIN seg s USING (profit_center)
JOIN acc a ON r.rev_account = a.gl_account
GROUP BY r.period, r.rev_company, e.entity_name, r.profit_center, s.segment_name, r.rev_account,
  a.account_name
UNION ALL
SELECT o.period, strftime(o.period, '%Y'), o.exp_company, e.entity_name, NULL, cc.department,
  a.pnl_category, o.exp_account, a.account_name, {dbl('-round(sum(o.expense), 2)')}
FROM line o JOIN ent e ON o.exp_company = e.company_code JOIN cc ON o.cost_center = cc.cost_center
JOIN acc a ON o.exp_account = a.gl_account
GROUP BY o.period, o.exp_company, e.entity_name, o.cost_center, cc.department, a.pnl_category,
  o.exp_account, a.account_name""",
)
oracle("pnl_monthly", [*_LA, PNL], margins("pnl0"))
oracle(
    "pnl_monthly_filtered", [*_LA, PNL],
    margins("pnl0", where=f"WHERE year(period) IN ({', '.join(map(str, p.FILTER_YEARS))}) ORDER BY period"),
)
oracle(
    "pnl_quarterly",
    [*_LA, PNL, f"""
pq AS (
  SELECT year(period) AS y, quarter(period) AS q, sum(rev) AS rev, sum(cogs) AS cogs,
         sum(opex) AS opex FROM pnl0 WHERE period <= {AS_OF} GROUP BY 1, 2),
pq2 AS (SELECT a.*, b.rev AS prior FROM pq a LEFT JOIN pq b ON b.y = a.y - 1 AND b.q = a.q)"""],
    margins("pq2", "CAST(y AS INTEGER) AS fiscal_year, 'Q' || CAST(q AS VARCHAR) AS fiscal_quarter",
            f", {ratio('rev - prior', 'prior')} AS yoy_growth"),
)
oracle(
    "pnl_levels",
    [*_LA, PNL, f"""
dated AS (
  SELECT period, CAST(year(period) AS INTEGER) AS fiscal_year,
         'Q' || CAST(quarter(period) AS VARCHAR) AS fiscal_quarter, rev, cogs, opex
  FROM pnl0 WHERE period <= {AS_OF}),
levels AS (
  SELECT CASE grouping(fiscal_quarter) + grouping(period) WHEN 0 THEN 'month' WHEN 1 THEN 'quarter'
           ELSE 'year' END AS level, fiscal_year, fiscal_quarter, period,
         sum(rev) AS rev, sum(cogs) AS cogs, sum(opex) AS opex
  FROM dated GROUP BY GROUPING SETS ((fiscal_year, fiscal_quarter, period),
    (fiscal_year, fiscal_quarter), (fiscal_year)))"""],
    margins("levels", "level, fiscal_year, fiscal_quarter, period"),
)
oracle(
    "yoy_revenue",
    [LINE, "m AS (SELECT profit_center, period, CAST(sum(revenue) AS DOUBLE) AS revenue FROM line GROUP BY 1, 2)"],
    f"""SELECT a.profit_center, a.period, a.revenue, b.revenue AS prior_year,
  {ratio('a.revenue - b.revenue', 'b.revenue')} AS yoy_growth
FROM m a LEFT JOIN m b ON a.profit_center = b.profit_center
 AND b.period = CAST(a.period - INTERVAL 12 MONTH AS DATE)""",
)
oracle(
    "latest_kpis", [*_LA, PNL],
    f"""SELECT a.period, {dbl('a.rev')} AS total_revenue,
  {ratio('a.rev - a.cogs', 'a.rev')} AS gross_margin_pct,
  {ratio('a.rev - a.cogs - a.opex', 'a.rev')} AS ebitda_margin_pct,
  {dbl('a.rev - a.cogs - a.opex')} AS ebitda,
  {ratio('a.rev - b.rev', 'b.rev')} AS yoy_revenue
FROM pnl0 a LEFT JOIN pnl0 b ON b.period = CAST(a.period - INTERVAL 12 MONTH AS DATE)
WHERE a.period = (SELECT max(period) FROM pnl0 WHERE period <= {AS_OF})""",
)
oracle(
    "qbr_segment_quarterly", [SEGMENTS, LINE],
    f"""SELECT CAST(year(period) AS INTEGER) AS fiscal_year,
  'Q' || CAST(quarter(period) AS VARCHAR) AS fiscal_quarter, segment_name,
  {dbl('round(sum(revenue), 2)')} AS revenue
FROM line JOIN seg USING (profit_center) WHERE period <= {AS_OF} GROUP BY 1, 2, 3""",
)
oracle(
    "segment_mix",
    [SEGMENTS, LINE, f"""
m AS (SELECT profit_center, sum(revenue) AS revenue FROM line
      WHERE year(period) IN ({', '.join(map(str, p.MIX_YEARS))}) GROUP BY 1)"""],
    f"""SELECT profit_center, segment_name, {dbl('revenue')} AS revenue,
  {ratio('revenue', '(SELECT sum(revenue) FROM m)')} AS share
FROM m LEFT JOIN seg USING (profit_center)""",
)
oracle(
    "segment_mix_quarterly",
    [SEGMENTS, LINE, """
m AS (SELECT CAST(year(period) AS INTEGER) AS fiscal_year,
             'Q' || CAST(quarter(period) AS VARCHAR) AS fiscal_quarter, profit_center,
             sum(revenue) AS revenue FROM line GROUP BY 1, 2, 3),
tot AS (SELECT fiscal_year, fiscal_quarter, sum(revenue) AS total FROM m GROUP BY 1, 2)"""],
    f"""SELECT fiscal_year, fiscal_quarter, profit_center, segment_name, {dbl('revenue')} AS revenue,
  {ratio('revenue', 'total')} AS share
FROM m JOIN tot USING (fiscal_year, fiscal_quarter) LEFT JOIN seg USING (profit_center)""",
)

_BUD = [BUDGET_GROWTH, LINE, BUDGET]
_FC = [LINE, FORECAST]
oracle(
    "budget_build", _BUD,
    f"""SELECT period, dim1, dim2, gl_account, line_type, {dbl('budget_amount')} AS budget_amount
FROM bud""",
)
oracle(
    "run_rate_forecast", _FC,
    f"""SELECT period, dim1, dim2, gl_account, line_type, {dbl('forecast_amount')} AS forecast_amount
FROM fc""",
)
oracle("lrp_plan", [LINE, LRP], "SELECT * FROM lrp")
oracle("variance_budget", _BUD, variance_sql("var_b", "budget_amount"))
_CHOSEN = (f"year(period) IN ({', '.join(map(str, p.FILTER_YEARS))}) "
           f"AND {{}} IN {in_list(p.FILTER_SEGMENTS)}")
oracle(
    "variance_budget_filtered", _BUD,
    variance_sql("var_b", "budget_amount") + " WHERE " + _CHOSEN.format("dim1"),
)
oracle("variance_forecast", _FC, variance_sql("var_f", "forecast_amount"))
oracle(
    "variance_rollup_budget", _BUD,
    rollup_sql("var_b", "budget_amount", "period, line_type", "period, line_type"),
)
oracle(
    "variance_rollup_forecast", _FC,
    rollup_sql("var_f", "forecast_amount", "period, line_type", "period, line_type"),
)
oracle(
    "variance_levels",
    [*_BUD, """
dated AS (
  SELECT line_type, CAST(year(period) AS INTEGER) AS fiscal_year,
         'Q' || CAST(quarter(period) AS VARCHAR) AS fiscal_quarter, period, budget_amount, actual_amount
  FROM var_b)"""],
    rollup_sql(
        "dated", "budget_amount",
        """CASE grouping(fiscal_year) + grouping(fiscal_quarter) + grouping(period)
    WHEN 0 THEN 'month' WHEN 1 THEN 'quarter' WHEN 2 THEN 'year' ELSE 'all' END AS level,
  line_type, fiscal_year, fiscal_quarter, period""",
        """GROUPING SETS ((line_type, fiscal_year, fiscal_quarter, period),
  (line_type, fiscal_year, fiscal_quarter), (line_type, fiscal_year), (line_type))""",
    ),
)
oracle(
    "variance_quarterly",
    [*_BUD, "vq AS (" + rollup_sql(
        "var_b", "budget_amount",
        "CAST(year(period) AS INTEGER) AS fiscal_year, "
        "'Q' || CAST(quarter(period) AS VARCHAR) AS fiscal_quarter, line_type", "1, 2, 3") + ")"],
    """SELECT *, CASE line_type WHEN 'Revenue' THEN variance_abs >= 0 ELSE variance_abs <= 0 END
  AS favourable FROM vq""",
)

_DRV = [LINE, SEG_FACT, DRIVERS]
_DRIVER_ROWS = """SELECT period, profit_center, customers, revenue, new_logos, churned,
  arpu AS arpu_implied, new_logos - churned AS net_new_customers,
  churn AS churn_rate_implied FROM drv2"""
oracle("driver_model_revenue", _DRV, _DRIVER_ROWS)
oracle("driver_model_filtered", _DRV, _DRIVER_ROWS + " WHERE " + _CHOSEN.format("profit_center"))
oracle(
    "whatif_drivers", _DRV,
    f"""SELECT period, profit_center, customers, revenue, new_logos, churned,
  arpu AS arpu_implied, new_logos - churned AS net_new_customers,
  churn AS churn_rate_implied, arpu2 AS arpu_adjusted,
  churn2 AS churn_rate_adjusted, cust2 AS customers_adjusted,
  rev2 AS revenue_adjusted FROM adj3""",
)
oracle(
    "whatif_impact",
    [*_DRV, """
wi AS (SELECT profit_center, sum(CAST(revenue AS DECIMAL(28,2))) AS b,
              sum(CAST(round(rev2, 6) AS DECIMAL(28,6))) AS a FROM adj3 GROUP BY 1)"""],
    f"""SELECT profit_center, {dbl('b')} AS revenue, {dbl('round(a, 2)')} AS revenue_adjusted,
  {dbl('round(a - b, 2)')} AS impact, {ratio('a - b', 'b')} AS impact_pct FROM wi""",
)
oracle(
    "opex_per_headcount",
    [BASE_COST, LINE, HEADS,
     "o AS (SELECT period, sum(expense) AS amount FROM line GROUP BY 1)",
     "h AS (SELECT period, sum(headcount) AS total_headcount FROM head_fact GROUP BY 1)"],
    f"""SELECT period, {dbl('amount')} AS amount, total_headcount,
  CAST(amount AS DOUBLE) / total_headcount AS opex_per_headcount_monthly FROM o JOIN h USING (period)""",
)
oracle(
    "opex_allocate",
    [BASE_COST, RATIOS, SPLIT, LINE, HEADS, """
pay AS (SELECT period, cost_center, company_code,
               CAST(headcount AS HUGEINT) * CAST(round(avg_fully_loaded_cost * 100) AS HUGEINT) AS cents
        FROM head_fact),
parts AS (
  SELECT cc.cost_center, s.gl_account, CAST(round(s.ratio * 100000) AS HUGEINT) AS r5
  FROM (SELECT cost_center FROM base_cost) cc CROSS JOIN split_pay s
  UNION ALL SELECT cost_center, gl_account, CAST(round(ratio * 100000) AS HUGEINT)
  FROM ratios)"""],
    """SELECT period, cost_center, company_code, gl_account,
  CAST((2 * cents * r5 + 1200000) // 2400000 AS DOUBLE) / 100 AS amount
FROM pay JOIN parts USING (cost_center)""",
)
oracle(
    "services_attach", [SEGMENTS, LINE],
    f"""SELECT period, {dbl('sum(revenue)')} AS base_revenue,
  round({dbl('sum(revenue)')} * {p.SERVICES_RATE}::DOUBLE, 2) AS services_revenue
FROM line WHERE profit_center IN (SELECT profit_center FROM seg WHERE segment_type = 'Subscription')
GROUP BY period""",
)
oracle(
    "allocate_by_mix",
    [values("mix", "company_code, share", p.COMPANY_MIX), LINE,
     "m AS (SELECT period, profit_center, sum(revenue) AS revenue FROM line GROUP BY 1, 2)"],
    f"""SELECT period, profit_center, company_code, {dbl('share')} AS share,
  {rnd("CAST(revenue AS DOUBLE) * CAST(share AS DOUBLE)", 4)} AS revenue FROM m CROSS JOIN mix""",
)
oracle(
    "customer_rollforward",
    [LINE, SEG_FACT, f"""
flow AS (
  SELECT profit_center, period, sum(new_logos) AS n, sum(churned_customers) AS c,
         row_number() OVER (PARTITION BY profit_center ORDER BY period) AS i
  FROM seg_fact GROUP BY 1, 2),
roll AS (
  SELECT profit_center, period, n, c, i,
         greatest({p.OPENING_CUSTOMERS}::DOUBLE + n - c, 0.0::DOUBLE) AS customers FROM flow WHERE i = 1
  UNION ALL
  SELECT f.profit_center, f.period, f.n, f.c, f.i, greatest(r.customers + f.n - f.c, 0.0::DOUBLE)
  FROM roll r JOIN flow f ON f.profit_center = r.profit_center AND f.i = r.i + 1)"""],
    """SELECT profit_center, period, n AS new_logos, c AS churned_customers, customers FROM roll""",
    recursive=True,
)

_SP = [SCENARIOS, LINE, FORECAST, flex(1), SCENARIO_PNL]
oracle(
    "scenario_pnl", _SP,
    f"""SELECT scenario, period, {dbl('revenue')} AS revenue, {dbl('opex')} AS opex,
  {dbl('ebitda_proxy')} AS ebitda_proxy FROM sp""",
)
oracle(
    "scenario_summary", _SP,
    f"""SELECT CAST(CASE scenario {' '.join(f"WHEN {q(n)} THEN {i}" for i, n in
                                        enumerate(scenarios.ORDER, 1))} ELSE 4 END AS INTEGER)
    AS scenario_rank, scenario, {dbl('sum(revenue)')} AS revenue, {dbl('sum(opex)')} AS opex,
  {dbl('sum(ebitda_proxy)')} AS ebitda_proxy,
  {ratio('sum(ebitda_proxy)', 'sum(revenue)')} AS ebitda_margin
FROM sp GROUP BY scenario ORDER BY scenario_rank""",
)
oracle(
    "lrp_scenarios",
    [SCENARIOS, LINE, LRP, flex(3), """
ls AS (
  SELECT scenario, fiscal_year, CAST(plan_revenue AS DECIMAL(20,2)) * rf AS rev,
         CAST(plan_opex AS DECIMAL(20,2)) * of_ AS opx FROM lrp CROSS JOIN flex)"""],
    f"""SELECT scenario, fiscal_year, {dbl('round(rev, 2)')} AS plan_revenue,
  {dbl('round(opx, 2)')} AS plan_opex, {dbl('round(rev - opx, 2)')} AS plan_ebitda,
  {ratio('rev - opx', 'rev')} AS plan_ebitda_margin FROM ls""",
)

_FEAT = [LINE, PANEL, FEATURES]
oracle(
    "forecast_features", _FEAT,
    f"""SELECT profit_center, company_code, period, y, CAST(t AS INTEGER) AS t, month, quarter,
  lag_1, lag_2, lag_3, lag_12, {rnd('rolling_mean_3', 4)} AS rolling_mean_3,
  {rnd('rolling_mean_6', 4)} AS rolling_mean_6 FROM feat""",
)
oracle(
    "holdout_split", _FEAT,
    f"""SELECT profit_center, company_code, period, CAST(t AS INTEGER) AS t, y,
  CASE WHEN age <= {p.HOLDOUT} THEN 'test' ELSE 'train' END AS split,
  CAST(greatest(age - {p.HOLDOUT}, 0) AS INTEGER) AS train_age FROM split0""",
)
oracle("baseline_naive", _FEAT, baseline(forecast.NAIVE))
oracle("baseline_moving_avg", _FEAT, baseline(forecast.MOVING_AVERAGE))
oracle("baseline_trend", _FEAT, baseline(forecast.TREND))
oracle("forecast_accuracy", _FEAT, metrics("profit_center, company_code"))
oracle("baseline_leaderboard", _FEAT, metrics("") + ' ORDER BY "MAPE", model')
_COLUMNS = ["t", "month", "quarter", "lag_1", "lag_2", "lag_3", "lag_12", "rolling_mean_6"]


def _linear(holdout: int, lin: str = "lin", pooled: bool = False) -> str:
    """Least squares by making one column after the other independent of those before.

    rolling_mean_3 is the mean of three other columns and adds nothing. Every step keeps
    all rows, but sums over those before the last ``holdout`` alone. ``c{j}_{k}`` is what
    column k holds of column j, ``b{j}`` the slope on what is left of column j.
    ``pooled`` fits one model on the rows of all series.
    """
    keys = "profit_center, company_code"

    def train(expr: str, fn: str = "sum") -> str:
        return f"{fn}({expr}) FILTER (WHERE age > {holdout}) OVER ({'' if pooled else f'PARTITION BY {keys}'})"

    n = len(_COLUMNS)
    kept = [f"m{k}" for k in range(n)] + ["my"]
    means = ", ".join(
        f"{train(f'CAST({c} AS DOUBLE)', 'avg')} AS m{k}, CAST({c} AS DOUBLE) - m{k} AS x{k}"
        for k, c in enumerate(_COLUMNS)
    )
    base = f"{keys}, period, age, y"
    steps = [f"{lin}0 AS (SELECT {base}, {train('y', 'avg')} AS my, y - my AS e, my AS p, {means} FROM split0)"]
    for j in range(n):
        square = f"nullif({train(f'x{j} * x{j}')}, 0)"
        own = [f"coalesce({train(f'x{j} * e')} / {square}, 0) AS b{j}", f"e - b{j} * x{j} AS e", f"p + b{j} * x{j} AS p"]
        for k in range(j + 1, n):
            own += [f"coalesce({train(f'x{j} * x{k}')} / {square}, 0) AS c{j}_{k}", f"x{k} - c{j}_{k} * x{j} AS x{k}"]
        steps.append(f"{lin}{j + 1} AS (SELECT {base}, {', '.join(kept + own)} FROM {lin}{j})")
        kept += [f"b{j}", *[f"c{j}_{k}" for k in range(j + 1, n)]]
    # back to the columns as they came: d{k} is the coefficient of column k
    back = ", ".join(
        f"b{k}" + "".join(f" - d{j} * c{k}_{j}" for j in range(k + 1, n)) + f" AS d{k}" for k in reversed(range(n))
    )
    level = "my - " + " - ".join(f"d{k} * m{k}" for k in range(n))
    series = ", ".join(f"any_value({c}) AS {c}" for c in kept)
    steps.append(
        f"{lin}_coef AS (SELECT {keys}, {back}, [{level}, {', '.join(f'd{k}' for k in range(n))}] AS c "
        f"FROM (SELECT {keys}, {series} FROM {lin}{n} GROUP BY {keys}))"
    )
    return ",\n".join(steps)


_AHEAD = ["(last_t + i + 1)", _MONTH, _QUARTER, "h[-1]", "h[-2]", "h[-3]", "h[-12]", _MEAN_6]
_ROLLED = _recursion(
    "(SELECT hist.*, c FROM hist JOIN full_coef USING (profit_center, company_code))",
    "c[1] + " + " + ".join(f"c[{k}] * {x}" for k, x in enumerate(_AHEAD, 2)),
)
oracle(
    "forecast_recursive", [*_FEAT, _linear(0, "full"), _ROLLED],
    f"""SELECT profit_center, company_code, CAST(last_period + to_months(i) AS DATE) AS period,
  {rnd('forecast', 1)} AS forecast FROM walk WHERE i > 0""",
    recursive=True,
)
oracle(
    "forecast_best",
    [*_FEAT, _linear(p.HOLDOUT), _linear(0, "full"), _ROLLED, f"""
four AS (
  SELECT * FROM pred
  UNION ALL SELECT profit_center, company_code, period, y, 'Linear Regression', p
  FROM lin8 WHERE age <= {p.HOLDOUT})""", BEST.replace("FROM pred GROUP", "FROM four GROUP")],
    f"""SELECT profit_center, company_code,
  CAST(b.last_period + to_months(CAST(r.i AS INTEGER)) AS DATE) AS period, model,
  {rnd(f"CASE model WHEN {q(forecast.NAIVE)} THEN naive WHEN {q(forecast.MOVING_AVERAGE)} THEN ma3 "
       f"WHEN {q(forecast.TREND)} THEN level + slope * (b.last_t + r.i) ELSE walk.forecast END", 1)} AS forecast
FROM refit3 b JOIN best USING (profit_center, company_code) CROSS JOIN range(1, {p.HORIZON + 1}) r(i)
LEFT JOIN walk ON walk.profit_center = b.profit_center AND walk.company_code = b.company_code AND walk.i = r.i""".replace(
        "SELECT profit_center, company_code,", "SELECT b.profit_center, b.company_code,", 1
    ),
    recursive=True,
)
oracle(
    "forecast_linear", [*_FEAT, _linear(p.HOLDOUT)],
    f"""SELECT profit_center, company_code, period, y AS actual, {q('Linear Regression')} AS model,
  {rnd('p', 1)} AS prediction FROM lin8 WHERE age <= {p.HOLDOUT}""",
)
oracle(
    "forecast_linear_pooled", [*_FEAT, _linear(p.HOLDOUT, pooled=True)],
    f"""SELECT profit_center, company_code, period, y AS actual, {q('Pooled Linear Regression')} AS model,
  {rnd('p', 0)} AS prediction FROM lin8 WHERE age <= {p.HOLDOUT}""",
)
oracle(
    "holdout_wide", _FEAT,
    f"""SELECT profit_center, company_code, period, actual,
  {rnd(f"max(CASE WHEN model = {q(forecast.NAIVE)} THEN prediction END)", 4)} AS naive,
  {rnd(f"max(CASE WHEN model = {q(forecast.MOVING_AVERAGE)} THEN prediction END)", 4)}
    AS moving_average,
  {rnd(f"max(CASE WHEN model = {q(forecast.TREND)} THEN prediction END)", 4)} AS trend
FROM pred GROUP BY ALL""",
)
oracle(
    "forecast_best_baseline", [*_FEAT, BEST],
    f"""SELECT profit_center, company_code,
  CAST(last_period + to_months(CAST(i AS INTEGER)) AS DATE) AS period, model,
  {rnd(f"CASE model WHEN {q(forecast.NAIVE)} THEN naive WHEN {q(forecast.MOVING_AVERAGE)} THEN ma3 "
       "ELSE level + slope * (last_t + i) END", 4)} AS forecast
FROM refit3 JOIN best USING (profit_center, company_code)
CROSS JOIN range(1, {p.HORIZON + 1}) r(i)""",
)
oracle(
    "forecast_recursive_fixed", [LINE, PANEL, RECURSION],
    f"""SELECT profit_center, company_code, CAST(last_period + to_months(i) AS DATE) AS period,
  {rnd('forecast', 4)} AS forecast FROM walk WHERE i > 0""",
    recursive=True,
)

oracle(
    "doc_tokens", [],
    """SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens,
  CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct,
  coalesce(array_to_string(w, ' '), '') AS tokens_joined
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-zA-Z'']+') AS w FROM documents)""",
)
_TONE = [DOCS, TONE]
oracle("sentiment_scored", _TONE, "SELECT * FROM scored")
oracle(
    "tone_agreement", _TONE,
    f"""SELECT count(label) AS labelled,
  CAST(sum(CASE WHEN lower(predicted_tone) = label THEN 1 WHEN label IS NOT NULL THEN 0 END)
       AS BIGINT) AS matched,
  {rnd("avg(CASE WHEN lower(predicted_tone) = label THEN 1.0 WHEN label IS NOT NULL THEN 0.0 END)",
       9)} AS agreement
FROM scored LEFT JOIN lab USING (doc_id)""",
)
oracle(
    "tfidf_terms", [DOCS, TFIDF],
    f"SELECT doc_id, term, CAST(idx AS INTEGER) AS idx, {rnd('weight', 6)} AS weight FROM weights",
)
oracle("doc_top_keywords", [DOCS, TFIDF], "SELECT * FROM top5")
oracle("topic_clusters", [DOCS, TFIDF, TOPICS], "SELECT * FROM topic")
oracle("topic_labels", [DOCS, TFIDF, TOPICS], "SELECT * FROM topic_name")
oracle(
    "topic_summary", [*_TONE, TFIDF, TOPICS],
    f"""SELECT topic_cluster, topic_cluster_label, count(*) AS comment_count,
  {rnd('avg(sentiment_score)', 9)} AS avg_sentiment
FROM scored JOIN topic USING (doc_id) JOIN topic_name USING (topic_cluster) GROUP BY ALL""",
)
oracle(
    "sentiment_by_department", [CENTERS, *_TONE, TFIDF],
    """SELECT s.*, department, function, label AS authored_tone_label,
  lower(predicted_tone) = label AS match_authored_label, top_keywords
FROM scored s LEFT JOIN cc USING (cost_center) LEFT JOIN lab USING (doc_id)
LEFT JOIN top5 USING (doc_id)""",
)
oracle(
    "commentary_detail", [CENTERS, *_TONE, TFIDF],
    """SELECT s.doc_id, s.fiscal_quarter, department, text AS commentary_text, sentiment_score,
  predicted_tone, top_keywords
FROM scored s JOIN docs USING (doc_id) LEFT JOIN cc ON cc.cost_center = s.cost_center
LEFT JOIN top5 ON top5.doc_id = s.doc_id""",
)
oracle(
    "tone_distribution", [CENTERS, *_TONE],
    f"""SELECT predicted_tone AS tone, count(*) AS count
FROM scored JOIN cc USING (cost_center) WHERE department IN {in_list(p.TONE_DEPARTMENTS)} GROUP BY 1""",
)

_LINK = [BUDGET_GROWTH, LINE, BUDGET, DOCS, TONE, LINK]
oracle("quarterly_opex_variance", _LINK, "SELECT * FROM qvar")
oracle(
    "quarterly_sentiment", _LINK,
    f"""SELECT fiscal_quarter, cost_center, {rnd('avg_sentiment', 9)} AS avg_sentiment,
  predicted_tone_mode FROM qsent""",
)
oracle(
    "sentiment_variance_link", _LINK,
    f"""SELECT fiscal_quarter, cost_center, {rnd('avg_sentiment', 9)} AS avg_sentiment,
  predicted_tone_mode, budget_amount, actual_amount, variance_abs, variance_pct FROM link""",
)
oracle(
    "tone_variance_corr", _LINK,
    f"""SELECT count(*) FILTER (WHERE avg_sentiment IS NOT NULL AND variance_pct IS NOT NULL) AS n,
  {rnd('CASE WHEN isnan(corr(avg_sentiment, variance_pct)) THEN NULL '
       'ELSE corr(avg_sentiment, variance_pct) END', 6)} AS correlation FROM link""",
)
oracle(
    "tone_variance_trend", _LINK,
    f"""SELECT cost_center, CAST(regr_count(variance_pct, avg_sentiment) AS BIGINT) AS n,
  {rnd('regr_slope(variance_pct, avg_sentiment)', 6)} AS slope,
  {rnd('regr_intercept(variance_pct, avg_sentiment)', 6)} AS intercept,
  {rnd('regr_r2(variance_pct, avg_sentiment)', 6)} AS r2
FROM link GROUP BY cost_center""",
)
