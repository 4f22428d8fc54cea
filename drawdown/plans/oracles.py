"""Independent SQL for every catalog query, for DuckDB over the same Parquet tables.

Written from the definitions with plain joins and correlated subqueries; only
column names are shared with the Spark jobs. Named subqueries are pulled in by
name, in dependency order.
"""

from __future__ import annotations

import re

D = "DATE '2000-06-30'"
M = "DATE '2000-06-01'"


def rnd(x: str, n: int) -> str:
    digits = 6 if n <= 2 else 8
    return f"CAST(round(CAST({x} AS DECIMAL(28,{digits})), {n}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def amt(x: str, cond: str = "TRUE") -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) FILTER (WHERE {cond}) AS DOUBLE)"


def avg(x: str, kind: str = "DECIMAL(18,12)") -> str:
    return (
        f"CAST(CAST(CAST(sum(CAST({x} AS {kind})) AS DOUBLE) / NULLIF(count({x}), 0)"
        f" AS {kind}) AS DOUBLE)"
    )


def cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


_PARTS: dict[str, str] = {
    "n_reps": "SELECT count(*) AS n FROM supplier",
    "reps": """SELECT s_suppkey AS employee_id, s_name AS name, r_name AS region,
        CASE s_suppkey % 3 WHEN 0 THEN 'Enterprise' WHEN 1 THEN 'Mid-Market' ELSE 'Public Sector' END AS segment,
        CAST(n_nationkey AS BIGINT) AS manager_id, n_name AS manager_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "accounts": """SELECT c_custkey AS account_id, c_name AS company_name, c_mktsegment AS industry,
        CASE WHEN c_custkey % 211 = 0 THEN n + c_custkey ELSE c_custkey % n END AS employee_id
        FROM customer, n_reps""",
    "all_contracts": """SELECT o_orderkey AS contract_id,
        CASE WHEN o_orderkey % 499 = 0 THEN -1 - o_custkey ELSE o_custkey END AS account_id,
        (o_custkey + o_orderkey) % n AS owner_id,
        CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_orderdate AS DATE) - 1
             ELSE CAST(CAST(o_orderdate AS DATE) + to_months(CASE WHEN o_orderkey % 89 = 0 THEN 8 WHEN o_orderkey % 83 = 0 THEN 18 WHEN o_orderpriority = '5-LOW' THEN 36 WHEN o_orderpriority = '2-HIGH' THEN 24 ELSE 12 END) AS DATE) - 1 END AS end_date,
        CAST(floor(o_totalprice) AS BIGINT) AS annual_commit_dollars,
        CASE WHEN o_orderkey % 53 = 0 THEN CAST(0 AS BIGINT) ELSE 1 + o_orderkey % 8 END AS included_monthly_compute_credits,
        CASE WHEN o_orderkey % 89 = 0 THEN 8 WHEN o_orderkey % 83 = 0 THEN 18 WHEN o_orderpriority = '5-LOW' THEN 36 WHEN o_orderpriority = '2-HIGH' THEN 24 ELSE 12 END AS contract_term_months
        FROM orders, n_reps""",
    "contracts": "SELECT * FROM all_contracts WHERE end_date >= start_date",
    "logs": """SELECT l_orderkey * 10 + l_linenumber AS log_id,
        CASE WHEN o_custkey % 10 = 3 OR l_orderkey % 200 = 0 THEN -1 - o_custkey ELSE o_custkey END AS account_id,
        CAST(l_shipdate AS DATE) AS date, l_quantity AS compute_credits_consumed
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "known_logs": "SELECT * FROM logs WHERE account_id IN (SELECT account_id FROM accounts)",
    "clean_logs": """SELECT * FROM known_logs l WHERE EXISTS (SELECT 1 FROM contracts c
        WHERE c.account_id = l.account_id AND l.date BETWEEN c.start_date AND c.end_date)""",
    "rogue_logs": """SELECT * FROM known_logs l WHERE NOT EXISTS (SELECT 1 FROM contracts c
        WHERE c.account_id = l.account_id AND l.date BETWEEN c.start_date AND c.end_date)""",
    "orphan_logs": "SELECT * FROM logs WHERE account_id NOT IN (SELECT account_id FROM accounts)",
    "month_use": f"""SELECT account_id, CAST(date_trunc('month', date) AS DATE) AS usage_month,
        {amt('compute_credits_consumed')} AS credits_consumed,
        count(DISTINCT date) AS active_usage_days FROM clean_logs GROUP BY ALL""",
    "month_grid": f"""SELECT account_id, CAST(m AS DATE) AS usage_month,
        {big('sum(included_monthly_compute_credits)')} AS included_monthly_compute_credits
        FROM (SELECT *, unnest(generate_series(date_trunc('month', start_date), date_trunc('month', end_date), INTERVAL 1 MONTH)) AS m
              FROM contracts) GROUP BY account_id, m""",
    "monthly_all": f"""SELECT account_id, usage_month, included_monthly_compute_credits,
        coalesce(credits_consumed, 0.0) AS credits_consumed, coalesce(active_usage_days, 0) AS active_usage_days,
        {div('coalesce(credits_consumed, 0.0)', 'included_monthly_compute_credits')} AS raw_rate,
        CASE WHEN included_monthly_compute_credits <> 0 THEN
          least({div('coalesce(credits_consumed, 0.0)', 'included_monthly_compute_credits')}, 2.0) END AS consumption_rate,
        coalesce(credits_consumed, 0.0) = 0 AS is_zero_usage_month
        FROM month_grid LEFT JOIN month_use USING (account_id, usage_month)""",
    "monthly": f"SELECT * FROM monthly_all WHERE usage_month < {M}",
    "daily_known": f"""SELECT account_id, date, {amt('compute_credits_consumed')} AS credits
        FROM clean_logs GROUP BY ALL""",
}


def _stats(source: str) -> str:
    return f"""SELECT account_id,
        {avg("CASE WHEN rk <= 3 THEN consumption_rate END")} AS trailing_90d_avg_rate,
        {avg("CASE WHEN rk <= 2 THEN consumption_rate END")} AS trailing_30d_avg_rate,
        {avg("CASE WHEN rk <= 1 THEN consumption_rate END")} AS trailing_7d_avg_rate,
        {cnt('rk <= 3')} AS months_of_data,
        max(CASE WHEN rk <= 3 THEN consumption_rate END) AS max_monthly_rate,
        min(CASE WHEN rk <= 3 THEN consumption_rate END) AS min_monthly_rate,
        {cnt('rk <= 3 AND consumption_rate > 1.2')} AS overage_months,
        {cnt('rk <= 3 AND is_zero_usage_month')} AS zero_usage_months,
        max(raw_rate) AS peak_rate
        FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY usage_month DESC) AS rk FROM {source})
        GROUP BY account_id"""


def _active(day: str, source: str = "contracts") -> str:
    return f"""SELECT p.account_id, a.employee_id, p.owner_id AS signing_owner_id, a.company_name, a.industry,
        p.contract_id AS primary_contract_id, p.start_date AS contract_start_date, p.end_date AS contract_end_date,
        t.commit AS annual_commit_dollars, p.contract_term_months, t.credits AS included_monthly_compute_credits,
        t.n AS active_contract_count, t.n > 1 AS has_expansion, {day} AS as_of_date
        FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY start_date, contract_id) AS rk
              FROM {source} WHERE {day} BETWEEN start_date AND end_date) p
        JOIN (SELECT account_id, {big('sum(annual_commit_dollars)')} AS commit,
                     {big('sum(included_monthly_compute_credits)')} AS credits, count(*) AS n
              FROM {source} WHERE {day} BETWEEN start_date AND end_date GROUP BY account_id) t
          ON t.account_id = p.account_id AND p.rk = 1
        JOIN accounts a ON a.account_id = p.account_id"""


def _fact(active: str, stats: str, day: str) -> str:
    new = f"(contract_start_date >= {day} - 90)"
    rate, commit = "trailing_90d_avg_rate", "annual_commit_dollars"
    capped = f"CASE WHEN {rate} IS NOT NULL THEN least({commit} * {rate}, CAST({commit} AS DOUBLE)) END"
    over = f"CASE WHEN {rate} IS NOT NULL THEN greatest({commit} * {rate} - {commit}, 0.0) END"
    return f"""SELECT account_id, employee_id, signing_owner_id, company_name, industry, primary_contract_id,
        contract_start_date, contract_end_date, contract_term_months, annual_commit_dollars,
        included_monthly_compute_credits, has_expansion, active_contract_count,
        {rate}, trailing_30d_avg_rate, trailing_7d_avg_rate, months_of_data, max_monthly_rate, overage_months, zero_usage_months,
        CASE WHEN months_of_data IS NOT NULL THEN overage_months >= 2 END AS expansion_flag,
        CASE WHEN months_of_data IS NOT NULL THEN coalesce(max_monthly_rate > 2.0 AND {rate} < 0.05, FALSE) END AS is_spike_drop,
        CASE WHEN months_of_data IS NOT NULL THEN months_of_data < 2 END AS low_data_flag,
        {new} AS is_new_account,
        CASE WHEN {new} THEN 'Ramping' WHEN months_of_data IS NULL THEN NULL
             WHEN {rate} > 1.20 THEN 'Expansion' WHEN {rate} BETWEEN 0.80 AND 1.20 THEN 'Healthy'
             WHEN {rate} BETWEEN 0.40 AND 0.80 THEN 'At Risk' WHEN {rate} BETWEEN 0.05 AND 0.40 THEN 'Shelfware'
             ELSE 'Inactive' END AS health_tier,
        CASE WHEN NOT {new} THEN {rnd(capped, 2)} END AS cacv,
        CASE WHEN NOT {new} THEN {rnd(over, 2)} END AS expansion_signal_acv,
        CASE WHEN NOT {new} THEN {rnd(f'{commit} - ({capped})', 2)} END AS acv_at_risk,
        {day} AS as_of_date
        FROM {active} LEFT JOIN {stats} USING (account_id)"""


_PARTS["stats"] = _stats("monthly")
_PARTS["active"] = _active(D)
_PARTS["fact"] = _fact("active", "stats", D)
_PARTS["owned"] = """SELECT f.*, r.name AS rep_name, r.region, r.segment, r.manager_id, r.manager_name
    FROM fact f JOIN reps r ON r.employee_id = f.employee_id"""

# Earlier snapshots: months and active contracts as of other dates.
for _tag, _day in {"s1": "1999-12-31", "s2": "2000-03-31", "k1": "2000-01-02", "k2": "2000-04-01"}.items():
    _lit = f"DATE '{_day}'"
    _PARTS[f"monthly_{_tag}"] = (
        f"SELECT * FROM monthly_all WHERE usage_month < date_trunc('month', {_lit})"
    )
    _PARTS[f"stats_{_tag}"] = _stats(f"monthly_{_tag}")
    _PARTS[f"active_{_tag}"] = _active(_lit)
    _PARTS[f"fact_{_tag}"] = _fact(f"active_{_tag}", f"stats_{_tag}", _lit)

# The same chain over amended contracts.
_PARTS["amendments"] = """SELECT l_orderkey * 10 + l_linenumber AS amendment_id, l_orderkey AS contract_id,
    CASE l_linenumber % 3 WHEN 1 THEN 'annual_commit_dollars' WHEN 2 THEN 'end_date' ELSE 'included_monthly_compute_credits' END AS field_changed,
    CASE l_linenumber % 3 WHEN 1 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR)
         WHEN 2 THEN CAST(CAST(l_shipdate AS DATE) + 365 AS VARCHAR) ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END AS new_value,
    CAST(l_shipdate AS DATE) AS effective_date FROM lineitem"""
_PARTS["due"] = f"""SELECT contract_id, field_changed, new_value FROM amendments WHERE effective_date <= {D}
    QUALIFY row_number() OVER (PARTITION BY contract_id, field_changed ORDER BY effective_date DESC, amendment_id DESC, new_value DESC) = 1"""
_PARTS["amended_all"] = """SELECT c.contract_id, c.account_id, c.owner_id, c.start_date,
    coalesce(TRY_CAST(e.new_value AS DATE), c.end_date) AS end_date,
    coalesce(TRY_CAST(a.new_value AS BIGINT), c.annual_commit_dollars) AS annual_commit_dollars,
    coalesce(TRY_CAST(i.new_value AS BIGINT), c.included_monthly_compute_credits) AS included_monthly_compute_credits,
    c.contract_term_months FROM all_contracts c
    LEFT JOIN due a ON a.contract_id = c.contract_id AND a.field_changed = 'annual_commit_dollars'
    LEFT JOIN due e ON e.contract_id = c.contract_id AND e.field_changed = 'end_date'
    LEFT JOIN due i ON i.contract_id = c.contract_id AND i.field_changed = 'included_monthly_compute_credits'"""
_PARTS["x_contracts"] = "SELECT * FROM amended_all WHERE end_date >= start_date"
_PARTS["x_clean_logs"] = _PARTS["clean_logs"].replace("FROM contracts c", "FROM x_contracts c")
_PARTS["x_month_use"] = _PARTS["month_use"].replace("clean_logs", "x_clean_logs")
_PARTS["x_month_grid"] = _PARTS["month_grid"].replace("FROM contracts)", "FROM x_contracts)")
_PARTS["x_monthly"] = (
    _PARTS["monthly_all"].replace("month_grid", "x_month_grid").replace("month_use ", "x_month_use ")
    + f" WHERE usage_month < {M}"
)
_PARTS["x_stats"] = _stats("x_monthly")
_PARTS["x_active"] = _active(D, "x_contracts")
_PARTS["x_fact"] = _fact("x_active", "x_stats", D)


def _with(sql: str) -> str:
    """Prefix the named subqueries a statement needs, dependencies first."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z_][a-z0-9_]*\b", text)):
            if name in _PARTS and name not in seen:
                seen.add(name)
                visit(_PARTS[name])
                order.append(name)

    visit(sql)
    if not order:
        return sql
    heads = ", ".join(f"{name} AS ({_PARTS[name]})" for name in order)
    if sql.startswith("WITH "):
        return f"WITH {heads}, {sql[5:]}"
    return f"WITH {heads} {sql}"


_SQL: dict[str, str] = {}

_R6 = {c: f"{rnd(c, 6)} AS {c}" for c in (
    "consumption_rate", "trailing_90d_avg_rate", "trailing_30d_avg_rate", "trailing_7d_avg_rate",
    "max_monthly_rate", "min_monthly_rate", "peak_rate", "daily_consumption_rate")}

_SQL["active_contracts"] = "SELECT * FROM active"
_SQL["orphan_guard"] = "SELECT * FROM known_logs"
_SQL["in_contract_logs"] = "SELECT * FROM clean_logs"
_SQL["orphaned_usage"] = "SELECT * FROM orphan_logs"
_SQL["out_of_contract_usage"] = "SELECT * FROM rogue_logs"
_SQL["contracts_missing_accounts"] = """SELECT c.contract_id, c.account_id FROM all_contracts c
    LEFT JOIN accounts a ON a.account_id = c.account_id WHERE a.account_id IS NULL"""
_SQL["accounts_missing_reps"] = """SELECT a.account_id, a.employee_id FROM accounts a
    LEFT JOIN reps r ON r.employee_id = a.employee_id WHERE r.employee_id IS NULL"""
_SQL["overlapping_pairs"] = """SELECT c1.account_id, c1.contract_id AS contract_1, c1.start_date AS c1_start, c1.end_date AS c1_end,
    c1.annual_commit_dollars AS c1_commit, c2.contract_id AS contract_2, c2.start_date AS c2_start, c2.end_date AS c2_end,
    c2.annual_commit_dollars AS c2_commit FROM all_contracts c1 JOIN all_contracts c2
    ON c2.account_id = c1.account_id AND c2.contract_id > c1.contract_id AND c2.start_date <= c1.end_date AND c2.end_date >= c1.start_date"""
_SQL["overlap_profile"] = """SELECT c1.account_id, c1.contract_id, c1.start_date, c1.end_date,
    count(c2.contract_id) AS overlapping_contracts FROM contracts c1 LEFT JOIN contracts c2
    ON c2.account_id = c1.account_id AND c2.contract_id <> c1.contract_id
    AND c2.start_date <= c1.end_date AND c2.end_date >= c1.start_date GROUP BY ALL"""
_SQL["monthly_usage"] = "SELECT * FROM month_use"
_SQL["monthly_usage_fanout"] = f"""SELECT l.account_id, CAST(date_trunc('month', l.date) AS DATE) AS usage_month,
    {amt('l.compute_credits_consumed')} AS credits_consumed, count(DISTINCT l.date) AS active_usage_days
    FROM known_logs l JOIN contracts c ON c.account_id = l.account_id AND l.date BETWEEN c.start_date AND c.end_date GROUP BY ALL"""
_MONTHLY = f"account_id, usage_month, included_monthly_compute_credits, credits_consumed, active_usage_days, {_R6['consumption_rate']}, is_zero_usage_month"
_SQL["monthly_consumption"] = f"SELECT {_MONTHLY} FROM monthly_all"
_SQL["fact_monthly"] = f"""SELECT {_MONTHLY},
    datediff('month', min(usage_month) OVER (PARTITION BY account_id), usage_month) AS month_index FROM monthly"""
_PARTS["day_grid"] = f"""SELECT a.account_id, CAST(d AS DATE) AS date, contract_start_date, included_monthly_compute_credits,
    coalesce(credits, 0.0) AS daily_credits_consumed FROM
    (SELECT *, unnest(generate_series(CAST(contract_start_date AS TIMESTAMP), CAST({D} AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM active) a
    LEFT JOIN daily_known u ON u.account_id = a.account_id AND u.date = CAST(a.d AS DATE)"""
_SQL["daily_consumption"] = f"""SELECT account_id, date, contract_start_date, included_monthly_compute_credits, daily_credits_consumed,
    {rnd(div('daily_credits_consumed', 'included_monthly_compute_credits / 30.0'), 6)} AS daily_consumption_rate FROM day_grid"""


def _stats_out(source: str) -> str:
    return f"""SELECT account_id, {D} AS as_of_date, {_R6['trailing_90d_avg_rate']}, {_R6['trailing_30d_avg_rate']},
    {_R6['trailing_7d_avg_rate']}, months_of_data, {_R6['max_monthly_rate']}, {_R6['min_monthly_rate']}, overage_months,
    zero_usage_months, {_R6['peak_rate']} FROM {source}"""


_SQL["trailing_stats"] = _stats_out("stats")
_PARTS["stats_nocut"] = _stats("monthly_all")
_SQL["trailing_stats_nocut"] = _stats_out("stats_nocut")
_SQL["rates_by_window"] = f"""SELECT account_id, {_R6['trailing_90d_avg_rate']}, {_R6['trailing_30d_avg_rate']},
    {_R6['trailing_7d_avg_rate']} FROM stats"""
_SQL["yoy_rate"] = f"""SELECT account_id, {rnd(avg('consumption_rate'), 6)} AS trailing_12m_avg_rate, count(*) AS months_in_window
    FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY usage_month DESC) AS rk FROM monthly) WHERE rk <= 12 GROUP BY account_id"""
_SQL["expansion_consecutive"] = """WITH last3 AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY usage_month DESC) AS rk FROM monthly QUALIFY rk <= 3)
    SELECT a.account_id, count(*) FILTER (WHERE a.consumption_rate > 1.2) AS overage_months,
    coalesce(bool_or(a.consumption_rate > 1.2 AND b.consumption_rate > 1.2), FALSE) AS expansion_consecutive
    FROM last3 a LEFT JOIN last3 b ON b.account_id = a.account_id AND b.usage_month + to_months(1) = a.usage_month GROUP BY a.account_id"""
_SQL["spike_drop"] = f"""SELECT account_id, {_R6['peak_rate']}, {_R6['trailing_90d_avg_rate']},
    coalesce(max_monthly_rate > 2.0 AND trailing_90d_avg_rate < 0.05, FALSE) AS is_spike_drop,
    coalesce(peak_rate > 2.0 AND trailing_90d_avg_rate < 0.05, FALSE) AS is_spike_drop_hist FROM stats"""


def _window_credits(w: int) -> str:
    return f"coalesce({amt('u.credits', f'u.date > {D} - {w}')}, 0.0)"


_SQL["rolling_rates"] = f"""SELECT account_id, credits_7d, credits_30d, credits_90d,
    {', '.join(f"{rnd(div(f'credits_{w}d', f'm * {w} / 30.0'), 6)} AS rate_{w}d" for w in (7, 30, 90))}
    FROM (SELECT a.account_id, a.included_monthly_compute_credits AS m,
      {', '.join(f"{_window_credits(w)} AS credits_{w}d" for w in (7, 30, 90))}
      FROM active a LEFT JOIN daily_known u ON u.account_id = a.account_id AND u.date BETWEEN a.contract_start_date AND {D} GROUP BY ALL)"""
_SQL["rolling_rates_daily"] = f"""SELECT account_id, date,
    {', '.join(f"{rnd(div(f'sum(CAST(daily_credits_consumed AS DECIMAL(18,2))) OVER (PARTITION BY account_id ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)', f'included_monthly_compute_credits * {w} / 30.0'), 6)} AS rate_{w}d" for w in (7, 30, 90))}
    FROM day_grid"""
_SQL["rolling_rates_since"] = f"SELECT * FROM ({_SQL['rolling_rates_daily']}) WHERE date >= date_trunc('month', {D})"
_SQL["early_shelfware_streak"] = f"""WITH days AS (SELECT *, {div('daily_credits_consumed', 'included_monthly_compute_credits / 30.0')} AS r FROM day_grid),
    quiet AS (SELECT account_id, date, date - CAST(row_number() OVER (PARTITION BY account_id ORDER BY date) AS INTEGER) AS island FROM days WHERE r < 0.05),
    runs AS (SELECT account_id, min(date) AS s, max(date) AS e, count(*) AS n FROM quiet GROUP BY account_id, island)
    SELECT a.account_id, s AS streak_start, coalesce(n, 0) AS streak_days, coalesce(n, 0) >= 30 AS early_shelfware_flag
    FROM active a LEFT JOIN runs r ON r.account_id = a.account_id AND r.e = {D}"""


def _block_rates(length: int, cond: str) -> str:
    return f"""SELECT a.account_id, CAST(b AS INTEGER) AS block,
    {div('coalesce(sum(CAST(u.credits AS DECIMAL(18,2))), 0)', f'a.included_monthly_compute_credits * {length} / 30.0')} AS rate
    FROM (SELECT *, unnest(generate_series(0, CAST(floor(({D} - contract_start_date + 1) / {length}) AS BIGINT) - 1)) AS b FROM active WHERE {cond}) a
    LEFT JOIN daily_known u ON u.account_id = a.account_id AND u.date > {D} - CAST((b + 1) * {length} AS INTEGER) AND u.date <= {D} - CAST(b * {length} AS INTEGER)
    GROUP BY a.account_id, b, a.included_monthly_compute_credits"""


_SQL["onboarding_stall"] = f"""WITH weeks AS ({_block_rates(7, f'contract_start_date >= {D} - 90')}),
    steps AS (SELECT account_id, block, coalesce(abs(rate - lag(rate) OVER (PARTITION BY account_id ORDER BY block DESC)) < 0.02, FALSE) AS flat FROM weeks),
    runs AS (SELECT account_id, block - row_number() OVER (PARTITION BY account_id ORDER BY block) AS island, count(*) AS n FROM
      (SELECT * FROM steps WHERE flat) GROUP BY ALL),
    lengths AS (SELECT account_id, island, count(*) AS n FROM (SELECT account_id, block - row_number() OVER (PARTITION BY account_id ORDER BY block) AS island FROM steps WHERE flat) GROUP BY ALL)
    SELECT w.account_id, count(DISTINCT w.block) AS weeks, coalesce(max(l.n), 0) AS longest_flat_run, coalesce(max(l.n), 0) >= 2 AS onboarding_stall_flag
    FROM weeks w LEFT JOIN lengths l ON l.account_id = w.account_id GROUP BY w.account_id"""
_SQL["mom_drop"] = f"""WITH periods AS ({_block_rates(30, 'TRUE')}),
    drops AS (SELECT n.account_id, n.block, {div('p.rate - n.rate', 'p.rate')} AS decline FROM periods n
      LEFT JOIN periods p ON p.account_id = n.account_id AND p.block = n.block + 1)
    SELECT account_id, count(*) AS periods, {rnd('max(decline) FILTER (WHERE block = 0)', 6)} AS latest_decline,
    {rnd('max(decline)', 6)} AS largest_decline, coalesce(bool_or(decline > 0.40), FALSE) AS spike_drop_early_flag
    FROM drops GROUP BY account_id"""
_SQL["zero_streak"] = f"""WITH z AS (SELECT account_id, usage_month,
      datediff('month', DATE '1990-01-01', usage_month) - row_number() OVER (PARTITION BY account_id ORDER BY usage_month) AS island
      FROM monthly WHERE is_zero_usage_month),
    runs AS (SELECT account_id, count(*) AS n, max(usage_month) AS last FROM z GROUP BY account_id, island)
    SELECT account_id, max(n) AS longest_zero_streak, coalesce(max(n) FILTER (WHERE last + to_months(1) = {M}), 0) AS current_zero_streak,
    max(n) >= 2 AS outreach_flag FROM runs GROUP BY account_id"""

_FACT_OUT = f"""account_id, employee_id, signing_owner_id, company_name, industry, primary_contract_id, contract_start_date,
    contract_end_date, contract_term_months, annual_commit_dollars, included_monthly_compute_credits, has_expansion,
    active_contract_count, {_R6['trailing_90d_avg_rate']}, months_of_data, {_R6['max_monthly_rate']}, overage_months, zero_usage_months,
    expansion_flag, is_spike_drop, low_data_flag, is_new_account, health_tier, cacv, expansion_signal_acv, acv_at_risk, as_of_date"""
_SQL["account_metrics"] = f"SELECT {_FACT_OUT} FROM fact"
_SQL["health_tier"] = f"SELECT account_id, {_R6['trailing_90d_avg_rate']}, is_new_account, health_tier FROM fact"
_ALERTS = f"""coalesce(trailing_7d_avg_rate < 0.30 AND months_of_data <= 2 AND NOT is_new_account, FALSE) AS early_shelfware_flag,
    coalesce(is_new_account AND trailing_7d_avg_rate = 0 AND {D} - contract_start_date > 30, FALSE) AS onboarding_stall_flag,
    coalesce(trailing_7d_avg_rate < 0.05 AND max_monthly_rate > 2.0 AND months_of_data <= 2, FALSE) AS spike_drop_early_flag"""
_SQL["alert_flags"] = f"SELECT account_id, {_ALERTS} FROM fact WHERE months_of_data IS NOT NULL"
_CONFIDENCE = "CASE WHEN is_new_account THEN 'Low' WHEN months_of_data >= 3 THEN 'High' WHEN months_of_data >= 1 THEN 'Medium' END"
_SQL["confidence_level"] = f"SELECT account_id, months_of_data, is_new_account, {_CONFIDENCE} AS confidence FROM fact"
_SQL["cs_score_band"] = """SELECT account_id, health_tier, low AS cs_score_low, high AS cs_score_high, action AS cs_action FROM fact
    JOIN (VALUES ('Expansion', 90, 100, 'Flag for AE expansion handoff'), ('Healthy', 70, 89, 'Maintain check-in cadence'),
      ('At Risk', 40, 69, 'Open CS escalation playbook; 30-day SLA'), ('Shelfware', 20, 39, 'Executive sponsor outreach playbook'),
      ('Inactive', 0, 19, 'Immediate save plan; escalate to VP CS'), ('Ramping', NULL, NULL, 'Onboarding playbook; 90-day activation tracking'))
      AS v(tier, low, high, action) ON tier = health_tier"""
_PACE = """CASE WHEN rate > -0.001 AND rate <= 0.2 THEN 'Lagging (<20%)' WHEN rate > 0.2 AND rate <= 0.5 THEN 'Developing (20–50%)'
    WHEN rate > 0.5 AND rate <= 0.8 THEN 'On Pace (50–80%)' WHEN rate > 0.8 AND rate <= 2.0 THEN 'Strong (≥80%)' END"""
_PARTS["ramping"] = f"""SELECT *, {_PACE} AS pace FROM (SELECT *, coalesce(trailing_90d_avg_rate, 0.0) AS rate FROM owned WHERE is_new_account)"""
_SQL["activation_pace"] = f"""SELECT v.pace, count(account_id) AS accounts, {big('coalesce(sum(annual_commit_dollars), 0)')} AS acv
    FROM (VALUES ('Lagging (<20%)'), ('Developing (20–50%)'), ('On Pace (50–80%)'), ('Strong (≥80%)')) AS v(pace)
    LEFT JOIN ramping r ON r.pace = v.pace GROUP BY v.pace"""
_SQL["activation_bonus"] = f"""SELECT employee_id, account_id, company_name, {_R6['trailing_90d_avg_rate']} FROM fact
    WHERE NOT is_new_account AND trailing_90d_avg_rate >= 0.80"""
_DETAIL = f"""SELECT account_id, company_name, industry, primary_contract_id, active_contract_count, has_expansion, contract_start_date,
    contract_end_date, contract_term_months, annual_commit_dollars, included_monthly_compute_credits,
    contract_end_date - {D} AS days_to_renewal, employee_id, rep_name, region, segment, manager_name,
    {_R6['trailing_7d_avg_rate']}, {_R6['trailing_30d_avg_rate']}, {_R6['trailing_90d_avg_rate']}, health_tier, cacv, acv_at_risk,
    expansion_signal_acv AS consumption_overage_acv, months_of_data, {_R6['max_monthly_rate']}, overage_months, zero_usage_months,
    is_new_account, expansion_flag, is_spike_drop, low_data_flag, {_ALERTS}, as_of_date FROM owned WHERE months_of_data IS NOT NULL"""
_SQL["account_detail"] = _DETAIL
_PARTS["register"] = f"""SELECT account_id, company_name, industry, primary_contract_id, contract_start_date, contract_end_date, contract_term_months,
    contract_end_date - {D} AS days_to_renewal,
    CASE WHEN contract_end_date - {D} <= 30 THEN '0–30 days' WHEN contract_end_date - {D} <= 60 THEN '31–60 days'
         WHEN contract_end_date - {D} <= 90 THEN '61–90 days' ELSE '91–180 days' END AS renewal_urgency_bucket,
    annual_commit_dollars, cacv, acv_at_risk, expansion_signal_acv AS consumption_overage_acv, health_tier, {_R6['trailing_90d_avg_rate']},
    months_of_data, is_new_account, expansion_flag, is_spike_drop, employee_id, rep_name, region, segment, manager_name, as_of_date,
    tier_risk, {rnd(f'tier_risk * (1 + floor((contract_end_date - {D}) / 30.0))', 2)} AS renewal_risk_score
    FROM owned JOIN (VALUES ('Inactive', 5), ('Shelfware', 4), ('At Risk', 3), ('Ramping', 3), ('Healthy', 2), ('Expansion', 1)) AS v(tier, tier_risk)
    ON tier = health_tier WHERE contract_end_date BETWEEN {D} AND {D} + 180"""
_SQL["renewal_pipeline"] = "SELECT * FROM register"
_SQL["expansion_pipeline"] = f"""SELECT account_id, company_name, rep_name, region, annual_commit_dollars, {_R6['trailing_90d_avg_rate']},
    cacv, expansion_signal_acv, acv_at_risk, contract_end_date FROM owned WHERE expansion_flag"""
_SQL["ramp_tracker"] = f"""SELECT account_id, company_name, rep_name, region, annual_commit_dollars, {rnd('rate', 6)} AS rate, pace,
    contract_start_date, contract_end_date FROM ramping"""
_SQL["ramp_kpis"] = f"""SELECT count(*) AS ramping_accounts, {big('coalesce(sum(annual_commit_dollars), 0)')} AS acv_ramping,
    {cnt('rate >= 0.5')} AS strong_start, {cnt('rate >= 0.2 AND rate < 0.5')} AS developing, {cnt('rate < 0.2')} AS needs_attention FROM ramping"""
_LISTED = f"""account_id, company_name, health_tier, annual_commit_dollars, cacv, acv_at_risk, expansion_signal_acv,
    {rnd('trailing_90d_avg_rate', 2)} AS trailing_90d_avg_rate, rep_name, region"""
_SQL["top_at_risk"] = f"""SELECT {_LISTED} FROM owned WHERE health_tier IN ('At Risk', 'Shelfware', 'Inactive')
    ORDER BY acv_at_risk DESC NULLS LAST, account_id LIMIT 10"""
_SQL["top_expansion"] = f"""SELECT {_LISTED} FROM owned WHERE health_tier = 'Expansion' ORDER BY expansion_signal_acv DESC NULLS LAST, account_id LIMIT 10"""
_SQL["urgent_renewals"] = f"""SELECT account_id, company_name, rep_name, health_tier, acv_at_risk, contract_end_date - {D} AS days_to_renewal
    FROM owned WHERE health_tier IN ('At Risk', 'Shelfware', 'Inactive') AND contract_end_date - {D} BETWEEN 0 AND 30"""
_SQL["q_accounts"] = f"""SELECT {_LISTED} FROM owned WHERE health_tier = 'At Risk' AND upper(region) = 'ASIA' AND acv_at_risk >= 1000
    ORDER BY acv_at_risk DESC NULLS LAST, account_id LIMIT 10"""
_SQL["q_renewals"] = f"""SELECT account_id, company_name, contract_end_date, contract_end_date - {D} AS days_to_renewal, health_tier,
    annual_commit_dollars, cacv, acv_at_risk, {rnd('trailing_90d_avg_rate', 2)} AS trailing_90d_avg_rate, rep_name, region
    FROM owned WHERE contract_end_date - {D} BETWEEN 0 AND 90 ORDER BY acv_at_risk DESC NULLS LAST, account_id LIMIT 20"""
_SQL["extract_crm"] = f"""SELECT account_id AS account, health_tier AS Health_Tier__c, {rnd(div('cacv', 'annual_commit_dollars'), 4)} AS Attainment__c,
    acv_at_risk AS ACV_at_Risk__c, CASE WHEN expansion_flag THEN 'Expansion Identified' END AS StageName,
    coalesce(is_spike_drop, FALSE) AS Spike_Drop_Flag__c, employee_id AS Owner, signing_owner_id AS Signing_Owner__c FROM owned"""
_SQL["extract_cs"] = f"""SELECT account_id, health_tier, {rnd("least(100.0, coalesce(trailing_90d_avg_rate, 0.0) * 100)", 2)} AS cs_health_score,
    {_CONFIDENCE} AS confidence, coalesce(current_zero_streak, 0) >= 2 AS outreach_flag, early_shelfware_flag, onboarding_stall_flag, spike_drop_early_flag
    FROM ({_DETAIL}) LEFT JOIN (SELECT account_id, current_zero_streak FROM ({_SQL['zero_streak']})) USING (account_id)"""
_PARTS["owned_aged"] = """SELECT f.*, r.name AS rep_name, r.region, r.segment, r.manager_id, r.manager_name
    FROM (SELECT * FROM fact WHERE account_id % 2 = 0 UNION ALL SELECT * FROM fact_s2 WHERE account_id % 2 <> 0) f
    JOIN reps r ON r.employee_id = f.employee_id"""
_AGED = _DETAIL.replace("owned", "owned_aged").replace(D, "as_of_date")
_SQL["extract_cs_aged"] = f"""SELECT account_id, health_tier, {rnd("least(100.0, coalesce(trailing_90d_avg_rate, 0.0) * 100)", 2)} AS cs_health_score,
    CASE WHEN {D} - as_of_date > 2 THEN 'Stale' ELSE {_CONFIDENCE} END AS confidence,
    coalesce(current_zero_streak, 0) >= 2 AS outreach_flag, early_shelfware_flag, onboarding_stall_flag, spike_drop_early_flag
    FROM ({_AGED}) LEFT JOIN (SELECT account_id, current_zero_streak FROM ({_SQL['zero_streak']})) USING (account_id)"""

_TIERS = ("Expansion", "Healthy", "At Risk", "Shelfware", "Inactive", "Ramping")


def _tier_counts(*skip: str) -> str:
    return ", ".join(
        f"{cnt(f'health_tier = {chr(39)}{t}{chr(39)}')} AS accounts_{t.lower().replace(' ', '_')}"
        for t in _TIERS
        if t not in skip
    )


_RISKY = "health_tier IN ('At Risk', 'Shelfware', 'Inactive')"
_TIER_ACV = ", ".join(
    f"{big(f'sum(CASE WHEN {cond} THEN annual_commit_dollars ELSE 0 END)')} AS {name}"
    for name, cond in (
        ("acv_expansion", "health_tier = 'Expansion'"),
        ("acv_healthy", "health_tier = 'Healthy'"),
        ("acv_at_risk_tiers", _RISKY),
    )
)
_COMMIT = big("sum(annual_commit_dollars)")
_MATURE = big("sum(annual_commit_dollars) FILTER (WHERE NOT is_new_account)")
_CACV, _RISK, _SIGNAL = amt("cacv"), amt("acv_at_risk"), amt("expansion_signal_acv")
_ATTAIN = rnd(div(_CACV, _MATURE), 4)
_MATURE_AVG = rnd(avg("CASE WHEN NOT is_new_account THEN trailing_90d_avg_rate END"), 4)
_REP = "employee_id, rep_name, region, segment"


def _ranks(region: str) -> str:
    return f"""rank() OVER (PARTITION BY {region} ORDER BY total_cacv DESC NULLS LAST) AS region_rank,
    rank() OVER (ORDER BY total_cacv DESC NULLS LAST) AS org_rank"""


_PARTS["rollup_rows"] = f"""SELECT {_REP}, count(*) AS total_accounts, {cnt('is_new_account')} AS ramping_accounts,
    {cnt('NOT is_new_account')} AS mature_accounts, {_COMMIT} AS total_acv, {_CACV} AS total_cacv, {_RISK} AS total_acv_at_risk,
    {_SIGNAL} AS total_expansion_signal_acv, {_ATTAIN} AS cacv_attainment_rate, {_tier_counts()}, {_TIER_ACV},
    {cnt('expansion_flag')} AS expansion_opportunities,
    {big('sum(CASE WHEN expansion_flag THEN annual_commit_dollars ELSE 0 END)')} AS expansion_acv_pipeline,
    {cnt('is_spike_drop')} AS spike_drop_accounts, {cnt('has_expansion')} AS mid_year_expansion_accounts,
    {_MATURE_AVG} AS avg_consumption_rate, as_of_date FROM owned GROUP BY {_REP}, as_of_date"""
_PARTS["rollup_ranked"] = f"SELECT *, {_ranks('region')} FROM rollup_rows"
_SQL["rep_rollup"] = "SELECT * FROM rollup_ranked"
_SQL["q_rep"] = "SELECT * FROM rollup_ranked WHERE lower(rep_name) = 'supplier#000000007'"
_SQL["rep_leaderboard"] = "SELECT employee_id, rep_name, region, total_cacv, region_rank, org_rank FROM rollup_ranked"
_PARTS["portfolio_rows"] = f"""SELECT {_REP}, manager_name, manager_id, count(*) AS total_accounts, {cnt('is_new_account')} AS accounts_ramping,
    {cnt('NOT is_new_account')} AS accounts_mature, coalesce({_MATURE}, 0) AS total_acv, {_CACV} AS total_cacv, {_RISK} AS total_acv_at_risk,
    {_SIGNAL} AS total_expansion_signal_acv, {_SIGNAL} AS total_consumption_overage_acv, {cnt('expansion_flag')} AS expansion_opportunities,
    {_ATTAIN} AS cacv_attainment_rate, {_tier_counts('Ramping')}, {_TIER_ACV}, {cnt('is_spike_drop')} AS spike_drop_accounts,
    {cnt('low_data_flag')} AS low_data_accounts, {cnt('has_expansion')} AS mid_year_expansion_accounts,
    {_MATURE_AVG} AS avg_consumption_rate_90d, as_of_date FROM owned GROUP BY {_REP}, manager_name, manager_id, as_of_date"""
_SQL["rep_portfolio"] = f"SELECT *, {_ranks('region')} FROM portfolio_rows"
_SQL["extract_comp"] = """SELECT employee_id, as_of_date, total_cacv AS quota_attainment_numerator, cacv_attainment_rate AS accelerator_rate,
    total_acv AS quota_denominator, expansion_opportunities > 0 AS expansion_spif_eligible FROM portfolio_rows"""
_PARTS["demo_rows"] = f"""SELECT {_REP}, count(*) AS total_accounts, {cnt('is_new_account')} AS ramping_accounts,
    {cnt('NOT is_new_account')} AS mature_accounts, {_COMMIT} AS total_acv, coalesce({_CACV}, 0.0) AS total_cacv,
    coalesce({_RISK}, 0.0) AS total_acv_at_risk, coalesce({_SIGNAL}, 0.0) AS total_expansion_signal_acv,
    coalesce({rnd(div(f'coalesce({_CACV}, 0.0)', _COMMIT), 4)}, 0.0) AS cacv_attainment_rate, {_tier_counts()}, {_TIER_ACV},
    {cnt('expansion_flag')} AS expansion_opportunities, coalesce({amt('expansion_signal_acv', 'expansion_flag')}, 0.0) AS expansion_acv_pipeline,
    {cnt('is_spike_drop')} AS spike_drop_accounts, {cnt('has_expansion')} AS mid_year_expansion_accounts,
    CASE WHEN {cnt('NOT is_new_account')} = 0 THEN 0.0 ELSE {_MATURE_AVG} END AS avg_consumption_rate, as_of_date
    FROM owned GROUP BY {_REP}, as_of_date"""
_SQL["demo_rep_rollup"] = f"SELECT *, {_ranks('region, segment')} FROM demo_rows"
_SQL["comp_input"] = f"""SELECT {_REP}, manager_id, as_of_date, count(*) AS total_mature_accounts, {_COMMIT} AS total_acv, {_CACV} AS total_cacv,
    {_ATTAIN} AS cacv_attainment_rate, {_RISK} AS total_acv_at_risk, {_SIGNAL} AS total_consumption_overage_acv
    FROM owned WHERE NOT is_new_account GROUP BY {_REP}, manager_id, as_of_date"""
_SUMMARY = f"""coalesce({_MATURE}, 0) AS total_acv, {_CACV} AS total_cacv, {_RISK} AS total_acv_at_risk, {_SIGNAL} AS total_consumption_overage_acv,
    {_ATTAIN} AS attainment_rate, count(*) AS total_accounts, {cnt('NOT is_new_account')} AS total_mature_accounts,
    {cnt('is_new_account')} AS total_ramping_accounts, {_tier_counts('Ramping')}, {cnt("health_tier = 'Ramping'")} AS accounts_ramping_tier,
    {_TIER_ACV}, count(DISTINCT employee_id) AS total_reps"""
_SQL["org_summary"] = f"""SELECT 'region' AS rollup_level, region, as_of_date, {_SUMMARY} FROM owned GROUP BY region, as_of_date
    UNION ALL SELECT 'org_total', 'All Regions', as_of_date, {_SUMMARY} FROM owned GROUP BY as_of_date"""
_SQL["segment_summary"] = f"SELECT segment, as_of_date, {_SUMMARY} FROM owned GROUP BY segment, as_of_date"
_FY = "year({0}) + CASE WHEN month({0}) >= 8 THEN 1 ELSE 0 END"
_FQ = "CASE WHEN month({0}) IN (8, 9, 10) THEN 1 WHEN month({0}) IN (11, 12, 1) THEN 2 WHEN month({0}) IN (2, 3, 4) THEN 3 ELSE 4 END"
_COHORT = "'FY' || (" + _FY.format("contract_start_date") + ") || '-Q' || (" + _FQ.format("contract_start_date") + ")"
_SQL["cohort_summary"] = f"SELECT {_COHORT} AS cohort, as_of_date, {_SUMMARY} FROM owned GROUP BY 1, as_of_date"
_SQL["attainment_cube"] = f"""SELECT region, segment, grouping(region, segment) AS level, count(*) AS total_accounts,
    coalesce({_MATURE}, 0) AS total_acv, {_CACV} AS total_cacv, {_ATTAIN} AS attainment_rate FROM owned GROUP BY ROLLUP (region, segment)"""
_SQL["region_page"] = f"""SELECT region, count(DISTINCT employee_id) AS reps, count(*) AS total_accounts, {_COMMIT} AS total_acv, {_CACV} AS total_cacv,
    {_RISK} AS total_acv_at_risk, {cnt("health_tier = 'Expansion'")} AS accounts_expansion, {cnt("health_tier = 'At Risk'")} AS accounts_at_risk,
    {big('sum(CASE WHEN expansion_flag THEN annual_commit_dollars ELSE 0 END)')} AS expansion_acv_pipeline, {cnt('is_spike_drop')} AS spike_drop_accounts,
    {rnd(div(_CACV, _COMMIT), 6)} AS att_rate, {rnd(div(_RISK, _COMMIT), 6)} AS risk_pct FROM owned GROUP BY region"""
_SQL["tier_mix_region"] = "SELECT region, " + ", ".join(
    f"{rnd(div(cnt(f'health_tier = {chr(39)}{t}{chr(39)}') + ' * 100', 'count(health_tier)'), 4)} AS pct_{t.lower().replace(' ', '_')}"
    for t in _TIERS
) + " FROM owned GROUP BY region"
_SQL["expansion_by_region"] = f"""SELECT region, count(*) AS exp_accounts, {_SIGNAL} AS exp_signal_acv,
    {rnd(div('sum(CAST(trailing_90d_avg_rate AS DECIMAL(18,12)))', 'count(trailing_90d_avg_rate)'), 6)} AS avg_rate
    FROM owned WHERE expansion_flag GROUP BY region"""
_SQL["tier_distribution"] = f"SELECT health_tier, count(*) AS accounts, {_COMMIT} AS acv FROM fact GROUP BY health_tier"
_SQL["renewal_bucket_exposure"] = f"""SELECT renewal_urgency_bucket AS bucket, health_tier, count(*) AS accounts, {_RISK} AS acv_at_risk
    FROM register WHERE {_RISKY} GROUP BY ALL"""
_SQL["portfolio_kpis"] = f"""SELECT *, {rnd(div('total_cacv', 'total_acv'), 6)} AS attainment,
    {rnd('greatest(total_acv * 0.85::DOUBLE - total_cacv, 0.0)', 2)} AS gap_to_target
    FROM (SELECT {_COMMIT} AS total_acv, {_CACV} AS total_cacv, {_RISK} AS total_acv_at_risk, {_SIGNAL} AS total_overage FROM owned)"""


def _due(days: int) -> str:
    return f"contract_end_date - {D} BETWEEN 0 AND {days}"


def _exposed(days: int) -> str:
    return amt("acv_at_risk", f"{_due(days)} AND {_RISKY}")


_SQL["renewal_kpis"] = f"""SELECT {cnt(_due(180))} AS accounts_expiring, {cnt(f'{_due(180)} AND {_RISKY}')} AS at_risk_accounts,
    {_exposed(180)} AS acv_exposed, {rnd(div(_exposed(180), _COMMIT), 6)} AS share_of_total_acv FROM owned"""
_SQL["near_risk_renewals"] = f"""SELECT {cnt(f'{_due(90)} AND {_RISKY}')} AS near_risk_count, {_exposed(90)} AS near_risk_acv FROM owned"""
_SQL["lagging_region"] = f"""SELECT region, {rnd(div(_CACV, _COMMIT), 6)} AS attainment FROM owned GROUP BY region ORDER BY attainment, region LIMIT 1"""
_SQL["nrr_band"] = f"""SELECT region, att_rate, CASE WHEN att_rate >= 0.9 THEN '≥ 90%' WHEN att_rate >= 0.7 THEN '70–90%'
    WHEN att_rate >= 0.5 THEN '50–70%' WHEN att_rate < 0.5 THEN '< 50%' END AS nrr_band
    FROM (SELECT region, {rnd(div(_CACV, _COMMIT), 6)} AS att_rate FROM owned GROUP BY region)"""
_SQL["attainment_band"] = """SELECT employee_id, rep_name, region, cacv_attainment_rate,
    CASE WHEN cacv_attainment_rate >= 0.85 THEN 'Above target' WHEN cacv_attainment_rate >= 0.70 THEN 'Below target' ELSE 'Needs attention' END AS band
    FROM rollup_rows"""
_PARTS["scores"] = f"""SELECT employee_id, rep_name, region, total_acv, total_cacv, cacv_attainment_rate,
    {rnd('CASE WHEN total_cacv IS NULL THEN 0.0 ELSE greatest(total_acv * 0.85::DOUBLE - total_cacv, 0.0) END', 2)} AS gap_to_target, accounts_at_risk FROM rollup_rows"""
_SQL["top_reps"] = "SELECT * FROM scores WHERE cacv_attainment_rate IS NOT NULL ORDER BY cacv_attainment_rate DESC, employee_id LIMIT 3"
_SQL["gap_reps"] = "SELECT * FROM scores WHERE cacv_attainment_rate IS NOT NULL ORDER BY gap_to_target DESC, employee_id LIMIT 3"
_SQL["coaching_reps"] = "SELECT * FROM scores WHERE cacv_attainment_rate < 0.85 ORDER BY cacv_attainment_rate, employee_id LIMIT 3"
_SQL["top20_reps"] = "SELECT * FROM scores ORDER BY total_cacv DESC NULLS LAST, employee_id LIMIT 20"
_COVERAGE = (
    ("accounts", "count(*)"),
    ("reps", "count(DISTINCT employee_id)"),
    ("rated_accounts", "count(trailing_90d_avg_rate)"),
    ("consuming_accounts", cnt("cacv > 0")),
    ("idle_accounts", cnt("health_tier IN ('Shelfware', 'Inactive')")),
    ("ramping_accounts", cnt("health_tier = 'Ramping'")),
    ("flagged_accounts", cnt("expansion_flag")),
)
_SQL["data_coverage"] = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {e} AS value, {rnd(div(e, 'count(*)'), 4)} AS share_of_accounts FROM owned"
    for m, e in _COVERAGE
)
_SQL["q_portfolio"] = f"""WITH tiers AS (SELECT health_tier AS t, count(*) AS n, {_COMMIT} AS c,
      CASE health_tier WHEN 'Expansion' THEN 1 WHEN 'Healthy' THEN 2 WHEN 'At Risk' THEN 3 WHEN 'Shelfware' THEN 4 WHEN 'Inactive' THEN 5 ELSE 6 END AS o
      FROM owned WHERE health_tier IS NOT NULL GROUP BY health_tier)
    SELECT 'All Regions' AS scope, {_COMMIT} AS total_acv, {rnd(_CACV, 0)} AS total_cacv, {rnd(div(_CACV, _COMMIT), 4)} AS attainment_rate,
    {rnd(_RISK, 0)} AS total_acv_at_risk, {rnd(_SIGNAL, 0)} AS total_expansion_signal_acv, count(DISTINCT employee_id) AS rep_count,
    count(*) AS account_count,
    (SELECT '{{' || string_agg('"' || t || '":' || n, ',' ORDER BY o) || '}}' FROM tiers) AS health_tier_counts,
    (SELECT '{{' || string_agg('"' || t || '":' || c, ',' ORDER BY o) || '}}' FROM tiers WHERE c > 0) AS health_tier_acv FROM owned"""


# Quality checks
def _check(name: str, severity: str, passed: str, n: str, detail: str, samples: str, source: str) -> str:
    return f"""SELECT '{name}' AS test_name, '{severity}' AS severity, {passed} AS passed, {big(n)} AS row_count,
    {detail} AS detail, {samples} AS sample_rows FROM {source}"""


def _rows(order: str, *columns: str) -> str:
    """The first five rows of ``bad`` as JSON text in the given order."""
    fields = " || ',' || ".join(f"""'"{c}":' || {_json(c)}""" for c in columns)
    return (
        f"(SELECT coalesce(string_agg('{{' || {fields} || '}}', ' ' ORDER BY {order}), '')"
        f" FROM (SELECT * FROM bad ORDER BY {order} LIMIT 5))"
    )


def _json(column: str) -> str:
    return f"""'"' || {column} || '"'""" if column.endswith("_date") else f"CAST({column} AS VARCHAR)"


_NULLS = " UNION ALL ".join(
    f"SELECT {i} AS pos, '{n}' AS tbl, {cnt(f'{k} IS NULL')} AS null_count FROM {src}"
    for i, (n, k, src) in enumerate(
        (
            ("sales_reps", "employee_id", "reps"),
            ("accounts", "account_id", "accounts"),
            ("contracts", "contract_id", "all_contracts"),
            ("daily_usage_logs", "log_id", "logs"),
        )
    )
)
_DQ = {
    "dq_null_pk": ("null_primary_keys", "ERROR", "sum(null_count) = 0", "sum(null_count)",
        "CAST(sum(null_count) AS VARCHAR) || ' null keys; tables ' || coalesce(string_agg(tbl, ', ' ORDER BY pos) FILTER (WHERE null_count > 0), 'none')",
        """string_agg('{"tbl":"' || tbl || '","null_count":' || null_count || '}', ' ' ORDER BY pos)""", f"({_NULLS})"),
    "dq_negative_credits": ("negative_credits", "ERROR", "count(*) = 0", "count(*)",
        "count(*) || ' credits below zero'", "''", "(SELECT * FROM logs WHERE compute_credits_consumed < 0)"),
}


def _bad(name: str, severity: str, passed: str, detail: str, order: str, columns: tuple[str, ...], bad: str) -> str:
    body = _check(name, severity, passed, "count(*)", detail, _rows(order, *columns), "bad")
    return f"WITH bad AS ({bad}) {body}"


for _key, _args in _DQ.items():
    _SQL[_key] = _check(*_args)
_SQL["dq_malformed_contracts"] = _bad("malformed_contracts", "ERROR", "count(*) = 0", "count(*) || ' contracts end too early'",
    "contract_id", ("contract_id", "account_id", "start_date", "end_date"), "SELECT * FROM all_contracts WHERE end_date < start_date")
_SQL["dq_duplicate_log_ids"] = _bad("duplicate_log_ids", "ERROR", "count(*) = 0", "count(*) || ' ids used twice or more'",
    "log_id", ("log_id", "cnt"), "SELECT log_id, count(*) AS cnt FROM logs GROUP BY log_id HAVING count(*) > 1")
_SQL["dq_contracts_missing_accounts"] = _bad("contracts_missing_accounts", "ERROR", "count(*) = 0",
    "count(*) || ' contracts without account'", "contract_id", ("contract_id", "account_id"), _SQL["contracts_missing_accounts"])
_SQL["dq_accounts_missing_reps"] = _bad("accounts_missing_reps", "ERROR", "count(*) = 0",
    "count(*) || ' accounts without rep'", "account_id", ("account_id", "employee_id"), _SQL["accounts_missing_reps"])
_SQL["dq_orphaned_usage"] = f"""WITH bad AS (SELECT account_id, count(*) AS orphan_count FROM orphan_logs GROUP BY account_id)
    SELECT 'orphaned_usage' AS test_name, 'WARNING' AS severity, count(*) = 0 AS passed, {big('coalesce(sum(orphan_count), 0)')} AS row_count,
    CAST(coalesce(sum(orphan_count), 0) AS BIGINT) || ' logs, ' || count(*) || ' unknown ids' AS detail,
    {_rows('orphan_count DESC, account_id', 'account_id', 'orphan_count')} AS sample_rows FROM bad"""
_SQL["dq_out_of_contract"] = _check("out_of_contract", "WARNING", "count(*) = 0", "count(*)",
    "count(*) || ' logs out of term'", "''", "rogue_logs")
_PCT = "CAST(CAST(round(CAST({0} * 100 AS DECIMAL(28,6)), 1) AS DECIMAL(10,1)) AS VARCHAR) || '%'"
_SQL["dq_shelfware_rate"] = f"""WITH c AS (SELECT count(*) AS active_accounts, {cnt('u.account_id IS NULL')} AS zero_usage_accounts
      FROM (SELECT DISTINCT account_id FROM contracts WHERE {D} BETWEEN start_date AND end_date) a LEFT JOIN
      (SELECT DISTINCT account_id FROM logs WHERE date BETWEEN {D} - 90 AND {D} AND compute_credits_consumed > 0) u USING (account_id)),
    r AS (SELECT *, {rnd(div('zero_usage_accounts', 'active_accounts'), 4)} AS shelfware_rate FROM c)
    SELECT 'shelfware_rate' AS test_name, 'WARNING' AS severity, coalesce(shelfware_rate, 0.0) <= 0.15 AS passed, zero_usage_accounts AS row_count,
    {_PCT.format('shelfware_rate')} || ' idle: ' || zero_usage_accounts || '/' || active_accounts || ', limit 15%' AS detail,
    '{{"active_accounts":' || active_accounts || ',"zero_usage_accounts":' || zero_usage_accounts || ',"shelfware_rate":' || shelfware_rate || '}}' AS sample_rows FROM r"""
_SQL["dq_overlapping_contracts"] = _bad("overlapping_contracts", "INFO", "TRUE", "count(*) || ' accounts with several terms'",
    "active_contracts DESC, account_id", ("account_id", "active_contracts"),
    f"SELECT account_id, count(*) AS active_contracts FROM contracts WHERE {D} BETWEEN start_date AND end_date GROUP BY 1 HAVING count(*) > 1")
_SQL["dq_new_account_rate"] = f"""WITH c AS (SELECT count(*) AS active_accounts, {cnt(f's >= {D} - 90')} AS ramping_accounts
      FROM (SELECT account_id, min(start_date) AS s FROM contracts WHERE {D} BETWEEN start_date AND end_date GROUP BY 1)),
    r AS (SELECT *, {rnd(div('ramping_accounts', 'active_accounts'), 4)} AS ramping_rate FROM c)
    SELECT 'new_account_rate' AS test_name, 'INFO' AS severity, TRUE AS passed, ramping_accounts AS row_count,
    {_PCT.format('ramping_rate')} || ' new: ' || ramping_accounts || '/' || active_accounts AS detail,
    '{{"active_accounts":' || active_accounts || ',"ramping_accounts":' || ramping_accounts || ',"ramping_rate":' || ramping_rate || '}}' AS sample_rows FROM r"""
_ALL_DQ = ("dq_null_pk", "dq_negative_credits", "dq_malformed_contracts", "dq_duplicate_log_ids", "dq_contracts_missing_accounts",
    "dq_accounts_missing_reps", "dq_orphaned_usage", "dq_out_of_contract", "dq_shelfware_rate", "dq_overlapping_contracts", "dq_new_account_rate")
_SQL["dq_report"] = " UNION ALL ".join(f"SELECT * FROM ({_SQL[k]})" for k in _ALL_DQ)
_SQL["dq_gate"] = f"""SELECT {cnt('passed')} AS passed, {cnt("NOT passed AND severity = 'ERROR'")} AS errors,
    {cnt("NOT passed AND severity = 'WARNING'")} AS warnings, {cnt("NOT passed AND severity = 'ERROR'")} = 0 AS gate_passed FROM ({_SQL['dq_report']})"""
_MAT = "health_tier IS DISTINCT FROM 'Ramping'"
_SHELF = cnt("health_tier IN ('Shelfware', 'Inactive')")
_SHELF_RATE = f"coalesce({div(_SHELF, cnt(_MAT))}, 0.0)"


def _snap(name: str, severity: str, cond: str, bad: str) -> str:
    return f"SELECT '{name}' AS check_name, '{severity}' AS severity, CASE WHEN {cnt(cond)} = 0 THEN 'PASS' ELSE '{bad}' END AS status, {cnt(cond)} AS row_count FROM fact"


_SQL["snapshot_checks"] = " UNION ALL ".join([
    _snap("cap violations", "ERROR", "cacv > annual_commit_dollars + 1", "FAIL"),
    _snap("negative value at risk", "ERROR", "acv_at_risk < -1", "FAIL"),
    _snap("negative overage", "ERROR", "expansion_signal_acv < -1", "FAIL"),
    _snap("NULL health tier", "ERROR", "health_tier IS NULL", "FAIL"),
    _snap("orphaned accounts (no rep)", "WARNING", "employee_id NOT IN (SELECT employee_id FROM reps)", "WARN"),
    _snap("missing rate (mature)", "WARNING", f"{_MAT} AND trailing_90d_avg_rate IS NULL", "WARN"),
    f"""SELECT 'shelfware rate', CASE WHEN {_SHELF_RATE} <= 0.08 THEN 'INFO' WHEN {_SHELF_RATE} <= 0.15 THEN 'WARNING' ELSE 'ERROR' END,
    CASE WHEN {_SHELF_RATE} <= 0.08 THEN 'PASS' WHEN {_SHELF_RATE} <= 0.15 THEN 'WARN' ELSE 'FAIL' END, {_SHELF} FROM fact""",
    f"SELECT 'ramping rate', 'INFO', 'INFO', {cnt(chr(104) + 'ealth_tier = ' + chr(39) + 'Ramping' + chr(39))} FROM fact",
])
_EXACT = rnd("annual_commit_dollars * trailing_90d_avg_rate", 2)
_CAPPED = rnd("least(annual_commit_dollars * trailing_90d_avg_rate, CAST(annual_commit_dollars AS DOUBLE))", 2)
_SQL["metric_invariants"] = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, {cnt(cond)} AS violations FROM fact"
    for name, cond in (
        ("cap holds", "cacv > annual_commit_dollars"),
        ("floor holds", "cacv < 0"),
        ("overage non-negative", "expansion_signal_acv < 0"),
        ("arithmetic identity", f"abs(cacv + expansion_signal_acv - {_EXACT}) > 0.015"),
        ("at-risk identity", "abs(acv_at_risk - (annual_commit_dollars - cacv)) > 0.015"),
        ("ramping accounts NULL", f"contract_start_date >= {D} - 90 AND cacv IS NOT NULL"),
        ("rate window consistency", f"abs(cacv - {_CAPPED}) > 0.015"),
        ("no phantom accounts", "account_id NOT IN (SELECT account_id FROM accounts)"),
        ("no phantom reps", "employee_id NOT IN (SELECT employee_id FROM reps)"),
    )
)


def _empty(name: str, source: str) -> str:
    return f"SELECT '{name} not empty' AS check_name, CASE WHEN count(*) = 0 THEN CAST(1 AS BIGINT) ELSE 0 END AS failures FROM {source}"


_SQL["view_checks"] = " UNION ALL ".join([
    _empty("account_detail", "(SELECT * FROM owned WHERE months_of_data IS NOT NULL)"),
    f"SELECT 'account_detail no NULL metrics', {cnt(chr(104) + 'ealth_tier <> ' + chr(39) + 'Ramping' + chr(39) + ' AND (cacv IS NULL OR acv_at_risk IS NULL OR health_tier IS NULL)')} FROM owned WHERE months_of_data IS NOT NULL",
    f"SELECT 'account_detail cap holds', {cnt('cacv > annual_commit_dollars')} FROM owned WHERE months_of_data IS NOT NULL",
    _empty("rep_portfolio", "portfolio_rows"),
    f"SELECT 'rep_portfolio attainment in range', {cnt('NOT cacv_attainment_rate BETWEEN 0 AND 1.5')} FROM portfolio_rows",
    _empty("comp_input", "(SELECT * FROM owned WHERE NOT is_new_account)"),
    "SELECT 'comp_input has no ramping', CAST(0 AS BIGINT)",
    _empty("renewal_pipeline", "register"),
    _empty("org_summary", "owned"),
])

# Edge cases
_PARTS["log_months"] = """SELECT account_id, date_trunc('month', date) AS m, sum(CAST(compute_credits_consumed AS DECIMAL(18,2))) AS credits FROM logs GROUP BY ALL"""
_PARTS["spikes"] = f"""SELECT * FROM (SELECT account_id, CAST(first_credits AS DOUBLE) AS month_1, CAST(sum(credits) AS DOUBLE) AS total FROM
      (SELECT *, first_value(credits) OVER (PARTITION BY account_id ORDER BY m) AS first_credits FROM log_months) GROUP BY account_id, first_credits)
    WHERE {div('month_1', 'total')} > 0.80 AND total - month_1 < 100"""
_SQL["spike_drop_accounts"] = f"""SELECT account_id, {rnd('month_1', 0)} AS month_1_credits, {rnd('total - month_1', 0)} AS remaining_credits,
    {rnd(div('month_1', 'total'), 2)} AS month_1_share FROM spikes"""
_SQL["shelfware_accounts"] = """SELECT a.account_id, c.contract_id, a.company_name, a.industry, c.annual_commit_dollars, c.included_monthly_compute_credits
    FROM accounts a JOIN all_contracts c ON c.account_id = a.account_id WHERE NOT EXISTS (SELECT 1 FROM logs l WHERE l.account_id = a.account_id)"""
_SQL["consistent_overage"] = f"""WITH mc AS (SELECT l.account_id, date_trunc('month', l.date) AS m, {amt('l.compute_credits_consumed')} AS credits,
      max(c.included_monthly_compute_credits) AS allowance FROM logs l JOIN all_contracts c ON c.account_id = l.account_id AND l.date BETWEEN c.start_date AND c.end_date GROUP BY ALL),
    rated AS (SELECT *, {div('credits', 'allowance')} AS r FROM mc)
    SELECT account_id, count(*) AS active_months, {cnt('credits > allowance * 1.2::DOUBLE')} AS overage_months, {rnd(avg('r', 'DECIMAL(24,12)'), 2)} AS avg_consumption_rate
    FROM rated GROUP BY account_id HAVING {cnt('credits > allowance * 1.2::DOUBLE')} >= count(*) * 0.5"""
_SQL["orphan_profile"] = f"""SELECT account_id, count(*) AS orphan_log_count, min(date) AS earliest_log, max(date) AS latest_log,
    {rnd(amt('compute_credits_consumed'), 0)} AS total_credits FROM orphan_logs GROUP BY account_id"""
_SQL["edge_case_scorecard"] = f"""SELECT 'spike_drop_accounts' AS edge_case, count(*) AS count, 'any' AS expected FROM spikes
    UNION ALL SELECT 'shelfware_accounts', count(*), 'any' FROM accounts a WHERE NOT EXISTS (SELECT 1 FROM logs l WHERE l.account_id = a.account_id)
    UNION ALL SELECT 'orphaned_usage', count(*), 'any' FROM orphan_logs
    UNION ALL SELECT 'out_of_contract_usage', count(*), 'any' FROM rogue_logs
    UNION ALL SELECT 'accounts_with_overlap', count(DISTINCT account_id), 'any' FROM ({_SQL['overlapping_pairs']})"""

# Compensation
_MULT = "CASE term_years WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 1.2::DOUBLE WHEN 3 THEN 1.35::DOUBLE WHEN 5 THEN 1.5::DOUBLE END"
_PARTS["deals"] = f"""SELECT contract_id, owner_id, term_years, acv, {rnd("acv * months / 12.0::DOUBLE", 2)} AS tcv, CAST(acv AS DOUBLE) AS credit_none,
    {rnd(f'acv * {_MULT}', 2)} AS credit_multiplier, {rnd("acv * months / 12.0::DOUBLE", 2)} AS credit_full_tcv
    FROM (SELECT contract_id, owner_id, contract_term_months / 12.0::DOUBLE AS term_years, contract_term_months AS months, annual_commit_dollars AS acv FROM contracts)"""
_SQL["comp_deal_economics"] = "SELECT * FROM deals"
_APPROACH = ("none", "multiplier", "full_tcv")
_PARTS["bookings"] = "SELECT owner_id AS employee_id, count(*) AS deals, " + ", ".join(
    f"{rnd(div(amt(f'credit_{a}'), '700000.0'), 4)} AS attainment_{a}" for a in _APPROACH
) + " FROM deals GROUP BY owner_id"
_SQL["comp_bookings_attainment"] = "SELECT * FROM bookings"
_PARTS["deal_years"] = f"""SELECT c.contract_id, c.account_id, c.owner_id, (c.contract_term_months + 11) // 12 AS term_years, c.y AS year, c.annual_commit_dollars AS acv,
    {avg('m.consumption_rate')} AS rate
    FROM (SELECT *, CAST(unnest(generate_series(1, (contract_term_months + 11) // 12)) AS INTEGER) AS y FROM contracts) c
    LEFT JOIN monthly m ON m.account_id = c.account_id
      AND datediff('month', c.start_date, m.usage_month) >= (c.y - 1) * 12 AND datediff('month', c.start_date, m.usage_month) < least(c.y * 12, c.contract_term_months)
    GROUP BY ALL"""
_PARTS["valued_years"] = """SELECT *, CASE WHEN rate IS NOT NULL THEN least(acv * rate, CAST(acv AS DOUBLE)) END AS v,
    CASE WHEN rate IS NOT NULL THEN greatest(acv * rate - acv, 0.0) END AS o FROM deal_years"""
_SQL["comp_yearly"] = f"""SELECT contract_id, year, {rnd('rate', 6)} AS consumption_rate, {rnd('v', 2)} AS annual_value, {rnd('o', 2)} AS overage,
    {rnd('v * 0.3::DOUBLE', 2)} AS ae_contribution FROM valued_years"""


def _flat_total(rate: str) -> str:
    return f"({div(f'acv * {_MULT}', '700000.0')} + {div(f'least(acv * {rate}, CAST(acv AS DOUBLE)) * 0.3::DOUBLE', '300000.0')})"


_SQL["comp_sensitivity"] = f"""SELECT contract_id, flat_rate, {rnd('least(acv * flat_rate, CAST(acv AS DOUBLE))', 2)} AS annual_value,
    {rnd('least(acv * flat_rate, CAST(acv AS DOUBLE)) * 0.3::DOUBLE', 2)} AS ae_contribution,
    {rnd(div(f'acv * {_MULT}', '700000.0'), 6)} AS bookings_attainment, {rnd(_flat_total('flat_rate'), 6)} AS total_attainment,
    CASE WHEN flat_rate <> 0.2::DOUBLE THEN {rnd(f"{_flat_total('flat_rate')} - {_flat_total('0.2::DOUBLE')}", 6)} END AS delta_vs_baseline
    FROM deals, (VALUES (0.2::DOUBLE), (0.4::DOUBLE), (0.6::DOUBLE), (0.8::DOUBLE), (1.0::DOUBLE)) AS r(flat_rate)"""
_YEAR1 = div("coalesce(year1_value, 0) * 0.3::DOUBLE", "300000.0")
_SQL["comp_ae_summary"] = f"""SELECT employee_id, deals, attainment_none, attainment_multiplier, attainment_full_tcv, year1_value,
    {rnd(_YEAR1, 4)} AS year1_attainment, {', '.join(f"{rnd(f'attainment_{a} + {_YEAR1}', 4)} AS combined_{a}" for a in _APPROACH)}
    FROM bookings LEFT JOIN (SELECT owner_id AS employee_id, {amt(rnd('v', 2))} AS year1_value FROM valued_years WHERE year = 1 GROUP BY 1) USING (employee_id)"""
_RENEW = "CASE WHEN year = term_years THEN " + div("acv * 0.3::DOUBLE", "240000.0") + " END"
_AMY = div("v * 0.7::DOUBLE", "560000.0")
_SQL["comp_am_yearly"] = f"""SELECT contract_id, year, {rnd('v', 2)} AS annual_value, {rnd('v * 0.7::DOUBLE', 2)} AS am_contribution, running AS cumulative_value,
    {rnd(_AMY, 6)} AS year_attainment, {rnd(div('running * 0.7::DOUBLE', '560000.0'), 6)} AS cumulative_attainment, {rnd(_RENEW, 6)} AS renewal_attainment,
    {rnd(f'{_AMY} + coalesce({_RENEW}, 0.0)', 6)} AS combined_attainment
    FROM (SELECT *, coalesce(CAST(sum(CAST({rnd('v', 2)} AS DECIMAL(18,2))) OVER (PARTITION BY contract_id ORDER BY year) AS DOUBLE), 0.0) AS running FROM valued_years WHERE year >= 2)"""
_SQL["comp_am_renewal"] = f"""SELECT contract_id, annual_commit_dollars AS renewal_acv, 1.0::DOUBLE AS renewal_multiplier,
    {rnd('annual_commit_dollars * 0.3::DOUBLE', 2)} AS renewal_credit, {rnd(div('annual_commit_dollars * 0.3::DOUBLE', '240000.0'), 6)} AS renewal_attainment FROM contracts"""

# Dimensions and history
_SQL["dim_accounts"] = "SELECT DISTINCT account_id, company_name, industry FROM accounts"
_SQL["dim_reps"] = "SELECT DISTINCT employee_id, name, region, segment FROM reps"
_SQL["dim_contracts"] = """SELECT c.contract_id, c.account_id, c.owner_id AS signing_owner_id, c.start_date, c.end_date, c.annual_commit_dollars,
    c.included_monthly_compute_credits, c.contract_term_months,
    CASE WHEN row_number() OVER (PARTITION BY c.account_id ORDER BY c.start_date, c.contract_id) = 1 THEN 'base'
      WHEN EXISTS (SELECT 1 FROM contracts e WHERE e.account_id = c.account_id AND e.end_date >= c.start_date
        AND (e.start_date < c.start_date OR (e.start_date = c.start_date AND e.contract_id < c.contract_id))) THEN 'expansion' ELSE 'renewal' END AS contract_type
    FROM all_contracts c"""
_SQL["dim_dates"] = f"""SELECT date, usage_logs, CAST(strftime(date, '%Y%m%d') AS BIGINT) AS date_id, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
    year(date) || '-Q' || quarter(date) AS year_quarter, CAST(month(date) AS INTEGER) AS month, strftime(date, '%B') AS month_name, strftime(date, '%b') AS month_short,
    strftime(date, '%Y-%m') AS year_month, CAST(strftime(date, '%U') AS INTEGER) AS week_of_year, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
    CAST(day(date) AS INTEGER) AS day_of_month, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, strftime(date, '%A') AS day_name, strftime(date, '%a') AS day_short,
    dayofweek(date) IN (0, 6) AS is_weekend, dayofweek(date) NOT IN (0, 6) AS is_weekday,
    day(date) = 1 AS is_month_start, date = last_day(date) AS is_month_end, CAST(date_trunc('month', date) AS DATE) AS month_start_date, last_day(date) AS month_end_date,
    date = date_trunc('quarter', date) AS is_quarter_start, date + 1 = date_trunc('quarter', date + 1) AS is_quarter_end,
    CAST(year(date) AS INTEGER) AS calendar_year, CAST(quarter(date) AS INTEGER) AS calendar_quarter, year(date) || '-Q' || quarter(date) AS calendar_year_quarter,
    CAST({_FY.format('date')} AS INTEGER) AS fiscal_year, 'FY' || ({_FY.format('date')}) AS fiscal_year_name, CAST((month(date) + 4) % 12 + 1 AS INTEGER) AS fiscal_month,
    CAST({_FQ.format('date')} AS INTEGER) AS fiscal_quarter, 'FY' || ({_FY.format('date')}) || '-Q' || ({_FQ.format('date')}) AS fiscal_year_quarter
    FROM (SELECT date, count(*) AS usage_logs FROM logs GROUP BY date)"""
_SQL["owner_as_of"] = """WITH signings AS (SELECT account_id, start_date, owner_id FROM all_contracts
      QUALIFY row_number() OVER (PARTITION BY account_id, start_date ORDER BY contract_id DESC) = 1)
    SELECT d.account_id, d.date, (SELECT s.owner_id FROM signings s WHERE s.account_id = d.account_id AND s.start_date <= d.date ORDER BY s.start_date DESC LIMIT 1) AS owner_id
    FROM daily_known d"""
_SQL["snapshot_latest"] = f"SELECT {_FACT_OUT} FROM fact"
_SQL["snapshot_as_of"] = f"SELECT {_FACT_OUT} FROM fact_s2"
_SQL["account_metrics_stored"] = _SQL["account_metrics"]
_SQL["usage_layer"] = """SELECT account_id, date, sum(CAST(round(compute_credits_consumed * 10000) AS BIGINT)) / 10000.0 AS credits_consumed, count(*) AS log_count
    FROM logs GROUP BY account_id, date"""
_SQL["snapshot_dates"] = """SELECT DISTINCT as_of_date FROM (SELECT as_of_date FROM active UNION ALL SELECT as_of_date FROM active_s1 UNION ALL SELECT as_of_date FROM active_s2)
    ORDER BY 1 DESC LIMIT 30"""
_SQL["retention_metrics"] = f"""WITH b AS (SELECT account_id, sum(annual_commit_dollars) AS begin_c, arg_min(end_date, (start_date, contract_id)) AS primary_end
      FROM contracts WHERE DATE '1999-06-30' BETWEEN start_date AND end_date GROUP BY 1),
    e AS (SELECT account_id, sum(annual_commit_dollars) AS end_c FROM contracts WHERE {D} BETWEEN start_date AND end_date GROUP BY 1),
    j AS (SELECT b.*, coalesce(end_c, 0) AS end_c, primary_end > DATE '1999-06-30' AND primary_end <= {D} AS up FROM b LEFT JOIN e USING (account_id)),
    t AS (SELECT count(*) AS accounts, {big('sum(begin_c)')} AS begin_acv, {big('coalesce(sum(end_c - begin_c) FILTER (WHERE end_c > begin_c), 0)')} AS expansion_acv,
      {big('coalesce(sum(begin_c - end_c) FILTER (WHERE end_c > 0 AND end_c < begin_c), 0)')} AS contraction_acv,
      {big('coalesce(sum(begin_c) FILTER (WHERE end_c = 0), 0)')} AS churned_acv, {cnt('up')} AS up_for_renewal, {cnt('up AND end_c = 0')} AS lost_accounts FROM j)
    SELECT *, {rnd(div('begin_acv + expansion_acv - contraction_acv - churned_acv', 'begin_acv'), 4)} AS nrr,
    {rnd(div('begin_acv - contraction_acv - churned_acv', 'begin_acv'), 4)} AS grr, {rnd(div('lost_accounts', 'up_for_renewal'), 4)} AS logo_churn FROM t"""
_KPIS = (
    ("org attainment", div(amt("f.cacv"), "sum(f.annual_commit_dollars) FILTER (WHERE NOT f.is_new_account)"), "0.85", ">="),
    ("shelfware rate", div(cnt("f.health_tier IN ('Shelfware', 'Inactive')"), "count(f.account_id)"), "0.08", "<="),
    ("expansion conversion", div(cnt("o.expansion_flag AND f.annual_commit_dollars > o.annual_commit_dollars"), cnt("o.expansion_flag")), "0.3", ">="),
    ("new account activation", div(cnt("r.is_new_account AND f.health_tier IN ('Healthy', 'Expansion')"), cnt("r.is_new_account")), "0.7", ">="),
)
_SQL["success_kpis"] = " UNION ALL ".join(
    f"SELECT '{k}' AS kpi, {rnd(e, 4)} AS value, {t}::DOUBLE AS target, {rnd(e, 4)} {op} {t}::DOUBLE AS met FROM fact f "
    "FULL JOIN fact_k2 r ON r.account_id = f.account_id FULL JOIN fact_k1 o ON o.account_id = coalesce(f.account_id, r.account_id)"
    for k, e, t, op in _KPIS
)
_SQL["run_log"] = f"""SELECT 'run-20000630' AS run_id, {D} AS as_of_date, '1' AS pipeline_version, 'manual' AS triggered_by, 'success' AS status,
    (SELECT count(*) FROM fact) AS rows_written_fact,
    (SELECT count(*) FROM accounts) + (SELECT count(*) FROM reps) + (SELECT count(*) FROM contracts) AS rows_written_dims, FALSE AS is_correction"""
_RUN = f"""{D} AS as_of_date, '1' AS pipeline_version"""
_SQL["run_log_all"] = f"""WITH n AS (SELECT (SELECT count(*) FROM fact) AS f, (SELECT count(*) FROM accounts) AS a,
      (SELECT count(*) FROM reps) + (SELECT count(*) FROM contracts) AS rest)
    SELECT 'run-20000630' AS run_id, {_RUN}, 'manual' AS triggered_by, 'success' AS status, f AS rows_written_fact, a + rest AS rows_written_dims,
      FALSE AS is_correction, CAST(NULL AS VARCHAR) AS correction_note, CAST(NULL AS VARCHAR) AS correction_approved_by, CAST(NULL AS VARCHAR) AS failed_layer FROM n
    UNION ALL SELECT 'broken-20000630', {_RUN}, 'scheduled', 'failed', f, a, FALSE, NULL, NULL, 'dim_reps' FROM n
    UNION ALL SELECT 'again-20000630', {_RUN}, 'correction', 'success', f, a + rest, TRUE, 'late amendment', 'finance', NULL FROM n"""
_SQL["key_remap"] = """WITH src AS (SELECT -1 - employee_id AS employee_id, name AS rep_name, region,
      CASE WHEN employee_id % 2 = 0 THEN 'Enterprise' ELSE segment END AS segment FROM reps),
    ns AS (SELECT *, row_number() OVER (PARTITION BY region, segment ORDER BY rep_name) - 1 AS i FROM src),
    nt AS (SELECT *, row_number() OVER (PARTITION BY region, segment ORDER BY employee_id) - 1 AS i, count(*) OVER (PARTITION BY region, segment) AS n FROM reps)
    SELECT s.employee_id AS source_key, s.region, s.segment, coalesce(t.employee_id, s.employee_id) AS target_key
    FROM ns s LEFT JOIN nt t ON t.region = s.region AND t.segment = s.segment AND t.i = s.i % t.n"""
_SQL["contracts_as_of"] = "SELECT * FROM amended_all"
_SQL["snapshot_corrections"] = """SELECT coalesce(o.account_id, n.account_id) AS account_id, coalesce(o.as_of_date, n.as_of_date) AS as_of_date,
    o.cacv AS old_cacv, o.health_tier AS old_health_tier, n.cacv AS new_cacv, n.health_tier AS new_health_tier
    FROM fact o FULL JOIN x_fact n ON n.account_id = o.account_id
    WHERE o.cacv IS DISTINCT FROM n.cacv OR o.health_tier IS DISTINCT FROM n.health_tier"""
_SQL["scd2_reps"] = """WITH q AS (SELECT owner_id AS employee_id, CAST(date_trunc('quarter', start_date) AS DATE) AS valid_from, sum(annual_commit_dollars) AS signed FROM all_contracts GROUP BY ALL),
    s AS (SELECT employee_id, valid_from, CASE WHEN signed >= 1500000 THEN 'Enterprise' WHEN signed >= 500000 THEN 'Mid-Market' ELSE 'Public Sector' END AS segment FROM q),
    c AS (SELECT * FROM s QUALIFY lag(segment) OVER (PARTITION BY employee_id ORDER BY valid_from) IS DISTINCT FROM segment)
    SELECT employee_id, segment, valid_from, lead(valid_from) OVER (PARTITION BY employee_id ORDER BY valid_from) - 1 AS valid_to,
    lead(valid_from) OVER (PARTITION BY employee_id ORDER BY valid_from) IS NULL AS is_current FROM c"""


def _field_at(field: str, kind: str) -> str:
    """Newest amendment of a field effective on the version day (earlier ones count from the start)."""
    return f"""coalesce((SELECT TRY_CAST(a.new_value AS {kind}) FROM amendments a WHERE a.contract_id = p.contract_id AND a.field_changed = '{field}'
      AND a.effective_date <= p.day ORDER BY a.effective_date DESC, a.amendment_id DESC, a.new_value DESC LIMIT 1), p.{field}) AS {field}"""


_SQL["scd2_contracts"] = f"""WITH p AS (SELECT DISTINCT c.*, d.day FROM all_contracts c JOIN
      (SELECT contract_id, start_date AS day FROM all_contracts UNION SELECT a.contract_id, greatest(a.effective_date, c.start_date) FROM amendments a JOIN all_contracts c USING (contract_id)) d
      ON d.contract_id = c.contract_id),
    v AS (SELECT p.contract_id, p.day, {_field_at('annual_commit_dollars', 'BIGINT')}, {_field_at('end_date', 'DATE')}, {_field_at('included_monthly_compute_credits', 'BIGINT')} FROM p),
    c AS (SELECT *, lag(day) OVER w AS before, lag(annual_commit_dollars) OVER w AS pa, lag(end_date) OVER w AS pe, lag(included_monthly_compute_credits) OVER w AS pi
      FROM v WINDOW w AS (PARTITION BY contract_id ORDER BY day)),
    k AS (SELECT * FROM c WHERE before IS NULL OR pa IS DISTINCT FROM annual_commit_dollars OR pe IS DISTINCT FROM end_date OR pi IS DISTINCT FROM included_monthly_compute_credits)
    SELECT contract_id, annual_commit_dollars, end_date, included_monthly_compute_credits, day AS valid_from,
    lead(day) OVER (PARTITION BY contract_id ORDER BY day) - 1 AS valid_to, lead(day) OVER (PARTITION BY contract_id ORDER BY day) IS NULL AS is_current FROM k"""

def _surrogate(key: str) -> str:
    return f"{key} * 65536 + (valid_from - DATE '1970-01-01') AS surrogate_key"


def _reason(key: str, reason: str) -> str:
    return f"CASE WHEN row_number() OVER (PARTITION BY {key} ORDER BY valid_from) > 1 THEN '{reason}' END AS change_reason"


_SQL["scd2_reps_stored"] = f"SELECT *, {_surrogate('employee_id')}, {_reason('employee_id', 'territory_reassignment')} FROM ({_SQL['scd2_reps']})"
_SQL["scd2_contracts_stored"] = (
    f"SELECT *, {_surrogate('contract_id')}, {_reason('contract_id', 'contract_amendment')} FROM ({_SQL['scd2_contracts']})"
)
_SQL["fact_bound"] = f"""SELECT f.account_id, f.as_of_date, f.employee_id, v.surrogate_key AS rep_surrogate_key, f.health_tier, f.cacv
    FROM fact f LEFT JOIN (SELECT *, {_surrogate('employee_id')} FROM ({_SQL['scd2_reps']})) v
    ON v.employee_id = f.employee_id AND f.as_of_date BETWEEN v.valid_from AND coalesce(v.valid_to, f.as_of_date)"""
_SQL["fact_corrections"] = f"""SELECT md5('second|' || account_id || '|' || as_of_date) AS correction_id, 'second' AS pipeline_run_id, *, 'revops' AS corrected_by,
    'amendments signed late' AS correction_reason, 'FY2000-Q4' AS comp_period_affected,
    coalesce(old_cacv, 0) > coalesce(new_cacv, 0) AS clawback_triggered,
    CASE WHEN coalesce(old_cacv, 0) > coalesce(new_cacv, 0) THEN round(coalesce(old_cacv, 0) - coalesce(new_cacv, 0), 2) END AS clawback_amount, 'cfo' AS approved_by
    FROM (SELECT coalesce(o.account_id, n.account_id) AS account_id, {D} AS as_of_date,
      o.cacv AS old_cacv, n.cacv AS new_cacv, o.health_tier AS old_health_tier, n.health_tier AS new_health_tier
      FROM fact o FULL JOIN x_fact n ON n.account_id = o.account_id
      WHERE o.account_id IS NULL OR n.account_id IS NULL OR o.cacv IS DISTINCT FROM n.cacv OR o.health_tier IS DISTINCT FROM n.health_tier)"""
_SQL["fact_provenance"] = """SELECT account_id, as_of_date, health_tier, cacv, 'first' AS pipeline_run_id, FALSE AS is_correction FROM fact_s1
    UNION ALL SELECT account_id, as_of_date, health_tier, cacv, 'first', FALSE FROM fact_s2
    UNION ALL SELECT n.account_id, n.as_of_date, n.health_tier, n.cacv, CASE WHEN o IS NOT DISTINCT FROM n THEN 'first' ELSE 'second' END,
      o.account_id IS NOT NULL AND o IS DISTINCT FROM n FROM x_fact n LEFT JOIN fact o ON o.account_id = n.account_id"""

# Streams: what is final once the watermark has passed
_SQL["stream_daily_usage_final"] = """SELECT * FROM (SELECT user_id AS account_id, CAST(ts AS DATE) AS date, CAST(sum(CAST(value AS DECIMAL(28,12))) AS DOUBLE) AS credits_consumed, count(*) AS log_count
    FROM events GROUP BY ALL) WHERE date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY"""
_SQL["stream_daily_usage_all"] = """SELECT user_id AS account_id, CAST(ts AS DATE) AS date, CAST(sum(CAST(value AS DECIMAL(28,12))) AS DOUBLE) AS credits_consumed, count(*) AS log_count,
    CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY AS is_final FROM events WHERE ts IS NOT NULL GROUP BY user_id, CAST(ts AS DATE)"""
_SQL["stream_daily_usage"] = _SQL["stream_daily_usage_all"]
_SQL["stream_late_usage"] = """WITH e AS (SELECT *, ts >= TIMESTAMP '2024-01-16' OR CAST(ts AS DATE) + INTERVAL 1 DAY > (SELECT max(ts) FROM events) - INTERVAL 2 DAY AS ok FROM events)
    SELECT user_id AS account_id, CAST(ts AS DATE) AS date, CAST(sum(CAST(value AS DECIMAL(28,12))) AS DOUBLE) AS credits_consumed, count(*) AS log_count,
      CASE WHEN coalesce(ok, FALSE) THEN 'daily' ELSE 'late' END AS route FROM e GROUP BY user_id, CAST(ts AS DATE), coalesce(ok, FALSE)"""
_SQL["stream_dedup"] = "SELECT event_id AS log_id, user_id AS account_id, CAST(ts AS DATE) AS date, value AS credits FROM events"
_SQL["stream_guarded"] = """SELECT event_id AS log_id, user_id AS account_id, CAST(ts AS DATE) AS date, value AS credits,
    CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND CAST(ts AS DATE) BETWEEN DATE '2023-12-25' + CAST(c_custkey % 20 AS INTEGER)
      AND DATE '2023-12-25' + CAST(c_custkey % 20 AS INTEGER) + 15) THEN 'accepted' ELSE 'rejected' END AS route FROM events"""
_SQL["stream_guarded_versions"] = """SELECT event_id AS log_id, user_id AS account_id, CAST(ts AS DATE) AS date, value AS credits,
    CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND CAST(ts AS DATE) BETWEEN DATE '2023-12-25' + CAST(c_custkey % 20 AS INTEGER)
      AND DATE '2023-12-25' + CAST(c_custkey % 20 AS INTEGER) + 15 + CASE WHEN event_id % 2 = 0 THEN 0 ELSE 10 END) THEN 'accepted' ELSE 'rejected' END AS route FROM events"""
_SQL["stream_inactivity"] = """WITH used AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(28,12))) AS credits FROM events GROUP BY ALL),
    term AS (SELECT c_custkey AS account_id, DATE '2023-12-25' + CAST(c_custkey % 20 AS INTEGER) AS s, 18000 + 6000 * (c_custkey % 4) AS allowance FROM customer),
    days AS (SELECT account_id, allowance, CAST(unnest(generate_series(s, s + 39, INTERVAL 1 DAY)) AS DATE) AS day FROM term),
    low AS (SELECT d.account_id, d.day, coalesce(u.credits, 0) AS credits,
        d.day - CAST(row_number() OVER (PARTITION BY d.account_id ORDER BY d.day) AS INTEGER) AS island
      FROM days d LEFT JOIN used u ON u.user_id = d.account_id AND u.day = d.day
      WHERE d.day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY AND CAST(coalesce(u.credits, 0) AS DOUBLE) * 30 / allowance < 0.05)
    SELECT account_id, min(day) AS quiet_since, min(day) + 2 AS flagged_on, CAST(sum(credits) FILTER (WHERE place <= 3) AS DOUBLE) AS credits_in_run
    FROM (SELECT *, row_number() OVER (PARTITION BY account_id, island ORDER BY day) AS place FROM low) GROUP BY account_id, island HAVING count(*) >= 3"""
_SQL["stream_silence"] = """WITH s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM
      (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
    SELECT user_id AS account_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS silent_since, count(*) AS events_before FROM s GROUP BY user_id, island
    HAVING max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in _SQL.items()}
