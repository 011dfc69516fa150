"""Named SELECTs shared by the oracle statements; each may use those above it."""

from __future__ import annotations

import re

from tidemark import fixed

SALT = "check-salt"
M = "DECIMAL(18,2)"


def _case(column: str, pairs: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" if isinstance(k, str) else f"WHEN {k} THEN {v!r}" for k, v in pairs.items())
    return f"CASE {column} {whens}{f' ELSE {default!r}' if default else ''} END"


def _fx(currency: str) -> str:
    whens = " ".join(f"WHEN {k!r} THEN CAST({v} AS DECIMAL(9,4))" for k, v in fixed.FX_RATES.items())
    return f"CASE {currency} {whens} ELSE CAST(1 AS DECIMAL(9,4)) END"


def _ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0))"


SK = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"
ISO_SK = "strftime(strptime(CAST(date_sk AS VARCHAR), '%Y%m%d'), '%Y-%m-%d')"

VIEWS: dict[str, str] = {
    "src_customers": """
        SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS segment, n_name AS country,
               strftime(DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER), '%Y-%m-%d') AS onboarded_date
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "src_accounts": f"""
        SELECT c_custkey AS account_id, c_custkey AS customer_id,
               {_case('c_custkey % 4', {0: 'current', 1: 'savings', 2: 'deposit', 3: 'loan'})} AS product_type,
               {_case('c_custkey % 6', {4: 'dormant', 5: 'closed'}, 'active')} AS status,
               CAST(c_acctbal AS {M}) AS balance,
               {_case('c_nationkey % 6', {2: 'GBP', 3: 'USD', 4: 'CHF', 5: 'JPY'}, 'EUR')} AS currency
        FROM customer""",
    "src_loans": f"""
        SELECT o_orderkey AS loan_id, o_custkey AS account_id,
               CAST(round(CAST(o_totalprice AS {M}) * CAST(0.001 AS DECIMAL(4,3)), 2) AS {M}) AS principal_outstanding,
               CAST(CAST(2.5 AS DECIMAL(6,1)) + CAST(o_orderkey % 71 AS DECIMAL(4,0)) * CAST(0.1 AS DECIMAL(2,1))
                    AS DECIMAL(6,1)) AS interest_rate,
               CAST(CASE o_orderstatus WHEN 'P' THEN 1 + o_orderkey % 89 WHEN 'O' THEN 90 + o_orderkey % 271
                    ELSE 0 END AS INTEGER) AS days_past_due,
               CASE o_orderstatus WHEN 'P' THEN 'delinquent' WHEN 'O' THEN 'default' ELSE 'current' END AS status
        FROM orders""",
    "raw_transactions": f"""
        SELECT event_id AS txn_id, user_id AS account_id, CAST(ts AS TIMESTAMP) AS posting_ts,
               CAST(value AS {M}) AS v, CAST(floor(event_id / 6) AS BIGINT) AS block,
               {_case('event_id % 6', {0: 'payment', 1: 'transfer', 2: 'fee', 3: 'interest', 4: 'withdrawal',
                                       5: 'deposit'})} AS txn_type,
               {_case('event_type', {'click': 'mobile', 'view': 'web', 'purchase': 'card', 'signup': 'branch',
                                     'error': 'atm'})} AS channel,
               {_case('event_id % 22', {19: 'GBP', 20: 'USD', 21: 'CHF'}, 'EUR')} AS currency,
               'Party ' || CAST(event_id % 997 AS VARCHAR) AS counterparty, props
        FROM events""",
    "src_transactions": f"""
        SELECT * EXCLUDE (v, block),
               CAST(CASE WHEN txn_type IN ('deposit', 'interest') THEN abs(v)
                         WHEN txn_type IN ('fee', 'withdrawal', 'payment') THEN -abs(v)
                         WHEN block % 2 = 0 THEN v ELSE -v END AS {M}) AS amount
        FROM raw_transactions""",
    "days": "SELECT DISTINCT CAST(ts AS DATE) AS d FROM events",
    "src_account_snapshots": f"""
        SELECT a.* EXCLUDE (balance), d AS snapshot_date,
               CAST(round(balance * (CAST(1 AS DECIMAL(9,4)) + CAST(0.0015 AS DECIMAL(9,4))
                    * CAST(day(d) AS DECIMAL(4,0))), 2) AS {M}) AS balance
        FROM src_accounts a, days""",
    "src_loan_snapshots": f"""
        SELECT l.* EXCLUDE (principal_outstanding), d AS snapshot_date,
               CAST(round(principal_outstanding * (CAST(1 AS DECIMAL(9,4)) + CAST(0.0008 AS DECIMAL(9,4))
                    * CAST(day(d) AS DECIMAL(4,0))), 2) AS {M}) AS principal_outstanding
        FROM src_loans l, days""",
    "src_lines": f"""
        SELECT l_orderkey * 10 + l_linenumber AS line_key, l_orderkey, l_partkey, l_suppkey,
               CAST(l_quantity AS {M}) AS quantity, CAST(l_extendedprice AS {M}) AS price,
               CAST(l_discount AS {M}) AS discount, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date
        FROM lineitem""",
    "channels": "SELECT * FROM (VALUES "
    + ", ".join(f"({n!r}, {str(d).upper()})" for n, d in fixed.CHANNELS)
    + ") t(channel, is_digital)",
    "dim_customer": "SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, * FROM src_customers",
    "dim_account": """
        SELECT row_number() OVER (ORDER BY a.account_id) AS account_sk, a.account_id, a.customer_id, a.product_type,
               a.status, c.customer_sk
        FROM src_accounts a LEFT JOIN dim_customer c ON a.customer_id = c.customer_id""",
    "dim_channel": "SELECT CAST(row_number() OVER (ORDER BY channel) AS INTEGER) AS channel_sk, * FROM channels",
    "txn_values": f"""
        SELECT txn_id, account_id, channel, txn_type, currency, amount, posting_ts,
               CAST(round(amount * {_fx('currency')}, 2) AS {M}) AS amount_eur,
               coalesce(txn_type = 'fee', FALSE) AS is_fee, coalesce(txn_type = 'interest', FALSE) AS is_interest,
               {SK.format('posting_ts')} AS date_sk
        FROM src_transactions""",
    "fact_transaction": """
        SELECT t.txn_id, t.amount_eur, t.txn_type, t.is_fee, t.is_interest, t.date_sk, a.account_sk, c.channel_sk
        FROM txn_values t LEFT JOIN dim_account a ON t.account_id = a.account_id
             LEFT JOIN dim_channel c ON t.channel = c.channel""",
    "fact_account_balance": f"""
        SELECT CAST(round(s.balance * {_fx('s.currency')}, 2) AS {M}) AS balance_eur,
               s.product_type IN ('current', 'savings', 'deposit') AS is_deposit, s.product_type = 'loan' AS is_loan,
               {SK.format('s.snapshot_date')} AS date_sk, a.account_sk
        FROM src_account_snapshots s LEFT JOIN dim_account a ON s.account_id = a.account_id""",
    "fact_loan": f"""
        SELECT s.loan_id, s.principal_outstanding AS principal_outstanding_eur, s.interest_rate, s.days_past_due,
               s.days_past_due >= 90 AS is_npl, {SK.format('s.snapshot_date')} AS date_sk, a.account_sk,
               CASE WHEN s.days_past_due > -1 AND s.days_past_due <= 0 THEN 'current'
                    WHEN s.days_past_due > 0 AND s.days_past_due <= 89 THEN 'delinquent'
                    WHEN s.days_past_due > 89 AND s.days_past_due <= 10000 THEN 'default' END AS status
        FROM src_loan_snapshots s LEFT JOIN dim_account a ON s.account_id = a.account_id""",
    "d_dep": f"""
        SELECT {ISO_SK} AS date, coalesce(sum(balance_eur) FILTER (WHERE is_deposit), 0) AS deposits
        FROM fact_account_balance GROUP BY date_sk""",
    "d_loan": f"""
        SELECT {ISO_SK} AS date, sum(principal_outstanding_eur) AS loans,
               coalesce(sum(principal_outstanding_eur) FILTER (WHERE is_npl), 0) AS npl
        FROM fact_loan GROUP BY date_sk""",
    "d_txn": f"""
        SELECT {ISO_SK} AS date, count(*) AS n, sum(abs(amount_eur)) AS value,
               -coalesce(sum(amount_eur) FILTER (WHERE is_fee), 0) AS fee,
               coalesce(sum(amount_eur) FILTER (WHERE is_interest), 0) AS interest,
               count(DISTINCT customer_sk) AS active,
               count(*) FILTER (WHERE is_digital) AS digital, count(is_digital) AS known
        FROM fact_transaction f LEFT JOIN dim_account a ON f.account_sk = a.account_sk
             LEFT JOIN dim_channel c ON f.channel_sk = c.channel_sk
        GROUP BY date_sk""",
    "kpi": f"""
        SELECT d.date, CAST(deposits AS DOUBLE) AS total_deposits_eur,
               round((CAST(deposits AS DOUBLE) - lag(CAST(deposits AS DOUBLE)) OVER w)
                     / nullif(lag(CAST(deposits AS DOUBLE)) OVER w, 0) * 100, 2) AS deposits_growth_pct,
               CAST(loans AS DOUBLE) AS net_loans_eur,
               round((CAST(loans AS DOUBLE) - lag(CAST(loans AS DOUBLE)) OVER w)
                     / nullif(lag(CAST(loans AS DOUBLE)) OVER w, 0) * 100, 2) AS loans_growth_pct,
               round({_ratio('loans', 'deposits')}, 4) AS loan_to_deposit_ratio,
               round(round({_ratio('coalesce(interest, 0)', 'loans')}, 4) * 100, 4) AS nim_pct,
               CAST(coalesce(fee, 0) AS DOUBLE) AS fee_income_eur, CAST(coalesce(n, 0) AS BIGINT) AS txn_count,
               CAST(coalesce(value, 0) AS DOUBLE) AS txn_value_eur,
               round(round({_ratio('npl', 'loans')}, 4) * 100, 2) AS npl_rate_pct,
               CAST(coalesce(active, 0) AS BIGINT) AS active_customers,
               CAST(coalesce(active, 0) - lag(coalesce(active, 0)) OVER w AS BIGINT) AS net_new_customers,
               round({_ratio('digital', 'known')} * 100, 2) AS digital_channel_mix_pct
        FROM d_dep d JOIN d_loan l ON d.date = l.date LEFT JOIN d_txn t ON d.date = t.date
        WINDOW w AS (ORDER BY d.date)""",
    "kpi_long": " UNION ALL ".join(
        f"SELECT date, '{k}' AS kpi, CAST({k} AS DOUBLE) AS value FROM kpi" for k in fixed.KPI_COLUMNS
    ),
    "mart_segment": f"""
        SELECT {ISO_SK} AS date, segment, CAST(sum(balance_eur) AS DOUBLE) AS deposits_eur
        FROM fact_account_balance b JOIN dim_account a ON b.account_sk = a.account_sk
             JOIN dim_customer c ON a.customer_sk = c.customer_sk
        WHERE is_deposit AND segment IS NOT NULL GROUP BY date_sk, segment""",
    "mart_channel": f"""
        SELECT {ISO_SK} AS date, channel, is_digital, count(*) AS txn_count,
               CAST(sum(abs(amount_eur)) AS DOUBLE) AS txn_value_eur
        FROM fact_transaction f JOIN dim_channel c ON f.channel_sk = c.channel_sk
        GROUP BY date_sk, channel, is_digital""",
    "mart_status": f"""
        SELECT {ISO_SK} AS date, status, CAST(sum(principal_outstanding_eur) AS DOUBLE) AS principal_outstanding_eur
        FROM fact_loan WHERE status IS NOT NULL GROUP BY date_sk, status""",
    "mart_source": f"""
        SELECT {ISO_SK} AS date,
               {_case('txn_type', {'withdrawal': 'trades', 'interest': 'loans', 'deposit': 'deposits', 'fee': 'cards',
                                   'payment': 'payments', 'transfer': 'transfers'})} AS source,
               count(*) AS volume, CAST(sum(abs(amount_eur)) AS DOUBLE) AS value_eur
        FROM fact_transaction GROUP BY 1, 2""",
    "telemetry": """
        SELECT strftime(posting_ts, '%Y-%m-%d') AS date, channel, CAST(json_extract(props, '$.k') AS INTEGER) AS ms
        FROM src_transactions""",
    "mart_ops_channel": """
        SELECT date, channel, count(*) AS volume,
               round(avg(CASE WHEN ms >= 5 THEN 1.0::DOUBLE ELSE 0.0 END) * 100, 2) AS uptime_pct,
               round(avg(ms), 2) AS avg_processing_ms
        FROM telemetry WHERE channel IS NOT NULL GROUP BY date, channel""",
    "mart_ops_daily": """
        SELECT date, count(*) AS txn_processed,
               round(avg(CASE WHEN ms >= 5 THEN 1.0::DOUBLE ELSE 0.0 END) * 100, 2) AS stp_rate_pct,
               count(*) FILTER (WHERE ms < 5) AS exceptions, round(avg(ms), 2) AS avg_processing_ms,
               round(avg(CASE WHEN ms <= 90 THEN 1.0::DOUBLE ELSE 0.0 END) * 100, 2) AS sla_adherence_pct
        FROM telemetry GROUP BY date""",
    "mart_department": f"""
        SELECT '2024-01-30' AS date, n_name AS department, count(*) AS headcount,
               CAST(sum(abs(CAST(s_acctbal AS {M}))) AS DOUBLE) AS payroll_cost_eur,
               round({_ratio(f'sum(abs(CAST(s_acctbal AS {M})))', 'count(*)')}, 2) AS cost_per_head_eur,
               round({_ratio(f'sum(abs(CAST(s_acctbal AS {M})))', f'sum(sum(abs(CAST(s_acctbal AS {M})))) OVER ()')}
                     * 100, 2) AS share_pct
        FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
    "states": """
        SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS as_of, o_orderpriority AS priority
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1""",
    "changes": """
        SELECT customer_id, as_of, priority FROM states
        QUALIFY lag(priority) OVER (PARTITION BY customer_id ORDER BY as_of) IS DISTINCT FROM priority""",
    "versions": """
        SELECT customer_id, priority, as_of AS valid_from,
               lead(as_of) OVER (PARTITION BY customer_id ORDER BY as_of) AS valid_to
        FROM changes""",
    "day_checks": """
        SELECT strftime(posting_ts, '%Y-%m-%d') AS day, c.name AS check_name, sum(CASE c.name
                 WHEN 'not_null[txn_id]' THEN CAST(txn_id IS NULL AS INTEGER)
                 WHEN 'not_null[account_id]' THEN CAST(account_id IS NULL AS INTEGER)
                 WHEN 'not_null[posting_ts]' THEN CAST(posting_ts IS NULL AS INTEGER)
                 WHEN 'not_null[amount]' THEN CAST(amount IS NULL AS INTEGER)
                 WHEN 'allowed_values[txn_type]' THEN CAST(txn_type IS NULL AS INTEGER)
                 WHEN 'allowed_values[channel]' THEN 0
                 WHEN 'range[amount]' THEN CAST(amount < -150 OR amount > 150 AS INTEGER)
                 ELSE 0 END) + CASE WHEN c.name = 'unique[txn_id]' THEN count(*) - count(DISTINCT txn_id) ELSE 0 END AS n
        FROM src_transactions, (VALUES ('not_null[txn_id]'), ('not_null[account_id]'), ('not_null[posting_ts]'),
             ('not_null[amount]'), ('unique[txn_id]'), ('allowed_values[txn_type]'), ('allowed_values[channel]'),
             ('range[amount]')) c(name)
        GROUP BY 1, 2""",
    "day_runs": """
        SELECT day, sum(n) AS bad FROM day_checks GROUP BY day""",
    "lines_bad": """
        SELECT *, quantity < 1 OR quantity > 45 AS r_quantity, discount < 0 OR discount > 0.05 AS r_discount,
               l_returnflag NOT IN ('A', 'N') AS r_flag, l_linestatus NOT IN ('F', 'O') AS r_status
        FROM src_lines""",
}


def build(body: str) -> str:
    """``body`` with the views that it needs in front, in order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", todo.pop())))
        for name in (words & set(VIEWS)) - needed:
            needed.add(name)
            todo.append(VIEWS[name])
    ctes = [f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body.strip()
