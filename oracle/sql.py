"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.views import ISO_SK, SALT, _ratio, build
from tidemark import fixed
from tidemark.sources.bank import LINES_CONTRACT

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
COLUMNS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
           "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}
KPI_TABLES = {
    "gold.kpi_daily": "kpi", "gold.deposits_by_segment": "mart_segment", "gold.txn_by_channel": "mart_channel",
    "gold.loans_by_status": "mart_status", "gold.activity_by_source": "mart_source",
    "gold.ops_by_channel": "mart_ops_channel", "gold.ops_processing_daily": "mart_ops_daily",
    "gold.hr_by_department": "mart_department",
}
MART_COLUMNS = {
    "mart_department": {"date", "department", "headcount", "payroll_cost_eur", "cost_per_head_eur", "share_pct"},
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _values(view: str, fields: list[str], where: str, extra: str = "NULL AS x") -> str:
    return _union(
        [f"SELECT '{f}' AS series, {extra}, CAST({f} AS DOUBLE) AS value FROM {view} WHERE {where}" for f in fields]
    )


def _latest(view: str, where: str = "TRUE") -> str:
    return f"{where} AND date = (SELECT max(date) FROM {view} WHERE {where})"


def _resolve() -> str:
    parts = []
    for t in fixed.TEMPLATES:
        for i, v in enumerate(t["visuals"], start=1):
            kind, view = v[0], KPI_TABLES.get(v[1])
            head = f"'{t['id']}' AS template, CAST({i} AS BIGINT) AS visual"
            known = MART_COLUMNS.get(view)
            wanted = v[2] if kind == "kpi_cards" else v[3] if kind == "line" else [v[3]]
            if view is None or (known and not known & set(wanted)):
                parts.append(f"SELECT {head}, 'empty' AS type, '{v[1]}' AS series, NULL AS x, NULL AS value")
                continue
            scope = "source = 'loans'" if v[-1] is True else "TRUE"
            if kind == "kpi_cards":
                body = _values(view, v[2], _latest(view, scope), "CAST(NULL AS VARCHAR) AS x")
            elif kind == "line":
                body = _values(view, v[3], scope, f"{v[2]} AS x")
            else:
                body = (
                    f"SELECT '{v[3]}' AS series, {v[2]} AS x, "
                    f"CAST(sum(CAST({v[3]} AS DECIMAL(38,6))) AS DOUBLE) AS value "
                    f"FROM {view} WHERE {_latest(view)} GROUP BY {v[2]}"
                )
            parts.append(f"SELECT {head}, '{kind}' AS type, series, x, value FROM ({body})")
    return _union(parts)


def _route() -> str:
    text = "lower(text)"
    source = "CASE " + " ".join(
        f"WHEN contains({text}, '{s.rstrip('s')}') THEN '{s}'" for s in fixed.KNOWN_SOURCES
    ) + " END"
    rows = []
    for i, t in enumerate(fixed.TEMPLATES):
        score = " + ".join(f"CAST(contains(low, '{k}') AS BIGINT)" for k in [*t["keywords"], t["domain"]])
        by_source = bool(t.get("by_source"))
        if by_source:
            score += " + CAST(src IS NOT NULL AS BIGINT)"
        chosen = "coalesce(src, 'trades')" if by_source else "CAST(NULL AS VARCHAR)"
        rows.append(
            f"SELECT conv_id, turn, '{t['id']}' AS template, '{t['domain']}' AS domain, {score} AS score, "
            f"{chosen} AS source, {i} AS pos FROM asked"
        )
    return f"""
        WITH asked AS (SELECT conv_id, turn, {text} AS low, {source} AS src FROM conversations WHERE role = 'user'),
             scored AS ({_union(rows)})
        SELECT conv_id, turn, template, domain, score, source FROM scored
        QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, pos) = 1"""


def _trailing(daily: str) -> str:
    return f"""
        SELECT date, n, trailing_avg, round(dev, 2) AS deviation_pct,
               CASE WHEN trailing_avg IS NULL THEN 'warn' WHEN round(dev, 2) > 40 THEN 'fail'
                    WHEN round(dev, 2) > 20 THEN 'warn' ELSE 'pass' END AS outcome
        FROM (SELECT *, abs((n - trailing_avg) / nullif(trailing_avg, 0) * 100) AS dev
              FROM (SELECT *, avg(nullif(n, 0)) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS trailing_avg
                    FROM (SELECT strftime(day, '%Y-%m-%d') AS date, coalesce(n, 0) AS n
                          FROM (SELECT unnest(generate_series(min(CAST(date AS DATE)), max(CAST(date AS DATE)), INTERVAL 1 DAY)) AS day
                                FROM ({daily}))
                          LEFT JOIN ({daily}) ON date = strftime(day, '%Y-%m-%d'))))"""


def _check(source: str, view: str, name: str, bad: str, detail: str, fine: str) -> str:
    return (
        f"SELECT '{source}' AS source, '{name}' AS \"check\", CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS outcome, "
        f"CASE WHEN n > 0 THEN {detail} ELSE '{fine}' END AS detail FROM (SELECT {bad} AS n FROM {view})"
    )


def _validate_one(source: str, view: str, contract: dict, absent: list[str]) -> list[str]:
    columns = contract.get("required_columns", [])
    text = f"missing: [''{absent[0]}'']" if absent else f"all {len(columns)} present"
    out = [
        f"SELECT '{source}' AS source, 'required_columns' AS \"check\", '{'fail' if absent else 'pass'}' AS outcome, "
        f"'{text}' AS detail"
    ]
    for x in contract.get("not_null", []):
        out.append(_check(source, view, f"not_null[{x}]", f"count(*) FILTER (WHERE {x} IS NULL)",
                          "n || ' null(s)'", "no nulls"))
    for x in contract.get("unique", []):
        out.append(_check(source, view, f"unique[{x}]",
                          f"count(*) - count(DISTINCT {x}) - CAST(count(*) > count({x}) AS INTEGER)",
                          "n || ' duplicate(s)'", "all unique"))
    for x, allowed in contract.get("allowed_values", {}).items():
        inside = ", ".join(f"'{a}'" for a in allowed)
        bad = f"(SELECT list_sort(list(DISTINCT {x})) FROM {view} WHERE {x} NOT IN ({inside}))"
        out.append(_check(source, view, f"allowed_values[{x}]", f"count(*) FILTER (WHERE {x} NOT IN ({inside}))",
                          f"'unexpected: [''' || array_to_string({bad}, ''', ''') || ''']'", "within allowed set"))
    for x, b in contract.get("ranges", {}).items():
        lo, hi = b.get("min"), b.get("max")
        bad = f"count(*) FILTER (WHERE {x} < {lo} OR {x} > {hi})" if None not in (lo, hi) else "count(*) FILTER (WHERE FALSE)"
        out.append(_check(source, view, f"range[{x}]", bad, f"n || ' outside [{lo},{hi}]'", f"within [{lo},{hi}]"))
    if "row_count" in contract:
        out.append(f"SELECT '{source}' AS source, 'row_count_tolerance' AS \"check\", 'warn' AS outcome, "
                   "'skipped — needs trailing history (available once runs accumulate)' AS detail")
    return out


def _validate() -> str:
    c = fixed.CONTRACTS
    with_date = "(SELECT *, 1 AS snapshot_date FROM {})"
    parts = (
        _validate_one("accounts", with_date.format("src_accounts"), c["accounts"], [])
        + _validate_one("customers", "src_customers", c["customers"], [])
        + _validate_one("loans", with_date.format("src_loans"), c["loans"], [])
        + _validate_one("transactions", "src_transactions", c["transactions"], [])
        + _validate_one("lines", "src_lines", LINES_CONTRACT, ["tax"])
    )
    return _union(parts)


TXN_JOIN = """fact_transaction f LEFT JOIN dim_account a ON f.account_sk = a.account_sk
             LEFT JOIN dim_customer c ON a.customer_sk = c.customer_sk
             LEFT JOIN dim_channel ch ON f.channel_sk = ch.channel_sk"""
BAL_JOIN = """fact_account_balance f LEFT JOIN dim_account a ON f.account_sk = a.account_sk
             LEFT JOIN dim_customer c ON a.customer_sk = c.customer_sk"""
LOAN_JOIN = """fact_loan f LEFT JOIN dim_account a ON f.account_sk = a.account_sk
             LEFT JOIN dim_customer c ON a.customer_sk = c.customer_sk"""
LAST_BAL = "f.date_sk = (SELECT max(date_sk) FROM fact_account_balance)"
LAST_LOAN = "f.date_sk = (SELECT max(date_sk) FROM fact_loan)"


def _statements() -> dict[str, str]:
    s: dict[str, str] = {}

    # scans, sources, sinks
    s["scan_table"] = """
        SELECT customer_id, segment, CASE WHEN segment NOT IN ('AUTOMOBILE', 'BUILDING') THEN country END AS country
        FROM src_customers"""
    s["write_overwrite"] = """
        SELECT loan_id, CAST(principal_outstanding AS DOUBLE) AS principal_outstanding, 'b2' AS _batch FROM src_loans"""
    s["write_batch_replace"] = """
        SELECT txn_id, CAST(amount AS DOUBLE) AS amount,
               'core_transactions:' || strftime(posting_ts, '%Y-%m-%d') AS _batch FROM src_transactions"""
    s["land_since"] = """
        SELECT txn_id, CAST(amount AS DOUBLE) AS amount,
               'core_transactions:' || strftime(posting_ts, '%Y-%m-%d') AS _batch,
               CASE WHEN posting_ts < TIMESTAMP '2024-01-16' THEN 'run-0' ELSE 'run-1' END AS run FROM src_transactions"""
    s["merge_batch"] = """
        SELECT txn_id, CAST(CASE WHEN _batch = '2024-01-30' THEN amount * 2 ELSE amount END AS DOUBLE) AS amount, _batch
        FROM (SELECT txn_id, amount, strftime(posting_ts, '%Y-%m-%d') AS _batch FROM src_transactions)"""
    s["table_row_count"] = _union(
        ["SELECT 'accounts' AS \"table\", count(*) AS rows FROM customer", "SELECT 'customers', count(*) FROM customer",
         "SELECT 'loans', count(*) FROM orders", "SELECT 'transactions', count(*) FROM events",
         "SELECT 'reference_products', 4", "SELECT 'reference_branches', 8", "SELECT 'reference_channels', 5"]
    )
    last = "(SELECT strftime(max(ts), '%Y-%m-%d') FROM events)"
    s["land_bronze"] = f"""
        SELECT 'core_transactions' AS source, 'core_transactions:' || strftime(ts, '%Y-%m-%d') AS batch_id,
               'run-1' AS run_id, count(*) AS rows FROM events GROUP BY 2
        UNION ALL SELECT 'accounts', 'accounts:' || {last}, 'run-1', count(*) FROM customer
        UNION ALL SELECT 'customers', 'customers:' || {last}, 'run-1', count(*) FROM customer
        UNION ALL SELECT 'loans', 'loans:' || {last}, 'run-1', count(*) FROM orders"""
    s["add_lineage"] = """
        SELECT o_orderkey, 'orders' AS source, 'orders:2024-01-30' AS batch_id, 'run-1' AS run_id,
               TRUE AS has_file, TRUE AS has_time FROM orders"""
    s["incremental_window"] = """
        SELECT txn_id, account_id, CAST(amount AS DOUBLE) AS amount FROM src_transactions
        WHERE CAST(posting_ts AS DATE) = DATE '2024-01-15'"""
    s["source_connectors"] = """
        SELECT connector, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
               max(o_orderkey) AS last_key
        FROM orders, (VALUES ('parquet'), ('orc'), ('csv'), ('json')) v(connector) GROUP BY connector"""
    s["sql_query"] = """
        SELECT a.product_type, count(*) AS loans, CAST(sum(l.principal_outstanding) AS DOUBLE) AS principal
        FROM src_loans l JOIN src_accounts a ON l.account_id = a.account_id GROUP BY a.product_type"""

    # projections
    s["fx_normalize"] = """
        SELECT txn_id, currency, CAST(amount AS DOUBLE) AS amount, CAST(amount_eur AS DOUBLE) AS amount_eur
        FROM txn_values"""
    s["tokenize_pii"] = f"""
        SELECT customer_id, substr(sha256('{SALT}:' || full_name), 1, 16) AS customer_token FROM src_customers"""
    s["drop_pii"] = f"""
        SELECT txn_id, account_id, CAST(amount AS DOUBLE) AS amount, currency, txn_type, channel,
               substr(sha256('{SALT}:' || counterparty), 1, 16) AS counterparty_token FROM src_transactions"""
    s["date_sk"] = "SELECT txn_id, date_sk FROM txn_values"
    s["txn_flags"] = "SELECT txn_id, is_fee, is_interest FROM txn_values"
    s["balance_flags"] = """
        SELECT account_id, product_type IN ('current', 'savings', 'deposit') AS is_deposit,
               product_type = 'loan' AS is_loan FROM src_accounts"""
    s["npl_flag"] = "SELECT loan_id, days_past_due >= 90 AS is_npl FROM src_loans"
    s["loan_bucket"] = """
        SELECT loan_id, CASE WHEN days_past_due > -1 AND days_past_due <= 0 THEN 'current'
            WHEN days_past_due > 0 AND days_past_due <= 89 THEN 'delinquent'
            WHEN days_past_due > 89 AND days_past_due <= 10000 THEN 'default' END AS status FROM src_loans"""
    s["signed_amount"] = """
        SELECT txn_id, txn_type, CAST(CASE WHEN txn_type IN ('deposit', 'interest', 'transfer') THEN abs(amount)
            ELSE -abs(amount) END AS DOUBLE) AS amount FROM src_transactions"""
    fact_txn = "txn_id, CAST(amount_eur AS DOUBLE) AS amount_eur, txn_type, is_fee, is_interest, date_sk, account_sk, channel_sk"
    s["day_filter"] = f"SELECT {fact_txn} FROM fact_transaction WHERE date_sk = 20240115"
    s["latest_date_rows"] = f"SELECT * FROM mart_status WHERE {_latest('mart_status')}"
    s["source_filter"] = "SELECT * FROM mart_source WHERE source = 'loans'"

    # joins
    s["dim_account_customer"] = "SELECT account_id, customer_sk, product_type, status FROM dim_account"
    s["fact_txn_keys"] = f"SELECT {fact_txn} FROM fact_transaction"
    s["fact_balance_keys"] = """
        SELECT CAST(balance_eur AS DOUBLE) AS balance_eur, is_deposit, is_loan, date_sk, account_sk
        FROM fact_account_balance"""
    s["fact_loan_keys"] = """
        SELECT l.loan_id, CAST(l.principal_outstanding AS DOUBLE) AS principal_outstanding_eur,
               CAST(l.interest_rate AS DOUBLE) AS interest_rate, l.days_past_due, l.days_past_due >= 90 AS is_npl,
               20240130 AS date_sk, a.account_sk
        FROM src_loans l LEFT JOIN dim_account a ON l.account_id = a.account_id"""
    s["txn_customer"] = """
        SELECT f.txn_id, f.account_sk, a.customer_sk, f.date_sk
        FROM fact_transaction f LEFT JOIN dim_account a ON f.account_sk = a.account_sk"""
    s["txn_channel"] = """
        SELECT f.txn_id, c.channel, c.is_digital, CAST(f.amount_eur AS DOUBLE) AS amount_eur
        FROM fact_transaction f LEFT JOIN dim_channel c ON f.channel_sk = c.channel_sk"""
    s["balance_segment"] = f"""
        SELECT f.account_sk, f.date_sk, a.customer_sk, c.segment, CAST(f.balance_eur AS DOUBLE) AS balance_eur
        FROM {BAL_JOIN}"""
    relations = [("accounts", "customer", "c_custkey", "customer", "c_custkey"),
                 ("transactions", "events", "user_id", "customer", "c_custkey"),
                 ("loans", "orders", "o_custkey", "customer", "c_custkey"),
                 ("customers without postings", "customer", "c_custkey", "events", "user_id"),
                 ("orders without lines", "orders", "o_orderkey", "lineitem", "l_orderkey")]
    s["orphan_keys"] = _union(
        [f"""SELECT '{name}' AS relation, count(*) AS orphans FROM (SELECT DISTINCT {key} AS k FROM {child}) c
             WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.k)"""
         for name, child, key, parent, parent_key in relations]
    )
    s["unresolved_fk"] = """
        SELECT count(*) FILTER (WHERE o_custkey IS NULL) AS unresolved, count(*) AS rows
        FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey"""
    s["stable_keys"] = """
        WITH o AS (SELECT DISTINCT o_custkey AS customer_id, strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month FROM orders),
        r AS (SELECT DISTINCT month FROM o ORDER BY month DESC LIMIT 6),
        f AS (SELECT customer_id, greatest(min(month), (SELECT min(month) FROM r)) AS wave,
                     min(month) < (SELECT min(month) FROM r) AS early FROM o GROUP BY customer_id),
        k AS (SELECT customer_id, row_number() OVER (ORDER BY NOT early, wave, customer_id) AS customer_sk FROM f)
        SELECT month, customer_id, customer_sk FROM o JOIN k USING (customer_id) WHERE month IN (SELECT month FROM r)"""
    s["fx_daily"] = """
        SELECT * FROM (WITH q AS (SELECT currency, CAST(posting_ts AS DATE) AS d, CAST(max(abs(amount)) / 100 AS DECIMAL(9,4)) AS rate
                   FROM src_transactions WHERE currency <> 'EUR' AND abs(amount) > 100 GROUP BY 1, 2),
        t AS (SELECT txn_id, currency, amount, CAST(posting_ts AS DATE) AS d FROM src_transactions)
        SELECT txn_id, t.currency, CAST(coalesce(rate, 1) AS DOUBLE) AS rate,
               CAST(CAST(round(amount * coalesce(rate, CAST(1 AS DECIMAL(9,4))), 2) AS DECIMAL(18,2)) AS DOUBLE) AS amount_eur
        FROM t ASOF LEFT JOIN q ON t.currency = q.currency AND t.d >= q.d)"""
    s["scd2_splice"] = """
        SELECT * FROM (WITH late AS (SELECT customer_id, segment AS priority FROM src_customers),
        log AS (
          SELECT customer_id, valid_from AS as_of, priority, 0 AS rank FROM versions
          UNION ALL SELECT customer_id, DATE '1996-07-01', priority, 2 FROM late
          UNION ALL SELECT v.customer_id, DATE '1996-07-02', v.priority, 1 FROM versions v JOIN late USING (customer_id)
            WHERE valid_from < DATE '1996-07-02' AND coalesce(valid_to, DATE '9999-12-31') > DATE '1996-07-02'),
        one AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY customer_id, as_of ORDER BY rank DESC) = 1),
        cut AS (SELECT * FROM one
                QUALIFY lag(priority) OVER (PARTITION BY customer_id ORDER BY as_of) IS DISTINCT FROM priority)
        SELECT customer_id, priority, CAST(as_of AS VARCHAR) AS valid_from,
               CAST(lead(as_of) OVER w AS VARCHAR) AS valid_to, lead(as_of) OVER w IS NULL AS is_current
        FROM cut WINDOW w AS (PARTITION BY customer_id ORDER BY as_of))"""
    s["kpi_pivot"] = "PIVOT (SELECT kpi, 'd' || replace(date, '-', '') AS day, value FROM kpi_long) ON day USING first(value) GROUP BY kpi"
    s["active_bits"] = """
        SELECT segment, CAST(grouping(segment) AS INTEGER) AS level, CAST(count(DISTINCT a.customer_sk) AS BIGINT) AS active
        FROM fact_transaction f JOIN dim_account a ON f.account_sk = a.account_sk
             JOIN dim_customer c ON a.customer_sk = c.customer_sk GROUP BY ROLLUP (segment)"""
    cell_txn = f"""SELECT {ISO_SK} AS date, {{0}}, count(DISTINCT a.customer_sk) AS active
        FROM fact_transaction f LEFT JOIN dim_account a ON f.account_sk = a.account_sk
             LEFT JOIN dim_customer c ON a.customer_sk = c.customer_sk
             LEFT JOIN dim_channel h ON f.channel_sk = h.channel_sk GROUP BY date_sk, {{0}}"""
    growth = "(CAST(n.{0} AS DOUBLE) - CAST(p.{0} AS DOUBLE)) / nullif(CAST(p.{0} AS DOUBLE), 0) * 100"
    s["growth_by_segment"] = f"""
        SELECT * FROM (WITH b AS (SELECT {ISO_SK} AS date, segment, coalesce(sum(balance_eur) FILTER (WHERE is_deposit), 0) AS deposits
                   FROM fact_account_balance f LEFT JOIN dim_account a ON f.account_sk = a.account_sk
                        LEFT JOIN dim_customer c ON a.customer_sk = c.customer_sk GROUP BY date_sk, segment),
        l AS (SELECT {ISO_SK} AS date, segment, sum(principal_outstanding_eur) AS loans
              FROM fact_loan f LEFT JOIN dim_account a ON f.account_sk = a.account_sk
                   LEFT JOIN dim_customer c ON a.customer_sk = c.customer_sk GROUP BY date_sk, segment),
        t AS ({cell_txn.format('segment')}),
        s AS (SELECT date, segment FROM b UNION SELECT date, segment FROM l UNION SELECT date, segment FROM t),
        g AS (SELECT d.date, e.segment FROM (SELECT DISTINCT date FROM s) d, (SELECT DISTINCT segment FROM s) e),
        n AS (SELECT g.date, g.segment, deposits, loans, active FROM g
              LEFT JOIN b ON g.date = b.date AND g.segment IS NOT DISTINCT FROM b.segment
              LEFT JOIN l ON g.date = l.date AND g.segment IS NOT DISTINCT FROM l.segment
              LEFT JOIN t ON g.date = t.date AND g.segment IS NOT DISTINCT FROM t.segment)
        SELECT n.date, n.segment, CAST(n.deposits AS DOUBLE) AS total_deposits,
               {growth.format('deposits')} AS deposits_growth_pct, {growth.format('loans')} AS loans_growth_pct,
               n.active AS active_customers, coalesce(n.active, 0) - coalesce(p.active, 0) AS net_new_customers
        FROM n LEFT JOIN n p ON CAST(p.date AS DATE) = CAST(n.date AS DATE) - 1 AND p.segment IS NOT DISTINCT FROM n.segment)"""
    s["growth_by_channel"] = f"""
        SELECT * FROM (WITH t AS ({cell_txn.format('channel')}),
        g AS (SELECT d.date, e.channel FROM (SELECT DISTINCT date FROM t) d, (SELECT DISTINCT channel FROM t) e),
        n AS (SELECT g.date, g.channel, active, CASE WHEN t.date IS NOT NULL THEN deposits END AS deposits,
                     CASE WHEN t.date IS NOT NULL THEN loans END AS loans
              FROM g LEFT JOIN t ON g.date = t.date AND g.channel IS NOT DISTINCT FROM t.channel
              LEFT JOIN d_dep ON g.date = d_dep.date LEFT JOIN d_loan ON g.date = d_loan.date)
        SELECT n.date, n.channel, {growth.format('deposits')} AS deposits_growth_pct,
               {growth.format('loans')} AS loans_growth_pct, coalesce(n.active, 0) - coalesce(p.active, 0) AS net_new_customers
        FROM n LEFT JOIN n p ON CAST(p.date AS DATE) = CAST(n.date AS DATE) - 1 AND p.channel IS NOT DISTINCT FROM n.channel)"""
    s["scd2_asof"] = """
        SELECT f.*, v.priority, CAST(v.valid_from AS VARCHAR) AS valid_from
        FROM (SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, o_custkey AS customer_id,
                     CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) f
        LEFT JOIN versions v ON f.customer_id = v.customer_id AND CAST(f.ship_date AS DATE) >= v.valid_from
             AND CAST(f.ship_date AS DATE) < coalesce(v.valid_to, DATE '9999-12-31')"""

    # aggregates
    s["total_deposits"] = "SELECT date, CAST(deposits AS DOUBLE) AS total_deposits_eur FROM d_dep"
    s["net_loans"] = "SELECT date, CAST(loans AS DOUBLE) AS net_loans_eur FROM d_loan"
    s["loan_to_deposit"] = "SELECT date, loan_to_deposit_ratio FROM kpi"
    s["fee_income"] = "SELECT date, CAST(fee AS DOUBLE) AS fee_income_eur FROM d_txn"
    s["nim"] = "SELECT date, nim_pct FROM kpi"
    s["npl_rate"] = "SELECT date, npl_rate_pct FROM kpi"
    s["active_customers"] = "SELECT date, active AS active_customers FROM d_txn"
    s["digital_mix"] = "SELECT date, digital_channel_mix_pct FROM kpi"
    s["txn_volume_value"] = "SELECT date, n AS txn_count, CAST(value AS DOUBLE) AS txn_value_eur FROM d_txn"
    s["kpi_daily"] = "SELECT * FROM kpi"
    s["deposits_by_segment"] = "SELECT * FROM mart_segment"
    s["txn_by_channel"] = "SELECT * FROM mart_channel"
    s["loans_by_status"] = "SELECT * FROM mart_status"
    s["value_counts"] = _union(
        [f"SELECT '{x}' AS \"column\", {x} AS value, count(*) AS n FROM src_transactions WHERE {x} IS NOT NULL GROUP BY {x}"
         for x in ["currency", "txn_type", "channel"]]
    )
    s["numeric_profile"] = """
        SELECT CAST(min(amount) AS DOUBLE) AS min, CAST(max(amount) AS DOUBLE) AS max,
               CAST(sum(amount) AS DOUBLE) / CAST(count(amount) AS DOUBLE) AS mean FROM src_transactions"""
    s["share_of"] = """
        SELECT 'EUR postings' AS what, CAST(count(*) FILTER (WHERE currency = 'EUR') AS DOUBLE)
               / CAST(count(*) AS DOUBLE) * 100 AS share FROM src_transactions
        UNION ALL SELECT 'loans 90 days past due', CAST(count(*) FILTER (WHERE days_past_due >= 90) AS DOUBLE)
               / CAST(count(*) AS DOUBLE) * 100 FROM src_loans"""
    s["sum_by_dim"] = f"""
        SELECT channel AS x, txn_value_eur AS value FROM mart_channel WHERE {_latest('mart_channel')}"""
    txn_parts = """
        coalesce(sum(amount_eur) FILTER (WHERE is_interest), 0) AS interest,
        -coalesce(sum(amount_eur) FILTER (WHERE is_fee), 0) AS fee, count(*) AS volume, sum(abs(amount_eur)) AS value,
        count(DISTINCT a.customer_sk) AS active, count(*) FILTER (WHERE is_digital) AS digital"""
    loan_parts = """sum(principal_outstanding_eur) AS loans,
        coalesce(sum(principal_outstanding_eur) FILTER (WHERE is_npl), 0) AS npl"""
    bal_parts = "coalesce(sum(balance_eur) FILTER (WHERE is_deposit), 0) AS deposits"
    s["measures_by_dims"] = f"""
        SELECT coalesce(b.date, l.date, t.date) AS date, coalesce(b.segment, l.segment, t.segment) AS segment,
               CAST(deposits AS DOUBLE) AS total_deposits, CAST(loans AS DOUBLE) AS net_loans,
               {_ratio('loans', 'deposits')} AS loan_to_deposit_ratio,
               {_ratio('interest', 'loans')} * 100 AS net_interest_margin_pct, CAST(fee AS DOUBLE) AS fee_income,
               volume AS transaction_volume, CAST(value AS DOUBLE) AS transaction_value,
               {_ratio('npl', 'loans')} * 100 AS npl_rate_pct, active AS active_customers,
               {_ratio('digital', 'volume')} * 100 AS digital_channel_mix_pct
        FROM (SELECT {ISO_SK} AS date, segment, {bal_parts} FROM {BAL_JOIN} GROUP BY date_sk, segment) b
        FULL JOIN (SELECT {ISO_SK} AS date, segment, {loan_parts} FROM {LOAN_JOIN} GROUP BY date_sk, segment) l
             ON b.date = l.date AND b.segment = l.segment
        FULL JOIN (SELECT {ISO_SK} AS date, segment, {txn_parts} FROM {TXN_JOIN} GROUP BY date_sk, segment) t
             ON coalesce(b.date, l.date) = t.date AND coalesce(b.segment, l.segment) = t.segment"""
    s["measures_by_product"] = f"""
        SELECT coalesce(b.product_type, l.product_type, t.product_type) AS product_type,
               CAST(deposits AS DOUBLE) AS total_deposits, CAST(loans AS DOUBLE) AS net_loans,
               {_ratio('npl', 'loans')} * 100 AS npl_rate_pct, CAST(value AS DOUBLE) AS transaction_value
        FROM (SELECT product_type, {bal_parts} FROM {BAL_JOIN} WHERE {LAST_BAL} GROUP BY product_type) b
        FULL JOIN (SELECT product_type, {loan_parts} FROM {LOAN_JOIN} WHERE {LAST_LOAN} GROUP BY product_type) l
             ON b.product_type = l.product_type
        FULL JOIN (SELECT product_type, {txn_parts} FROM {TXN_JOIN} GROUP BY product_type) t
             ON coalesce(b.product_type, l.product_type) = t.product_type"""
    s["measures_by_channel"] = f"""
        SELECT channel, volume AS transaction_volume, CAST(fee AS DOUBLE) AS fee_income,
               CAST(loans AS DOUBLE) AS net_loans, {_ratio('interest', 'loans')} * 100 AS net_interest_margin_pct
        FROM (SELECT channel, {txn_parts} FROM {TXN_JOIN} GROUP BY channel),
             (SELECT {loan_parts} FROM fact_loan f WHERE {LAST_LOAN})"""
    s["measures_rollup"] = f"""
        SELECT coalesce(b.country, l.country, t.country) AS country, coalesce(b.segment, l.segment, t.segment) AS segment,
               coalesce(b.level, l.level, t.level) AS level,
               CAST(deposits AS DOUBLE) AS total_deposits, CAST(loans AS DOUBLE) AS net_loans,
               active AS active_customers, volume AS transaction_volume
        FROM (SELECT country, segment, CAST(grouping(country, segment) AS INTEGER) AS level, {bal_parts}
              FROM {BAL_JOIN} WHERE {LAST_BAL} GROUP BY ROLLUP (country, segment)) b
        FULL JOIN (SELECT country, segment, CAST(grouping(country, segment) AS INTEGER) AS level, {loan_parts}
              FROM {LOAN_JOIN} WHERE {LAST_LOAN} GROUP BY ROLLUP (country, segment)) l
             ON b.country IS NOT DISTINCT FROM l.country AND b.segment IS NOT DISTINCT FROM l.segment
                AND b.level = l.level
        FULL JOIN (SELECT country, segment, CAST(grouping(country, segment) AS INTEGER) AS level, {txn_parts}
              FROM {TXN_JOIN} GROUP BY ROLLUP (country, segment)) t
             ON coalesce(b.country, l.country) IS NOT DISTINCT FROM t.country
                AND coalesce(b.segment, l.segment) IS NOT DISTINCT FROM t.segment
                AND coalesce(b.level, l.level) = t.level"""
    s["measures_cube"] = f"""
        SELECT channel, segment, CAST(grouping(channel, segment) AS INTEGER) AS level, count(*) AS transaction_volume,
               CAST(sum(abs(amount_eur)) AS DOUBLE) AS transaction_value,
               count(DISTINCT a.customer_sk) AS active_customers
        FROM {TXN_JOIN} GROUP BY CUBE (channel, segment)"""
    s["txn_net_flow"] = f"""
        SELECT account_sk, {ISO_SK} AS date,
               CAST(coalesce(sum(amount_eur) FILTER (WHERE amount_eur > 0), 0) AS DOUBLE) AS credits,
               CAST(coalesce(sum(-amount_eur) FILTER (WHERE amount_eur < 0), 0) AS DOUBLE) AS debits,
               CAST(sum(amount_eur) AS DOUBLE) AS net_flow_eur
        FROM fact_transaction GROUP BY account_sk, date_sk"""
    s["segment_growth"] = """
        SELECT *, round((deposits_eur - lag(deposits_eur) OVER w) / nullif(lag(deposits_eur) OVER w, 0) * 100, 2)
               AS growth_pct
        FROM mart_segment WINDOW w AS (PARTITION BY segment ORDER BY date)"""
    s["npl_by_product"] = f"""
        SELECT {ISO_SK} AS date, f.status, a.product_type,
               CAST(sum(principal_outstanding_eur) AS DOUBLE) AS principal_outstanding_eur,
               CAST(coalesce(sum(principal_outstanding_eur) FILTER (WHERE is_npl), 0) AS DOUBLE) AS npl_eur
        FROM fact_loan f JOIN dim_account a ON f.account_sk = a.account_sk
        WHERE f.status IS NOT NULL GROUP BY date_sk, f.status, a.product_type"""
    s["activity_by_source"] = "SELECT * FROM mart_source"
    s["ops_by_channel"] = "SELECT * FROM mart_ops_channel"
    s["ops_processing_daily"] = "SELECT * FROM mart_ops_daily"
    s["by_department"] = "SELECT * FROM mart_department"

    # windows
    s["growth_pct"] = "SELECT date, deposits_growth_pct, loans_growth_pct FROM kpi"
    s["net_new_customers"] = "SELECT date, active_customers, net_new_customers FROM kpi"
    s["growth_calendar_day"] = """
        SELECT c.date, c.total_deposits_eur,
               (c.total_deposits_eur - p.total_deposits_eur) / nullif(p.total_deposits_eur, 0) * 100 AS growth_pct
        FROM kpi c LEFT JOIN kpi p ON CAST(p.date AS DATE) = CAST(c.date AS DATE) - 1"""
    s["history_7"] = """
        SELECT date, count(*) OVER w AS days, string_agg(date, ',') OVER w AS dates,
               string_agg(CAST(txn_count AS VARCHAR), ',') OVER w AS txn_counts
        FROM kpi WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
    s["latest_row"] = f"""
        SELECT date, n AS txn_count, CAST(value AS DOUBLE) AS txn_value_eur FROM d_txn WHERE {_latest('d_txn')}"""
    s["first_row_per_day"] = """
        SELECT strftime(posting_ts, '%Y-%m-%d') AS date, txn_id, account_id, CAST(amount AS DOUBLE) AS amount
        FROM src_transactions
        QUALIFY row_number() OVER (PARTITION BY strftime(posting_ts, '%Y-%m-%d') ORDER BY posting_ts DESC, txn_id DESC) = 1"""
    s["surrogate_key"] = "SELECT row_number() OVER (ORDER BY txn_id) AS txn_sk, txn_id FROM src_transactions"
    s["dedup_latest"] = """
        SELECT line_key, l_orderkey, l_partkey, l_suppkey, CAST(quantity AS DOUBLE) AS quantity,
               CAST(price AS DOUBLE) AS price, CAST(discount AS DOUBLE) AS discount, l_returnflag, l_linestatus,
               CAST(ship_date AS VARCHAR) AS ship_date
        FROM src_lines
        QUALIFY row_number() OVER (PARTITION BY line_key ORDER BY src_lines.ship_date DESC, l_orderkey DESC,
            l_partkey DESC, l_suppkey DESC, src_lines.quantity DESC, src_lines.price DESC, src_lines.discount DESC,
            l_returnflag DESC, l_linestatus DESC) = 1"""
    s["running_balance"] = """
        SELECT txn_id, account_id, CAST(t.amount_eur AS DOUBLE) AS amount_eur,
               CAST(sum(t.amount_eur) OVER (PARTITION BY account_id ORDER BY posting_ts, txn_id
                    ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance_eur
        FROM txn_values t"""
    s["scd2_history"] = """
        SELECT customer_id, priority, CAST(v.valid_from AS VARCHAR) AS valid_from,
               CAST(v.valid_to AS VARCHAR) AS valid_to, v.valid_to IS NULL AS is_current FROM versions v"""
    s["trailing_row_count"] = _trailing("SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events GROUP BY 1")
    flat = [x for x in fixed.KPI_COLUMNS if not x.endswith("growth_pct") and x != "net_new_customers"]
    s["kpi_swing"] = f"""
        SELECT date, kpi, value, swing_pct, CASE WHEN abs(swing_pct) > 10 THEN 'warn' ELSE 'pass' END AS outcome
        FROM (SELECT *, round((value - lag(value) OVER w) / nullif(lag(value) OVER w, 0) * 100, 2) AS swing_pct
              FROM kpi_long WHERE kpi IN ({', '.join(repr(x) for x in flat)})
              WINDOW w AS (PARTITION BY kpi ORDER BY date))"""
    s["sort_limit"] = """
        SELECT loan_id, CAST(l.principal_outstanding AS DOUBLE) AS principal_outstanding FROM src_loans l
        ORDER BY l.principal_outstanding DESC, loan_id LIMIT 20"""

    # streams give what the batch gives
    s["stream_bronze"] = """
        SELECT txn_id, account_id, CAST(amount AS DOUBLE) AS amount, strftime(posting_ts, '%Y-%m-%d') AS day
        FROM src_transactions"""
    daily = """
        SELECT strftime(posting_ts, '%Y-%m-%d') AS date, channel, count(*) AS txn_count,
               CAST(sum(abs(amount)) AS DOUBLE) AS txn_value FROM src_transactions GROUP BY 1, 2"""
    s["stream_daily_txn"] = daily
    s["stream_closed_days"] = f"""
        SELECT * FROM ({daily}) WHERE CAST(date AS TIMESTAMP) + INTERVAL 1 DAY
            <= (SELECT max(posting_ts) - INTERVAL 2 DAY FROM src_transactions)"""
    s["stream_dedup"] = """
        SELECT account_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM src_transactions GROUP BY account_id"""

    # set operations and reshape
    s["dim_date"] = """
        SELECT DISTINCT date_sk, strftime(d, '%Y-%m-%d') AS date, CAST(month(d) AS INTEGER) AS month,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year
        FROM (SELECT date_sk, strptime(CAST(date_sk AS VARCHAR), '%Y%m%d') AS d FROM
              (SELECT date_sk FROM fact_transaction UNION SELECT date_sk FROM fact_account_balance
               UNION SELECT date_sk FROM fact_loan))"""
    s["union_batches"] = """
        SELECT account_id, product_type, CAST(balance AS DOUBLE) AS balance, CAST(NULL AS BIGINT) AS loan_id,
               CAST(NULL AS DOUBLE) AS principal_outstanding FROM src_accounts
        UNION ALL SELECT account_id, NULL, NULL, loan_id, CAST(principal_outstanding AS DOUBLE) FROM src_loans"""
    s["unexpected_values"] = """
        SELECT 'segment' AS "column", segment AS value, count(*) AS n FROM src_customers
        WHERE segment NOT IN ('retail', 'sme', 'corporate', 'private') GROUP BY segment"""
    s["kpi_transpose"] = "SELECT date, kpi, value FROM kpi_long"
    s["json_extract"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"

    # quality
    s["dq_not_null"] = """
        SELECT 'not_null[c_name]' AS "check", count(*) FILTER (WHERE c_name IS NULL) AS n FROM customer
        UNION ALL SELECT 'not_null[order_sk]', count(*) FILTER (WHERE o_custkey IS NULL)
        FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey"""
    s["dq_unique"] = """
        SELECT 'unique[line_key]' AS "check", count(*) - count(DISTINCT line_key)
               - CAST(count(*) > count(line_key) AS INTEGER) AS n FROM src_lines"""
    s["dq_allowed_values"] = """
        SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS n FROM lineitem
        WHERE l_returnflag NOT IN ('A', 'N') GROUP BY l_returnflag
        UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem
        WHERE l_linestatus NOT IN ('F', 'O') GROUP BY l_linestatus"""
    s["dq_range"] = """
        SELECT 'range[quantity]' AS "check", count(*) FILTER (WHERE r_quantity) AS n FROM lines_bad
        UNION ALL SELECT 'range[discount]', count(*) FILTER (WHERE r_discount) FROM lines_bad
        UNION ALL SELECT 'range[price]', 0"""
    s["dq_row_count"] = _trailing(
        "SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, count(*) AS n FROM lineitem GROUP BY 1"
    )
    s["dq_validate"] = _validate()
    worst = "CASE max(CASE outcome WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END) WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END"
    s["dq_gate"] = f"""
        SELECT source, {worst} AS outcome FROM ({_validate()}) GROUP BY source
        UNION ALL SELECT 'all', {worst} FROM ({_validate()})"""
    s["dq_silver"] = """
        SELECT 'silver' AS stage, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS outcome,
               CASE WHEN n = 0 THEN name ELSE name || ': ' || n || ' ' || word END AS details
        FROM (SELECT 'fact_transaction.account_sk resolves' AS name, 'unresolved' AS word,
                     count(*) FILTER (WHERE account_sk IS NULL) AS n FROM fact_transaction
              UNION ALL SELECT 'fact_transaction.amount_eur not null', 'null',
                     count(*) FILTER (WHERE amount_eur IS NULL) FROM fact_transaction
              UNION ALL SELECT 'amounts EUR-normalized (no currency col)', '', 0
              UNION ALL SELECT 'fact_loan.account_sk resolves', 'unresolved',
                     count(*) FILTER (WHERE account_sk IS NULL) FROM fact_loan)"""
    s["dq_gold_bounds"] = _union(
        [f"""SELECT date, '{k}' AS kpi, {k} AS value, CAST({lo} AS DOUBLE) AS low, CAST({hi} AS DOUBLE) AS high,
             CASE WHEN {k} IS NULL OR {k} BETWEEN {lo} AND {hi} THEN 'pass' ELSE 'fail' END AS outcome
             FROM kpi WHERE {_latest('kpi')}""" for k, (lo, hi) in fixed.GOLD_BOUNDS.items()]
    )
    s["dq_quarantine"] = """
        SELECT line_key, l_partkey, CAST(quantity AS DOUBLE) AS quantity, CAST(discount AS DOUBLE) AS discount,
               l_returnflag, concat_ws(';', CASE WHEN r_flag THEN 'allowed_values[l_returnflag]' END,
                   CASE WHEN r_status THEN 'allowed_values[l_linestatus]' END,
                   CASE WHEN r_quantity THEN 'range[quantity]' END, CASE WHEN r_discount THEN 'range[discount]' END) AS failed
        FROM lines_bad WHERE r_flag OR r_status OR r_quantity OR r_discount"""
    s["gate_decision"] = """
        SELECT 'run-' || day AS run_id, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS outcome, layer,
               CAST(retries AS BIGINT) AS retries,
               CASE WHEN bad = 0 OR layer = 'gold' THEN 'proceed'
                    WHEN CAST(substr(day, 9, 2) AS INTEGER) % 2 = 0 THEN 'halt'
                    WHEN retries >= 1 THEN 'escalate' ELSE 'retry' END AS action
        FROM day_runs, (VALUES ('bronze'), ('gold')) l(layer), (VALUES (0), (1)) r(retries)"""

    # reports and runs
    s["report_kpi_cards"] = "SELECT series, value FROM (" + _values(
        "kpi", fixed.TEMPLATES[0]["visuals"][0][2], _latest("kpi")) + ")"
    s["report_line"] = _values("kpi", ["total_deposits_eur", "net_loans_eur"], "TRUE", "date AS x")
    s["report_bar"] = f"""
        SELECT segment AS x, deposits_eur AS value FROM mart_segment WHERE {_latest('mart_segment')}"""
    s["report_resolve"] = _resolve()
    s["route_requests"] = _route()
    drill = [("deposits_by_segment", "mart_segment", "segment", ["deposits_eur"]),
             ("txn_by_channel", "mart_channel", "channel", ["txn_count", "txn_value_eur"]),
             ("loans_by_status", "mart_status", "status", ["principal_outstanding_eur"])]
    s["dashboard_context"] = _union(
        [f"""SELECT 'latest' AS section, series AS name, x, value
             FROM ({_values('kpi', fixed.KPI_COLUMNS, _latest('kpi'), 'CAST(NULL AS VARCHAR) AS x')})""",
         f"""SELECT 'series' AS section, kpi AS name, date AS x, round(value, 2) AS value FROM kpi_long
             WHERE kpi IN ({', '.join(repr(x) for x in fixed.DASHBOARD_SERIES)})"""]
        + [f"SELECT '{section}' AS section, series AS name, x, value FROM ({_values(view, ys, _latest(view), f'{x} AS x')})"
           for section, view, x, ys in drill]
    )
    row = """'{"date":"' || date || '","txn_count":' || txn_count || ',"active_customers":' || active_customers || '}'"""
    s["briefing_context"] = f"""
        SELECT k.date, {row.replace('date ||', 'k.date ||')} AS today,
               '[' || string_agg({row.replace('date ||', 'k.date ||')}, ',') OVER w || ']' AS history,
               CASE WHEN bad > 0 THEN '["bronze:range[amount]: ' || bad || ' row(s)"]' ELSE '[]' END AS qa_notes
        FROM kpi k LEFT JOIN day_runs r ON k.date = r.day
        WINDOW w AS (ORDER BY k.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
    s["lake_profile"] = _union(
        [f"""SELECT '{t}' AS "table", count(*) AS rows, CAST({COLUMNS[t]} AS BIGINT) AS business_columns,
             CAST(0 AS BIGINT) AS lineage_columns FROM {t}""" for t in TABLES]
    )
    s["manifest_qa"] = """
        SELECT 'run-' || day AS run_id, 'bronze:' || check_name AS stage,
               CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS outcome, n || ' row(s)' AS details FROM day_checks"""
    s["manifest_audit"] = """
        SELECT actor, count(*) AS entries, CAST(sum(CASE actor WHEN 'extraction' THEN n ELSE bad END) AS BIGINT) AS rows,
               round(sum(span), 3) AS duration_s,
               count(*) FILTER (WHERE actor = 'validation' AND bad > 0) AS errors
        FROM (SELECT strftime(posting_ts, '%Y-%m-%d') AS day, count(*) AS n,
                     CAST(floor(epoch(max(posting_ts))) - floor(epoch(min(posting_ts))) AS DOUBLE) AS span
              FROM src_transactions GROUP BY 1) d JOIN day_runs r ON d.day = r.day,
             (VALUES ('extraction'), ('validation')) a(actor)
        GROUP BY actor"""
    s["manifest_stages"] = """
        SELECT 'run-' || day AS run_id, CASE WHEN bad > 0 THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN bad > 0 THEN 'failed' ELSE 'passed' END AS extract,
               CASE WHEN bad > 0 THEN 'pending' ELSE 'passed' END AS transform,
               CASE WHEN bad > 0 THEN 'pending' ELSE 'passed' END AS aggregate FROM day_runs"""
    return s


def statements() -> dict[str, str]:
    return {name: _prepared(body) for name, body in _statements().items()}


def _prepared(body: str) -> str:
    """A statement that opens with its own WITH keeps it; others get the shared views in front."""
    return body.strip() if body.lstrip().startswith("WITH") else build(body)
