"""Lookups, contracts and report templates that results depend on."""

from __future__ import annotations

# EUR per unit of currency. A currency that is not listed counts as EUR.
BASE_CURRENCY = "EUR"
FX_RATES = {"EUR": "1.00", "GBP": "1.17", "USD": "0.92", "CHF": "1.04"}

# Product groups and lookups.
DEPOSIT_PRODUCTS = ["current", "savings", "deposit"]
LOAN_PRODUCT = "loan"
PRODUCTS = [
    ("current", "Current Account"),
    ("savings", "Savings Account"),
    ("deposit", "Term Deposit"),
    ("loan", "Loan Facility"),
]
CHANNELS = [("mobile", True), ("web", True), ("atm", False), ("branch", False), ("card", False)]
BRANCH_CITIES = ["Dublin", "Cork", "Galway", "Limerick", "Frankfurt", "Paris", "Madrid", "Milan"]
NPL_DAYS = 90

# Plausible ranges of the newest KPI row.
GOLD_BOUNDS = {
    "npl_rate_pct": (0, 100),
    "digital_channel_mix_pct": (0, 100),
    "loan_to_deposit_ratio": (0, 10),
}

# Columns of the daily KPI mart, in order.
KPI_COLUMNS = [
    "total_deposits_eur", "deposits_growth_pct", "net_loans_eur", "loans_growth_pct",
    "loan_to_deposit_ratio", "nim_pct", "fee_income_eur", "txn_count", "txn_value_eur",
    "npl_rate_pct", "active_customers", "net_new_customers", "digital_channel_mix_pct",
]

# KPI series of the dashboard.
DASHBOARD_SERIES = [
    "total_deposits_eur", "net_loans_eur", "loan_to_deposit_ratio", "npl_rate_pct", "txn_count",
    "txn_value_eur", "digital_channel_mix_pct", "nim_pct", "fee_income_eur", "active_customers",
    "deposits_growth_pct",
]

# Data contracts per source.
CONTRACTS = {
    "transactions": {
        "required_columns": ["txn_id", "account_id", "posting_ts", "amount", "currency", "txn_type", "channel"],
        "not_null": ["txn_id", "account_id", "posting_ts", "amount"],
        "unique": ["txn_id"],
        "allowed_values": {
            "txn_type": ["payment", "transfer", "fee", "interest", "withdrawal", "deposit"],
            "channel": ["mobile", "web", "atm", "branch", "card"],
        },
        "ranges": {"amount": {"min": -1000000, "max": 1000000}},
        "row_count": {"tolerance_pct": 40},
    },
    "accounts": {
        "required_columns": [
            "account_id", "customer_id", "product_type", "status", "balance", "currency", "snapshot_date",
        ],
        "not_null": ["account_id", "customer_id", "product_type"],
        "unique": ["account_id"],
        "allowed_values": {
            "product_type": ["current", "savings", "deposit", "loan"],
            "status": ["active", "dormant", "closed"],
        },
    },
    "customers": {
        "required_columns": ["customer_id", "segment", "country", "onboarded_date"],
        "not_null": ["customer_id", "segment"],
        "unique": ["customer_id"],
        "allowed_values": {"segment": ["retail", "sme", "corporate", "private"]},
    },
    "loans": {
        "required_columns": [
            "loan_id", "account_id", "principal_outstanding", "interest_rate", "days_past_due", "status",
            "snapshot_date",
        ],
        "not_null": ["loan_id", "account_id", "principal_outstanding"],
        "unique": ["loan_id"],
        "allowed_values": {"status": ["current", "delinquent", "default"]},
        "ranges": {
            "days_past_due": {"min": 0, "max": 3650},
            "principal_outstanding": {"min": 0, "max": 100000000},
        },
    },
}

# Texts of check results; {} takes the number, the values or the limits.
DETAILS = {
    "required_columns": ("all {} present", "missing: {}"),
    "not_null": ("no nulls", "{} null(s)"),
    "unique": ("all unique", "{} duplicate(s)"),
    "allowed_values": ("within allowed set", "unexpected: {}"),
    "range": ("within {}", "{} outside {}"),
}
COLUMN_ABSENT = "column absent"
NO_HISTORY = "skipped — needs trailing history (available once runs accumulate)"

# Names of the silver checks.
SILVER_CHECKS = {
    "txn_account": "fact_transaction.account_sk resolves",
    "txn_amount": "fact_transaction.amount_eur not null",
    "no_currency": "amounts EUR-normalized (no currency col)",
    "loan_account": "fact_loan.account_sk resolves",
}

# Actions a failed gate may ask for.
GATE_ACTIONS = ["retry", "halt", "escalate", "proceed"]

# Business sources that a request can name, in order of preference.
KNOWN_SOURCES = ["trades", "loans", "deposits", "cards", "payments", "transfers"]

# Report templates in order of preference. A visual is
# ("kpi_cards", table, fields) | ("line", table, x, series) | ("bar", table, x, y);
# a trailing True scopes the visual to the requested source.
TEMPLATES = [
    {
        "id": "finance_executive_overview",
        "domain": "finance",
        "keywords": ["finance", "executive", "overview", "summary", "headline", "kpi", "board"],
        "visuals": [
            ("kpi_cards", "gold.kpi_daily", ["total_deposits_eur", "net_loans_eur", "loan_to_deposit_ratio",
                                         "nim_pct", "fee_income_eur", "npl_rate_pct"]),
            ("line", "gold.kpi_daily", "date", ["total_deposits_eur", "net_loans_eur"]),
            ("line", "gold.kpi_daily", "date", ["loan_to_deposit_ratio", "npl_rate_pct"]),
        ],
    },
    {
        "id": "finance_deposits_funding",
        "domain": "finance",
        "keywords": ["finance", "deposits", "funding", "liquidity", "segment", "growth"],
        "visuals": [
            ("kpi_cards", "gold.kpi_daily", ["total_deposits_eur", "deposits_growth_pct", "loan_to_deposit_ratio"]),
            ("line", "gold.kpi_daily", "date", ["total_deposits_eur"]),
            ("bar", "gold.deposits_by_segment", "segment", "deposits_eur"),
        ],
    },
    {
        "id": "finance_credit_risk",
        "domain": "finance",
        "keywords": ["finance", "credit", "risk", "loans", "npl", "delinquency", "default", "arrears"],
        "visuals": [
            ("kpi_cards", "gold.kpi_daily", ["net_loans_eur", "loans_growth_pct", "npl_rate_pct"]),
            ("line", "gold.kpi_daily", "date", ["npl_rate_pct"]),
            ("bar", "gold.loans_by_status", "status", "principal_outstanding_eur"),
        ],
    },
    {
        "id": "finance_revenue_margin",
        "domain": "finance",
        "keywords": ["finance", "revenue", "income", "fee", "commission", "margin", "nim", "profitability"],
        "visuals": [
            ("kpi_cards", "gold.kpi_daily", ["fee_income_eur", "nim_pct", "txn_value_eur", "txn_count"]),
            ("line", "gold.kpi_daily", "date", ["fee_income_eur"]),
            ("bar", "gold.txn_by_channel", "channel", "txn_value_eur"),
        ],
    },
    {
        "id": "hr_workforce_overview",
        "domain": "hr",
        "keywords": ["hr", "workforce", "headcount", "employees", "people", "staffing", "overview"],
        "visuals": [
            ("kpi_cards", "gold.hr_headcount_daily", ["headcount", "hires", "attrition_rate_pct",
                                                  "avg_tenure_years", "open_positions"]),
            ("line", "gold.hr_headcount_daily", "date", ["headcount"]),
            ("bar", "gold.hr_by_department", "department", "headcount"),
        ],
    },
    {
        "id": "hr_attrition",
        "domain": "hr",
        "keywords": ["hr", "attrition", "retention", "turnover", "churn", "leavers"],
        "visuals": [
            ("kpi_cards", "gold.hr_headcount_daily", ["attrition_rate_pct", "attrition_count", "avg_tenure_years"]),
            ("line", "gold.hr_headcount_daily", "date", ["attrition_rate_pct"]),
            ("bar", "gold.hr_by_department", "department", "attrition_rate_pct"),
        ],
    },
    {
        "id": "hr_cost",
        "domain": "hr",
        "keywords": ["hr", "cost", "payroll", "compensation", "salary", "budget", "spend"],
        "visuals": [
            ("kpi_cards", "gold.hr_headcount_daily", ["payroll_cost_eur", "cost_per_head_eur", "headcount"]),
            ("bar", "gold.hr_by_department", "department", "payroll_cost_eur"),
        ],
    },
    {
        "id": "ops_processing_overview",
        "domain": "operations",
        "keywords": ["operations", "ops", "processing", "throughput", "stp", "exceptions", "overview"],
        "visuals": [
            ("kpi_cards", "gold.ops_processing_daily", ["txn_processed", "stp_rate_pct", "exceptions",
                                                    "avg_processing_ms", "sla_adherence_pct"]),
            ("line", "gold.ops_processing_daily", "date", ["txn_processed"]),
            ("line", "gold.ops_processing_daily", "date", ["stp_rate_pct"]),
        ],
    },
    {
        "id": "ops_channel_performance",
        "domain": "operations",
        "keywords": ["operations", "ops", "channel", "uptime", "availability", "sla", "performance", "latency"],
        "visuals": [
            ("kpi_cards", "gold.ops_processing_daily", ["sla_adherence_pct", "avg_processing_ms", "exceptions"]),
            ("bar", "gold.ops_by_channel", "channel", "volume"),
            ("bar", "gold.ops_by_channel", "channel", "uptime_pct"),
        ],
    },
    {
        "id": "ops_exceptions",
        "domain": "operations",
        "keywords": ["operations", "ops", "exceptions", "failures", "errors", "sla", "incidents", "risk"],
        "visuals": [
            ("kpi_cards", "gold.ops_processing_daily", ["exceptions", "sla_adherence_pct", "stp_rate_pct"]),
            ("line", "gold.ops_processing_daily", "date", ["exceptions"]),
            ("line", "gold.ops_processing_daily", "date", ["sla_adherence_pct"]),
        ],
    },
    {
        "id": "source_activity",
        "domain": "source",
        "keywords": ["source", "by source", "filter", "trades", "trading", "loans", "deposits", "cards",
                     "payments", "transfers", "business line"],
        "by_source": True,
        "visuals": [
            ("kpi_cards", "gold.activity_by_source", ["volume", "value_eur"], True),
            ("line", "gold.activity_by_source", "date", ["volume"], True),
            ("bar", "gold.activity_by_source", "source", "value_eur"),
        ],
    },
]
