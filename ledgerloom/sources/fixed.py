"""Fixed values of the bank ledger model.

FIXED VALUES — these must equal the source model for results to agree.
They are stated here once, in their natural order, as plain data; every
other module builds DataFrames from them.
"""

from __future__ import annotations

from decimal import Decimal as D

# ---------------------------------------------------------------------------
# FIXED VALUES: channels (channel_id, channel_name, channel_type, country,
# region, opened_date, is_active)
# ---------------------------------------------------------------------------
CHANNELS = [
    (1, "Paris Flagship", "Branch", "France", "Western Europe", "2018-03-01", True),
    (2, "Berlin Main", "Branch", "Germany", "Central Europe", "2018-06-01", True),
    (3, "Amsterdam Branch", "Branch", "Netherlands", "Western Europe", "2019-04-01", True),
    (4, "Madrid Branch", "Branch", "Spain", "Southern Europe", "2019-09-01", True),
    (5, "Milan Flagship", "Branch", "Italy", "Southern Europe", "2018-03-01", True),
    (6, "Warsaw Branch", "Branch", "Poland", "Eastern Europe", "2020-01-01", True),
    (7, "Vienna Branch", "Branch", "Austria", "Central Europe", "2020-06-01", True),
    (8, "Zurich Branch", "Branch", "Switzerland", "Central Europe", "2021-03-01", True),
    (9, "Stockholm Branch", "Branch", "Sweden", "Northern Europe", "2021-09-01", True),
    (10, "Mobile Banking", "Digital", "Other", "Other", "2019-01-01", True),
    (11, "Internet Banking", "Digital", "Other", "Other", "2018-01-01", True),
    (12, "Call Center", "Remote", "Other", "Other", "2018-01-01", True),
    (13, "Corporate Banking Unit", "Business Unit", "Other", "Other", "2018-01-01", True),
    (14, "Private Banking Unit", "Business Unit", "Other", "Other", "2018-01-01", True),
]

# FIXED VALUES: segments (segment_id, segment_name, description)
SEGMENTS = [
    (1, "Retail", "Individual customers, personal banking"),
    (2, "SME", "Small and medium enterprises"),
    (3, "Corporate", "Large corporate clients"),
    (4, "Private Banking", "High net worth individuals"),
    (5, "Financial Institutions", "Banks and financial entities"),
]

# FIXED VALUES: products (product_id, product_name, category, subcategory, is_active)
PRODUCTS = [
    (1, "Consumer Loan", "Loan", "Unsecured", True),
    (2, "Mortgage", "Loan", "Secured", True),
    (3, "Auto Loan", "Loan", "Secured", True),
    (4, "Business Loan", "Loan", "Unsecured", True),
    (5, "SME Credit Line", "Loan", "Revolving", True),
    (6, "Corporate Loan", "Loan", "Secured", True),
    (7, "Credit Card Classic", "Card", "Credit", True),
    (8, "Credit Card Premium", "Card", "Credit", True),
    (9, "Debit Card", "Card", "Debit", True),
    (10, "Current Account EUR", "Deposit", "Current", True),
    (11, "Current Account USD", "Deposit", "Current", True),
    (12, "Current Account GBP", "Deposit", "Current", True),
    (13, "Savings Account", "Deposit", "Savings", True),
    (14, "Term Deposit EUR", "Deposit", "Term", True),
    (15, "Term Deposit USD", "Deposit", "Term", True),
    (16, "Internet Banking", "Service", "Digital", True),
    (17, "Mobile Banking", "Service", "Digital", True),
]

# FIXED VALUES: currencies (currency_id, code, name, symbol)
CURRENCIES = [
    (1, "EUR", "Euro", "€"),
    (2, "USD", "US Dollar", "$"),
    (3, "GBP", "British Pound", "£"),
]

# FIXED VALUES: scenarios (scenario_id, scenario_name, scenario_type, fiscal_year, description)
SCENARIOS = [
    (1, "Actual", "Actual", None, "Actuals 2022-2025, filter year via dim_date"),
    (2, "Budget_2023", "Budget", 2023, "Original approved budget FY2023"),
    (3, "Budget_2024", "Budget", 2024, "Original approved budget FY2024"),
    (4, "Budget_2025", "Budget", 2025, "Original approved budget FY2025"),
    (5, "Budget_2026_TopDown", "Budget", 2026, "Management stretch targets FY2026"),
    (6, "Budget_2026_BottomUp", "Budget", 2026, "Consolidated channel submissions FY2026"),
    (7, "Forecast_2025_Q3", "Forecast", 2025, "Rolling forecast after Q3 2025 close"),
    (8, "Forecast_2026_Q1", "Forecast", 2026, "Rolling forecast after Q1 2026 close"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: chart of accounts (budget_item_id, item_name, statement_type,
# category, subcategory, parent_item_id, sort_order, is_subtotal,
# sign_convention)
# ---------------------------------------------------------------------------
BUDGET_ITEMS = [
    (1, "Net Interest Income", "PL", "Income", "NII", None, 10, True, 1),
    (2, "Interest Income", "PL", "Income", "NII", 1, 11, True, 1),
    (3, "Interest Income on Loans", "PL", "Income", "NII", 2, 12, False, 1),
    (4, "Interest Income on Securities", "PL", "Income", "NII", 2, 13, False, 1),
    (5, "Interest Income on Placements", "PL", "Income", "NII", 2, 14, False, 1),
    (6, "Interest Expense", "PL", "Expense", "NII", 1, 15, True, -1),
    (7, "Interest Expense on Deposits", "PL", "Expense", "NII", 6, 16, False, -1),
    (8, "Interest Expense on Borrowings", "PL", "Expense", "NII", 6, 17, False, -1),
    (9, "Non-Interest Income", "PL", "Income", "Non-Interest", None, 20, True, 1),
    (10, "Fee & Commission Income", "PL", "Income", "Non-Interest", 9, 21, False, 1),
    (11, "Trading & Investment Income", "PL", "Income", "Non-Interest", 9, 22, False, 1),
    (12, "FX Gains", "PL", "Income", "Non-Interest", 9, 23, False, 1),
    (13, "Other Non-Interest Income", "PL", "Income", "Non-Interest", 9, 24, False, 1),
    (14, "Operating Expenses", "PL", "Expense", "OpEx", None, 30, True, -1),
    (15, "Personnel Expenses", "PL", "Expense", "OpEx", 14, 31, False, -1),
    (16, "Administrative Expenses", "PL", "Expense", "OpEx", 14, 32, False, -1),
    (17, "Depreciation & Amortization", "PL", "Expense", "OpEx", 14, 33, False, -1),
    (18, "Provision for Loan Losses", "PL", "Expense", "Risk Cost", None, 40, False, -1),
    (19, "Profit Before Tax", "PL", "Subtotal", "PBT", None, 50, True, 1),
    (20, "Income Tax Expense", "PL", "Expense", "Tax", None, 51, False, -1),
    (21, "Net Income", "PL", "Subtotal", "Bottom Line", None, 52, True, 1),
    (22, "Total Assets", "BS", "Asset", "Total", None, 60, True, 1),
    (23, "Cash & Central Bank Balances", "BS", "Asset", "Liquid", 22, 61, False, 1),
    (24, "Loans to Customers", "BS", "Asset", "Loans", 22, 62, True, 1),
    (25, "Consumer & Personal Loans", "BS", "Asset", "Loans", 24, 63, False, 1),
    (26, "Mortgage Loans", "BS", "Asset", "Loans", 24, 64, False, 1),
    (27, "SME & Corporate Loans", "BS", "Asset", "Loans", 24, 65, False, 1),
    (28, "Investment Securities", "BS", "Asset", "Investments", 22, 66, False, 1),
    (29, "Property Plant & Equipment", "BS", "Asset", "Fixed Assets", 22, 67, False, 1),
    (30, "Other Assets", "BS", "Asset", "Other", 22, 68, False, 1),
    (31, "Total Liabilities", "BS", "Liability", "Total", None, 70, True, -1),
    (32, "Customer Deposits", "BS", "Liability", "Deposits", 31, 71, True, -1),
    (33, "Demand Deposits", "BS", "Liability", "Deposits", 32, 72, False, -1),
    (34, "Savings Accounts", "BS", "Liability", "Deposits", 32, 73, False, -1),
    (35, "Term Deposits", "BS", "Liability", "Deposits", 32, 74, False, -1),
    (36, "Interbank Borrowings", "BS", "Liability", "Borrowings", 31, 75, False, -1),
    (37, "Bonds Issued", "BS", "Liability", "Borrowings", 31, 76, False, -1),
    (38, "Other Liabilities", "BS", "Liability", "Other", 31, 77, False, -1),
    (39, "Total Equity", "BS", "Equity", "Total", None, 80, True, 1),
    (40, "Share Capital", "BS", "Equity", "Capital", 39, 81, False, 1),
    (41, "Retained Earnings", "BS", "Equity", "Earnings", 39, 82, False, 1),
    (42, "Regulatory Reserves", "BS", "Equity", "Reserves", 39, 83, False, 1),
    (43, "Other Comprehensive Income", "BS", "Equity", "Other", 39, 84, False, 1),
]

# Formula subtotals that have no children: the node sums the signed P&L leaves
# whose sort_order is below the bound (Profit Before Tax, Net Income).
FORMULA_NODES = [(19, 50), (21, 52)]

# ---------------------------------------------------------------------------
# FIXED VALUES: coverage rules (channel ids, segment_id, (product_id, currency_id) pairs),
# in the order of the source model's thirteen insert blocks.
# ---------------------------------------------------------------------------
_BRANCHES = (1, 2, 3, 4, 5, 6, 7, 8, 9)
_DIGITAL = (10, 11)
COVERAGE_RULES = [
    (_BRANCHES, 1, [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (7, 1), (9, 1),
                    (10, 1), (11, 2), (12, 3), (13, 1), (13, 2), (14, 1), (15, 2), (16, 1), (17, 1)]),
    (_BRANCHES, 2, [(4, 1), (4, 2), (5, 1), (5, 2), (10, 1), (11, 2), (14, 1), (16, 1)]),
    (_BRANCHES, 3, [(6, 1), (6, 2), (6, 3), (10, 1), (11, 2), (12, 3), (14, 1), (15, 2), (16, 1)]),
    (_BRANCHES, 4, [(2, 1), (2, 2), (8, 1), (8, 2), (9, 1),
                    (10, 1), (11, 2), (12, 3), (13, 1), (13, 2), (14, 1), (15, 2), (16, 1), (17, 1)]),
    (_BRANCHES, 5, [(10, 1), (11, 2), (12, 3), (14, 1), (15, 2)]),
    (_DIGITAL, 1, [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (7, 1), (9, 1),
                   (10, 1), (11, 2), (12, 3), (13, 1), (13, 2), (14, 1), (15, 2), (16, 1), (17, 1)]),
    (_DIGITAL, 2, [(4, 1), (4, 2), (5, 1), (10, 1), (11, 2), (14, 1), (16, 1)]),
    (_DIGITAL, 4, [(2, 1), (2, 2), (8, 1), (9, 1),
                   (10, 1), (11, 2), (12, 3), (13, 1), (13, 2), (14, 1), (15, 2), (16, 1), (17, 1)]),
    ((12,), 1, [(1, 1), (1, 2), (7, 1), (9, 1), (10, 1), (11, 2), (13, 1), (13, 2), (14, 1), (16, 1), (17, 1)]),
    ((12,), 2, [(4, 1), (10, 1), (11, 2), (14, 1), (16, 1)]),
    ((13,), 3, [(6, 1), (6, 2), (6, 3), (10, 1), (11, 2), (12, 3), (14, 1), (15, 2), (16, 1)]),
    ((13,), 5, [(10, 1), (11, 2), (12, 3), (14, 1), (15, 2)]),
    ((14,), 4, [(2, 1), (2, 2), (8, 1), (8, 2), (9, 1),
                (10, 1), (11, 2), (12, 3), (13, 1), (13, 2), (14, 1), (15, 2), (16, 1), (17, 1)]),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: planning drivers
# ---------------------------------------------------------------------------
# base amount by account category, set A (actuals) and set B (budgets)
DRIVER_BASE = {
    "A": [("Income", D("50000")), ("Expense", D("30000")), ("Asset", D("2000000")),
          ("Liability", D("1500000")), ("Equity", D("500000"))],
    "B": [("Income", D("53000")), ("Expense", D("28000")), ("Asset", D("2100000")),
          ("Liability", D("1550000")), ("Equity", D("520000"))],
}
BASE_OTHER = {"A": D("20000"), "B": D("21000")}
# channel multiplier: Flagship branch, other branch, digital, remote, business unit
DRIVER_CHANNEL_FLAGSHIP = D("3.0")
DRIVER_CHANNEL = [("Branch", D("2.0")), ("Digital", D("1.5")), ("Remote", D("0.8")),
                  ("Business Unit", D("2.5"))]
FLAGSHIP_PATTERN = "%Flagship%"
# segment multiplier by segment_id; any other id uses 1.0
DRIVER_SEGMENT = [(3, D("4.0")), (4, D("3.0")), (5, D("2.5")), (2, D("2.0")), (1, D("1.0"))]
# seasonality by quarter, set A (actuals) and set B (budgets)
DRIVER_SEASON = {
    "A": [(1, D("0.90")), (2, D("0.95")), (3, D("1.00")), (4, D("1.15"))],
    "B": [(1, D("0.92")), (2, D("0.96")), (3, D("1.00")), (4, D("1.12"))],
}
# currency weight by currency_id
DRIVER_CURRENCY = [(1, D("1.00")), (2, D("0.40")), (3, D("0.25"))]
# daily-average adjustment by category; any other category uses 1.00
DRIVER_DAILY_ADJ = [("Asset", D("0.94")), ("Liability", D("1.03"))]

# The eleven load blocks: (scenario_id, year, base set, multiplier up to the
# cutoff month, multiplier after it, cutoff month, season set, noise span of
# amount_eur, noise span of daily_avg_eur). The noise draw is v % span - span/2.
PLAN_BLOCKS = [
    (1, 2022, "A", D("1.0000"), D("1.0000"), 12, "A", 30000, 20000),
    (1, 2023, "A", D("1.1000"), D("1.1000"), 12, "A", 30000, 20000),
    (1, 2024, "A", D("1.2100"), D("1.2100"), 12, "A", 30000, 20000),
    (1, 2025, "A", D("1.3300"), D("1.3300"), 12, "A", 30000, 20000),
    (2, 2023, "B", D("1.0000"), D("1.0000"), 12, "B", 10000, 8000),
    (3, 2024, "B", D("1.1200"), D("1.1200"), 12, "B", 10000, 8000),
    (4, 2025, "B", D("1.2500"), D("1.2500"), 12, "B", 10000, 8000),
    (5, 2026, "B", D("1.3800"), D("1.3800"), 12, "B", 10000, 8000),
    (6, 2026, "B", D("1.2800"), D("1.2800"), 12, "B", 10000, 8000),
    (7, 2025, "A", D("1.3300"), D("1.3000"), 9, "A", 20000, 15000),
    (8, 2026, "B", D("1.3200"), D("1.3200"), 12, "A", 15000, 15000),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: FX bands (currency_id, year, centre, draw modulus); the rate is
# centre + (draw % modulus) / 10000 - modulus / 20000, eom and daily average
# drawn independently.  Documented ranges are kept for the range check.
# ---------------------------------------------------------------------------
FX_BANDS = [
    (2, 2022, D("1.0530"), 1700), (2, 2023, D("1.0820"), 800), (2, 2024, D("1.0820"), 600),
    (2, 2025, D("1.0500"), 700), (2, 2026, D("1.0600"), 600),
    (3, 2022, D("0.8530"), 600), (3, 2023, D("0.8690"), 400), (3, 2024, D("0.8550"), 400),
    (3, 2025, D("0.8400"), 500), (3, 2026, D("0.8450"), 400),
]
FX_DOCUMENTED_RANGES = [
    (2, 2022, D("0.9900"), D("1.1600")), (2, 2023, D("1.0500"), D("1.1300")),
    (2, 2024, D("1.0600"), D("1.1200")), (2, 2025, D("1.0200"), D("1.0900")),
    (2, 2026, D("1.0300"), D("1.0900")),
    (3, 2022, D("0.8300"), D("0.8900")), (3, 2023, D("0.8500"), D("0.8900")),
    (3, 2024, D("0.8300"), D("0.8700")), (3, 2025, D("0.8200"), D("0.8700")),
    (3, 2026, D("0.8300"), D("0.8700")),
]
FX_FIRST_BAND_YEAR = 2022
FX_BAND_YEARS = 5

MODEL_START = "2022-01-01"
MODEL_END = "2026-12-31"

# ---- Column lengths of the tables (fixed values of the model) ---------------------------------
VARCHAR_LENGTHS = [
    ("dim_date", "quarter_name", 6),
    ("dim_date", "month_name", 12),
    ("dim_date", "month_name_short", 3),
    ("dim_channel", "channel_name", 100),
    ("dim_channel", "channel_type", 30),
    ("dim_channel", "country", 50),
    ("dim_channel", "region", 50),
    ("dim_segment", "segment_name", 30),
    ("dim_product", "product_name", 100),
    ("dim_product", "product_category", 50),
    ("dim_product", "product_subcategory", 50),
    ("dim_currency", "rate_id", 20),
    ("dim_currency", "currency_name", 50),
    ("dim_currency", "currency_symbol", 5),
    ("dim_scenario", "scenario_name", 50),
    ("dim_scenario", "scenario_type", 30),
    ("dim_budget_items", "item_name", 100),
    ("dim_budget_items", "statement_type", 5),
    ("dim_budget_items", "category", 50),
    ("dim_budget_items", "subcategory", 50),
    ("fact_financial_data", "rate_id", 20),
]
