"""Fixed values of the business model.

They must equal the published model for results to match; each one is a default
that the functions using it accept as a parameter.
"""

import datetime as dt

# --- fixed values -----------------------------------------------------------

HISTORY_START = dt.date(2023, 1, 1)
BENCH_PROJECT_ID = -1
BENCH_PROJECT = (BENCH_PROJECT_ID, "Bench", "Internal", "Internal")

BASE_CURRENCY = "USD"
FX_CURRENCIES = ("PKR", "GBP", "EUR", "AED", "SAR", "SGD")

# designation -> (low, high) factor on the regional salary band
SALARY_FACTORS = {
    "consultant": (0.60, 0.75),
    "Analyst": (0.75, 0.88),
    "MANAGER": (0.88, 1.00),
    "manager": (0.88, 1.00),
    "SENIOR ANALYST": (1.00, 1.30),
}
DEFAULT_SALARY_FACTOR = (0.75, 1.00)

# region -> (low, high, currency) of the monthly salary
SALARY_BANDS = {
    "Pakistan": (80000, 600000, "PKR"),
    "USA": (5000, 15000, "USD"),
    "United Kingdom": (4000, 10000, "GBP"),
    "UAE": (15000, 40000, "AED"),
    "Germany": (4000, 11000, "EUR"),
    "Saudi Arabia": (15000, 40000, "SAR"),
    "Singapore": (6000, 15000, "SGD"),
}

# client market -> (low, high) hourly rate in USD
MARKET_RATES = {
    "USA": (55, 95),
    "United Kingdom": (50, 85),
    "Australia": (50, 80),
    "Canada": (48, 80),
    "Germany": (45, 75),
    "Netherlands": (45, 75),
    "United Arab Emirates": (42, 70),
    "Saudi Arabia": (40, 68),
    "Singapore": (38, 65),
    "Qatar": (40, 65),
}
DEFAULT_MARKET_RATE = (40, 65)

# designation -> factor on the hourly rate
RATE_FACTORS = {
    "consultant": 0.90,
    "Analyst": 1.00,
    "MANAGER": 1.40,
    "manager": 1.40,
    "SENIOR ANALYST": 1.30,
}
DEFAULT_RATE_FACTOR = 1.00

# year -> factor on the hourly rate
YEAR_FACTORS = {2023: 1.00, 2024: 1.08, 2025: 1.17, 2026: 1.26}
DEFAULT_YEAR_FACTOR = 1.26

# month -> billable share of the season
SEASON = {
    1: 0.77, 2: 0.79, 3: 0.83, 4: 0.86, 5: 0.88, 6: 0.87,
    7: 0.91, 8: 0.90, 9: 0.88, 10: 0.85, 11: 0.83, 12: 0.79,
}
DEFAULT_SEASON = 0.85

# department -> bench share
DEPARTMENT_BENCH = {
    "Engineering": 0.08,
    "Data Science": 0.10,
    "Cloud": 0.09,
    "Sales": 0.12,
    "HR": 0.30,
    "QA": 0.20,
    "Unassigned": 0.25,
}
DEFAULT_DEPARTMENT_BENCH = 0.15
NON_BILLABLE_MARGIN = 0.10
NON_BILLABLE_RANGE = (0.03, 0.20)

MAX_DAY_HOURS = 8.0
CORRECTION_RANGE = (0.5, 4.0)

# month length and day length behind the bench cost
COST_DAYS_PER_MONTH = 30.0
COST_HOURS_PER_DAY = 8.0

MARKET_SHARE_BASE = 100

# expectation -> (low, high)
EXPECTATIONS = {
    "history_start_offset_days": (0, 0),
    "history_end_lag_days": (0, 0),
    "null_department_pct": (5, 9),
    "negative_hours_pct": (1, 3),
    "padded_name_pct": (15, 25),
    "pkr_salary_pct": (70, 80),
    "fx_rows": (273, 273),
    "client_projects": (100, 100),
    "bench_rows": (1, 1),
    "correction_pct": (1, 3),
    "duplicate_ids": (0, 0),
}
