"""Run parameters of the registered queries (our own fixture choices).

The reference hard-codes a producer name, a group-code token and "today";
here they are parameters (quirks Q21, F10) so that every query is reproducible.
"""

from __future__ import annotations

# Reference run date and per-table lookback in days (U1).  The test tables
# span 1995-2001, so these windows cut through the middle of the data.
AS_OF = "2001-12-31"
LOOKBACK_DAYS = {
    "ingredients": 700,
    "movements": 700,
    "deaths": 700,
    "sales": 700,
    "budget_actuals": 2300,
    "closeouts": 2300,
}

# Entity rename applied by the movement pipeline (P5).
SETUP_LONG_NAME = "Setup existing wean to finish groups"
SETUP_SHORT_NAME = "Setup"
ENTITY_RENAME = {SETUP_LONG_NAME: SETUP_SHORT_NAME}

# Producer excluded from the actuals mart and group-code token excluded from
# closeout candidates (Q21); our own test choices.
EXCLUDED_PRODUCER = "FRANCE"
CANDIDATE_EXCLUDE_TOKEN = "G1"

# Fixed values (they must equal the report contents): the group types the
# actuals mart covers, the mill whose deliveries count as feed trips, the
# movement categories of the trucking averages, and the budget row types.
ACTUALS_GROUP_TYPES = ("Finishing", "Wean to Finish")
HOME_MILL = "Home Mill"
# The mill that counted as home mill when the stored actuals were computed.
PREVIOUS_HOME_MILL = "Supplier#000000001"
MARKET_CATEGORY = "Market Sale"
ADJUSTMENT_CATEGORY = "Inventory Adjustment"
BUDGET_TYPES = ("budget", "actual")

# Report-slice parameters.
SLICE_START = "2000-01-01"
SLICE_END = "2000-12-31"
SLICE_SITE = "Site 3"
SLICE_PRODUCER = "NATION_3"
SLICE_PRODUCER_CODE = "3"
SLICE_MILLS = ("Home Mill", "Supplier#000000001", "Supplier#000000002")
SLICE_WEEKS = ("1998 10", "1998 40")
SLICE_PLANTS = ("P0", "P2")

# Report export fixture (S1, S11): banner rows per file, files per report and
# the file-name token that picks up every order-list file (not the customer list).
REPORT_BANNER_ROWS = 3
REPORT_FILES = 4
REPORT_TOKEN = "orders_part"
