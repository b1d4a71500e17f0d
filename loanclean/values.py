"""Marker lists, formats, thresholds and column names.

These are plain data. They decide what counts as a missing value, a known
date layout or a known category, so they are kept together and readable.
"""

# Cells that a pandas CSV reader turns into nulls even when reading text.
CSV_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Cells that the cleaning step turns into nulls, in every text column.
MISSING_MARKERS = ["", "NULL", "N/A", "n/a", "unknown", "-1", "nan", "???", "no phone", "00000"]

NUMERIC_COLUMNS = ["loan_amnt", "int_rate", "installment", "annual_inc", "dti"]

CANONICAL_PURPOSES = [
    "debt_consolidation", "credit_card", "home_improvement", "major_purchase",
    "small_business", "car", "medical", "other",
]
PURPOSE_MIN_SCORE = 80

HOME_OWNERSHIP_RECODE = {"RENTED": "RENT", "MORTGAGED": "MORTGAGE"}

# Column, lowest and highest allowed value; None leaves that side open.
RANGE_RULES = [
    ("loan_amnt", 0, None),
    ("fico_score", 300, 850),
    ("dti", None, 100),
    ("annual_inc", 0, None),
]

DATE_FORMATS = [
    "%Y-%m-%d", "%Y/%m/%d",
    "%d-%m-%Y", "%d/%m/%Y", "%d.%m.%Y",
    "%m-%d-%Y", "%m/%d/%Y", "%m.%d.%Y",
    "%b %d, %Y", "%d %b %Y", "%B %d, %Y", "%d %B %Y",
]
MIN_GAP_DAYS = 1
MAX_GAP_DAYS = 30

PAIR_LOW = 2.3
PAIR_HIGH = 2.6

BATCH_SIZE = 100
MAX_ATTEMPTS = 3
CONCURRENCY = 10  # resolver calls at a time

ESCALATED_COLUMNS = ["application_date", "issue_date", "advisor_notes"]
PAIR_FIELDS = ["customer_id", "full_name", "email", "phone", "street_address", "zip_code"]
PROFILED_COLUMNS = ["zip_code", "city", "state", "emp_length", "verification_status", "loan_status"]

# Correct spelling and its usual misspelling in advisor notes.
NOTE_TYPOS = [
    ("employed", "emplyed"), ("verified", "verifed"), ("business", "buisness"),
    ("income", "incme"), ("history", "histroy"), ("consistent", "consistant"),
]

# Characters that Python's str.strip() and str.split() treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003"
    "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

LOAN_COLUMNS = [
    "customer_id", "full_name", "email", "phone", "street_address", "city", "state",
    "zip_code", "loan_amnt", "term_months", "int_rate", "installment", "grade",
    "emp_title", "emp_length", "home_ownership", "annual_inc", "verification_status",
    "purpose", "dti", "fico_score", "loan_status", "application_date", "issue_date",
    "advisor_notes",
]

# Dirt that is put into clean tables, with its shares.
# Markers per column and the share of rows they replace.
MISSING_PLAN = [
    ("annual_inc", 0.04, ["", "NULL", "N/A", "unknown", "-1"]),
    ("emp_title", 0.06, ["", "n/a", "N/A", "unknown", "???"]),
    ("dti", 0.03, ["", "NULL", "nan", "999"]),
    ("zip_code", 0.02, ["", "00000", "N/A"]),
    ("phone", 0.03, ["", "N/A", "no phone"]),
]
MESSY_DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "dd MMM yyyy", "yyyy/MM/dd"]
COMMA_SKIPS = ["", "NULL", "N/A", "unknown", "-1", "nan", "999"]
PHONE_SKIPS = ["", "N/A", "no phone"]
PHONE_LAYOUTS = ["({}) {}-{}", "{}.{}.{}", "{}-{}-{}", "{}{}{}"]
HOME_VARIANTS = {
    "RENT": ["rent", "Rent", " RENT", "RENT ", "rented"],
    "MORTGAGE": ["mortgage", "Mortgage", "MORTGAGE ", "mortgaged"],
    "OWN": ["own", "Own", " OWN"],
    "OTHER": ["other", "Other", "OTHER "],
}
PURPOSE_VARIANTS = {
    "debt_consolidation": ["Debt Consolidation", "debt consolidation", "DEBT_CONSOLIDATION", "dept_consolidation"],
    "credit_card": ["Credit Card", "creditcard", "credit-card"],
    "home_improvement": ["Home Improvement", "home_improvment", "homeimprovement"],
    "small_business": ["Small Business", "small buisness"],
}
