"""Fixed values that must equal the behaviour being reproduced.

These are stated plainly and in natural order; changing any of them
changes results.
"""

# --- Fixed values: text that counts as a missing value (exact, case-sensitive).
MISSING_SENTINELS = ("None", "")

# --- Fixed values: the six column roles.
ROLES = ("date", "id", "measure", "dimension", "text", "currency")

# --- Fixed values: rejection reasons of the baseline sales rules (first match wins).
REASON_MISSING_DATE = "Missing/Invalid Date"
REASON_MISSING_CATEGORY = "Missing/Invalid Category"
REASON_NEGATIVE_ANY = "Negative Numeric Metric(s)"
REASON_DUPLICATE = "Duplicate Transaction"

# --- Fixed values: rejection reason patterns of the profile-driven rules.
REASON_NULL_REQUIRED = "Null value in required column: {col}"
REASON_NEGATIVE_COL = "Negative Numeric Metric: {col}"

# --- Own reasons for rows that the rules above cannot judge: another number of fields than the header, units beyond 32 bits.
REASON_MALFORMED_ROW = "Malformed Row"
REASON_OUT_OF_RANGE = "Numeric Metric Out of Range"

# --- Extension reasons (off by default, not part of the reproduced behaviour).
REASON_MALFORMED_NUMERIC = "Malformed Numeric Metric: {col}"
REASON_UNPARSEABLE_DATE = "Unparseable Date: {col}"

# --- Fixed values: layer table names.
BRONZE_TABLE = "bronze_raw_sales"
SILVER_TABLE = "silver_clean_sales"
QUARANTINE_TABLE = "quarantine_rejected_sales"
GOLD_TABLE = "gold_monthly_metrics"

# --- Fixed values: the baseline sales schema and its dedup key.
SALES_COLUMNS = ("date", "category", "revenue", "cost", "units_sold")
SALES_DEDUP_KEYS = ("date", "category", "units_sold", "revenue")

# --- Fixed values: read-only SQL guard.
GUARD_FORBIDDEN_KEYWORDS = (
    "drop", "delete", "update", "insert", "alter", "create", "replace", "truncate",
    "grant", "revoke", "pragma", "attach", "detach", "write", "exec",
)
# Spark-specific functions that reach the JVM; denied in addition.
GUARD_SPARK_EXTRA_KEYWORDS = ("reflect", "java_method", "try_reflect")
# Literals and quoted names, which comments cannot begin in, and comments.
GUARD_QUOTED = r"""'(?:[^'\\]++|\\[\s\S]|'')*+'|"(?:[^"\\]++|\\[\s\S]|"")*+"|`(?:[^`]++|``)*+`"""
GUARD_COMMENT = r"--[^\r\n]*+|/\*[\s\S]*?\*/"
GUARD_MSG_FOREIGN = "Query reads outside its workspace: {names}"
GUARD_MSG_NO_PLAN = "Query cannot be checked on this kind of session."
GUARD_MSG_NOT_SELECT = "Query must be a read-only SELECT or WITH statement."
GUARD_MSG_FORBIDDEN = "Query contains forbidden write/modify keyword(s): {kw}"
GUARD_MSG_BLOCKED = "SQL Guard Blocked Query: {msg}"
GUARD_MSG_PLAN_FAILED = "SQL Plan Validation Failed (Syntax or Table/Column schema mismatch): {err}"

# --- Fixed values: name keywords that pick a display format (checked in this order).
CURRENCY_KEYWORDS = ("revenue", "cost", "salary", "amount", "price", "copay", "fee")
PERCENT_KEYWORDS = ("margin", "rate", "pct", "percent")
COUNT_KEYWORDS = ("units", "sold", "count", "qty", "quantity", "id")

# --- Fixed values: chart scaling threshold.
CHART_SCALE_THRESHOLD = 1000
