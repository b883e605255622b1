"""Fixed values.

These must equal the source API's response format and the target table's definition; they are
stated here once, in natural order, and imported everywhere else.
"""

# --- fixed values: keys of a daily time-series response document ---------------------------
META_KEY = "Meta Data"
META_SYMBOL_KEY = "2. Symbol"
SERIES_KEY = "Time Series (Daily)"
INFO_KEY = "Information"  # present in a 200 OK body when the rate limit is hit
ERROR_KEY = "Error Message"  # present in a 200 OK body when the call is invalid
OPEN_KEY = "1. open"
HIGH_KEY = "2. high"
LOW_KEY = "3. low"
CLOSE_KEY = "4. close"
VOLUME_KEY = "5. volume"
FIELD_KEYS = (OPEN_KEY, HIGH_KEY, LOW_KEY, CLOSE_KEY, VOLUME_KEY)

# --- fixed values: target table ---------------------------------------------------------------
PRICE_TYPE = "decimal(10,4)"
SALARY_TYPE = "decimal(10,2)"
SYMBOL_MAX_LEN = 10
BULLISH = "Bullish"
BEARISH = "Bearish"
DATE_FORMAT = "yyyy-MM-dd"
KEY = ("symbol", "bar_date")

# --- fixed values: incremental load -----------------------------------------------------------
LOOKBACK_DAYS = 2
FIRST_RUN_DAYS = 100

# --- fixed values: report line formats --------------------------------------------------------
REPORT_LINE = "%-5s %-15s %-15s %-10s %s"
LABELLED_LINE = "ID: %s | Name: %s"

# --- response classification labels (ours) ----------------------------------------------------
STATUS_OK = "ok"
STATUS_RATE_LIMITED = "rate_limited"
STATUS_API_ERROR = "api_error"
STATUS_MISSING_SERIES = "missing_series"
STATUS_HTTP_ERROR = "http_error"
STATUS_UNPARSEABLE = "unparseable"

# --- reasons for which a landed value cannot become a row (ours) ------------------------------
REJECT_BODY = "unparseable_body"
REJECT_DAY = "bad_day"
REJECT_DATE = "bad_date"
REJECT_SYMBOL = "null_symbol"
REJECT_FUTURE = "future_date"
