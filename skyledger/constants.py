"""Names, labels and thresholds that results must carry exactly."""

# Source header -> canonical column name of the raw feed.
SOURCE_COLUMNS = {
    "Flight": "flight_number",
    "Date": "flight_date",
    "Airline": "airline",
    "Origin": "origin",
    "Destination": "destination",
    "Aircraft": "aircraft",
    "Scheduled Departure": "scheduled_departure",
    "Actual Departure": "actual_departure",
    "Delay (min)": "departure_variance",
    "Cancelled": "is_cancelled",
    "Distance (mi)": "distance_miles",
    "Cabin Class": "cabin_class",
    "Passengers": "passengers",
    "Ticket Price": "ticket_price",
}
FEED_COLUMNS = list(SOURCE_COLUMNS.values())

# In the order of Spark's ``dayofweek``, from 1.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Spellings of the cancellation flag, compared in lower case.
CANCELLED_YES = ("yes", "y", "1", "true")
CANCELLED_NO = ("no", "n", "0", "false")

# Date spellings accepted in one column (Spark patterns).
DATE_PATTERNS = ("yyyy-M-d", "M/d/yyyy")

CABINS = ("Economy", "Premium Economy", "Business")

# (label, highest hour of the part of day)
DAYPARTS = (("Morning", 11), ("Afternoon", 16), ("Evening", 20), ("Night", 23))

# (label, highest delay in minutes of the bin)
DELAY_BINS = (
    ("On time (<15)", 14),
    ("15-29", 29),
    ("30-59", 59),
    ("60-119", 119),
    ("120-179", 179),
    ("180+", None),
)
CANCELLED_LABEL = "Cancelled"
DELAY_CATEGORIES = tuple(label for label, _ in DELAY_BINS) + (CANCELLED_LABEL,)

ON_TIME_MINUTES = 15
SEVERE_MINUTES = 60
MINUTES_PER_DAY = 1440
EARLIEST_DEPARTURE = -180

# Characters a text value is stripped of (Unicode white space).
ASCII_WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
WHITESPACE = ASCII_WHITESPACE + (
    "\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

WINTER_MONTHS = (12, 1, 2)
SUMMER_MONTHS = (6, 7, 8)
SHOULDER_MONTHS = (3, 4, 5, 9, 10, 11)

EARTH_RADIUS_MILES = 3958.8

# Counters of the cleaning report, in report order.
REPORT_COUNTERS = (
    "raw_rows",
    "exact_duplicates_removed",
    "prices_with_currency_symbol_fixed",
    "key_duplicates_removed",
    "invalid_prices_nulled",
    "invalid_rows_dropped",
    "delays_derived_from_times",
    "actual_departures_rebuilt",
    "rows_dropped_no_departure_data",
    "distance_imputed_from_route",
    "passengers_imputed",
    "ticket_prices_imputed",
    "clean_rows",
    "flights",
)

REQUIRED_COLUMNS = (
    "flight_id", "flight_date", "airline", "origin", "destination", "cabin_class",
    "passengers", "ticket_price", "distance_miles", "is_cancelled",
)

# Fixed value: the first line of the insights text.
INSIGHTS_HEADING = "# Key Insights"

# Dates of flights that are believed where no period is given.
FIRST_PLAUSIBLE_DATE = "1970-01-01"
LAST_PLAUSIBLE_DATE = "2099-12-31"
