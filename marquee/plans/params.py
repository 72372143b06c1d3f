"""Parameters the registered queries run with (same values in the oracle SQL)."""

RUN_DATE = "2024-01-08"            # daily cycle date: cohorts run-1 and run-7 both exist
COHORT_DATE = "2024-01-01"
RANGE_START = "2024-01-01 00:00:00"
RANGE_END = "2024-01-31 23:59:59.999999"
TTL_AS_OF = "2024-04-20"           # 90-day retention cut lands inside January
TTL_DAYS = 90
TOP_N = 10
HEATMAP_LIMIT = 30
MAX_DAY_OFFSET = 7
COMPUTED_AT = "2024-01-09 00:05:00"  # fixed stamp for oracle-checked outputs
PARTIAL_CUTOFF_HOUR = 18           # "earlier run" of a day sees events before this hour
RATE_LIMIT_SECONDS = 60
PAGE_STATUS = "ACTIVE"
PAGE = 3
PAGE_SIZE = 20
SEARCH_ORIGIN = "SVO"
SEARCH_DESTINATION = "AER"
SEARCH_DATE = "2026-04-07"
BOOKING_USER = "user_100"
FAILURE_WINDOW = 10
FAILURE_THRESHOLD = 5
CAMPAIGN_RATE = 100                # SMS provider token bucket, requests per second
