"""Fixed values of the domain."""

AGENCY_TZ = "America/Los_Angeles"
#: Seconds from schedule that count as on time, both ends included.
EARLY_S, LATE_S = -60, 300
#: Left-closed edges of lead time, in seconds, and their names in order.
LEAD_EDGES = (0, 120, 300, 600, 1200)
LEAD_BUCKETS = ("0-2 min", "2-5 min", "5-10 min", "10-20 min", "20+ min")
HORIZON_MAX_S = 3600
#: Floors below which a mart keeps no group.
FLOOR_AGENCY, FLOOR_ROUTE_HOUR, FLOOR_WORST = 100, 20, 50
RETENTION_DAYS = 90
CONTRACT_VERSION = "1.0.0"
STOPPED = "STOPPED_AT"
GRAIN = ("service_date", "trip_id", "stop_sequence")
#: The end of a validity that has none.
FOREVER = "2999-12-31 00:00:00"
BEGINNING = "1970-01-01 00:00:00"
ERROR_CHARS = 2000
EXPORT_STALE_HOURS, LAKE_STALE_HOURS = 36, 72
