"""Names and numbers that are part of the contract with data already on the wire or on disk."""

# Defaults of the feeds and topics.
DEFAULT_CITY = "Dubai"
DEFAULT_STATION_NAME = "Unknown"
DEFAULT_BROKER = "localhost:9092"
TOPIC_STATION_INFO = "station_info"
TOPIC_STATION_STATUS = "station_status"
TOPIC_WEATHER = "weather"

# The two usage jobs (window length, watermark delay) and the publish cycles.
GRAIN_30M = "30 minutes"
DELAY_30M = "30 minutes"
GRAIN_1M = "1 minute"
DELAY_1M = "30 seconds"
STATUS_CYCLE = "300 seconds"
WEATHER_CYCLE = "1800 seconds"

# The forecast model.
FEATURES = ["temp_t1h", "wind_t1h", "rain_t1h", "clouds_t1h", "hour_t1h", "is_weekend_t1h"]
LABEL = "util_t1h"
TREES = 120
DEPTH = 8
SEED = 42
TRAIN_TENTHS = 8
# The first four hex digits of a hash are below this for that share of all hashes.
TRAIN_BELOW = f"{65536 * TRAIN_TENTHS // 10:04x}"
ROWS_AHEAD = 2
TIME_AHEAD = "1 hour"
HISTOGRAM_BINS = 20

# How far ahead of its message's publish time an event may claim to be before its time is taken for an error.
TIME_TOLERANCE = "1 hour"

# Size of a quantile sketch: at 400 its ranks are off by about one in 100 at most.
KLL_K = 400
# Spans of the trailing features, by the name in their columns.
TRAILING = {"1h": "1 hour", "24h": "24 hours", "7d": "7 days"}
