"""Table layouts and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Fields and types of a trade message.
TRADE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
])

# Feature names in model order, label texts, defaults of the published set-up.
FEATURES = ["pct_return", "volatility", "volume_intensity", "price_speed"]
NORMAL = "normal"
ANOMALOUS = "anomalo"
SYMBOLS = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "BNBUSDT", "XRPUSDT", "DOGEUSDT", "ADAUSDT", "AVAXUSDT"]
WINDOW_SIZE = "1 minute"
WINDOW_SLIDE = "30 seconds"
WATERMARK_DELAY = "30 seconds"
TRIGGER_INTERVAL = "10 seconds"
MAX_OFFSETS_PER_TRIGGER = 10_000
K_VALUES = (3, 4, 5)
ANOMALY_QUANTILE = 0.95
FALLBACK_THRESHOLD = 1.0
MIN_TRAINING_ROWS = 20
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
KEPT_TRADES_PER_SYMBOL = 5_000
SHOWN_PREDICTIONS = 50

# The published classifier (one weight per feature, same order as FEATURES).
PUBLISHED_COEFFICIENTS = [
    0.08600174641535539,
    0.40362007319894877,
    0.3583768501335714,
    0.4875838421655489,
]
PUBLISHED_INTERCEPT = -3.3717481251896624

STATISTICS = [
    "symbol", "price_min", "price_max", "price_avg", "price_variance", "trade_count",
    "total_volume", "price_first", "price_last", "price_stddev", "window_start", "window_end",
]
WINDOW_COLUMNS = [
    "symbol", "window_start", "window_end", "price_min", "price_max", "price_avg",
    "price_variance", "trade_count", "total_volume", *FEATURES,
]
LABELED = [*WINDOW_COLUMNS, "prediction", "distance_to_centroid", "label", "label_binary"]
PREDICTIONS = [*WINDOW_COLUMNS, "prediction", "probability"]
