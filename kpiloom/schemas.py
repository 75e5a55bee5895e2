"""Schemas and fixed values of the market data model.

The raw market CSV is read as text, by the names in its header, and typed by
``operators.clean`` so that one bad cell cannot silently turn a column into
text (which schema inference would do). Events arrive as JSON text.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values (must equal the original application's for equal results) ---
# Market CSV column order.
MARKET_COLUMNS = [
    "obs_date", "platform", "genre", "current_price_usd", "discount_pc",
    "is_on_sale", "concurrent_players", "hype_score", "estimated_revenue_usd",
    "is_early_access", "holiday_sale",
]
# Columns that must be present for a row to count (revenue also > 0).
REQUIRED_COLUMNS = ["platform", "genre", "estimated_revenue_usd"]
DATE_FORMAT = "yyyy-MM-dd"
MONTH_FORMAT = "yyyy-MM"
# A hype spike is more than this many concurrent players.
SPIKE_PLAYER_THRESHOLD = 300_000
RELEASE_EARLY = "Early Access"
RELEASE_FULL = "Full Release"
TOP_GENRES_LIMIT = 10
# ML: features, label, prediction column, grid, folds, split and seed.
ML_FEATURES = ["concurrent_players", "hype_score", "discount_pc"]
ML_LABEL = "estimated_revenue_usd"
ML_PREDICTION = "predicted_revenue"
ML_REG_PARAMS = [0.01, 0.1]
ML_ELASTIC_NET_PARAMS = [0.0, 0.5]
ML_FOLDS = 3
ML_SPLIT = [0.8, 0.2]
ML_SEED = 42
# Fields of an event message.
EVENT_SCHEMA = StructType([
    StructField("timestamp", StringType(), True),
    StructField("platform", StringType(), True),
    StructField("genre", StringType(), True),
    StructField("concurrent_players", IntegerType(), True),
    StructField("hype_score", DoubleType(), True),
    StructField("current_price_usd", DoubleType(), True),
    StructField("is_on_sale", IntegerType(), True),
    StructField("hype_spike", IntegerType(), True),
])
# --- end of fixed values ---

# Target type of every market column after cleaning.
MARKET_TYPES = {
    "obs_date": DateType(),
    "platform": StringType(),
    "genre": StringType(),
    "current_price_usd": DoubleType(),
    "discount_pc": DoubleType(),
    "is_on_sale": IntegerType(),
    "concurrent_players": IntegerType(),
    "hype_score": DoubleType(),
    "estimated_revenue_usd": DoubleType(),
    "is_early_access": IntegerType(),
    "holiday_sale": IntegerType(),
}


MARKET_CLEAN = StructType(
    [StructField(c, MARKET_TYPES[c], c not in REQUIRED_COLUMNS) for c in MARKET_COLUMNS]
    + [StructField("year_month", StringType(), True)]
)

# The curated table as read back: the partition column (platform) comes last.
CURATED_SCHEMA = StructType(
    [f for f in MARKET_CLEAN.fields if f.name != "platform"]
    + [StructField("platform", StringType(), True)]
)

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

ALERT_SCHEMA = StructType(EVENT_SCHEMA.fields + [StructField("event_time", TimestampType(), True)])
