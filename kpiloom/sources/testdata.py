"""Adapter from the benchmark tables onto the market and event schemas.

The benchmark tables hold no market observations, so these two functions map
them onto the market schema (lineitem ⋈ part) and onto JSON event
messages (events). They are input shims, not engine operators: the engine
itself starts at ``operators.clean.clean_market`` and
``streaming.alerts.parse_events``.

Money is computed in integer cents so that every engine computes the same
bits; the revenue formula follows players × price × rate with
rate = 5% + 3% per line number, and a few nulls and negative revenues are
planted by key so that cleaning has work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.casting import iso_timestamp_text
from kpiloom.functions.derive import spike_flag

# --- Fixed values of the adapter (must match the SQL oracle) ---
NULL_PLATFORM_EVERY = 97     # l_orderkey % 97 = 0   → platform NULL
NULL_GENRE_EVERY = 89        # l_orderkey % 89 = 0   → genre NULL
NULL_EARLY_EVERY = 83        # l_orderkey % 83 = 0   → is_early_access NULL
NEGATIVE_REVENUE_EVERY = 50  # l_partkey % 50 = 0    → revenue negated
EARLY_ACCESS_FLAG = "R"      # l_returnflag 'R'      → early access
HOLIDAY_MONTHS = [11, 12]
EVENT_GENRE_BUCKETS = 8      # genre = 'G' || user_id % 8
EVENT_PLAYER_SCALE = 2000    # players = floor(value * 2000)
EVENT_HYPE_MODULUS = 11      # hype = floor(value) % 11
# --- end of fixed values ---


# Declared schemas (the columns the adapter reads): no footer-inference job
# per read, and a changed file layout fails loudly instead of drifting.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def state_of(spark: SparkSession, sf_dir: str, names: list[str]) -> int:
    """A number that changes when a file of these tables does: over names, lengths and times of the files, not their rows."""
    files = spark.read.format("binaryFile").load([f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names])
    return files.agg(F.sum(F.xxhash64("path", "length", "modificationTime") % (1 << 40))).first()[0]


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def market_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed market rows (the schema of the raw CSV after typing), one per lineitem."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")
    # A plain equi-join; AQE turns it into a broadcast at runtime only when
    # that side's measured size is under the threshold, and splits skewed key
    # partitions otherwise.
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))

    # One selectExpr: the whole projection is parsed in a single call instead
    # of ~60 Column-API calls (each a driver round trip).
    price_cents = "CAST(ROUND(p_retailprice * 100) AS BIGINT)"
    discount_pc = "CAST(ROUND(l_discount * 100) AS BIGINT)"
    players = "(l_quantity * p_size * 100)"
    revenue_cents = (f"FLOOR((CAST({players} AS BIGINT) * {price_cents} * (100 - {discount_pc})"
                     f" * (5 + 3 * l_linenumber) + 5000) / 10000)")
    months = ", ".join(str(m) for m in HOLIDAY_MONTHS)
    return joined.selectExpr(
        "CAST(l_shipdate AS DATE) AS obs_date",
        f"CASE WHEN l_orderkey % {NULL_PLATFORM_EVERY} = 0 THEN NULL ELSE p_type END AS platform",
        f"CASE WHEN l_orderkey % {NULL_GENRE_EVERY} = 0 THEN NULL ELSE p_brand END AS genre",
        f"CAST(FLOOR(({price_cents} * (100 - {discount_pc}) + 50) / 100) AS DOUBLE) / 100 AS current_price_usd",
        f"CAST({discount_pc} AS DOUBLE) AS discount_pc",
        "CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS is_on_sale",
        f"CAST({players} AS INT) AS concurrent_players",
        "CAST(CAST(ROUND(l_tax * 100) AS BIGINT) AS DOUBLE) AS hype_score",
        f"CASE WHEN l_partkey % {NEGATIVE_REVENUE_EVERY} = 0 THEN -1.0D ELSE 1.0D END"
        f" * CAST({revenue_cents} / 100 AS DOUBLE) AS estimated_revenue_usd",
        f"CASE WHEN l_orderkey % {NULL_EARLY_EVERY} = 0 THEN CAST(NULL AS INT)"
        f" WHEN l_returnflag = '{EARLY_ACCESS_FLAG}' THEN 1 ELSE 0 END AS is_early_access",
        f"CASE WHEN month(l_shipdate) IN ({months}) THEN 1 ELSE 0 END AS holiday_sale",
    )


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List prices before any discount (lineitem ⋈ part), one per lineitem."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        "l_orderkey", "l_linenumber",
        F.col("p_retailprice").alias("base_price_usd"),
        _cents(F.col("l_discount")).cast("double").alias("discount_pc"),
        F.when(F.col("l_discount") > 0, 1).otherwise(0).alias("is_on_sale"),
        (F.col("l_quantity") * F.col("p_size") * 100).cast("int").alias("concurrent_players"),
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed event records (the producer's message fields), one per events row."""
    events = read_table(spark, sf_dir, "events")
    players = F.floor(F.col("value") * EVENT_PLAYER_SCALE)
    return events.select(
        iso_timestamp_text(F.col("ts")).alias("timestamp"),
        F.col("event_type").alias("platform"),
        F.concat(F.lit("G"), (F.col("user_id") % EVENT_GENRE_BUCKETS).cast("string")).alias("genre"),
        players.cast("int").alias("concurrent_players"),
        (F.floor(F.col("value")) % EVENT_HYPE_MODULUS).cast("double").alias("hype_score"),
        F.col("value").alias("current_price_usd"),
        (F.col("event_id") % 2).cast("int").alias("is_on_sale"),
        spike_flag(players).alias("hype_spike"),
    )
