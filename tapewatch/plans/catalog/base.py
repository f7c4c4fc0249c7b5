"""Registration and the shared inputs, in Spark and as SQL common table expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.operators.windows import window_features, window_stats
from tapewatch.session import utc
from tapewatch.sources.tables import EVENTS_ORDER, LINEITEM_ORDER, events_trades, lineitem_trades

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SIZE, SLIDE = "1 hour", "30 minutes"          # events are minutes apart
LONG_SIZE, LONG_SLIDE = "14 days", "7 days"   # lineitem has day precision


def tidy(df: DataFrame, digits: int | None = 6) -> DataFrame:
    """Comparable output: timestamps as epoch seconds, doubles rounded (None: left as they are)."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_seconds(c.cast("timestamp"))
        elif isinstance(field.dataType, T.DoubleType):
            c = (c if digits is None else F.round(c, digits)) + F.lit(0.0)  # no negative zero
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, digits: int | None = 6) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(utc(spark), sf_dir), digits)
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_stats(events_trades(spark, sf_dir), SIZE, SLIDE, order=EVENTS_ORDER)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_features(stats(spark, sf_dir))


def long_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = lineitem_trades(spark, sf_dir)  # four ids do not fit by type, what a table holds may
    return window_stats(trades, LONG_SIZE, LONG_SLIDE, order=LINEITEM_ORDER.measured(trades))


TRADES = """trades AS (
  SELECT event_type AS symbol, value AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         epoch_us(ts) // 1000 AS "timestamp", user_id % 2 = 0 AS is_buyer_maker,
         ts AS event_time, event_id
  FROM events)"""

NULL_TRADES = TRADES.replace("event_type AS symbol", "nullif(event_type, 'view') AS symbol")
HOUR_TRADES = TRADES.replace("ts AS event_time", "date_trunc('hour', ts) AS event_time")

LINE_TRADES = """trades AS (
  SELECT l_returnflag || l_linestatus AS symbol, l_extendedprice / l_quantity AS price,
         l_quantity AS quantity, l_shipdate AS event_time,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem)"""


def _stats_sql(minutes: int, tie: str, extra_key: str = "") -> str:
    key = f"{extra_key}, " if extra_key else ""
    return f"""placed AS (
  SELECT t.*, time_bucket(INTERVAL {minutes} MINUTES, event_time, TIMESTAMP '1970-01-01')
              - o.i * INTERVAL {minutes} MINUTES AS ws
  FROM trades t, (SELECT unnest([0, 1]) AS i) o),
stats AS (
  SELECT {key}symbol, epoch(ws)::BIGINT AS window_start, epoch(ws)::BIGINT + {minutes * 120} AS window_end,
         min(price) AS price_min, max(price) AS price_max, avg(price) AS price_avg,
         var_samp(price) AS price_variance, count(*) AS trade_count, sum(quantity) AS total_volume,
         arg_min(price, (event_time, {tie})) AS price_first,
         arg_max(price, (event_time, {tie})) AS price_last,
         stddev_samp(price) AS price_stddev
  FROM placed GROUP BY {key}symbol, ws)"""


EVENT_STATS_OF = _stats_sql(30, "event_id")
EVENT_STATS = f"{TRADES}, {EVENT_STATS_OF}"
FRAGMENT_STATS = (f"{TRADES.replace('trades AS', 'base AS')}, "
                  f"trades AS (SELECT event_id // 500 AS batch_id, * FROM base), "
                  f"{_stats_sql(30, 'event_id', 'batch_id')}")
LINE_STATS = f"{LINE_TRADES}, {_stats_sql(7 * 24 * 60, 'l_orderkey, l_linenumber, l_partkey, l_suppkey')}"

FEATURES_SQL = """feats AS (
  SELECT *,
    CASE WHEN price_first <> 0 THEN (price_last - price_first) / price_first ELSE 0 END AS pct_return,
    CASE WHEN price_avg <> 0 THEN coalesce(price_stddev, 0) / price_avg ELSE 0 END AS volatility,
    CASE WHEN trade_count <> 0 THEN total_volume / trade_count ELSE 0 END AS volume_intensity,
    CASE WHEN price_avg <> 0 THEN (price_max - price_min) / price_avg ELSE 0 END AS price_speed
  FROM stats)"""
EVENT_FEATURES = f"{EVENT_STATS}, {FEATURES_SQL}"
LINE_FEATURES = f"{LINE_STATS}, {FEATURES_SQL}"

STAT_COLUMNS = """symbol, window_start, window_end, round(price_min, 6) AS price_min,
  round(price_max, 6) AS price_max, round(price_avg, 6) AS price_avg,
  round(price_variance, 6) AS price_variance, trade_count, round(total_volume, 6) AS total_volume,
  round(price_first, 6) AS price_first, round(price_last, 6) AS price_last,
  round(price_stddev, 6) AS price_stddev"""
FEATURE_COLUMNS = """round(pct_return, 6) AS pct_return, round(volatility, 6) AS volatility,
  round(volume_intensity, 6) AS volume_intensity, round(price_speed, 6) AS price_speed"""


def r(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)
