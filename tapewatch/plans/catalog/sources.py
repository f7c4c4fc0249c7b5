"""Decoding, validation and file sinks; messages are derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewatch.operators.summaries import group_count
from tapewatch.plans.catalog.base import EVENT_STATS, TRADES, query, r, stats, table
from tapewatch.session import fresh_path
from tapewatch.sources.sinks import append_parquet, compact, export_csv, overwrite_parquet
from tapewatch.sources.tables import events_trades, read_csv, read_parquet, resolve_path
from tapewatch.sources.trades import decode_trades, encode_trades, normalise_payload, valid_trades, with_event_time


def _messages(spark, sf):
    """One JSON message per event; every 97th is no JSON, every 89th has text for a price."""
    trades = events_trades(spark, sf)
    e = F.col("event_id")
    price = F.when(e % 89 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    good = F.to_json(F.struct("symbol", "price", "quantity", "timestamp", "is_buyer_maker", F.lit(True).alias("test")))
    bad = F.to_json(F.struct("symbol", price.alias("price"), "quantity", "timestamp", "is_buyer_maker"))
    value = F.when(e % 97 == 0, F.lit("garbage")).when(e % 89 == 0, bad).otherwise(good)
    return trades.select("event_id", value.cast("binary").alias("value"))


@query("decode_trades", f"""WITH {TRADES} SELECT event_id,
  CASE WHEN event_id % 97 <> 0 THEN symbol END AS symbol,
  CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN round(price, 6) END AS price,
  CASE WHEN event_id % 97 <> 0 THEN round(quantity, 6) END AS quantity,
  CASE WHEN event_id % 97 <> 0 THEN "timestamp" END AS "timestamp",
  CASE WHEN event_id % 97 <> 0 THEN is_buyer_maker END AS is_buyer_maker,
  CASE WHEN event_id % 97 <> 0 THEN "timestamp" // 1000 END AS event_time FROM trades""")
def _(spark, sf):
    return with_event_time(decode_trades(_messages(spark, sf), keep=["event_id"]))


@query("event_time", f"""WITH {TRADES} SELECT event_id, "timestamp", "timestamp" * 1000 AS event_us FROM trades""")
def _(spark, sf):
    timed = with_event_time(events_trades(spark, sf).drop("event_time"))
    return timed.select("event_id", "timestamp", F.unix_micros("event_time").alias("event_us"))


def _payloads(spark, sf):
    """Exchange messages: even events enveloped, odd ones bare; some lack a key or a number."""
    trades = events_trades(spark, sf)
    e = F.col("event_id")
    payload = F.struct(
        F.col("symbol").alias("s"),
        F.when(e % 83 == 0, F.lit("abc")).otherwise(F.col("price").cast("string")).alias("p"),
        F.when(e % 79 != 0, F.col("quantity").cast("string")).alias("q"),
        F.col("timestamp").alias("T"), F.col("is_buyer_maker").alias("m"))
    enveloped = F.to_json(F.struct(F.concat("symbol", F.lit("@trade")).alias("stream"), payload.alias("data")))
    value = F.when(e % 97 == 0, F.lit("garbage")).when(e % 2 == 0, enveloped).otherwise(F.to_json(payload))
    return trades.select("event_id", value.alias("value"))


_REJECTED = "event_id % 97 = 0 OR event_id % 83 = 0 OR event_id % 79 = 0"


@query("normalise_payload", f"""WITH {TRADES} SELECT event_id, symbol, {r('price', 'quantity')}, "timestamp", is_buyer_maker
FROM trades WHERE NOT ({_REJECTED})""")
def _(spark, sf):
    return normalise_payload(_payloads(spark, sf))[0]


@query("normalise_payload_rejected", f"SELECT event_id FROM events WHERE {_REJECTED}")
def _(spark, sf):
    return normalise_payload(_payloads(spark, sf))[1].select("event_id")


@query("encode_trades", f"""WITH {TRADES} SELECT event_id, json_object('symbol', symbol, 'price', price, 'quantity', quantity,
  'timestamp', "timestamp", 'is_buyer_maker', is_buyer_maker)::VARCHAR AS value FROM trades""")
def _(spark, sf):
    return encode_trades(events_trades(spark, sf), keep=["event_id"])


@query("encode_decode", f"""WITH {TRADES} SELECT symbol, {r('price', 'quantity')}, "timestamp", is_buyer_maker FROM trades""")
def _(spark, sf):
    return decode_trades(encode_trades(events_trades(spark, sf)))


@query("valid_trades", f"""WITH {TRADES} SELECT event_id, upper(symbol) AS symbol, {r('price', 'quantity')} FROM trades
WHERE symbol IN ('click', 'view', 'purchase') AND event_id % 83 <> 0 AND event_id % 79 <> 0""")
def _(spark, sf):
    e = F.col("event_id")
    records = events_trades(spark, sf).select(
        "event_id", "symbol", F.col("timestamp").cast("string").alias("timestamp"),
        F.when(e % 83 == 0, F.lit("abc")).otherwise(F.col("price").cast("string")).alias("price"),
        F.when(e % 79 != 0, F.col("quantity").cast("string")).alias("quantity"))
    return valid_trades(records, ["CLICK", "VIEW", "PURCHASE"]).select("event_id", "symbol", "price", "quantity")


@query("valid_trades_by_table", f"""WITH {TRADES}, listed AS (SELECT symbol FROM trades GROUP BY 1 HAVING max(price) > 300)
SELECT event_id, upper(symbol) AS symbol, round(price, 6) AS price FROM trades WHERE symbol IN (SELECT symbol FROM listed)""")
def _(spark, sf):
    trades = events_trades(spark, sf)
    listed = (trades.groupBy(F.upper("symbol").alias("symbol")).agg(F.max("price").alias("top"))
              .filter("top > 300"))
    return valid_trades(trades, listed).select("event_id", "symbol", "price")


@query("parquet_source", "SELECT event_id, event_type, round(value, 6) AS value FROM events")
def _(spark, sf):
    return read_parquet(spark, f"{sf}/events.parquet").select("event_id", "event_type", "value")


@query("fallback_source", "SELECT event_type, count(*) AS \"count\" FROM events GROUP BY 1")
def _(spark, sf):
    path = resolve_path(spark, [f"{sf}/finished.parquet", f"{sf}/events.parquet"])
    return group_count(read_parquet(spark, path), "event_type")


@query("parquet_append", f"""WITH {TRADES} SELECT event_id % 3 AS batch_id, symbol, count(*) AS "count" FROM trades GROUP BY 1, 2""")
def _(spark, sf):
    path, trades = fresh_path(spark, "appended"), events_trades(spark, sf)
    for batch in (0, 1, 1, 2):  # batch 1 is retried and must count once
        append_parquet(trades.filter(F.col("event_id") % 3 == batch), path, batch)
    back = read_parquet(spark, path).withColumn("batch_id", F.col("batch_id").cast("long"))
    return group_count(back, "batch_id", "symbol")


@query("parquet_compact", f"WITH {EVENT_STATS} SELECT symbol, window_start, trade_count, {r('price_avg')} FROM stats")
def _(spark, sf):
    source, target = fresh_path(spark, "small-files"), fresh_path(spark, "compacted")
    overwrite_parquet(stats(spark, sf).repartition(16), source)
    return compact(spark, source, target).select("symbol", "window_start", "trade_count", "price_avg")


@query("csv_roundtrip", f"""WITH {EVENT_STATS} SELECT symbol, {r('price_avg', 'price_variance')}, trade_count,
  strftime(make_timestamp(window_start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start_str FROM stats""")
def _(spark, sf):
    path = fresh_path(spark, "csv")
    out = stats(spark, sf).select("symbol", "price_avg", "price_variance", "trade_count", "window_start")
    export_csv(out, path, order_by="window_start")
    schema = ("symbol string, price_avg double, price_variance double, trade_count long, "
              "window_start timestamp, window_start_str string")
    return read_csv(spark, path, schema).drop("window_start")
