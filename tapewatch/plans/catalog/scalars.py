"""Projections and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewatch.functions import frames
from tapewatch.functions import scalars as S
from tapewatch.plans.catalog.base import EVENT_FEATURES, EVENT_STATS, TRADES, features, query, stats, table
from tapewatch.schema import WINDOW_COLUMNS
from tapewatch.sources.tables import events_trades


@query("flatten_struct", f"WITH {TRADES} SELECT event_id, symbol, round(price, 6) AS price FROM trades")
def _(spark, sf):
    nested = events_trades(spark, sf).select("event_id", F.struct("symbol", "price").alias("trade"))
    return frames.flatten(nested, "trade")


@query("drop_and_rename", f"WITH {EVENT_STATS} SELECT symbol AS ticker, window_start, trade_count FROM stats")
def _(spark, sf):
    kept = frames.drop_cols(stats(spark, sf), "price_min", "price_max", "price_avg", "price_variance",
                            "total_volume", "price_first", "price_last", "price_stddev", "window_end")
    return frames.rename(kept, "symbol", "ticker")


@query("fixed_projection", f"""WITH {EVENT_FEATURES} SELECT symbol, window_start, window_end,
  round(price_min, 6) AS price_min, round(price_max, 6) AS price_max, round(price_avg, 6) AS price_avg,
  round(price_variance, 6) AS price_variance, trade_count, round(total_volume, 6) AS total_volume,
  round(pct_return, 6) AS pct_return, round(volatility, 6) AS volatility,
  round(volume_intensity, 6) AS volume_intensity, round(price_speed, 6) AS price_speed FROM feats""")
def _(spark, sf):
    return frames.project(features(spark, sf), WINDOW_COLUMNS)


@query("dropna", f"""WITH {EVENT_STATS} SELECT symbol, window_start, round(price_variance, 6) AS price_variance
FROM stats WHERE price_variance IS NOT NULL AND price_avg IS NOT NULL""")
def _(spark, sf):
    return (frames.dropna(stats(spark, sf), ["price_variance", "price_avg"])
            .select("symbol", "window_start", "price_variance"))


@query("label_when", """SELECT event_id, CASE WHEN value > 100 THEN 'anomalo' ELSE 'normal' END AS label,
  CASE WHEN value > 100 THEN 1 ELSE 0 END AS label_binary FROM events""")
def _(spark, sf):
    flagged = events_trades(spark, sf).withColumn("label_binary", S.label_when(F.col("price") > 100, 1, 0))
    return flagged.select("event_id", S.label_text("label_binary").alias("label"), "label_binary")


@query("null_default", f"""WITH {EVENT_STATS} SELECT symbol, window_start,
  round(coalesce(price_stddev, 0), 6) AS price_stddev FROM stats""")
def _(spark, sf):
    return stats(spark, sf).select("symbol", "window_start",
                                   S.or_default("price_stddev", 0.0).alias("price_stddev"))


@query("guarded_division", """SELECT event_id, round(CASE WHEN event_id % 7 <> 0 THEN value / (event_id % 7) ELSE 0 END, 6)
  AS ratio FROM events""")
def _(spark, sf):
    return events_trades(spark, sf).select(
        "event_id", S.safe_div("price", (F.col("event_id") % 7).cast("double")).alias("ratio"))


@query("casts", """SELECT event_id, value::VARCHAR AS as_text, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS as_long,
  TRY_CAST(event_type AS DOUBLE) AS bad_number, epoch_us(ts) // 1000000 AS as_time FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", S.text(S.text("value").cast("binary")).alias("as_text"),
        S.whole_number(F.get_json_object("props", "$.k")).alias("as_long"),
        S.number("event_type").alias("bad_number"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")).withColumn(
            "as_time", F.timestamp_millis("ms")).drop("ms")


@query("modulo_multiply", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_orderkey % 1000)::INTEGER AS g,
  l_orderkey * 1.5::DOUBLE AS v FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_orderkey") % 1000).cast("int").alias("g"),
        (F.col("l_orderkey") * F.lit(1.5)).alias("v"))


@query("format_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def _(spark, sf):
    return events_trades(spark, sf).select("event_id", S.fmt_ts("event_time").alias("at"))


@query("parse_timestamp", "SELECT event_id, epoch_us(ts) // 1000000 AS at FROM events")
def _(spark, sf):
    as_text = events_trades(spark, sf).select("event_id", S.fmt_ts("event_time").alias("at"))
    return as_text.select("event_id", S.parse_ts("at").alias("at"))


@query("iso_timestamp", """SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%dT%H:%M:%S.%g+00:00')
  AS iso FROM events""")
def _(spark, sf):
    return events_trades(spark, sf).select("event_id", S.iso_ts("timestamp").alias("iso"))


@query("sigmoid", """SELECT event_id, round(CASE WHEN x >= 0 THEN 1 / (1 + exp(-x)) ELSE exp(x) / (1 + exp(x)) END, 9) AS p
FROM (SELECT event_id, (value - 50) / 10 AS x FROM events)""", digits=9)
def _(spark, sf):
    return events_trades(spark, sf).select("event_id", S.sigmoid((F.col("price") - 50) / 10).alias("p"))


@query("euclidean", """SELECT vec_id, round(list_distance(embedding::DOUBLE[], list_transform(embedding, lambda x: 0.5::DOUBLE * x)), 5)
  AS distance FROM embeddings""", digits=5)
def _(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))
    halved = F.transform("e", lambda x: x * 0.5)
    return vectors.select("vec_id", S.euclidean("e", halved).alias("distance"))


@query("symbol_case", "SELECT event_id, upper(event_type) AS symbol FROM events")
def _(spark, sf):
    return events_trades(spark, sf).select("event_id", S.norm_symbol("symbol").alias("symbol"))
