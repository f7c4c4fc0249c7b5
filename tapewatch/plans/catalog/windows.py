"""Window statistics, features, fragments and what is read off them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tapewatch.functions.frames import newest, recent, sort_by, top_by_key
from tapewatch.operators import series
from tapewatch.operators.windows import (merge_fragments, min_trades, pane_window_stats, readable_bounds,
                                         window_features, window_fragments, window_stats)
from tapewatch.plans.catalog.base import (EVENT_FEATURES, EVENT_STATS, EVENT_STATS_OF, FEATURE_COLUMNS, FRAGMENT_STATS, HOUR_TRADES,
                                          LINE_FEATURES, LINE_STATS, LINE_TRADES, LONG_SIZE, LONG_SLIDE, NULL_TRADES, SIZE,
                                          SLIDE, STAT_COLUMNS, TRADES, features, long_stats, query, r, stats)
from tapewatch.sources.tables import EVENTS_ORDER, LINEITEM_ORDER, events_trades, lineitem_trades

ASOF = datetime(2024, 1, 15, 12, 0, 0)
ASOF_SQL = "TIMESTAMP '2024-01-15 12:00:00'"


@query("window_stats", f"WITH {EVENT_STATS} SELECT {STAT_COLUMNS} FROM stats")
def _(spark, sf):
    return stats(spark, sf)


@query("window_stats_population", f"""WITH {EVENT_STATS}
SELECT symbol, epoch(ws)::BIGINT AS window_start, round(var_pop(price), 6) AS price_variance,
       round(stddev_pop(price), 6) AS price_stddev FROM placed GROUP BY symbol, ws""")
def _(spark, sf):
    out = window_stats(events_trades(spark, sf), SIZE, SLIDE, order=EVENTS_ORDER, ddof=0)
    return out.select("symbol", "window_start", "price_variance", "price_stddev")


@query("window_stats_panes", f"WITH {EVENT_STATS} SELECT {STAT_COLUMNS} FROM stats")
def _(spark, sf):
    return pane_window_stats(events_trades(spark, sf), SIZE, SLIDE, order=EVENTS_ORDER)


@query("window_stats_short_panes", f"WITH {EVENT_STATS} SELECT {STAT_COLUMNS} FROM stats")
def _(spark, sf):
    return pane_window_stats(events_trades(spark, sf), SIZE, SLIDE, order=EVENTS_ORDER, pane="5 minutes")


# Prices are cents over quantities up to 50: at most 7 decimals, so 8 digits never round a half.
# Their means have no such bound and are compared at single precision.
@query("window_stats_lineitem", f"""WITH {LINE_STATS} SELECT symbol, window_start, window_end,
  {r('price_min', 'price_max', 'price_first', 'price_last', digits=8)}, 
  price_avg::FLOAT::DOUBLE AS price_avg, price_variance::FLOAT::DOUBLE AS price_variance,
  price_stddev::FLOAT::DOUBLE AS price_stddev, trade_count, total_volume FROM stats""", digits=None)
def _(spark, sf):
    means = ("price_avg", "price_variance", "price_stddev")
    prices = ("price_min", "price_max", "price_first", "price_last")
    return long_stats(spark, sf).withColumns(
        {c: F.col(c).cast("float").cast("double") for c in means} | {c: F.round(c, 8) for c in prices})


@query("window_features", f"WITH {EVENT_FEATURES} SELECT {STAT_COLUMNS}, {FEATURE_COLUMNS} FROM feats")
def window_features_query(spark, sf):
    return features(spark, sf)


@query("window_features_lineitem",
       f"WITH {LINE_FEATURES} SELECT symbol, window_start, {FEATURE_COLUMNS} FROM feats")
def _(spark, sf):
    out = window_features(long_stats(spark, sf))
    return out.select("symbol", "window_start", "pct_return", "volatility", "volume_intensity", "price_speed")


def _fragments(spark, sf):
    trades = events_trades(spark, sf).withColumn("batch_id", (F.col("event_id") / 500).cast("long"))
    return window_fragments(trades, "batch_id", SIZE, SLIDE, EVENTS_ORDER)


@query("window_fragments", f"WITH {FRAGMENT_STATS} SELECT batch_id, {STAT_COLUMNS} FROM stats")
def _(spark, sf):
    return _fragments(spark, sf).drop("first_time", "last_time", "first_event_id", "last_event_id")


@query("merge_fragments", f"WITH {EVENT_STATS} SELECT {STAT_COLUMNS} FROM stats")
def _(spark, sf):
    return merge_fragments(_fragments(spark, sf), "batch_id", order=EVENTS_ORDER)


@query("merge_fragments_tied", f"WITH {HOUR_TRADES}, {EVENT_STATS_OF} SELECT {STAT_COLUMNS} FROM stats")
def _(spark, sf):
    """Many trades share an instant, and batches are not in the order of ids."""
    trades = events_trades(spark, sf).withColumns({"event_time": F.date_trunc("hour", "event_time"),
                                                   "batch_id": F.col("event_id") * 7919 % 13})
    return merge_fragments(window_fragments(trades, "batch_id", SIZE, SLIDE, EVENTS_ORDER), "batch_id", order=EVENTS_ORDER)


@query("min_trades", f"WITH {EVENT_STATS} SELECT {STAT_COLUMNS} FROM stats WHERE trade_count >= 3")
def _(spark, sf):
    return min_trades(stats(spark, sf), 3)


@query("readable_bounds", f"""WITH {EVENT_STATS}
SELECT symbol, window_start, strftime(make_timestamp(window_start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start_str,
       strftime(make_timestamp(window_end * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end_str FROM stats""")
def _(spark, sf):
    return readable_bounds(stats(spark, sf)).select("symbol", "window_start", "window_start_str", "window_end_str")


@query("latest_price", f"""WITH {TRADES}
SELECT symbol, round(arg_max(price, (event_time, event_id)), 6) AS price,
       epoch_us(max(event_time)) // 1000000 AS event_time FROM trades GROUP BY symbol""")
def _(spark, sf):
    return series.latest_price(events_trades(spark, sf), EVENTS_ORDER)


_CHANGE = """SELECT symbol, round(first_price, 6) AS first_price, round(last_price, 6) AS last_price, trades,
  round(CASE WHEN trades >= 2 AND first_price <> 0 THEN (last_price - first_price) / first_price * 100 END, 6)
    AS change_pct
FROM (SELECT symbol, arg_min(price, (event_time, event_id)) AS first_price,
             arg_max(price, (event_time, event_id)) AS last_price, count(*) AS trades
      FROM inside GROUP BY symbol)"""


@query("trailing_change", f"""WITH {TRADES},
newest AS (SELECT symbol, max(event_time) AS newest_time FROM trades GROUP BY symbol),
inside AS (SELECT t.* FROM trades t JOIN newest USING (symbol) WHERE event_time >= newest_time - INTERVAL 6 HOURS)
{_CHANGE}""")
def _(spark, sf):
    return series.trailing_change(events_trades(spark, sf), seconds=6 * 3600, order=EVENTS_ORDER)


@query("trailing_change_asof", f"""WITH {TRADES},
inside AS (SELECT * FROM trades WHERE event_time >= {ASOF_SQL} - INTERVAL 6 HOURS AND event_time <= {ASOF_SQL})
{_CHANGE}""")
def _(spark, sf):
    return series.trailing_change(events_trades(spark, sf), ASOF, 6 * 3600, EVENTS_ORDER)


@query("pct_change_from_start", f"""WITH {TRADES},
base AS (SELECT symbol, arg_min(price, (event_time, event_id)) AS base_price FROM trades GROUP BY symbol)
SELECT event_id, symbol, round(CASE WHEN base_price <> 0 THEN (price - base_price) / base_price * 100 END, 6)
  AS pct_change FROM trades JOIN base USING (symbol)""")
def _(spark, sf):
    out = series.pct_change_from_start(events_trades(spark, sf), EVENTS_ORDER)
    return out.select("event_id", "symbol", "pct_change")


def _null_symbols(spark, sf):
    return events_trades(spark, sf).withColumn("symbol", F.nullif("symbol", F.lit("view")))


@query("pct_change_from_start_null", f"""WITH {NULL_TRADES},
base AS (SELECT symbol, arg_min(price, (event_time, event_id)) AS base_price FROM trades GROUP BY symbol)
SELECT event_id, t.symbol, round(CASE WHEN base_price <> 0 THEN (price - base_price) / base_price * 100 END, 6)
  AS pct_change FROM trades t JOIN base b ON t.symbol IS NOT DISTINCT FROM b.symbol""")
def _(spark, sf):
    out = series.pct_change_from_start(_null_symbols(spark, sf), EVENTS_ORDER)
    return out.select("event_id", "symbol", "pct_change")


@query("last_n_per_symbol_null", f"""WITH {NULL_TRADES}
SELECT event_id, symbol, round(price, 6) AS price FROM trades
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, event_id DESC) <= 500""")
def _(spark, sf):
    return series.last_n_per_symbol(_null_symbols(spark, sf), 500, EVENTS_ORDER).select("event_id", "symbol", "price")


@query("trailing_change_null", f"""WITH {NULL_TRADES},
newest AS (SELECT symbol, max(event_time) AS newest_time FROM trades GROUP BY symbol),
inside AS (SELECT t.* FROM trades t JOIN newest n ON t.symbol IS NOT DISTINCT FROM n.symbol
           WHERE event_time >= newest_time - INTERVAL 6 HOURS)
{_CHANGE}""")
def _(spark, sf):
    return series.trailing_change(_null_symbols(spark, sf), seconds=6 * 3600, order=EVENTS_ORDER)


@query("recent_trades", f"""WITH {TRADES} SELECT event_id, symbol, round(price, 6) AS price FROM trades
WHERE event_time >= {ASOF_SQL} - INTERVAL 1 DAY AND event_time <= {ASOF_SQL}""")
def _(spark, sf):
    return recent(events_trades(spark, sf), ASOF, 86_400).select("event_id", "symbol", "price")


@query("last_n_per_symbol", f"""WITH {TRADES}
SELECT event_id, symbol, round(price, 6) AS price FROM trades
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, event_id DESC) <= 500""")
def _(spark, sf):
    return series.last_n_per_symbol(events_trades(spark, sf), 500, EVENTS_ORDER).select("event_id", "symbol", "price")


@query("last_n_per_symbol_lineitem", f"""WITH {LINE_TRADES}
SELECT symbol, l_orderkey, l_linenumber, l_partkey, round(price, 8) AS price FROM trades
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, l_orderkey DESC, l_linenumber DESC,
                           l_partkey DESC, l_suppkey DESC) <= 5000""", digits=8)
def _(spark, sf):
    return (series.last_n_per_symbol(lineitem_trades(spark, sf), 5000, LINEITEM_ORDER)
            .select("symbol", "l_orderkey", "l_linenumber", "l_partkey", "price"))


_RATIO = """SELECT symbol, window_start, round(total_volume, 6) AS total_volume,
  round(avg_before, 6) AS volume_moving_avg,
  round(CASE WHEN avg_before <> 0 THEN total_volume / avg_before END, 6) AS volume_ratio
FROM (SELECT *, avg(total_volume) OVER (PARTITION BY symbol ORDER BY window_start
             ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS avg_before FROM stats)"""


@query("volume_ratio", f"WITH {EVENT_STATS} {_RATIO}")
def _(spark, sf):
    return series.volume_ratio(stats(spark, sf), 10).select(
        "symbol", "window_start", "total_volume", "volume_moving_avg", "volume_ratio")


@query("volume_ratio_null", f"WITH {NULL_TRADES}, {EVENT_STATS_OF} {_RATIO}")
def _(spark, sf):
    windows = window_stats(_null_symbols(spark, sf), SIZE, SLIDE, order=EVENTS_ORDER)
    return series.volume_ratio(windows, 10).select(
        "symbol", "window_start", "total_volume", "volume_moving_avg", "volume_ratio")


@query("price_band", f"""WITH {EVENT_STATS} SELECT symbol, window_start, {r('price_avg', 'price_min', 'price_max')}
FROM stats WHERE symbol IN ('click', 'purchase')""")
def _(spark, sf):
    return series.price_band(stats(spark, sf), ["click", "purchase"])


@query("sort_one_column", f"WITH {EVENT_STATS} SELECT symbol, window_start, {r('price_avg')} FROM stats")
def _(spark, sf):
    return sort_by(stats(spark, sf), "window_start").select("symbol", "window_start", "price_avg")


@query("sort_two_columns", f"WITH {EVENT_STATS} SELECT symbol, window_start, trade_count FROM stats")
def _(spark, sf):
    return sort_by(stats(spark, sf), "symbol", "window_start").select("symbol", "window_start", "trade_count")


@query("newest_message", f"""WITH {TRADES} SELECT event_id, symbol, round(price, 6) AS price FROM trades
ORDER BY event_time DESC, event_id DESC LIMIT 1""")
def _(spark, sf):
    return newest(events_trades(spark, sf), "event_time", 1, ["event_id"]).select("event_id", "symbol", "price")


@query("top_by_key", """SELECT l_orderkey % 1000 AS g, round(avg(l_quantity * 1.5), 6) AS avg_v,
  round(sum(l_quantity * 1.5), 3) AS sum_v FROM lineitem GROUP BY 1 ORDER BY g LIMIT 3""")
def _(spark, sf):
    from tapewatch.plans.catalog.summaries import grouped_lineitem
    return top_by_key(grouped_lineitem(spark, sf), "g", 3)
