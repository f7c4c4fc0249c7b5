"""Counts, shares, histograms, throughput, set operations and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewatch.functions import frames
from tapewatch.operators import joins, summaries
from tapewatch.operators.quantiles import (exact_percentiles, merge_sketches, percentile_threshold, rank_error,
                                          sketch_percentile, sketch_values)
from tapewatch.plans.catalog.base import (EVENT_FEATURES, EVENT_STATS, LINE_TRADES, SIZE, SLIDE, TRADES, features,
                                          query, r, stats, table)
from tapewatch.plans.catalog.models import LABELED_SQL, SCORED_SQL, labeled, scored
from tapewatch.plans.catalog.windows import ASOF, ASOF_SQL
from tapewatch.session import fresh_path, settle
from tapewatch.sources.bucketed import write_bucketed
from tapewatch.sources.tables import events_trades, lineitem_trades


@query("group_count", "SELECT event_type AS symbol, count(*) AS \"count\" FROM events GROUP BY 1")
def _(spark, sf):
    return summaries.group_count(events_trades(spark, sf), "symbol")


@query("count_where", f"""WITH {SCORED_SQL} SELECT count(*) FILTER (WHERE prediction = 0) AS normal,
  count(*) FILTER (WHERE prediction = 1) AS anomalous FROM scored""")
def _(spark, sf):
    p = F.col("prediction")
    return summaries.count_where(scored(spark, sf), normal=p == 0, anomalous=p == 1)


@query("row_count", "SELECT count(*) AS rows, count(*) = 0 AS is_empty FROM events")
def _(spark, sf):
    return summaries.row_count(events_trades(spark, sf))


def grouped_lineitem(spark, sf):
    base = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 1000).alias("g"), (F.col("l_quantity") * 1.5).alias("v"))
    return summaries.group_mean_sum(base, "g", "v").withColumn("sum_v", F.round("sum_v", 3))


@query("group_mean_sum", """SELECT l_orderkey % 1000 AS g, round(avg(l_quantity * 1.5), 6) AS avg_v,
  round(sum(l_quantity * 1.5), 3) AS sum_v FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return grouped_lineitem(spark, sf)


@query("percentile_exact", """SELECT round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.5), 6) AS p50 FROM events""")
def _(spark, sf):
    trades = events_trades(spark, sf).select("price")
    p95, p50 = exact_percentiles(trades, "price", [0.95, 0.5])
    return spark.range(1).select(F.lit(p95).alias("p95"), F.lit(p50).alias("p50"))


@query("percentile_exact_lineitem", """SELECT round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS p50 FROM lineitem""")
def _(spark, sf):
    prices = table(spark, sf, "lineitem").select("l_extendedprice")
    p95, p50 = exact_percentiles(prices, "l_extendedprice", [0.95, 0.5])
    return spark.range(1).select(F.lit(p95).alias("p95"), F.lit(p50).alias("p50"))


@query("percentile_approximate")
def _(spark, sf):
    found = percentile_threshold(events_trades(spark, sf), "price", 0.95, exact=False)
    return spark.range(1).select(F.lit(found).alias("p95"))


@query("percentile_approximate_within", "SELECT count(*) AS rows, true AS within FROM lineitem")
def _(spark, sf):
    """The rank of the sketch's answer differs from the wanted one by at most the accuracy."""
    lines = table(spark, sf, "lineitem")
    found = percentile_threshold(lines, "l_extendedprice", 0.95, exact=False, accuracy=100)
    price, n = F.col("l_extendedprice"), F.count(F.lit(1))
    return lines.agg(n.alias("rows"), ((F.count_if(price < found) <= n * 0.96) & (F.count_if(price <= found) >= n * 0.94)).alias("within"))


def _daily_sketches(spark, sf):
    """One sketch of the prices of each day, as a table that grows by a row a day."""
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"), "l_extendedprice")
    return settle(sketch_values(days, "l_extendedprice", ["day"]), "sketches")


@query("percentile_of_merged_sketches", """SELECT count(*) AS rows, count(*) AS sketched, true AS within FROM lineitem""")
def _(spark, sf):
    """The rank of what merged daily sketches answer is off by their rank error at most."""
    sketches, prices = _daily_sketches(spark, sf), table(spark, sf, "lineitem")
    (found,) = sketch_percentile(sketches, 0.95)
    (n,) = merge_sketches(sketches).select("n").first()
    price, rows, error = F.col("l_extendedprice"), F.count(F.lit(1)), rank_error()
    return prices.agg(rows.alias("rows"), F.lit(n).alias("sketched"), (
        (F.count_if(price < found) <= rows * (0.95 + error)) & (F.count_if(price <= found) >= rows * (0.95 - error))).alias("within"))


@query("percentile_exact_by_sketches", """SELECT round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
  round(quantile_cont(l_extendedprice, 0.01), 6) AS p01 FROM lineitem""")
def _(spark, sf):
    """Stored sketches spare the first scan."""
    prices = table(spark, sf, "lineitem").select("l_extendedprice")
    p95, p01 = exact_percentiles(prices, "l_extendedprice", [0.95, 0.01], accuracy=1_000, sketches=_daily_sketches(spark, sf))
    return spark.range(1).select(F.lit(p95).alias("p95"), F.lit(p01).alias("p01"))


@query("windows_per_symbol", f"WITH {EVENT_STATS} SELECT symbol, count(*) AS windows FROM stats GROUP BY 1")
def _(spark, sf):
    return summaries.windows_per_symbol(stats(spark, sf))


@query("mean_trades_per_window", f"""WITH {EVENT_STATS}
SELECT symbol, round(avg(trade_count), 6) AS mean_trades FROM stats GROUP BY 1""")
def _(spark, sf):
    return summaries.mean_trades_per_window(stats(spark, sf))


@query("anomaly_share", f"""WITH {LABELED_SQL} SELECT count(*) FILTER (WHERE label = 'anomalo') AS anomalies,
  count(*) AS windows, round(100.0::DOUBLE * count(*) FILTER (WHERE label = 'anomalo') / count(*), 6) AS anomaly_pct
FROM labeled""")
def _(spark, sf):
    return summaries.anomaly_share(labeled(spark, sf))


@query("anomaly_rate_by_symbol", f"""WITH {LABELED_SQL}
SELECT symbol, round(100.0::DOUBLE * count(*) FILTER (WHERE label = 'anomalo') / count(*), 6) AS anomaly_pct
FROM labeled GROUP BY 1""")
def _(spark, sf):
    return summaries.anomaly_rate_by_symbol(labeled(spark, sf))


@query("cluster_by_symbol", f"""WITH {LABELED_SQL} SELECT symbol, count(*) FILTER (WHERE prediction = 0) AS cluster_0,
  count(*) FILTER (WHERE prediction = 1) AS cluster_1, count(*) FILTER (WHERE prediction = 2) AS cluster_2
FROM labeled GROUP BY 1""")
def _(spark, sf):
    return summaries.cluster_by_symbol(labeled(spark, sf), [0, 1, 2])


@query("empirical_threshold", f"""WITH {LABELED_SQL}
SELECT round(min(distance_to_centroid), 6) AS threshold FROM labeled WHERE label = 'anomalo'""")
def _(spark, sf):
    return summaries.empirical_threshold(labeled(spark, sf))


@query("session_totals", f"""WITH {LABELED_SQL} SELECT (SELECT count(*) FROM events) AS total_trades,
  count(*) AS total_windows, count(*) FILTER (WHERE label = 'anomalo') AS total_anomalies FROM labeled""")
def _(spark, sf):
    return summaries.session_totals(events_trades(spark, sf), labeled(spark, sf))


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""bounds AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}),
bins AS (SELECT unnest(range({bins}))::INTEGER AS bin),
counted AS (SELECT least(floor(({column} - lo) * {bins}::DOUBLE / (hi - lo)), {bins - 1})::INTEGER AS bin, count(*) AS n
            FROM {source}, bounds GROUP BY 1)"""


@query("histogram", f"""WITH {_histogram_sql('events', 'value', 40)}
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 40), 6) AS bin_lo, round(lo + (b.bin + 1) * ((hi - lo) / 40), 6) AS bin_hi,
       coalesce(n, 0) AS n FROM bins b CROSS JOIN bounds LEFT JOIN counted USING (bin)""")
def _(spark, sf):
    return summaries.histogram(events_trades(spark, sf), "price", 40)


@query("histogram_not_finite", f"""WITH good AS (SELECT value FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0),
{_histogram_sql('good', 'value', 40)}
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 40), 6) AS bin_lo, round(lo + (b.bin + 1) * ((hi - lo) / 40), 6) AS bin_hi,
       coalesce(n, 0) AS n FROM bins b CROSS JOIN bounds LEFT JOIN counted USING (bin)""")
def _(spark, sf):
    price = (F.when(F.col("event_id") % 7 == 0, float("nan")).when(F.col("event_id") % 11 == 0, float("-inf"))
             .otherwise(F.col("price")))
    return summaries.histogram(events_trades(spark, sf).withColumn("price", price), "price", 40)


@query("histogram_density", f"""WITH {_histogram_sql('events', 'value', 20)}
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 20), 6) AS bin_lo, round(lo + (b.bin + 1) * ((hi - lo) / 20), 6) AS bin_hi,
       round(coalesce(n, 0) / ((SELECT count(*) FROM events) * ((hi - lo) / 20)), 9) AS density
FROM bins b CROSS JOIN bounds LEFT JOIN counted USING (bin)""", digits=9)
def _(spark, sf):
    out = summaries.histogram(events_trades(spark, sf), "price", 20, density=True)
    return out.withColumns({c: F.round(c, 6) for c in ("bin_lo", "bin_hi")})


def _drift_sql(feature: str) -> str:
    return f"""SELECT '{feature}' AS feature, side, least(floor((v - lo) * 30::DOUBLE / (hi - lo)), 29)::INTEGER AS bin,
  (hi - lo) / 30 AS width FROM (SELECT {feature} AS v, side FROM sided),
  (SELECT min({feature}) AS lo, max({feature}) AS hi FROM sided)"""


_DRIFT = " UNION ALL ".join(_drift_sql(f) for f in ("pct_return", "volatility", "volume_intensity", "price_speed"))


@query("feature_drift", f"""WITH {EVENT_FEATURES},
sided AS (SELECT *, CASE WHEN window_start < 1705320000 THEN 'first' ELSE 'second' END AS side FROM feats),
binned AS ({_DRIFT}),
counted AS (SELECT feature, side, bin, count(*) AS n FROM binned GROUP BY ALL),
totals AS (SELECT feature, side, any_value(width) AS width, count(*) AS total FROM binned GROUP BY ALL),
grid AS (SELECT *, unnest(range(30))::INTEGER AS bin FROM totals)
SELECT feature, side, bin, coalesce(n, 0) AS n, round(coalesce(n, 0) / (total * width), 6) AS density
FROM grid LEFT JOIN counted USING (feature, side, bin)""")
def _(spark, sf):
    from tapewatch.session import settle
    all_windows = settle(features(spark, sf), "features")
    early = F.unix_seconds("window_start") < 1705320000
    return summaries.feature_drift(all_windows.filter(early), all_windows.filter(~early), 30)


@query("stats_by_price_range", f"""WITH {TRADES} SELECT symbol,
  CASE WHEN price < 10 THEN 0 WHEN price < 50 THEN 1 WHEN price < 100 THEN 2 ELSE 3 END AS price_range,
  round(min(price), 6) AS price_min, round(max(price), 6) AS price_max, round(avg(price), 6) AS price_avg,
  round(var_samp(price), 6) AS price_variance, count(*) AS trade_count, round(sum(quantity), 6) AS total_volume
FROM trades GROUP BY 1, 2""")
def _(spark, sf):
    return summaries.stats_by_price_range(events_trades(spark, sf), [10, 50, 100])


@query("throughput", f"""WITH {TRADES},
counted AS (SELECT epoch(time_bucket(INTERVAL 1 HOUR, event_time, TIMESTAMP '1970-01-01'))::BIGINT AS interval_start,
                   count(*) AS messages FROM trades GROUP BY 1)
SELECT interval_start, messages, round(messages / 3600.0::DOUBLE, 6) AS current_rate,
  round(sum(messages) OVER (ORDER BY interval_start)::DOUBLE
        / (interval_start + 3600 - min(interval_start) OVER ()), 6) AS average_rate FROM counted""")
def _(spark, sf):
    return summaries.throughput(events_trades(spark, sf), "1 hour")


@query("throughput_reports", f"""WITH {TRADES},
numbered AS (SELECT row_number() OVER (ORDER BY event_time, event_id) AS i, epoch_us(event_time) AS us FROM trades),
marks AS (SELECT i, us, coalesce(lag(us) OVER (ORDER BY i), (SELECT min(us) FROM numbered)) AS us_before
          FROM numbered WHERE i % 500 = 0)
SELECT i // 500 AS report, i AS messages, round(500 / ((us - us_before) / 1e6::DOUBLE), 6) AS current_rate,
  round(i / ((us - (SELECT min(us) FROM numbered)) / 1e6::DOUBLE), 6) AS average_rate FROM marks""")
def _(spark, sf):
    return summaries.throughput_reports(events_trades(spark, sf), ["event_time", "event_id"], 500)


@query("recent_predictions", f"""WITH {SCORED_SQL} SELECT symbol, window_start, round(probability, 6) AS probability, label
FROM scored ORDER BY window_start DESC, symbol LIMIT 50""")
def _(spark, sf):
    return (summaries.recent_predictions(scored(spark, sf), 50)
            .select("symbol", "window_start", "probability", "label"))


@query("latest_prediction", f"""WITH {SCORED_SQL} SELECT symbol, window_start, round(probability, 6) AS probability, label
FROM scored ORDER BY window_start DESC, symbol LIMIT 1""")
def _(spark, sf):
    return summaries.latest_prediction(scored(spark, sf)).select("symbol", "window_start", "probability", "label")


@query("union_batches", """SELECT symbol, count(*) AS n FROM (SELECT event_type AS symbol FROM events
UNION ALL SELECT l_returnflag || l_linestatus FROM lineitem) GROUP BY 1""")
def _(spark, sf):
    both = frames.union_batches(events_trades(spark, sf).select("symbol", "price"),
                                lineitem_trades(spark, sf).select("price", "symbol"))
    return both.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query("union_loose", f"""WITH {TRADES}, lines AS (SELECT l_returnflag || l_linestatus AS symbol, l_orderkey FROM lineitem),
u AS (SELECT symbol, event_id, NULL AS l_orderkey FROM trades UNION ALL SELECT symbol, NULL, l_orderkey FROM lines)
SELECT symbol, count(*) AS n, count(event_id) AS with_event, count(l_orderkey) AS with_order FROM u GROUP BY 1""")
def _(spark, sf):
    both = frames.union_loose(events_trades(spark, sf).select("symbol", "event_id"),
                              lineitem_trades(spark, sf).select("symbol", "l_orderkey"))
    return both.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.count("event_id").alias("with_event"),
                                      F.count("l_orderkey").alias("with_order"))


_RECENT_ANOMALOUS = f"""recent AS (SELECT DISTINCT symbol FROM labeled WHERE label = 'anomalo'
  AND make_timestamp(window_start * 1000000) >= {ASOF_SQL} - INTERVAL 6 HOURS
  AND make_timestamp(window_start * 1000000) <= {ASOF_SQL})"""


def _flagged(spark, sf):
    return labeled(spark, sf).select("symbol", "window_start", F.col("label_binary").alias("prediction"),
                                     F.col("distance_to_centroid").alias("probability"))


@query("union_distinct", f"""WITH {LABELED_SQL}, {_RECENT_ANOMALOUS}
SELECT symbol FROM recent UNION SELECT DISTINCT event_type FROM events WHERE event_type IN ('click', 'view')""")
def _(spark, sf):
    chosen = events_trades(spark, sf).filter(F.col("symbol").isin("click", "view")).select("symbol")
    return frames.union_distinct(chosen, joins.recently_anomalous(_flagged(spark, sf), ASOF, 6 * 3600))


@query("distinct_symbols", "SELECT DISTINCT event_type AS symbol FROM events")
def _(spark, sf):
    return frames.distinct_symbols(events_trades(spark, sf))


@query("trades_of_anomalous", f"""WITH {LABELED_SQL}, {_RECENT_ANOMALOUS}
SELECT event_id, symbol, round(price, 6) AS price FROM trades WHERE symbol IN (SELECT symbol FROM recent)""")
def _(spark, sf):
    return (joins.trades_of_anomalous(events_trades(spark, sf), _flagged(spark, sf), ASOF, 6 * 3600)
            .select("event_id", "symbol", "price"))


OVERLAY_SQL = f"""WITH {LABELED_SQL},
flags AS (SELECT symbol, window_start, label = 'anomalo' AS is_anomaly, distance_to_centroid FROM labeled
          WHERE trade_count >= 2)
SELECT s.symbol, s.window_start, round(price_avg, 6) AS price_avg, coalesce(is_anomaly, false) AS is_anomaly,
  round(distance_to_centroid, 6) AS probability FROM stats s LEFT JOIN flags USING (symbol, window_start)"""


def _flagged_windows(spark, sf):
    return labeled(spark, sf).filter("trade_count >= 2").select(
        "symbol", "window_start", F.col("label_binary").alias("prediction"),
        F.col("distance_to_centroid").alias("probability"))


@query("overlay_anomalies", OVERLAY_SQL)
def _(spark, sf):
    flagged = _flagged_windows(spark, sf)
    return (joins.overlay_anomalies(stats(spark, sf), flagged)
            .select("symbol", "window_start", "price_avg", "is_anomaly", "probability"))


@query("overlay_anomalies_bucketed", OVERLAY_SQL)
def _(spark, sf):
    """The same from two stored tables that share their buckets."""
    prices = write_bucketed(stats(spark, sf), fresh_path(spark, "bucketed-windows"), 8)
    flagged = write_bucketed(_flagged_windows(spark, sf), fresh_path(spark, "bucketed-flags"), 8)
    return joins.overlay_anomalies(prices, flagged).select("symbol", "window_start", "price_avg", "is_anomaly", "probability")


@query("trades_in_windows", f"""WITH {LABELED_SQL}
SELECT p.event_id, p.symbol, epoch(p.ws)::BIGINT AS window_start, l.label_binary AS prediction
FROM placed p JOIN labeled l ON p.symbol = l.symbol AND epoch(p.ws)::BIGINT = l.window_start""")
def _(spark, sf):
    return (joins.trades_in_windows(events_trades(spark, sf), _flagged(spark, sf), SIZE, SLIDE)
            .select("event_id", "symbol", "window_start", "prediction"))
