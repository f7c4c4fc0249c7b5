"""Hand-made edge rows: single trades, ties, zeros, malformed messages, bounds."""

import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tapewatch.functions import frames
from tapewatch.functions import scalars as S
from tapewatch.operators import joins, summaries
from tapewatch.operators.classify import ModelParams, auc_roc, classification_metrics, score_with_params
from tapewatch.operators.cluster import check_trainable, cluster_and_label, label_anomalies, standardise
from tapewatch.operators.ordering import ArrivalOrder
from tapewatch.operators.quantiles import percentile_threshold
from tapewatch.operators.windows import (merge_fragments, micros, min_trades, pane_window_stats, window_features,
                                         window_fragments, window_stats)
from tapewatch.schema import FEATURES
from tapewatch.sources.sinks import export_csv
from tapewatch.sources.trades import decode_trades, normalise_payload, synthetic, valid_trades

T0 = datetime(2024, 5, 1, 12, 0, 0)
TRADE = "symbol string, price double, quantity double, event_time timestamp, id long"


def trades(spark, rows):
    return spark.createDataFrame([(s, p, q, T0 + timedelta(seconds=t), i) for i, (s, p, q, t) in enumerate(rows)], TRADE)


def one(df, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_single_trade_window(spark):
    out = window_features(window_stats(trades(spark, [("A", 10.0, 2.0, 5)]), "1 minute", "1 minute"))
    row = one(out)
    assert row.price_variance is None and row.price_stddev is None
    assert row.volatility == 0.0 and row.pct_return == 0.0 and row.volume_intensity == 2.0


def test_sliding_windows_cover_each_trade_twice(spark):
    out = window_stats(trades(spark, [("A", 10.0, 1.0, 45)]))
    starts = sorted(r.window_start for r in out.collect())
    assert starts == [T0, T0 + timedelta(seconds=30)]


@pytest.mark.parametrize("order", [
    ArrivalOrder("event_time", ("id",)),
    ArrivalOrder("event_time", ("id",), ranges=((0, 1 << 20),)),
    ArrivalOrder("event_time", ("id", "id", "id")),         # too wide to pack
    ArrivalOrder("event_time", ("id",), tick_us=1_000_000),
])
def test_first_and_last_break_ties(spark, order):
    rows = trades(spark, [("A", 3.0, 1.0, 5), ("A", 1.0, 1.0, 5), ("A", 2.0, 1.0, 9), ("A", 9.0, 1.0, 9)])
    row = one(window_stats(rows.orderBy(F.desc("id")), "1 minute", "1 minute", order=order))
    assert (row.price_first, row.price_last) == (3.0, 9.0)


def test_default_ties_follow_the_price(spark):
    row = one(window_stats(trades(spark, [("A", 3.0, 1.0, 5), ("A", 1.0, 1.0, 5)]), "1 minute", "1 minute"))
    assert (row.price_first, row.price_last) == (1.0, 3.0)


def test_zero_prices_are_guarded(spark):
    out = window_features(window_stats(trades(spark, [("A", 0.0, 1.0, 1), ("A", 4.0, 1.0, 2), ("B", 0.0, 1.0, 1)]),
                                       "1 minute", "1 minute"))
    a, b = one(out, symbol="A"), one(out, symbol="B")
    assert a.pct_return == 0.0 and a.price_speed == 2.0
    assert (b.pct_return, b.volatility, b.price_speed) == (0.0, 0.0, 0.0)


def test_population_spread(spark):
    rows = trades(spark, [("A", 1.0, 1.0, 1), ("A", 3.0, 1.0, 2)])
    assert one(window_stats(rows, "1 minute", "1 minute", ddof=0)).price_stddev == 1.0
    assert one(window_stats(rows, "1 minute", "1 minute")).price_stddev == pytest.approx(math.sqrt(2))


def test_empty_input_gives_no_windows(spark):
    assert window_stats(trades(spark, [("A", 1.0, 1.0, 1)]).limit(0)).count() == 0


def test_min_trades(spark):
    stats = window_stats(trades(spark, [("A", 1.0, 1.0, 1), ("A", 3.0, 1.0, 2), ("B", 1.0, 1.0, 1)]), "1 minute", "1 minute")
    assert [r.symbol for r in min_trades(stats, 2).collect()] == ["A"]


def test_durations():
    assert micros("30 seconds") == 30_000_000 and micros("1 hour") == 3_600_000_000


@pytest.mark.parametrize("salts", [1, 8])
def test_fragments_merge_to_exact_windows(spark, salts):
    import random
    random.seed(7)
    rows = [(random.choice("ABA"), 60_000 + random.random(), random.random(), random.randrange(600)) for _ in range(400)]
    base = trades(spark, rows)
    order = ArrivalOrder("event_time", ("id",))
    exact = window_stats(base, order=order)
    split = base.withColumn("batch", (F.col("id") * 7919 % 23).cast("long"))  # not in id order
    merged = merge_fragments(window_fragments(split, "batch", order=order), "batch", salts, order=order)
    keys = ["symbol", "window_start", "window_end"]
    both = exact.alias("x").join(merged.alias("m"), keys, "full_outer").collect()
    assert len(both) == exact.count()
    for r in exact.alias("x").join(merged.alias("m"), keys).select(
            *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xm" for c in exact.columns if c not in keys]).collect():
        for c in exact.columns:
            if c not in keys:
                a, b = r[f"x_{c}"], r[f"m_{c}"]
                assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9)), c


@pytest.mark.parametrize("order", [ArrivalOrder(), ArrivalOrder("event_time", ("id",))])
def test_merge_decides_ties_like_exact_windows(spark, order):
    rows = trades(spark, [("A", 5.0, 1.0, 5), ("A", 1.0, 1.0, 5), ("A", 3.0, 1.0, 5)])
    split = rows.withColumn("batch", F.lit(9).cast("long") - F.col("id"))
    exact = one(window_stats(rows, "1 minute", "1 minute", order=order))
    merged = one(merge_fragments(window_fragments(split, "batch", "1 minute", "1 minute", order), "batch", order=order))
    assert (merged.price_first, merged.price_last) == (exact.price_first, exact.price_last)


def test_split_follows_any_ratio(spark):
    from tapewatch.operators.classify import split
    df = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    for ratio in (0.999, 0.004, 0.5):
        train, test = split(df, ["key"], ratio)
        assert train.count() + test.count() == 20_000 and train.count() > 0 and test.count() > 0
        assert abs(train.count() / 20_000 - ratio) < 0.02


def test_numbers_that_are_not_finite_are_rejected(spark):
    from tapewatch.sources.trades import normalise_payload, valid_trades
    lines = [f'{{"s":"A","p":"{p}","q":"1.0","T":5,"m":true}}' for p in ("NaN", "Infinity", "-Infinity", "1e999", "2.5")]
    good, bad = normalise_payload(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [r.price for r in good.collect()] == [2.5] and bad.count() == 4
    rows = spark.createDataFrame([(" a", "1", "NaN", "1"), ("a ", "1", "2", "1"), ("b", "1", "2", "1")],
                                 "symbol string, timestamp string, price string, quantity string")
    listed = spark.createDataFrame([("a",), (" A ",), (None,)], "symbol string")
    assert [r.symbol for r in valid_trades(rows, ["a"]).collect()] == ["A"]
    assert [r.symbol for r in valid_trades(rows, listed).collect()] == ["A"]


def test_histogram_of_values_that_are_not_finite(spark):
    from tapewatch.operators.summaries import feature_drift, histogram
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 5.0, float("nan"), float("inf"), None)], "v double")
    rows = histogram(df, "v", 4).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 1, 0, 1] and (rows[0].bin_lo, rows[-1].bin_hi) == (1.0, 5.0)
    drift = feature_drift(df, df.filter("v < 3"), 4, ["v"])
    assert drift.count() == 8 and drift.agg(F.sum("n")).first()[0] == 5


def test_panes_must_divide(spark):
    with pytest.raises(ValueError):
        pane_window_stats(trades(spark, [("A", 1.0, 1.0, 1)]), "1 minute", "25 seconds")


def test_malformed_messages(spark):
    lines = ["garbage", '{"symbol":"A","price":"x","quantity":1.0,"timestamp":5,"is_buyer_maker":true}',
             '{"symbol":"B","price":2.0,"quantity":1.0,"timestamp":6}',
             '{"symbol":"TESTUSDT","price":99999.99,"quantity":0.001,"timestamp":7,"is_buyer_maker":false,"test":true}']
    rows = decode_trades(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert all(v is None for v in rows[0])
    assert rows[1].symbol == "A" and rows[1].price is None and rows[1].quantity == 1.0
    assert rows[2].is_buyer_maker is None
    assert tuple(rows[3]) == ("TESTUSDT", 99999.99, 0.001, 7, False)


def test_payload_normaliser(spark):
    lines = ['{"stream":"a@trade","data":{"e":"trade","E":1,"s":"A","t":9,"p":"1.5","q":"2","T":5,"m":true,"M":true}}',
             '{"s":"B","p":"2.5","q":"1","T":6,"m":false}', '{"result":null,"id":1}',
             '{"s":"C","p":"x","q":"1","T":6,"m":false}', '{"s":"D","q":"1","T":6,"m":false}']
    good, bad = normalise_payload(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(map(tuple, good.collect())) == [("A", 1.5, 2.0, 5, True), ("B", 2.5, 1.0, 6, False)]
    assert bad.count() == 3


def test_validation(spark):
    rows = spark.createDataFrame([("btc", "1", "2.0", "3"), ("eth", "1", "2.0", "3"), ("btc", "x", "2.0", "3"),
                                  ("btc", "1", None, "3")], "symbol string, timestamp string, price string, quantity string")
    assert [tuple(r) for r in valid_trades(rows, ["BTC"]).collect()] == [("BTC", 1, 2.0, 3.0)]


def test_synthetic(spark):
    out = summaries.group_mean_sum(synthetic(spark, 10_000), "g", "v")
    assert out.count() == 1000
    assert frames.top_by_key(out, "g", 3).collect()[1].sum_v == sum(1.5 * i for i in range(1, 10_000, 1000))


def test_sigmoid_is_safe(spark):
    rows = spark.createDataFrame([(-1000.0,), (0.0,), (1000.0,)], "x double").select(S.sigmoid("x").alias("p")).collect()
    assert [r.p for r in rows] == [0.0, 0.5, 1.0]


def test_zero_variance_scales_to_zero(spark):
    out = standardise(spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double"), ["a", "b"])
    assert [r.z_a for r in out.collect()] == [0.0, 0.0]


def test_threshold_is_strict(spark):
    out = label_anomalies(spark.createDataFrame([(1.0,), (2.0,)], "distance_to_centroid double"), threshold=1.0)
    assert sorted((r.label, r.label_binary) for r in out.collect()) == [("anomalo", 1), ("normal", 0)]


def test_threshold_without_values(spark):
    empty = spark.createDataFrame([], "d double")
    assert percentile_threshold(empty, "d", 0.95) == 1.0
    assert percentile_threshold(empty, "d", 0.95, exact=False) == 1.0


def test_decision_boundary(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    params = ModelParams([1.0], [1.0], [2.0], 0.0, ["a"])
    assert score_with_params(df, params).first().prediction == 1
    assert score_with_params(df, params, at_boundary=0).first().prediction == 0


def test_too_few_rows(spark):
    rows = [("A", 1.0, 1.0, 60 * i) for i in range(5)]
    features = window_features(window_stats(trades(spark, rows), "1 minute", "1 minute"))
    assert cluster_and_label(features) is None
    ready = check_trainable(features)
    assert ready.rows == 5 and not ready.trainable


def test_null_features_do_not_count(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, None), (1.0, 1.0, 1.0, 1.0)], ", ".join(f"{f} double" for f in FEATURES))
    assert check_trainable(df, min_rows=1).rows == 1


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.0,), (5.0,)], "x double")
    out = {r.bin: r.n for r in summaries.histogram(df, "x", 2, 0.0, 1.0).collect()}
    assert out == {0: 1, 1: 3}
    flat = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert sum(r.n for r in summaries.histogram(flat, "x", 5).collect()) == 4
    dense = summaries.histogram(df, "x", 4, density=True).collect()
    assert sum(r.density * (r.bin_hi - r.bin_lo) for r in dense) == pytest.approx(1.0)


def test_shares_of_nothing(spark):
    empty = spark.createDataFrame([], "symbol string, label string")
    assert summaries.anomaly_share(empty).first().anomaly_pct == 0.0


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label_binary int, prediction int, probability double")
    row = classification_metrics(df).first()
    assert row.accuracy == 1.0 and row.weighted_f1 == 1.0
    assert auc_roc(df).first().auc_roc is None


def test_nearest_centroid_tie_takes_the_smaller(spark):
    df = spark.createDataFrame([(0.0,)], "x double")
    row = joins.assign_nearest(df, ["x"], [[1.0], [-1.0]]).first()
    assert row.prediction == 0 and row.distance_to_centroid == 1.0


def test_union_of_different_columns(spark):
    a = spark.createDataFrame([(1, "x")], "run int, a string")
    b = spark.createDataFrame([(2, 3.0)], "run int, b double")
    assert sorted(map(tuple, frames.union_loose(a, b).collect())) == [(1, "x", None), (2, None, 3.0)]


def test_csv_has_header_and_readable_times(spark, tmp_path):
    stats = window_stats(trades(spark, [("A", 1.0, 1.0, 1), ("B", 3.0, 1.0, 2)]), "1 minute", "1 minute")
    export_csv(stats, str(tmp_path / "out"), order_by="window_start", single_file=True)
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert {r.window_start_str for r in back.collect()} == {"2024-05-01 12:00:00"}


def test_iso_and_parse(spark):
    ms = int(T0.replace(tzinfo=timezone.utc).timestamp() * 1000) + 7
    row = spark.range(1).select(S.iso_ts(F.lit(ms)).alias("iso"),
                                S.parse_ts(F.lit("2024-05-01 12:00:00")).alias("t")).first()
    assert row.iso == "2024-05-01T12:00:00.007+00:00" and row.t == T0
