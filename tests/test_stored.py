"""Tables stored in buckets, and messages that are no trades."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tapewatch.operators.joins import overlay_anomalies
from tapewatch.sources.bucketed import read_bucketed, write_bucketed
from tapewatch.sources.trades import dead_letters, decode_checked, trades_of

T0 = datetime(2024, 5, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sides(spark):
    prices = spark.range(2000).select(F.concat(F.lit("S"), F.col("id") % 7).alias("symbol"),
                                      F.timestamp_seconds(F.col("id") * 30).alias("window_start"), F.col("id").cast("double").alias("price_avg"))
    flags = prices.filter("price_avg % 3 = 0").select("symbol", "window_start", (F.col("price_avg") % 2).alias("prediction"), F.lit(0.5).alias("probability"))
    return prices, flags


def test_overlay_of_bucketed_tables_moves_nothing(spark, sides, tmp_path):
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        stored = [write_bucketed(df, str(tmp_path / name), 4) for df, name in zip(sides, ("prices", "flags"))]
        want = sorted(map(tuple, overlay_anomalies(*sides).collect()))
        assert "Exchange" in plan_of(overlay_anomalies(*sides))
        joined = overlay_anomalies(*stored)
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert sorted(map(tuple, joined.collect())) == want
        # another session knows the buckets from the files alone
        for table in ("prices", "flags"):
            name = [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
        for n in name:
            spark.sql(f"DROP TABLE {n}")
        again = overlay_anomalies(*[read_bucketed(spark, str(tmp_path / n)) for n in ("prices", "flags")])
        assert "Exchange" not in plan_of(again) and sorted(map(tuple, again.collect())) == want
    finally:
        spark.conf.set(key, before)


def test_a_bucketed_table_is_replaced(spark, sides, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(sides[0], path, 4)
    table = write_bucketed(sides[0].limit(5), path, 2)
    assert table.count() == 5 == read_bucketed(spark, path).count()
    empty = write_bucketed(sides[0].limit(0), path, 2)
    assert empty.count() == 0 and empty.columns == sides[0].columns


GOOD = {"symbol": "A", "price": 1.5, "quantity": 2.0, "timestamp": 1714564800000, "is_buyer_maker": True}
MESSAGES = [
    (json.dumps(GOOD), None), (json.dumps(GOOD | {"test": 1}), None), (json.dumps({k: v for k, v in GOOD.items() if k != "is_buyer_maker"}), None),
    (None, "no text"), ("", "no JSON object"), ("nonsense", "no JSON object"), ("[]", "no JSON object"), ("{}", "without symbol, price, quantity, timestamp"),
    (json.dumps(GOOD)[:-9], "broken JSON"), (json.dumps(GOOD | {"price": "abc"}), "without price"),
    (json.dumps(GOOD | {"price": None, "timestamp": None}), "without price, timestamp"),
    (json.dumps(GOOD | {"price": "NaN"}), "not finite: price"), (json.dumps(GOOD | {"quantity": "Infinity", "price": "-Infinity"}), "not finite: price, quantity"),
]


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_each_message_is_a_trade_or_a_dead_letter(spark, kind):
    rows = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(MESSAGES)], "offset long, value string").withColumn("value", F.col("value").cast(kind))
    checked = decode_checked(rows, keep=["offset"])
    got = {r.offset: r.reason for r in checked.collect()}
    want = {i: reason for i, (_, reason) in enumerate(MESSAGES)}
    assert {k: v for k, v in got.items() if want[k] != "broken JSON"} == {k: v for k, v in want.items() if v != "broken JSON"}
    assert got[8] is not None  # cut in its last field: what it lacks depends on how far the parser came
    letters, trades = dead_letters(checked), trades_of(checked)
    assert letters.count() + trades.count() == len(MESSAGES)
    assert {r.offset: r.text for r in letters.collect()} == {i: m for i, (m, _) in enumerate(MESSAGES) if got[i]}
    assert letters.columns == ["offset", "reason", "text"] and {r.price for r in trades.collect()} == {1.5}
    assert trades.first().event_time == datetime(2024, 5, 1, 12)
    assert plan_of(checked).count("from_json") == 1
