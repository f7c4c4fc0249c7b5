"""Order-sensitive operators against plain Python, on skewed data."""

import math
import random
import struct
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from tapewatch.operators import ordering, quantiles
from tapewatch.operators.ordering import ArrivalOrder
from tapewatch.functions.scalars import order_code
from tapewatch.operators.windows import merge_fragments, window_fragments, window_stats
from tapewatch.streaming.windows import BROKER_ORDER

T0 = datetime(2024, 5, 1)
ORDER = ArrivalOrder("event_time", ("id",))


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows are one symbol, a third of those at one instant."""
    random.seed(3)
    rows = []
    for i in range(3000):
        symbol = "HOT" if random.random() < 0.66 else random.choice("ABC")
        seconds = 500_000 if random.random() < 0.33 else random.randrange(1_000_000)
        rows.append((symbol, T0 + timedelta(seconds=seconds), i, random.random() * 100))
    return spark.createDataFrame(rows, "symbol string, event_time timestamp, id long, price double").cache()


def test_global_index(skewed):
    got = [r.id for r in ordering.global_index(skewed, ["event_time", "id"], "i").orderBy("i").collect()]
    want = [r.id for r in skewed.orderBy("event_time", "id").collect()]
    assert got == want


def test_keyed_index(skewed):
    w = Window.partitionBy("symbol").orderBy("event_time", "id")
    want = {r.id: r.n for r in skewed.select("id", (F.row_number().over(w) - 1).alias("n")).collect()}
    got = {r.id: r.n for r in ordering.keyed_index(skewed, ["symbol"], ["event_time", "id"], "n").collect()}
    assert got == want


@pytest.mark.parametrize("block", [1, 50])
def test_trailing_rows_across_blocks(skewed, block):
    w = Window.partitionBy("symbol").orderBy("event_time", "id").rowsBetween(-7, -1)
    want = {r.id: r.m for r in skewed.select("id", F.avg("price").over(w).alias("m")).collect()}
    out = ordering.trailing_rows(skewed, ["symbol"], ["event_time", "id"], 7, {"m": F.avg("price")}, block)
    got = {r.id: r.m for r in out.collect()}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == (want[i] if want[i] is None else pytest.approx(want[i]))


def test_running_total(skewed):
    rows = sorted(skewed.collect(), key=lambda r: (r.event_time, r.id))
    total, want = 0, {}
    for r in rows:
        want[r.id] = total
        total += r.id
    got = {r.id: r.id_before for r in ordering.running_total(skewed, ["event_time", "id"], ["id"]).collect()}
    assert got == want


@pytest.mark.parametrize("n", [1, 10, 700, 100_000])
def test_last_n(skewed, n):
    want = set()
    for s in ("HOT", "A", "B", "C"):
        mine = sorted((r for r in skewed.collect() if r.symbol == s), key=lambda r: (r.event_time, r.id))
        want |= {r.id for r in mine[-n:]}
    assert {r.id for r in ordering.last_n(skewed, ["symbol"], ORDER, n, salts=4).collect()} == want


def test_last_n_keeps_rows_without_time(spark):
    df = spark.createDataFrame([("A", None, 1), ("A", T0, 2)], "symbol string, event_time timestamp, id long")
    assert {r.id for r in ordering.last_n(df, ["symbol"], ORDER, 5).collect()} == {1, 2}


@pytest.mark.parametrize("last", [True, False])
def test_extreme_by(skewed, last):
    got = {r.symbol: r.price for r in ordering.extreme_by(skewed, ["symbol"], "price", ORDER, last).collect()}
    for s, price in got.items():
        mine = sorted((r for r in skewed.collect() if r.symbol == s), key=lambda r: (r.event_time, r.id))
        assert price == mine[-1 if last else 0].price


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 0.999, 1.0])
@pytest.mark.parametrize("shape", ["spread", "one value holds a third", "few values"])
def test_exact_percentile(spark, monkeypatch, q, shape):
    monkeypatch.setattr(quantiles, "CELLS", 8)  # several rounds
    v = {"spread": F.rand(1) * 1000, "few values": F.floor(F.rand(1) * 3).cast("double"),
         "one value holds a third": F.when(F.rand(2) < 0.33, 500.0).otherwise(F.rand(1) * 1000)}[shape]
    df = spark.range(5000).select(v.alias("v")).union(spark.range(1).select(F.lit(None).cast("double"))).cache()
    want = df.agg(F.percentile("v", q)).first()[0]
    assert quantiles.exact_percentile(df, "v", q, accuracy=100) == pytest.approx(want, rel=1e-12)


def test_measured_ranges(skewed):
    assert ORDER.measured(skewed).ranges == ((0, 3000),)
    assert ArrivalOrder().measured(skewed).ranges is None
    assert ORDER.measured(skewed.withColumn("id", -F.col("id"))).ranges == ((-2999, 3000),)
    assert ORDER.measured(skewed.limit(0)).ranges == ((0, 1),)


@pytest.mark.parametrize("ids", [(600, 1 << 40), (-5, -(1 << 62)), (2**31 - 1, 2**63 - 1), (-(2**31), -(2**63))])
@pytest.mark.parametrize("size", ["1 minute", "1 hour"])
def test_any_partition_and_offset_order_a_window(spark, ids, size):
    partition, offset = ids
    rows = [("A", T0, partition, offset, 2.0, 1.0), ("A", T0, partition, None, 1.0, 1.0), ("A", T0, None, 7, 0.0, 1.0),
            ("A", T0 + timedelta(seconds=1), partition, offset, 4.0, 1.0), ("A", T0 + timedelta(seconds=1), partition, None, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp, partition int, offset long, price double, quantity double")
    row = window_stats(df, size, size, order=BROKER_ORDER).first()
    assert (row.price_first, row.price_last) == (0.0, 4.0)


@pytest.mark.parametrize("order", [BROKER_ORDER, ArrivalOrder("event_time", ("offset",)), ArrivalOrder("event_time", ())])
def test_packed_orders_aggregate_by_hash(spark, order):
    df = spark.createDataFrame([("A", T0, 1, 1, 1.0, 1.0)],
                               "symbol string, event_time timestamp, partition int, offset long, price double, quantity double")
    plan = window_stats(df, "1 hour", "30 minutes", order=order)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_null_keys_are_keys(spark):
    df = spark.createDataFrame([(s, T0 + timedelta(seconds=i), i, float(i)) for i, s in enumerate(["A", None] * 3)],
                               "symbol string, event_time timestamp, id long, price double")
    assert ordering.keyed_index(df, ["symbol"], ["event_time"], "n").count() == 6
    assert {r.id for r in ordering.last_n(df, ["symbol"], ORDER, 2).collect()} == {2, 3, 4, 5}
    assert ordering.trailing_rows(df, ["symbol"], ["event_time"], 2, {"m": F.avg("price")}).count() == 6


def test_order_code_sorts_as_doubles_do(spark):
    rnd = random.Random(9)
    edges = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 1.0, 0.1, float("inf")]
    edges += [2.0**e for e in range(-1074, 1024, 37)] + [math.nextafter(2.0**e, side) for e in range(-1070, 1023, 41) for side in (0, math.inf)]
    edges += [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(63)))[0] for _ in range(3000)] + [67543.21 + i * 0.01 for i in range(500)]
    values = sorted({s * v for v in edges if not math.isnan(v) for s in (1, -1)})
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", order_code("x").alias("c")).collect()
    codes = [r.c for r in sorted(rows, key=lambda r: r.x)]
    assert codes == sorted(set(codes))
    bits = {v: struct.unpack("<q", struct.pack("<d", abs(v)))[0] for v in values}
    assert all(r.c == (bits[r.x] if r.x > 0 else -bits[r.x]) for r in rows)
    last = spark.createDataFrame([(float("nan"),), (None,), (-0.0,)], "x double").select(order_code("x").alias("c")).collect()
    assert [r.c for r in last] == [max(codes) + 1, None, 0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["double", "float", "long"])
def test_default_order_aggregates_by_hash(spark, skewed, kind):
    trades = skewed.select("symbol", "event_time", "id", F.col("price").cast(kind).alias("price"), F.lit(1.0).alias("quantity"))
    trades = trades.unionByName(trades.withColumn("price", -F.col("price"))).unionByName(trades.limit(5).withColumn("price", F.lit(None).cast(kind)))
    stats = window_stats(trades, "1 day", "12 hours")
    assert "HashAggregate" in plan_of(stats) and "SortAggregate" not in plan_of(stats)
    assert plan_of(stats).count("Exchange hashpartitioning") == 1
    plain = (trades.withColumn("w", F.window("event_time", "1 day", "12 hours")).groupBy("symbol", "w")
             .agg(F.min_by("price", F.struct("event_time", "price")).alias("a"), F.max_by("price", F.struct("event_time", "price")).alias("b")))
    want = sorted((r.symbol, r.w.start, str(r.a), str(r.b)) for r in plain.collect())
    assert sorted((r.symbol, r.window_start, str(r.price_first), str(r.price_last)) for r in stats.collect()) == want


@pytest.mark.parametrize("order", [ArrivalOrder(), ORDER, ArrivalOrder("event_time", ()), BROKER_ORDER, ArrivalOrder("event_time", ("id", "price"))])
def test_merged_fragments_aggregate_by_hash(spark, skewed, order):
    trades = skewed.withColumns({"quantity": F.lit(1.0), "batch": F.col("id") % 7, "partition": (F.col("id") % 3).cast("int"), "offset": F.col("id")})
    merged = merge_fragments(window_fragments(trades, "batch", "1 day", "12 hours", order), "batch", order=order)
    fits = order.tiebreak != ("id", "price")
    assert ("SortAggregate" not in plan_of(merged)) == fits
    rows = lambda df: sorted((r.symbol, r.window_start, r.trade_count, r.price_first, r.price_last, round(r.price_avg, 9)) for r in df.collect())
    whole = window_stats(trades, "1 day", "12 hours", order=order)
    if order.tiebreak:
        assert rows(merged) == rows(whole)
    spreads = {(r.symbol, r.window_start): r.price_variance for r in whole.collect()}
    for r in merged.collect():
        want = spreads[r.symbol, r.window_start]
        assert r.price_variance == (want if want is None else pytest.approx(want, rel=1e-12))


def test_percentiles_of_extreme_values(spark):
    values = [-math.inf, -1e308, -5e-324, -0.0, 0.0, 5e-324, 1.0, math.nextafter(1.0, 2), 1e308, math.inf] * 3
    df = spark.createDataFrame([(v,) for v in [*values, math.nan, None]], "v double")
    n, ordered = len(values), sorted(values)
    got = quantiles.exact_percentiles(df, "v", [i / (n - 1) for i in range(n)], accuracy=100)
    assert got == pytest.approx(ordered, rel=0, abs=0)
    assert quantiles.exact_percentiles(df.limit(0), "v", [0.5]) is None
    assert quantiles.exact_percentile(df.filter("isnan(v)"), "v", 0.5) is None


def test_two_scans_are_enough(spark, tmp_path):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v")).repartition(3)
    scans = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch
    found = quantiles.exact_percentiles(df.mapInArrow(seen, "v double"), "v", [0.95, 0.1])
    assert found == pytest.approx([df.agg(F.percentile("v", q)).first()[0] for q in (0.95, 0.1)], rel=1e-12)
    assert scans.value <= 2 * 200_000


def test_merged_sketches_keep_their_error(spark):
    df = spark.range(300_000).select((F.col("id") % 40).alias("day"), F.pow(F.rand(4), 5).alias("v"))
    df = df.unionByName(spark.createDataFrame([(50, None), (51, math.nan)], "day long, v double")).cache()
    sketches = quantiles.sketch_values(df, "v", ["day"], size=256).cache()
    assert sketches.count() == 42 and sketches.filter("n = 0").count() == 2
    assert quantiles.merge_sketches(sketches).first().n == 300_000
    for q, v in zip((0.0, 0.05, 0.5, 0.95, 1.0), quantiles.sketch_percentile(sketches, [0.0, 0.05, 0.5, 0.95, 1.0])):
        below = df.filter((F.col("v") <= v) & ~F.isnan("v")).count() / 300_000
        assert abs(below - q) <= 2 * quantiles.rank_error(256)
    assert quantiles.sketch_percentile(sketches.limit(0), 0.5) is None
    exact = quantiles.exact_percentile(df, "v", 0.95, accuracy=100, sketches=sketches)
    assert exact == pytest.approx(df.filter(~F.isnan("v")).agg(F.percentile("v", 0.95)).first()[0], rel=1e-12)
