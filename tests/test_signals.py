import random

import pytest
from pyspark.sql import functions as F

from cashtide.operators.signals import rolling_signals, ticker_signals, top_tickers
from cashtide.resources.vocabulary import SIGNAL_WINDOWS

NOW = 1_700_000_000.0
SCHEMA = "ticker string, sentiment_compound double, created_utc double"


def mentions(spark, *rows):
    return spark.createDataFrame([(t, c, NOW + dt) for t, c, dt in rows], SCHEMA)


def signal(spark, *rows, ticker):
    listed = spark.createDataFrame([(ticker,)], "ticker string")
    return ticker_signals(mentions(spark, *rows), NOW, tickers=listed).first()


def test_single(spark):
    row = signal(spark, ("AAPL", 0.5, 0), ticker="AAPL")
    assert (row.sentiment_5m, row.mentions_5m) == (0.5, 1)


def test_mean(spark):
    assert signal(spark, ("TSLA", 1.0, 0), ("TSLA", 0.0, 0), ticker="TSLA").sentiment_5m == 0.5


def test_unknown(spark):
    row = signal(spark, ("AAPL", 0.5, 0), ticker="ZZZZ")
    assert (row.sentiment_5m, row.mentions_5m) == (None, 0)


def test_window_excludes_old(spark):
    row = signal(spark, ("GME", 1.0, -400), ("GME", -0.5, 0), ticker="GME")
    assert (row.mentions_5m, row.sentiment_5m, row.mentions_1h) == (1, -0.5, 2)


def test_bounds(spark):
    row = signal(spark, ("A", 1.0, -300), ("A", 1.0, -300.001), ("A", 1.0, 50), ticker="A")
    assert row.mentions_5m == 2 and row.mentions_1h == 3


def test_top(spark):
    rows = [("NVDA", 0.8, 0)] * 3 + [("AMD", 0.3, -5), ("GM", 0.1, -9)]
    top = top_tickers(mentions(spark, *rows), NOW, "5m", 2).collect()
    assert [(r.ticker, r.mentions, r.avg_sentiment) for r in top] == [("NVDA", 3, 0.8), ("GM", 1, 0.1)]


def test_expired_ticker_is_absent(spark):
    assert ticker_signals(mentions(spark, ("BB", 0.1, -90000)), NOW).count() == 0


@pytest.mark.parametrize("slot_seconds", [60, 300])
def test_rolling_against_brute_force(spark, slot_seconds):
    rng = random.Random(slot_seconds)
    rows = []
    for number in range(900):
        dt = rng.choice([rng.uniform(0, 200_000), rng.randint(0, 600) * 300, rng.randint(0, 4000) / 8])
        rows.append((rng.choice(["HOT", "HOT", "HOT", "A", "B"]), rng.randint(-1000, 1000) / 1000, dt))
    df = mentions(spark, *rows).withColumn("post_id", F.monotonically_increasing_id()).cache()
    data = [(r.ticker, r.sentiment_compound, round(r.created_utc * 1e6)) for r in df.collect()]
    out = rolling_signals(df, slot_seconds=slot_seconds).collect()
    assert len(out) == len(rows)
    for row in out:
        t = round(row.created_utc * 1e6)
        for label, seconds in SIGNAL_WINDOWS.items():
            values = [c for k, c, u in data if k == row.ticker and t - seconds * 1_000_000 <= u <= t]
            assert row[f"mentions_{label}"] == len(values)
            assert row[f"sentiment_{label}"] == pytest.approx(sum(values) / len(values), abs=6e-5)


def test_rolling_needs_whole_slots(spark):
    with pytest.raises(ValueError):
        rolling_signals(mentions(spark), windows={"x": 90})


def test_rolling_partitions_by_slot(spark):
    plan = rolling_signals(mentions(spark, ("A", 0.1, 0)))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ticker" in plan and "_slot" in plan.split("hashpartitioning(ticker")[1][:40]


def test_stored_table_is_pruned_to_the_window(spark):
    from cashtide.session import scratch_path
    from cashtide.sinks.tables import write_mentions
    from cashtide.sources.tables import read_mentions

    df = mentions(spark, ("SPY", 0.5, -10), ("SPY", 0.1, -90_000), ("GM", -0.5, -3000))
    full = df.select(
        F.lit("p").alias("post_id"), "ticker", F.lit("demo").alias("source"), "sentiment_compound",
        F.lit(0).alias("score"), "created_utc", F.lit(NOW).alias("processed_at"),
    )
    root = scratch_path(spark, "signals")
    write_mentions(full, root, 1)
    stored = read_mentions(spark, root)
    pruned = ticker_signals(stored, NOW, partitioned=True)
    assert "PartitionFilters: [(concat(year" in pruned._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, ticker_signals(df, NOW).collect()))
    top = top_tickers(stored, NOW, "24h", partitioned=True).collect()
    assert [(r.ticker, r.mentions) for r in top] == [("GM", 1), ("SPY", 1)]
