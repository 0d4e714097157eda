import pytest
from pyspark.sql import functions as F

from cashtide.operators import analytics, metrics
from cashtide.schemas import MENTION, POST

NOW = 1_700_000_000.0


def mention(post_id, ticker, compound=0.0, created=NOW, source="demo"):
    return (post_id, ticker, source, compound, 0, created, NOW)


def posts(spark, *rows):
    base = dict.fromkeys(POST.fieldNames())
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], POST)


def test_top_mentions_and_single_deviation(spark):
    df = spark.createDataFrame(
        [mention("a", "SPY", 0.1), mention("b", "SPY", 0.2), mention("c", "GM", 0.5), mention("d", "AMD", 0.5)], MENTION
    )
    rows = [tuple(r) for r in analytics.top_mentions(df, 2).collect()]
    assert rows == [("SPY", 2, 0.15, 0.071), ("AMD", 1, 0.5, None)]


def test_latest_mentions(spark):
    df = spark.createDataFrame(
        [mention(str(i), "NVDA", created=NOW + i) for i in range(20)] + [mention("x", "GM", created=NOW + 99)], MENTION
    )
    assert [r.post_id for r in analytics.latest_mentions(df).collect()] == [str(i) for i in range(19, 9, -1)]


def test_hourly_volume(spark):
    hours = [0, 0, 1, 1, 1]
    df = spark.createDataFrame(
        [mention(str(i), t, created=1_699_999_200.0 + 3600 * h) for i, (h, t) in enumerate(zip(hours, "AABCC"))], MENTION
    )
    rows = [(r.mentions, r.distinct_tickers) for r in analytics.hourly_volume(df).collect()]
    assert rows == [(3, 2), (2, 1)]


def test_posts_reports(spark):
    df = posts(
        spark,
        {"post_id": "1", "source": "a", "sentiment_compound": -0.9, "tickers": ["SPY"], "quality_score": 0.5, "body": "x" * 200},
        {"post_id": "2", "source": "a", "sentiment_compound": 0.8, "tickers": ["GM", "SPY"], "quality_score": 1.0, "body": "y"},
        {"post_id": "3", "source": "b", "sentiment_compound": 0.95, "tickers": [], "quality_score": 0.75, "body": "z"},
        {"post_id": "4", "source": "b", "sentiment_compound": 0.95, "quality_score": 0.75, "body": "z"},
    )
    assert [(r.s, r.preview) for r in analytics.extreme_posts(df).collect()] == [(-0.9, "x" * 120), (0.8, "y")]
    rows = sorted(tuple(r) for r in analytics.source_quality(df).collect())
    assert rows == [("a", 2, 0.75, 0.5, 2), ("b", 2, 0.75, 0.75, 0)]
    assert tuple(analytics.ticker_density(df).first()) == (4, 2, 3, 2)
    assert tuple(analytics.ticker_density(df.limit(0)).first()) == (0, 0, 0, 0)


def test_pipeline_metrics(spark):
    names = ["duplicate"] * 2 + ["invalid"] + ["processed"] * 7
    df = spark.createDataFrame([(n,) for n in names], "outcome string")
    row = metrics.pipeline_metrics(df, elapsed_s=30.0).first()
    assert row.ingested == row.duplicates + row.invalid + row.processed == 10
    assert (row.processed, row.written, row.throughput_per_min, row.quality_pass_rate) == (7, 7, 14.0, 0.875)


def test_pipeline_metrics_of_nothing(spark):
    row = metrics.pipeline_metrics(spark.createDataFrame([], "outcome string"), elapsed_s=0.0).first()
    assert (row.ingested, row.processed, row.throughput_per_min, row.quality_pass_rate) == (0, 0, 0.0, 0.0)


def test_funnel(spark):
    rows = [("$SPY", NOW - 4, NOW - 3, True), ("ramen", NOW - 2, NOW - 1.5, True), ("stocks", NOW, NOW, False)]
    df = spark.createDataFrame(rows, "body string, created_utc double, fetched_at double, ordered boolean")
    row = metrics.funnel_metrics(df, NOW, 4.0, in_order="ordered").first()
    assert tuple(row) == (2, 1, 1, 1, 0.5, 0.5, 1.5, 2.0)
    assert metrics.funnel_metrics(df, NOW, 4.0).first().received_total == 3


@pytest.mark.parametrize(
    "values, p50, p99", [([], 0.0, 0.0), ([1.0, 2.0], 2.0, 2.0), ([1.0, 2.0, 3.0], 2.0, 3.0), ([5.0], 5.0, 5.0)]
)
def test_percentile(spark, values, p50, p99):
    df = spark.createDataFrame(list(enumerate(values)), "seq int, ms double")
    assert tuple(metrics.percentile_nearest(df, "ms").first()) == (p50, p99)


def test_recent_samples_only(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), F.col("id").cast("double").alias("ms"))
    assert tuple(metrics.percentile_nearest(df, "ms").first()) == (900.0, 998.0)
    assert metrics.last_n_mean(df, "ms").first().avg_ms == 974.5
    assert metrics.last_n_mean(df.limit(0), "ms").first().avg_ms == 0.0


def test_grouped_recent_samples_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id AS seq", "double(id) AS ms", "id % 2 AS g")
    out = metrics.percentile_nearest(df, "ms", group=("g",), last_n=10)
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted(map(tuple, out.collect())) == [(0, 990.0, 998.0), (1, 991.0, 999.0)]


def test_sketches_of_hours_roll_up(spark):
    from cashtide.operators.analytics import volume_between, volume_sketches

    rows = [(f"T{i % 5000}", 3600.0 * (i % 48)) for i in range(40_000)] + [(None, 0.0)]
    sketches = volume_sketches(spark.createDataFrame(rows, "ticker string, created_utc double"))
    assert sketches.count() == 48
    for row in volume_between(sketches, "day").collect():
        held = {t for t, s in rows if t and int(s // 86400) == (row.start.timestamp() // 86400)}
        assert abs(row.distinct_tickers - len(held)) <= 0.05 * len(held)
    assert sum(r.mentions for r in volume_between(sketches, "month").collect()) == 40_001


def test_percentiles_of_a_large_group(spark):
    """A million values, nearly all of one group, sketched by part and merged."""
    n = 1_000_000
    mixed = F.pmod(F.col("id") * 7919, F.lit(n))  # each of 0 to n - 1 once, out of order
    rows = spark.range(0, n, 1, 8).select(mixed.cast("double").alias("v"), F.when(F.col("id") < 100, "few").otherwise("many").alias("g"), F.expr("id % 5").alias("part"))
    sketches = metrics.quantile_sketches(rows, "v", ("g", "part"))
    assert sketches.count() == 10
    found = {r.g: r for r in metrics.sketched_percentiles(sketches, (1, 50, 99), ("g",)).collect()}
    assert (found["few"].samples, found["many"].samples) == (100, n - 100)
    few = sorted(7919 * i % n for i in range(100))
    assert found["few"].p50 in few[48:52] and found["few"].p99 in few[97:]
    for p in (1, 50, 99):
        assert abs(found["many"][f"p{p}"] / n - p / 100) < metrics.RANK_ERROR
    everything = metrics.sketched_percentiles(sketches, (50,)).first()
    assert everything.samples == n and abs(everything.p50 / n - 0.5) < metrics.RANK_ERROR


def test_percentiles_of_nothing_and_of_nulls(spark):
    rows = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 3.0), (None, 4.0)], "g string, v double")
    found = metrics.sketched_percentiles(metrics.quantile_sketches(rows, "v", ("g",)), (50,), ("g",))
    assert {tuple(r) for r in found.collect()} == {("b", 1, 3.0), (None, 1, 4.0)}
    empty = rows.limit(0)
    assert metrics.sketched_percentiles(metrics.quantile_sketches(empty, "v"), (50,)).count() == 0
    assert metrics.sketched_percentiles(metrics.quantile_sketches(empty, "v", ("g",)), (50,), ("g",)).count() == 0
