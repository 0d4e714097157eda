"""Reports over the stored posts and mentions tables.

Group sums are combined in the map tasks before each shuffle, and every ordered report has
tie-breakers, so equal data gives equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide.functions.common import stable_round
from cashtide.functions.text import event_timestamp, preview
from cashtide.operators.filters import extreme_sentiment, ticker_equals


def top_mentions(mentions: DataFrame, n: int = 5) -> DataFrame:
    """Most mentioned tickers with mean and sample deviation of the sentiment."""
    return (
        mentions.groupBy("ticker")
        .agg(
            F.count(F.lit(1)).alias("mentions"),
            stable_round(F.avg("sentiment_compound"), 3).alias("avg_sentiment"),
            stable_round(F.stddev_samp("sentiment_compound"), 3).alias("sentiment_stddev"),
        )
        .orderBy(F.desc("mentions"), "ticker")
        .limit(n)
    )


def source_quality(posts: DataFrame) -> DataFrame:
    """Volume and quality per source."""
    has_tickers = F.coalesce(F.size("tickers"), F.lit(0)) > 0
    return posts.groupBy("source").agg(
        F.count(F.lit(1)).alias("posts"),
        stable_round(F.avg("quality_score"), 3).alias("avg_quality"),
        stable_round(F.min("quality_score").cast("double"), 3).alias("min_quality"),
        F.sum(F.when(has_tickers, 1).otherwise(0)).alias("posts_with_tickers"),
    )


def latest_mentions(mentions: DataFrame, ticker: str = "NVDA", n: int = 10) -> DataFrame:
    """The newest mentions of one ticker."""
    return (
        mentions.filter(ticker_equals(ticker))
        .orderBy(F.desc("created_utc"), "post_id")
        .limit(n)
        .select(
            event_timestamp("created_utc").alias("ts"), "ticker", "sentiment_compound", "source", "post_id"
        )
    )


def hourly_volume(mentions: DataFrame, n: int = 24) -> DataFrame:
    """Mentions and distinct tickers per hour, newest hours first.

    Counting per hour and ticker first keeps a busy hour from reaching one task row by row.
    """
    hour = F.date_trunc("hour", event_timestamp("created_utc"))
    per_ticker = mentions.groupBy(hour.alias("hour"), "ticker").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_ticker.groupBy("hour")
        .agg(F.sum("n").alias("mentions"), F.count("ticker").alias("distinct_tickers"))
        .orderBy(F.desc("hour"))
        .limit(n)
    )


def volume_sketches(mentions: DataFrame, lg_k: int = 12) -> DataFrame:
    """``hour, mentions, tickers`` for every hour: a count, and a mergeable sketch of the distinct tickers.

    A table of these (a few kilobytes an hour) answers ``volume_between`` for any range without reading mentions again, and
    further hours are simply added. Estimates have a relative standard error of about 1.04 / sqrt(2 ** lg_k), 1.6 % by
    default; up to an eighth of 2 ** lg_k tickers (512) the sketch keeps them one by one and the estimate is their number.
    """
    hour = F.date_trunc("hour", event_timestamp("created_utc"))
    return mentions.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("mentions"), F.hll_sketch_agg("ticker", F.lit(lg_k)).alias("tickers"))


def volume_between(sketches: DataFrame, unit: str = "day") -> DataFrame:
    """Mentions and estimated distinct tickers per ``unit`` (any that ``date_trunc`` knows), from the sketches of its hours."""
    rolled = sketches.groupBy(F.date_trunc(unit, "hour").alias("start")).agg(F.sum("mentions").alias("mentions"), F.hll_union_agg("tickers").alias("tickers"))
    return rolled.select("start", "mentions", F.hll_sketch_estimate("tickers").alias("distinct_tickers"))


def extreme_posts(posts: DataFrame, limit: float = 0.7, n: int = 10) -> DataFrame:
    """Posts with tickers and the strongest sentiment, with the start of their text."""
    return (
        posts.filter(extreme_sentiment(limit=limit))
        .orderBy(F.desc(F.abs("sentiment_compound")), "post_id")
        .limit(n)
        .select(
            "source",
            stable_round(F.col("sentiment_compound").cast("double"), 2).alias("s"),
            "tickers",
            preview("body").alias("preview"),
        )
    )


def ticker_density(posts: DataFrame) -> DataFrame:
    """Posts, posts with a ticker, mentions and distinct tickers in one row.

    Each post gives one row of its own and one per ticker. Counting per symbol (the post's own row
    has none) leaves a few rows per map task to shuffle, and no distinct count over all mentions.
    """
    symbols = F.coalesce(F.col("tickers"), F.array().cast("array<string>"))
    rows = posts.select(
        (F.size(symbols) > 0).alias("tagged"),
        F.explode(F.array_append(symbols, F.lit(None).cast("string"))).alias("ticker"),
    )
    own = F.col("ticker").isNull()
    per_symbol = rows.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(own & F.col("tagged")).alias("tagged")
    )
    return per_symbol.agg(
        F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias("posts"),
        F.coalesce(F.sum("tagged"), F.lit(0)).alias("posts_with_tickers"),
        F.coalesce(F.sum(F.when(~own, F.col("n"))), F.lit(0)).alias("mentions"),
        F.count("ticker").alias("distinct_tickers"),
    )
