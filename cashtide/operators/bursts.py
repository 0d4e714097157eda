"""Unusual activity: tickers that are mentioned far more than of late, accounts that post in bursts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashtide.functions.common import ColumnOrName, as_col, stable_round
from cashtide.session import staged

HOUR_US = 3_600_000_000
#: Slots a long history of one account is cut into.
SLOT_US = 24 * HOUR_US


def hourly_calendar(mentions: DataFrame, ticker: str = "ticker", time_us: ColumnOrName = "time_us") -> DataFrame:
    """``ticker, hour, mentions`` for every hour from the first to the last one of the table, 0 where there are none.

    Mentions are counted in the map tasks, so what is shuffled is a row for each ticker and hour. Rows without a time
    are left out; those without a ticker are one ticker.
    """
    hour = F.floor(as_col(time_us) / F.lit(HOUR_US)).cast("long")
    counted = mentions.select(F.col(ticker).alias("ticker"), hour.alias("hour")).filter("hour IS NOT NULL")
    counted = staged(counted.groupBy("ticker", "hour").agg(F.count(F.lit(1)).alias("n")), "hours")
    first, last = counted.agg(F.min("hour"), F.max("hour")).first()
    if first is None:
        return counted.select("ticker", "hour", F.col("n").alias("mentions"))
    calendar = counted.select("ticker").distinct().select("ticker", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("hour"))
    empty = calendar.select("ticker", "hour", F.lit(0).cast("long").alias("n"))
    return counted.unionByName(empty).groupBy("ticker", "hour").agg(F.sum("n").alias("mentions"))


def mention_spikes(
    mentions: DataFrame,
    trailing_hours: int = 24,
    deviations: int = 3,
    min_mentions: int = 3,
    ticker: str = "ticker",
    time_us: ColumnOrName = "time_us",
) -> DataFrame:
    """Hours in which a ticker has more than its trailing mean and so many trailing deviations.

    Mean and deviation (of the population) are over the ``trailing_hours`` hours before, which must all lie in the table;
    hours without a mention count as 0. The test is one of integers: with n mentions now, a sum S and a sum of squares Q
    over k hours, (k n - S) > 0 and (k n - S)^2 > d^2 (k Q - S^2), so it never depends on rounding.
    Windows are over hours, not mentions: a ticker with a third of all mentions has as many rows here as any other.
    """
    k = trailing_hours
    trailing = Window.partitionBy("ticker").orderBy("hour").rowsBetween(-k, -1)
    exact = F.col("mentions").cast("decimal(19,0)")
    rows = hourly_calendar(mentions, ticker, time_us).select(
        "ticker",
        "hour",
        "mentions",
        F.count(F.lit(1)).over(trailing).alias("hours"),
        F.sum("mentions").over(trailing).alias("total"),
        F.sum((exact * exact).cast("decimal(28,0)")).over(trailing).alias("squares"),
    )
    total = F.col("total").cast("decimal(19,0)")
    above = (exact * k - total).cast("decimal(19,0)")
    spread = (F.col("squares") * k - total * total).cast("decimal(38,0)")
    found = rows.filter((F.col("hours") == k) & (F.col("mentions") >= min_mentions) & (above > 0) & ((above * above).cast("decimal(38,0)") > spread * (deviations**2)))
    return found.select(
        "ticker",
        F.timestamp_micros(F.col("hour") * F.lit(HOUR_US)).alias("hour"),
        "mentions",
        stable_round(F.col("total") / F.lit(float(k)), 4).alias("trailing_mean"),
        stable_round(F.sqrt(spread.cast("double")) / F.lit(float(k)), 4).alias("trailing_deviation"),
    )


def _merged(parts: DataFrame, gap_us: int, keys: list[str], ends: Column) -> DataFrame:
    """Joins parts of sessions (``first_us, last_us, posts``) that are at most ``gap_us`` apart."""
    order = Window.partitionBy(*keys).orderBy("first_us", "last_us")
    apart = F.col("first_us") - F.lag("last_us").over(order) > gap_us
    numbered = parts.withColumn("opens", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("number", F.sum("opens").over(order))
    return numbered.groupBy(*keys, "number").agg(
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("posts").alias("posts"), ends.alias("edge")
    )


def account_sessions(posts: DataFrame, gap_us: int = HOUR_US // 2, account: str = "source", time_us: ColumnOrName = "time_us") -> DataFrame:
    """``account, first_us, last_us, posts``: runs of posts that are at most ``gap_us`` apart.

    Posts of one account and time are summed in the map tasks. Sessions are then found within slots of a day, each by its own task,
    and only the first and last one of a slot, which may go on beyond it, are brought together by account. So an
    account with a third of all posts is spread over the slots. Rows without a time are left out, those without an
    account are one account.
    """
    slot_us = max(SLOT_US, gap_us)
    time = as_col(time_us).cast("long")
    moments = posts.select(F.col(account).alias("account"), time.alias("first_us")).filter("first_us IS NOT NULL")
    moments = moments.groupBy("account", "first_us").agg(F.count(F.lit(1)).alias("posts"))
    moments = moments.withColumn("last_us", F.col("first_us")).withColumn("slot", F.floor(F.col("first_us") / F.lit(slot_us)))
    inside = _merged(moments, gap_us, ["account", "slot"], F.lit(False))
    slot = Window.partitionBy("account", "slot")
    edge = (F.col("number") == 1) | (F.col("number") == F.max("number").over(slot))
    inside = staged(inside.withColumn("edge", edge).drop("number"), "sessions")
    across = _merged(inside.filter("edge"), gap_us, ["account"], F.lit(True))
    names = ["account", "first_us", "last_us", "posts"]
    return inside.filter("NOT edge").select(*names).unionByName(across.select(*names))


def _bursts(sessions: DataFrame, min_posts: int, max_mean_gap_us: int) -> DataFrame:
    """Sessions of so many posts that follow each other this closely on average."""
    lasted = F.col("last_us") - F.col("first_us")
    dense = sessions.filter((F.col("posts") >= min_posts) & (lasted <= (F.col("posts") - 1) * F.lit(max_mean_gap_us)))
    return dense.select(
        "account", "first_us", "last_us", "posts", stable_round(F.col("posts") * F.lit(60e6) / F.greatest(lasted, F.lit(1_000_000)), 4).alias("posts_per_minute")
    )


def bursty_accounts(
    posts: DataFrame,
    gap_us: int = HOUR_US // 2,
    min_posts: int = 5,
    max_mean_gap_us: int = HOUR_US // 6,
    account: str = "source",
    time_us: ColumnOrName = "time_us",
) -> DataFrame:
    """``account, first_us, last_us, posts, posts_per_minute`` of the sessions that are bursts (a span counts as a second at least)."""
    return _bursts(account_sessions(posts, gap_us, account, time_us), min_posts, max_mean_gap_us)


def session_counts(posts: DataFrame, gap_us: int = HOUR_US // 2, delay_us: int = HOUR_US // 6, account: str = "source", time_us: ColumnOrName = "time_us") -> DataFrame:
    """Sessions as a stream: emitted when the watermark, ``delay_us`` behind the newest post, has passed their end."""
    timed = posts.select(F.col(account).alias("account"), as_col(time_us).alias("time_us")).withColumn("event_time", F.timestamp_micros("time_us"))
    # A session window ends before its gap is over; one microsecond more makes posts at exactly the gap one session.
    window = F.session_window("event_time", f"{gap_us + 1} microseconds")
    found = timed.withWatermark("event_time", f"{delay_us} microseconds").groupBy(window, "account")
    counted = found.agg(F.count(F.lit(1)).alias("posts"), F.min("time_us").alias("first_us"), F.max("time_us").alias("last_us"))
    return counted.select("account", "first_us", "last_us", "posts")


def bursty_accounts_stream(posts: DataFrame, min_posts: int = 5, max_mean_gap_us: int = HOUR_US // 6, **options) -> DataFrame:
    """``bursty_accounts`` as a stream; the state is a row for each open session."""
    return _bursts(session_counts(posts, **options), min_posts, max_mean_gap_us)
