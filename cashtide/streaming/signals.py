"""Continuous per-ticker windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide.functions.common import stable_round
from cashtide.functions.text import event_timestamp


def sliding_signals(
    mentions: DataFrame,
    window_seconds: int = 300,
    slide_seconds: int | None = None,
    delay_seconds: int = 600,
    compound: str = "sentiment_compound",
    created: str = "created_utc",
) -> DataFrame:
    """Mean sentiment and mentions per ticker for windows of ``window_seconds``.

    Without ``slide_seconds`` the windows tumble. Otherwise mentions are summed per slide first and
    these sums are combined into the sliding windows: a mention would have to be copied into every
    window it belongs to (288 for a day in steps of five minutes), a sum per slide is copied
    instead. Windows are emitted when the watermark closes them; late mentions are dropped.
    Works on a batch as well: ``open_windows`` completes a stream that has ended.
    """
    slide = slide_seconds or window_seconds
    if window_seconds % slide:
        raise ValueError("window_seconds must be a multiple of slide_seconds")
    timed = mentions.withColumn("event_time", event_timestamp(created)).withWatermark(
        "event_time", f"{delay_seconds} seconds"
    )
    sums = timed.groupBy(F.window("event_time", f"{slide} seconds").alias("w"), "ticker").agg(
        F.sum(F.col(compound).cast("double")).alias("total"), F.count(compound).alias("mentions")
    )
    if slide != window_seconds:
        span = F.window(F.window_time("w"), f"{window_seconds} seconds", f"{slide} seconds")
        sums = sums.groupBy(span.alias("w"), "ticker").agg(
            F.sum("total").alias("total"), F.sum("mentions").alias("mentions")
        )
    return sums.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "ticker",
        stable_round(F.col("total") / F.col("mentions"), 4).alias("avg_sentiment"),
        "mentions",
    )


def open_windows(
    mentions: DataFrame,
    emitted: DataFrame,
    window_seconds: int = 300,
    slide_seconds: int | None = None,
    compound: str = "sentiment_compound",
    created: str = "created_utc",
) -> DataFrame:
    """The windows a drained stream has not emitted: those that end after the last one in ``emitted``.

    ``mentions`` is the stream's input as a table. Only what lies in these windows is aggregated.
    """
    last = emitted.agg(F.max(F.unix_micros("window_end"))).first()[0]
    if last is None:
        return sliding_signals(mentions, window_seconds, slide_seconds, 0, compound, created)
    since = last / 1e6 - window_seconds
    late = sliding_signals(mentions.filter(F.col(created) >= since), window_seconds, slide_seconds, 0, compound, created)
    return late.filter(F.unix_micros("window_end") > last)
