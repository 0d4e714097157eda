"""Row predicates, and the order filter that needs a running maximum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cashtide.functions.common import ColumnOrName, as_col
from cashtide.functions.text import time_partitions
from cashtide.resources import vocabulary as V
from cashtide.schemas import TIME_PARTITIONS


def is_create_post() -> Column:
    """A newly created post (NULL fields drop the row)."""
    return (
        (F.col("kind") == V.COMMIT_KIND)
        & (F.col("commit.operation") == V.CREATE_OPERATION)
        & (F.col("commit.collection") == V.POST_COLLECTION)
    )


def has_text(stripped: ColumnOrName = "body") -> Column:
    return F.length(as_col(stripped)) > 0


def has_identity(did: ColumnOrName, rkey: ColumnOrName) -> Column:
    return (F.length(as_col(did)) > 0) & (F.length(as_col(rkey)) > 0)


def quality_gate(
    df: DataFrame, report: str = "quality", threshold: float = V.QUALITY_THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """(passed, rejected) by a quality_report column."""
    passes = F.col(f"{report}.is_valid") & (F.col(f"{report}.quality_score") >= threshold)
    return df.filter(passes), df.filter(~passes)


def ticker_equals(ticker: str, column: ColumnOrName = "ticker") -> Column:
    return as_col(column) == ticker


def extreme_sentiment(
    compound: ColumnOrName = "sentiment_compound", tickers: ColumnOrName = "tickers", limit: float = 0.7
) -> Column:
    return (F.abs(as_col(compound)) > limit) & (F.coalesce(F.size(as_col(tickers)), F.lit(0)) > 0)


def time_range_filter(
    start: float, end: float | None = None, created: ColumnOrName = "created_utc", partitioned: bool = True
) -> Column:
    """``start <= created_utc (<= end)``, with matching predicates on the partition folders.

    Tables are partitioned by the same event time, so whole hours outside the range are pruned.
    """
    created = as_col(created)
    keep = created >= start
    if end is not None:
        keep = keep & (created <= end)
    if partitioned:
        folder = F.concat(*[F.col(name) for name in TIME_PARTITIONS])
        keep = keep & (folder >= _folder(start))
        if end is not None:
            keep = keep & (folder <= _folder(end))
    return keep


def _folder(seconds: float) -> Column:
    return F.concat(*time_partitions(F.lit(float(seconds))).values())


def recent_mentions(
    mentions: DataFrame, ticker: str, as_of: float, seconds: int = 6 * 3600, partitioned: bool = True
) -> DataFrame:
    """All mentions of one ticker since ``as_of - seconds``."""
    return mentions.filter(
        ticker_equals(ticker) & time_range_filter(as_of - seconds, partitioned=partitioned)
    )


def drop_out_of_order(
    events: DataFrame,
    arrival: str,
    time_us: str = "time_us",
    source: str = "source",
    chunk: int = 1_000_000,
) -> DataFrame:
    """Keep events that are newer than everything that arrived before them from their source.

    ``arrival`` is an integer arrival position (a log offset, for example). One source may hold
    every row, so the running maximum is taken in two levels: within chunks of ``chunk`` arrival
    positions, and over the maxima of the earlier chunks, one small row each. Events without a
    source are a source of their own; of events without a time only those before the first timed
    one of their source stay.
    """
    tagged = events.withColumn("_chunk", F.floor(F.col(arrival) / F.lit(chunk)))
    earlier = Window.partitionBy(source).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        tagged.groupBy(source, "_chunk")
        .agg(F.max(time_us).alias("_top"))
        .select(F.col(source).alias("_of"), F.col("_chunk").alias("_at"), F.max("_top").over(earlier).alias("_carried"))
    )
    same = F.col(source).eqNullSafe(F.col("_of")) & F.col("_chunk").eqNullSafe(F.col("_at"))
    within = (
        Window.partitionBy(source, "_chunk").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    )
    cursor = F.greatest(F.col("_carried"), F.max(time_us).over(within))
    return (
        tagged.join(carried, same)
        .withColumn("_cursor", cursor)
        .filter(F.col("_cursor").isNull() | (F.col(time_us) > F.col("_cursor")))
        .select(*[f"`{c}`" for c in events.columns])
    )


def read_since_cursor(events: DataFrame, cursor: int | None, time_us: str = "time_us") -> DataFrame:
    """Rows after the saved position; all rows when there is none."""
    return events if cursor is None else events.filter(F.col(time_us) > cursor)


def next_cursor(events: DataFrame, time_us: str = "time_us") -> DataFrame:
    """One row ``cursor``: the position to resume after."""
    return events.agg(F.max(time_us).alias("cursor"))
