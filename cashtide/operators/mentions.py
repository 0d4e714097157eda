"""Raw posts -> scored posts -> mentions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashtide.functions import text as X
from cashtide.functions.quality import quality_report
from cashtide.functions.tickers import extract_tickers
from cashtide.operators.sentiment import Lexicon, Scorer, score_sentiment
from cashtide.schemas import MENTION, POST


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fixed column order and types; an integer that does not fit fails the job."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def conform_posts(df: DataFrame) -> DataFrame:
    return conform(df, POST)


def conform_mentions(df: DataFrame) -> DataFrame:
    return conform(df, MENTION)


def to_processed(
    raw: DataFrame,
    now: float | Column | None = None,
    lexicon: Lexicon = None,
    scorer: Scorer | None = None,
    text_mode: str = "title_and_body",
    max_chars: int | None = None,
) -> DataFrame:
    """RAW_POST -> the post columns in double precision, plus the ``quality`` report.

    ``scorer`` replaces the rule-based scorer: it gets the posts with a ``score_text`` column and
    adds the four ``sentiment_*`` columns. ``max_chars`` cuts the text that is scored, never the one
    that is searched for tickers.

    Tickers come out of a generator, below the scores: a later filter on them (``explode`` brings
    one) spares the scoring of posts without tickers and does not repeat the search.
    """
    texts = raw.withColumn("score_text", X.score_text(text_mode=text_mode))
    found = F.struct(extract_tickers("score_text").alias("tickers"))
    searched = texts.select("*", F.inline_outer(F.array(found)))
    scored = scorer(searched) if scorer else score_sentiment(searched, "score_text", lexicon, max_chars)
    scored = scored.select(*[F.col(c) for c in scored.columns if c != "tickers"], "tickers")
    return (
        scored.withColumn("quality", quality_report())
        .withColumn("quality_score", F.col("quality.quality_score"))
        .withColumn("processed_at", X.epoch_seconds(now))
        .drop("score_text")
    )


def explode_mentions(posts: DataFrame) -> DataFrame:
    """One row per post and ticker; posts without tickers give none."""
    return posts.select(
        "post_id",
        F.explode("tickers").alias("ticker"),
        "source",
        "sentiment_compound",
        "score",
        "created_utc",
        "processed_at",
    )


def restrict_mentions(
    mentions: DataFrame, universe: DataFrame, blacklist: DataFrame | None = None, ticker: str = "ticker"
) -> DataFrame:
    """Membership tests against ticker tables of any size (column ``ticker`` in both).

    Plain semi and anti joins: Spark broadcasts a table only if its statistics say it is small.
    """
    kept = mentions.join(universe.select(ticker), ticker, "left_semi")
    return kept if blacklist is None else kept.join(blacklist.select(ticker), ticker, "left_anti")


def mentions_with_posts(mentions: DataFrame, posts: DataFrame, columns: Sequence[str] = ("title", "body", "tickers")) -> DataFrame:
    """Mentions with further ``columns`` of their posts, as ``post_<column>``; mentions without a post are kept, with NULL.

    ``posts`` has one row a post id. Both sides are large, so they are merged by the id: without an exchange if both come
    from ``store_buckets`` with as many buckets. Neither side is ever broadcast.
    """
    wanted = posts.select(F.col("post_id").alias("_post_id"), *[F.col(c).alias(f"post_{c}") for c in columns])
    joined = mentions.join(wanted.hint("merge"), F.col("post_id") == F.col("_post_id"), "left")
    return joined.drop("_post_id")
