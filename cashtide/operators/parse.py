"""Envelope text -> raw posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashtide.functions import text as X
from cashtide.functions.common import let
from cashtide.operators.filters import has_identity, has_text, is_create_post
from cashtide.resources import vocabulary as V
from cashtide.schemas import ENVELOPE, RAW_POST


def parse_envelope(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON message per row -> ``did, time_us, kind, commit`` (plus ``keep``).

    The message is parsed as the only element of a list: text after the object, an empty message,
    a list or a bare number then do not yield exactly one object, and the row is dropped, as is an
    object without ``kind``.

    The list is unpacked by a generator, so that later filters work on its output. On a plain
    column each of their conditions would be pushed down with its own copy of the JSON parsing.
    """
    content = F.concat(F.lit("["), X.decode_utf8(value), F.lit("]"))
    listed = F.from_json(content, T.ArrayType(ENVELOPE), {"allowSingleQuotes": "false"})
    single = let(listed, lambda objects: F.when(F.size(objects) == 1, objects))
    return messages.select(*keep, F.inline_outer(single)).filter(F.col("kind").isNotNull())


def default_engagement(source: str = V.LIVE_SOURCE) -> dict[str, Column]:
    """The feed carries no engagement counts, so these are constants."""
    return {
        "source": F.lit(source),
        "score": F.lit(0),
        "upvote_ratio": F.lit(1.0),
        "num_comments": F.lit(0),
    }


def to_raw_posts(events: DataFrame, now: float | Column | None = None) -> DataFrame:
    """Parsed events -> RAW_POST rows; everything that is not a new, identified post is dropped.

    ``created_utc`` is the server's clock. The client's own ``createdAt`` is never read.
    """
    posts = (
        events.filter(is_create_post())
        .withColumn("body", X.strip_text(F.coalesce(F.col("commit.record.text"), F.lit(""))))
        .filter(has_text("body"))
        .filter(has_identity("did", "commit.rkey"))
    )
    columns = {
        "post_id": X.derive_post_id("did", "commit.rkey"),
        "title": X.derive_title("body"),
        "body": F.col("body"),
        "created_utc": X.server_time("time_us", now),
        "url": X.derive_url("did", "commit.rkey"),
        "fetched_at": X.epoch_seconds(now),
        **default_engagement(),
    }
    return posts.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_POST])


def parse_posts(messages: DataFrame, value: str = "value", now: float | Column | None = None) -> DataFrame:
    """``parse_envelope`` and ``to_raw_posts`` in one step."""
    return to_raw_posts(parse_envelope(messages, value), now)
