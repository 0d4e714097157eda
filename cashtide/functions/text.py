"""Text and time scalars of the parser and the scorer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cashtide.functions.common import ColumnOrName, as_col, let
from cashtide.resources import vocabulary as V

# Every code point that counts as white space for str.strip()/str.split() in Python.
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular expression of Java. Every part of a class is tried on every character, so the class before
# ``&&`` tells most letters apart by two ranges: splitting a text takes less than half the time.
WHITESPACE_RUN = (
    "[\\x00-\\x20\\x7f-\\uffff&&[\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]]+"
)


def decode_utf8(payload: ColumnOrName) -> Column:
    """Bytes (or text) to text; broken sequences become U+FFFD."""
    return F.make_valid_utf8(as_col(payload).cast("string"))


def strip_text(text: ColumnOrName) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone knows only the space)."""
    return F.btrim(as_col(text), F.lit(WHITESPACE))


def truncate_text(text: ColumnOrName, max_chars: int | None = V.SENTIMENT_CHARS) -> Column:
    """Stripped text, cut to ``max_chars`` code points; ``None`` keeps all of it."""
    stripped = F.coalesce(strip_text(text), F.lit(""))
    return stripped if max_chars is None else F.substring(stripped, 1, max_chars)


def derive_title(body: ColumnOrName) -> Column:
    return F.substring(as_col(body), 1, V.TITLE_CHARS)


def derive_post_id(did: ColumnOrName, rkey: ColumnOrName) -> Column:
    return F.concat(as_col(did), F.lit("/"), as_col(rkey))


def derive_url(did: ColumnOrName, rkey: ColumnOrName) -> Column:
    return F.format_string(V.POST_URL_FORMAT, as_col(did), as_col(rkey))


def preview(body: ColumnOrName, chars: int = V.PREVIEW_CHARS) -> Column:
    return F.substring(as_col(body), 1, chars)


def score_text(
    title: ColumnOrName = "title", body: ColumnOrName = "body", text_mode: str = "title_and_body"
) -> Column:
    """Text that is scored and searched for tickers.

    The default repeats the title before the body, as stored results expect: live posts have
    the start of the body as title, so their first part counts twice. ``body`` avoids that.
    """
    if text_mode == "body":
        return as_col(body)
    if text_mode != "title_and_body":
        raise ValueError(f"unknown text_mode: {text_mode}")
    return F.concat(as_col(title), F.lit(" "), as_col(body))


def epoch_seconds(now: float | Column | None = None) -> Column:
    """``now`` as double epoch seconds; the query (or micro-batch) start time by default."""
    if now is None:
        return F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    return now if isinstance(now, Column) else F.lit(float(now))


def server_time(time_us: ColumnOrName, now: float | Column | None = None) -> Column:
    """Server-observed microseconds as epoch seconds; missing or zero means now."""
    observed = F.nullif(as_col(time_us), F.lit(0)) / F.lit(1e6)
    return F.coalesce(observed, epoch_seconds(now))


def epoch_micros(seconds: ColumnOrName) -> Column:
    """Double epoch seconds back to exact integer microseconds."""
    return F.round(as_col(seconds) * F.lit(1e6)).cast("long")


def event_timestamp(seconds: ColumnOrName) -> Column:
    return F.timestamp_micros(epoch_micros(seconds))


def time_partitions(seconds: ColumnOrName) -> dict[str, Column]:
    """Zero-padded UTC partition values of an event time."""
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    moment = event_timestamp(seconds)
    return {name: F.date_format(moment, pattern) for name, pattern in formats.items()}


def lower_once(text: ColumnOrName, body) -> Column:
    """``body`` over the lowercased text, lowercased a single time."""
    return let(F.lower(as_col(text)), body)
