"""The fixed table layouts. Nothing is inferred on write."""

from pyspark.sql import types as T

_S, _I, _L, _D, _F = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


RECORD = _struct(("text", _S), ("createdAt", _S))
COMMIT = _struct(("operation", _S), ("collection", _S), ("rkey", _S), ("record", RECORD))
ENVELOPE = _struct(("did", _S), ("time_us", _L), ("kind", _S), ("commit", COMMIT))

RAW_POST = _struct(
    ("post_id", _S),
    ("source", _S),
    ("title", _S),
    ("body", _S),
    ("score", _I),
    ("upvote_ratio", _D),
    ("num_comments", _I),
    ("created_utc", _D),
    ("url", _S),
    ("fetched_at", _D),
)

POST = _struct(
    ("post_id", _S),
    ("source", _S),
    ("title", _S),
    ("body", _S),
    ("score", _I),
    ("upvote_ratio", _F),
    ("num_comments", _I),
    ("created_utc", _D),
    ("url", _S),
    ("fetched_at", _D),
    ("sentiment_compound", _F),
    ("sentiment_positive", _F),
    ("sentiment_negative", _F),
    ("sentiment_neutral", _F),
    ("tickers", T.ArrayType(_S)),
    ("quality_score", _F),
    ("processed_at", _D),
)

MENTION = _struct(
    ("post_id", _S),
    ("ticker", _S),
    ("source", _S),
    ("sentiment_compound", _F),
    ("score", _I),
    ("created_utc", _D),
    ("processed_at", _D),
)

SENTIMENT = _struct(("compound", _D), ("positive", _D), ("negative", _D), ("neutral", _D))

TIME_PARTITIONS = ("year", "month", "day", "hour")
BATCH_COLUMN = "batch_id"


def with_partition_fields(schema: T.StructType) -> T.StructType:
    """``schema`` as read back from disk: partition values stay zero-padded strings."""
    names = (*TIME_PARTITIONS, BATCH_COLUMN)
    return T.StructType([*schema.fields, *(T.StructField(n, _S) for n in names)])
