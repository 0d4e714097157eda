"""One entry point for every post source; all of them give RAW_POST rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cashtide.config import Settings
from cashtide.operators.mentions import conform
from cashtide.operators.parse import parse_posts
from cashtide.schemas import RAW_POST
from cashtide.sources.envelopes import read_envelopes, read_envelopes_stream

MODES = ("live", "demo")


def load_posts(
    spark: SparkSession,
    mode: str | None = None,
    path: str | None = None,
    streaming: bool = False,
    settings: Settings | None = None,
    now: float | None = None,
) -> DataFrame:
    """``live`` parses event files below ``path``; ``demo`` reads posts kept there as a RAW_POST table. Batch or stream."""
    settings = settings or Settings()
    mode = mode or ("demo" if settings.demo_mode else "live")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    if path is None:
        raise ValueError("posts need a path")
    if mode == "demo":
        reader = spark.readStream if streaming else spark.read
        return reader.schema(RAW_POST).parquet(path)
    if streaming:
        return parse_posts(read_envelopes_stream(spark, path, settings.max_files_per_trigger), now=now)
    return parse_posts(read_envelopes(spark, path), now=now)


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Posts of several sources, each brought to RAW_POST."""
    return reduce(lambda a, b: a.unionByName(b), [conform(df, RAW_POST) for df in (first, *others)])
