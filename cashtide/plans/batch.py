"""The same job over a bounded set of events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cashtide.config import Settings
from cashtide.functions.relevance import is_financial
from cashtide.functions.text import epoch_micros
from cashtide.operators.dedup import dedup_ttl
from cashtide.operators.filters import quality_gate
from cashtide.operators.mentions import explode_mentions, to_processed
from cashtide.operators.metrics import outcome_counts, pipeline_metrics
from cashtide.operators.sentiment import Lexicon, Scorer
from cashtide.schemas import POST
from cashtide.session import staged
from cashtide.sinks.tables import WriteStats, write_mentions, write_posts, write_stats
from cashtide.sources.tables import hour_folders


@dataclass(frozen=True)
class BatchResult:
    metrics: DataFrame
    stats: WriteStats


def unique_posts(posts: DataFrame, settings: Settings | None = None, prefilter: bool = True) -> DataFrame:
    """Relevant posts without re-deliveries, before the costly scoring.

    Deduplication scans its input more than once. The relevant posts are a small part of all
    messages, so they are staged: the messages are read and parsed a single time.
    """
    settings = settings or Settings()
    wanted = posts.filter(is_financial("body")) if prefilter else posts
    timed = staged(wanted.withColumn("time_us", epoch_micros("created_utc")), "relevant")
    return dedup_ttl(timed, window_us=settings.dedup_window_seconds * 1_000_000).drop("time_us")


def accepted_posts(
    posts: DataFrame,
    now: float | None = None,
    settings: Settings | None = None,
    prefilter: bool = True,
    lexicon: Lexicon = None,
    scorer: Scorer | None = None,
) -> DataFrame:
    """RAW_POST -> scored posts that pass the gate (double precision, before the float sink)."""
    settings = settings or Settings()
    scored = to_processed(unique_posts(posts, settings, prefilter), now, lexicon, scorer)
    passed, _ = quality_gate(scored, threshold=settings.quality_threshold)
    return passed.drop("quality")


def run_batch(
    posts: DataFrame,
    root: str,
    batch_id: str | int,
    elapsed_s: float = 1.0,
    now: float | None = None,
    settings: Settings | None = None,
    prefilter: bool = True,
    lexicon: Lexicon = None,
    scorer: Scorer | None = None,
) -> BatchResult:
    """Score a bounded set of posts and write both tables.

    Mentions are taken from the posts just written, a scan of a few narrow columns, so nothing is
    scored twice and nothing large is cached.
    """
    spark, settings = posts.sparkSession, settings or Settings()
    ingest, kept, done = (Observation(name) for name in ("ingest", "kept", "done"))
    rows = F.count(F.lit(1)).alias("n")

    wanted = posts.filter(is_financial("body")) if prefilter else posts
    unique = unique_posts(wanted.observe(ingest, rows), settings, prefilter=False).observe(kept, rows)
    ingested = ingest.get["n"]  # known once the relevant posts are staged
    if not ingested:
        return BatchResult(_metrics(spark, 0, 0, 0, elapsed_s), WriteStats())
    passed, _ = quality_gate(to_processed(unique, now, lexicon, scorer), threshold=settings.quality_threshold)
    mentions = F.coalesce(F.sum(F.size("tickers")), F.lit(0)).alias("mentions")
    span = [F.coalesce(f("created_utc"), F.lit(0.0)).alias(n) for f, n in ((F.min, "since"), (F.max, "until"))]
    write_posts(passed.observe(done, rows, mentions, *span), root, batch_id)

    processed, found = done.get["n"], done.get["mentions"]
    since, until = done.get["since"], done.get["until"]
    if found:
        folders = hour_folders(spark, root, "posts", since, until, batch=str(batch_id))
        write_mentions(explode_mentions(spark.read.schema(POST).parquet(*folders)), root, batch_id)
    metrics = _metrics(spark, ingested, kept.get["n"], processed, elapsed_s)
    return BatchResult(metrics, write_stats(spark, root, batch_id, processed, found, since, until))


def _metrics(spark: SparkSession, ingested: int, kept: int, processed: int, elapsed_s: float) -> DataFrame:
    counts = spark.createDataFrame(outcome_counts(ingested, kept, processed), "outcome string, n long")
    return pipeline_metrics(counts, elapsed_s)
