"""The registered queries: each operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide.functions import quality
from cashtide.functions import text as X
from cashtide.functions import tickers as K
from cashtide.functions.quality import quality_report
from cashtide.functions.relevance import is_financial, is_financial_words, with_keywords
from cashtide.operators import analytics, metrics
from cashtide.operators.bursts import bursty_accounts, bursty_accounts_stream, mention_spikes
from cashtide.operators.copies import copied_texts, near_copied_texts
from cashtide.operators.dedup import dedup_on_read, dedup_ttl
from cashtide.operators.filters import (
    drop_out_of_order,
    extreme_sentiment,
    next_cursor,
    quality_gate,
    read_since_cursor,
    recent_mentions,
    ticker_equals,
)
from cashtide.operators.mentions import conform_mentions, conform_posts, explode_mentions, mentions_with_posts, restrict_mentions, to_processed
from cashtide.operators.parse import parse_envelope, parse_posts
from cashtide.operators.sentiment import score_sentiment
from cashtide.operators.signals import rolling_signals, ticker_signals, top_tickers
from cashtide.plans import inputs as I
from cashtide.plans.batch import accepted_posts, run_batch
from cashtide.resources import vocabulary as V
from cashtide.resources.lexicon import DEFAULT_LEXICON
from cashtide.session import scratch_path, staged
from cashtide.sinks.buckets import store_buckets
from cashtide.sinks.tables import compact_partitions, with_time_partitions, write_mentions
from cashtide.sources.envelopes import read_envelopes, read_envelopes_stream
from cashtide.sources.load import load_posts, union_sources
from cashtide.sources.tables import read_mentions, read_posts, read_union_by_name, splits_of, stored_files
from cashtide.streaming.dedup import KeptIds, dedup_ttl_stream, dedup_watermark
from cashtide.streaming.progress import counted_progress, store_progress
from cashtide.streaming.run import run_stream, stream_metrics
from cashtide.streaming.signals import open_windows, sliding_signals

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _REGISTRY[name] = function
        return function

    return register


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- parsing and projections -------------------------------------------------


@query("parse_envelope")
def _parse_envelope(spark, sf):
    """Messages -> envelope fields; broken messages are gone."""
    fields = ["did", "time_us", "kind", "commit.operation", "commit.collection", "commit.rkey"]
    return parse_envelope(I.messages(spark, sf)).select(*fields, F.length("commit.record.text").alias("chars"))


@query("parse_posts")
def _parse_posts(spark, sf):
    return parse_posts(I.messages(spark, sf), now=I.NOW)


@query("decode_utf8")
def _decode_utf8(spark, sf):
    broken = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF41C3")))
    return I.documents(spark, sf).select("doc_id", X.decode_utf8(broken).alias("decoded"))


@query("text_scalars")
def _text_scalars(spark, sf):
    padded = F.concat(F.lit("\u3000\x1f "), F.col("text"), F.lit("\x85 \n"))
    return I.documents(spark, sf).select(
        "doc_id",
        X.strip_text(padded).alias("stripped"),
        X.truncate_text(padded).alias("truncated"),
        X.derive_title("text").alias("title"),
        X.preview("text").alias("preview"),
        X.derive_post_id(F.col("source"), F.col("doc_id").cast("string")).alias("post_id"),
        X.derive_url(F.col("source"), F.col("doc_id").cast("string")).alias("url"),
        F.length(X.score_text(X.derive_title("text"), "text")).alias("score_text_chars"),
    )


@query("server_time")
def _server_time(spark, sf):
    observed = F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.col("time_us"))
    created = X.server_time(observed, I.NOW)
    return I.timed_events(spark, sf).select(
        "event_id", created.alias("created_utc"), X.epoch_micros(created).alias("created_us")
    )


@query("with_time_partitions")
def _with_time_partitions(spark, sf):
    return (
        with_time_partitions(I.event_mentions(spark, sf))
        .groupBy("year", "month", "day", "hour")
        .agg(F.count(F.lit(1)).alias("mentions"))
    )


@query("read_envelopes")
def _read_envelopes(spark, sf):
    """Messages as text files, read back and parsed."""
    root = scratch_path(spark, "messages")
    I.messages(spark, sf).write.text(root)
    return parse_envelope(read_envelopes(spark, root)).select("did", "time_us", "kind", "commit.rkey")


@query("load_posts")
def _load_posts(spark, sf):
    root = scratch_path(spark, "messages")
    I.messages(spark, sf).write.text(root)
    return load_posts(spark, "live", root, now=I.NOW).select("post_id", "source", "title", "created_utc")


@query("to_processed")
def _to_processed(spark, sf):
    """All 17 columns of every parsed post, in double precision."""
    posts = to_processed(parse_posts(I.messages(spark, sf), now=I.NOW), now=I.NOW)
    return posts.drop("quality").withColumn("tickers", F.array_join("tickers", ","))


@query("conform_posts")
def _conform_posts(spark, sf):
    posts = to_processed(parse_posts(I.messages(spark, sf), now=I.NOW), now=I.NOW, text_mode="body")
    return conform_posts(posts).withColumn("tickers", F.array_join("tickers", ","))


# --- filters -----------------------------------------------------------------


@query("is_financial")
def _is_financial(spark, sf):
    return I.documents(spark, sf).select("doc_id", is_financial("text").alias("financial"))


@query("is_financial_words")
def _is_financial_words(spark, sf):
    return I.documents(spark, sf).select("doc_id", is_financial_words(I.post_text()).alias("cashtag"), is_financial_words("text").alias("financial"))


@query("with_keywords")
def _with_keywords(spark, sf):
    """Documents with long second words of any document: a table of keywords that grows with the input."""
    words = I.table(spark, sf, "documents").select(F.get(F.split("text", " ", 3), 1).alias("keyword")).filter("length(keyword) > 6")
    return with_keywords(I.table(spark, sf, "documents"), "doc_id", "text", words.distinct()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("keywords"))


@query("drop_out_of_order")
def _drop_out_of_order(spark, sf):
    events = I.timed_events(spark, sf).withColumn("arrival", F.col("event_id").bitwiseXOR(F.lit(7)))
    return drop_out_of_order(events, "arrival", source="event_type", chunk=1000).select("event_id", "time_us")


@query("drop_out_of_order_null_source")
def _drop_out_of_order_null_source(spark, sf):
    events = I.timed_events(spark, sf).withColumn("arrival", F.col("event_id").bitwiseXOR(F.lit(7)))
    events = events.withColumn("source", F.nullif("event_type", F.lit("error")))
    return drop_out_of_order(events, "arrival", chunk=1000).select("event_id", "time_us")


@query("read_since_cursor")
def _read_since_cursor(spark, sf):
    return read_since_cursor(I.timed_events(spark, sf), round(I.AS_OF * 1e6)).select("event_id", "time_us")


@query("next_cursor")
def _next_cursor(spark, sf):
    return next_cursor(I.timed_events(spark, sf))


@query("quality_checks")
def _quality_checks(spark, sf):
    """Each check on its own; true means the post fails it."""
    checks = ("post_id", "removed", "title", "body", "upvote_ratio", "compound", "created")
    return I.graded_posts(spark, sf).select(
        "doc_id", *[getattr(quality, f"check_{name}")().alias(f"bad_{name}") for name in checks]
    )


@query("quality_score")
def _quality_score(spark, sf):
    return I.graded_posts(spark, sf).select("doc_id", quality.quality_score().alias("quality_score"))


@query("quality_report")
def _quality_report(spark, sf):
    return (
        I.graded_posts(spark, sf)
        .select("doc_id", quality_report().alias("q"))
        .select(
            "doc_id", "q.is_valid", F.array_join("q.issues", "; ").alias("issues"), "q.quality_score"
        )
    )


@query("quality_gate")
def _quality_gate(spark, sf):
    passed, rejected = quality_gate(I.graded_posts(spark, sf).withColumn("quality", quality_report()))
    return passed.select("doc_id", F.lit(True).alias("passed")).unionAll(
        rejected.select("doc_id", F.lit(False).alias("passed"))
    )


@query("ticker_equals")
def _ticker_equals(spark, sf):
    return I.event_mentions(spark, sf).filter(ticker_equals("COIN")).select("post_id", "ticker", "created_utc")


@query("extreme_sentiment")
def _extreme_sentiment(spark, sf):
    posts = I.graded_posts(spark, sf).withColumn("sentiment_compound", F.col("sentiment_compound") * 0.8)
    return posts.filter(extreme_sentiment()).select("doc_id")


@query("recent_mentions")
def _recent_mentions(spark, sf):
    """Recent mentions of one ticker from the partitioned table, with whole hours pruned."""
    root = scratch_path(spark, "mentions")
    write_mentions(I.event_mentions(spark, sf), root, "all")
    return recent_mentions(read_mentions(spark, root), "COIN", I.AS_OF, 5 * 86400).select(
        "post_id", "created_utc", "day", "hour"
    )


# --- text scoring ------------------------------------------------------------


@query("extract_cashtags")
def _extract_cashtags(spark, sf):
    found = K.extract_cashtags(I.post_text())
    return I.documents(spark, sf).select("doc_id", F.array_join(found, ",").alias("cashtags"))


@query("extract_bare_tickers")
def _extract_bare_tickers(spark, sf):
    found = K.extract_bare_tickers(I.post_text())
    return I.documents(spark, sf).select("doc_id", F.array_join(found, ",").alias("bare"))


@query("extract_tickers")
def _extract_tickers(spark, sf):
    found = K.extract_tickers(I.post_text())
    return I.documents(spark, sf).select("doc_id", F.array_join(found, ",").alias("tickers"))


@query("ticker_membership")
def _ticker_membership(spark, sf):
    """Capitalised words of all texts against ticker tables that Spark joins."""
    word = F.explode(F.regexp_extract_all("text", F.lit("[A-Z]+"), F.lit(0))).alias("ticker")
    words = I.documents(spark, sf).select("doc_id", word)
    universe = spark.createDataFrame([(t,) for t in V.TICKERS], "ticker string")
    banned = spark.createDataFrame([(t,) for t in V.BARE_WORD_BLACKLIST], "ticker string")
    return restrict_mentions(words, universe, banned).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))


def _scores(df: DataFrame) -> DataFrame:
    names = ("compound", "positive", "negative", "neutral")
    return df.select("doc_id", *[F.col(f"sentiment_{n}").alias(n) for n in names])


@query("score_sentiment")
def _score_sentiment(spark, sf):
    return _scores(score_sentiment(I.documents(spark, sf), I.post_text()))


@query("score_sentiment_whole_text")
def _score_sentiment_whole_text(spark, sf):
    return _scores(score_sentiment(I.documents(spark, sf), I.post_text(), max_chars=None))


@query("score_sentiment_lexicon_table")
def _score_sentiment_lexicon_table(spark, sf):
    """The lexicon as a table that names every word twice."""
    rows = [*DEFAULT_LEXICON.items(), *((word, -4.0) for word in DEFAULT_LEXICON), (None, 1.0)]
    table = spark.createDataFrame(rows, "token string, valence double")
    return _scores(score_sentiment(I.documents(spark, sf), I.post_text(), table))


# --- dedup -------------------------------------------------------------------


@query("dedup_ttl")
def _dedup_ttl(spark, sf):
    events = I.timed_events(spark, sf)
    return dedup_ttl(events, "user_id", order=("event_id",)).select("event_id", "user_id", "time_us")


@query("dedup_ttl_crowded_keys")
def _dedup_ttl_crowded_keys(spark, sf):
    """Few keys with many rows each: the form that never gathers a key."""
    events = I.timed_events(spark, sf)
    return dedup_ttl(events, "event_type", order=("event_id",), fold_rows=100).select(
        "event_id", "event_type", "time_us"
    )


@query("dedup_ttl_null_times")
def _dedup_ttl_null_times(spark, sf):
    """Some events have no time: all of these stay. Crowded and usual keys."""
    time_us = F.when(F.col("user_id") % 7 != 3, F.col("time_us"))
    events = I.timed_events(spark, sf).withColumn("time_us", time_us)
    return dedup_ttl(events, "event_type", order=("event_id",)).select("event_id", "event_type", "time_us")


@query("dedup_on_read")
def _dedup_on_read(spark, sf):
    events = I.timed_events(spark, sf)
    return dedup_on_read(events, "user_id", ("time_us", "event_id")).select("user_id", "event_id", "time_us")


# --- mentions and signals ----------------------------------------------------


@query("explode_mentions")
def _explode_mentions(spark, sf):
    return conform_mentions(explode_mentions(I.graded_posts(spark, sf)))


@query("ticker_signals")
def _ticker_signals(spark, sf):
    universe = spark.createDataFrame([(t,) for t in V.TICKERS], "ticker string")
    return ticker_signals(I.event_mentions(spark, sf), I.AS_OF, universe)


@query("rolling_signals")
def _rolling_signals(spark, sf):
    return rolling_signals(I.event_mentions(spark, sf)).drop("sentiment_compound", "source", "score", "processed_at")


@query("rolling_signals_null_ticker")
def _rolling_signals_null_ticker(spark, sf):
    """Mentions without a ticker are kept, as a ticker of their own."""
    mentions = I.event_mentions(spark, sf).withColumn("ticker", F.nullif("ticker", F.lit("SPY")))
    return rolling_signals(mentions).drop("sentiment_compound", "source", "score", "processed_at")


@query("top_tickers")
def _top_tickers(spark, sf):
    return top_tickers(I.event_mentions(spark, sf), I.AS_OF, "24h", 10)


# --- reports -----------------------------------------------------------------


@query("top_mentions")
def _top_mentions(spark, sf):
    return analytics.top_mentions(I.event_mentions(spark, sf))


@query("source_quality")
def _source_quality(spark, sf):
    posts = I.graded_posts(spark, sf).withColumn("quality_score", quality_report()["quality_score"].cast("float"))
    return analytics.source_quality(posts)


@query("latest_mentions")
def _latest_mentions(spark, sf):
    return analytics.latest_mentions(I.event_mentions(spark, sf))


@query("hourly_volume")
def _hourly_volume(spark, sf):
    return analytics.hourly_volume(I.event_mentions(spark, sf))


@query("volume_sketches")
def _volume_sketches(spark, sf):
    return analytics.volume_between(analytics.volume_sketches(I.event_mentions(spark, sf)), "day")


@query("extreme_posts")
def _extreme_posts(spark, sf):
    posts = analytics.extreme_posts(I.graded_posts(spark, sf))
    return posts.withColumn("tickers", F.array_join("tickers", ","))


@query("ticker_density")
def _ticker_density(spark, sf):
    return analytics.ticker_density(I.graded_posts(spark, sf))


# --- metrics -----------------------------------------------------------------


@query("run_metrics")
def _run_metrics(spark, sf):
    kinds = F.when(F.col("event_type") == "signup", metrics.DUPLICATE).when(
        F.col("event_type") == "error", metrics.INVALID
    )
    outcomes = I.timed_events(spark, sf).select(kinds.otherwise(metrics.PROCESSED).alias("outcome"))
    return metrics.pipeline_metrics(outcomes, elapsed_s=777.25)


@query("funnel_metrics")
def _funnel_metrics(spark, sf):
    posts = parse_posts(I.messages(spark, sf), now=I.NOW).withColumn("ordered", ~F.col("post_id").contains("src2/"))
    return metrics.funnel_metrics(posts, I.NOW + 2.5, 600.0, in_order="ordered")


@query("percentile_nearest")
def _percentile_nearest(spark, sf):
    return metrics.percentile_nearest(
        I.timed_events(spark, sf), "value", order=("time_us", "event_id"), group=("event_type",)
    )


@query("percentile_nearest_overall")
def _percentile_nearest_overall(spark, sf):
    return metrics.percentile_nearest(I.timed_events(spark, sf), "value", order=("time_us", "event_id"))


@query("percentile_sketches")
def _percentile_sketches(spark, sf):
    """Percentiles of all values of a type, from sketches by day; whether their ranks, counted exactly, are within the stated error."""
    events = I.timed_events(spark, sf).withColumn("day", F.floor(F.col("time_us") / F.lit(86_400_000_000)))
    daily = staged(metrics.quantile_sketches(events, "value", ("event_type", "day")), "sketches")
    found = staged(metrics.sketched_percentiles(daily, (1, 50, 99), ("event_type",)), "percentiles")
    value = F.col("value").cast("double")
    ranks = [F.count_if(value < F.col(f"p{p}")).alias(f"below{p}") for p in (1, 50, 99)] + [F.count_if(value <= F.col(f"p{p}")).alias(f"upto{p}") for p in (1, 50, 99)]
    known = events.filter(value.isNotNull() & ~F.isnan(value)).join(found, "event_type")
    counted = known.groupBy("event_type", "samples").agg(*ranks)

    def within(p: int) -> Column:
        slack = F.col("samples") * metrics.RANK_ERROR
        return ((F.col(f"below{p}") - slack <= F.col("samples") * p / 100) & (F.col(f"upto{p}") + slack >= F.col("samples") * p / 100)).alias(f"p{p}_within")

    return counted.select("event_type", "samples", *[within(p) for p in (1, 50, 99)])


@query("last_n_mean")
def _last_n_mean(spark, sf):
    return metrics.last_n_mean(
        I.timed_events(spark, sf), "value", order=("time_us", "event_id"), group=("event_type",)
    )


# --- sources and sinks -------------------------------------------------------


@query("load_posts_stored")
def _load_posts_stored(spark, sf):
    """Posts kept as a table, from the turns of conversations."""
    root = scratch_path(spark, "stored")
    I.conversation_posts(spark, sf).write.parquet(root)
    return load_posts(spark, "demo", root).select("post_id", "source", "body")


@query("union_sources")
def _union_sources(spark, sf):
    both = union_sources(parse_posts(I.messages(spark, sf), now=I.NOW), I.conversation_posts(spark, sf))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("posts"))


@query("read_union_by_name")
def _read_union_by_name(spark, sf):
    """Old files name the column ``subreddit``, new ones ``source``."""
    docs, root = I.documents(spark, sf), scratch_path(spark, "versions")
    old = F.col("lang") == "en"
    day = (F.col("doc_id") % 3).cast("int").alias("day")
    docs.filter(old).select("doc_id", F.col("source").alias("subreddit"), day).write.partitionBy("day").parquet(f"{root}/v1")
    docs.filter(~old).select("doc_id", "source", day).write.partitionBy("day").parquet(f"{root}/v2")
    return read_union_by_name(spark, f"{root}/v1", f"{root}/v2").select("doc_id", "subreddit", "source", "day")


@query("read_mentions_range")
def _read_mentions_range(spark, sf):
    """A time range of the stored table, of which only the hours in it are listed."""
    root = scratch_path(spark, "mentions")
    write_mentions(I.event_mentions(spark, sf), root, "all")
    found = read_mentions(spark, root, I.AS_OF - 5 * 86400, I.AS_OF - 86400)
    return found.select("post_id", "ticker", "created_utc", "day", "hour")


@query("mentions_with_posts")
def _mentions_with_posts(spark, sf):
    """Posts and their mentions stored in buckets by post, and joined without an exchange."""
    root = scratch_path(spark, "buckets")
    accepted = staged(accepted_posts(parse_posts(I.delivered_twice(spark, sf), now=I.NOW), now=I.NOW), "accepted")
    posts = store_buckets(accepted, f"{root}/posts")
    mentions = store_buckets(conform_mentions(explode_mentions(accepted)), f"{root}/mentions")
    joined = mentions_with_posts(mentions, posts, ("title", "tickers"))
    return joined.select("post_id", "ticker", "created_utc", "post_title", F.array_join("post_tickers", ",").alias("post_tickers"))


@query("compact_partitions")
def _compact_partitions(spark, sf):
    """Three batches, merged hour by hour: the same rows in one folder an hour."""
    root, mentions = scratch_path(spark, "mentions"), I.event_mentions(spark, sf)
    batch = F.pmod(F.xxhash64("post_id"), F.lit(3))
    for number in range(3):
        write_mentions(mentions.filter(batch == number), root, number)
    compact_partitions(spark, root, "mentions", I.AS_OF - 40 * 86400, I.AS_OF + 40 * 86400)
    hours = read_mentions(spark, root).groupBy("year", "month", "day", "hour")
    return hours.agg(F.count(F.lit(1)).alias("mentions"), F.countDistinct("batch_id").alias("folders"))


@query("write_posts")
def _write_posts(spark, sf):
    """Both tables written by the batch job, posts read back."""
    root = scratch_path(spark, "tables")
    run_batch(parse_posts(I.delivered_twice(spark, sf), now=I.NOW), root, 1, now=I.NOW)
    return conform_posts(read_posts(spark, root)).withColumn("tickers", F.array_join("tickers", ","))


@query("write_mentions")
def _write_mentions(spark, sf):
    root = scratch_path(spark, "tables")
    run_batch(parse_posts(I.delivered_twice(spark, sf), now=I.NOW), root, 1, now=I.NOW)
    return read_mentions(spark, root).drop("batch_id")


@query("batch_metrics")
def _batch_metrics(spark, sf):
    posts = parse_posts(I.delivered_twice(spark, sf), now=I.NOW)
    return run_batch(posts, scratch_path(spark, "tables"), 1, elapsed_s=60.0, now=I.NOW).metrics


@query("write_stats")
def _write_stats(spark, sf):
    """Row counts of the written batch, and whether its listed files hold exactly these rows."""
    root = scratch_path(spark, "tables")
    stats = run_batch(parse_posts(I.delivered_twice(spark, sf), now=I.NOW), root, 1, now=I.NOW).stats
    listed = stored_files(spark, f"{root}/posts").agg(F.sum("bytes").alias("bytes"), F.count("key").alias("keys"))
    return listed.select(
        F.lit(stats.num_posts).cast("long").alias("num_posts"),
        F.lit(stats.num_mentions).cast("long").alias("num_mentions"),
        (F.col("bytes") == stats.posts_bytes).alias("bytes_match"),
        (F.col("keys") == stats.posts_files).alias("keys_match"),
    )


@query("mentioned_tickers")
def _mentioned_tickers(spark, sf):
    """Messages to report without a table in between: parse, filter, dedup, score, extract, gate."""
    posts = accepted_posts(parse_posts(I.delivered_twice(spark, sf), now=I.NOW), now=I.NOW)
    return analytics.top_mentions(conform_mentions(explode_mentions(posts)))


# --- patterns of posting ------------------------------------------------------


@query("copied_texts")
def _copied_texts(spark, sf):
    return copied_texts(I.table(spark, sf, "documents"), text="text", post_id="doc_id")


@query("near_copied_texts")
def _near_copied_texts(spark, sf):
    return near_copied_texts(I.table(spark, sf, "documents"), text="text", post_id="doc_id")


@query("mention_spikes")
def _mention_spikes(spark, sf):
    mentions = I.event_mentions(spark, sf)
    return mention_spikes(mentions, time_us=X.epoch_micros("created_utc"))


@query("bursty_accounts")
def _bursty_accounts(spark, sf):
    return bursty_accounts(I.timed_events(spark, sf), account="event_type")


@query("stream_bursty_accounts")
def _stream_bursty_accounts(spark, sf):
    """The bursts a stream emits, after a post at the end of time that closes all sessions."""
    events, root = I.timed_events(spark, sf).select("event_type", "time_us"), scratch_path(spark, "bursts")
    files = splits_of(I.table(spark, sf, "events"))  # one trigger has them all
    events.repartition(files).write.parquet(f"{root}/in/1")
    last = events.agg(F.max("time_us") + 10 * 86_400_000_000)
    last.select(F.lit("end").alias("event_type"), F.col(last.columns[0]).alias("time_us")).write.parquet(f"{root}/in/2")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in/*")
    return _drain(bursty_accounts_stream(stream, account="event_type"), "bursts")


# --- streams, drained to the end ---------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = I.table(spark, sf, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return files.withColumn("time_us", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


def _drain(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream to the end of its input into Parquet files and read them."""
    spark, root = stream.sparkSession, scratch_path(stream.sparkSession, label)
    running = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query("stream_dedup_ttl")
def _stream_dedup_ttl(spark, sf):
    """Three triggers in order of time, and then every event once more, shuffled: none of these stays."""
    events, root = I.timed_events(spark, sf).select("event_id", "user_id", "time_us"), scratch_path(spark, "dedup")
    first, last = events.agg(F.min("time_us"), F.max("time_us")).first()
    third = F.floor((F.col("time_us") - first) * 3 / F.lit(last - first + 1))
    for part in range(3):  # written one after the other: a stream reads older files first
        events.filter(third == part).coalesce(1).write.parquet(f"{root}/in/{part}")
    events.repartition(2, "event_id").write.parquet(f"{root}/in/3")
    for name, files in (("{0,1,2}", 1), ("3", 2)):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in/{name}")
        options = {"order": ("event_id",), "first_batch": 100 * files}
        dedup_ttl_stream(stream, f"{root}/out", f"{root}/checkpoint-{files}", "user_id", **options).awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/out/rows").drop("batch_id")


@query("stream_dedup_watermark")
def _stream_dedup_watermark(spark, sf):
    """Each id comes twice; one copy stays."""
    twice = _event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return _drain(dedup_watermark(twice, "event_id"), "watermark").select("event_id", "time_us")


def _mentions_of(events: DataFrame) -> DataFrame:
    position = (F.col("user_id") % len(V.TICKERS)).cast("int")
    return events.select(
        F.get(F.array(*[F.lit(t) for t in V.TICKERS]), position).alias("ticker"),
        (F.least(F.col("value"), F.lit(100.0)) / 50 - 1).alias("sentiment_compound"),
        (F.col("time_us") / F.lit(1e6)).alias("created_utc"),
    )


@query("stream_sliding_signals")
def _stream_sliding_signals(spark, sf):
    return _all_windows(spark, sf, 3600, 900)


@query("stream_tumbling_signals")
def _stream_tumbling_signals(spark, sf):
    return _all_windows(spark, sf, 3600, None)


def _all_windows(spark, sf, window: int, slide: int | None) -> DataFrame:
    """The windows the stream emits, and those that are open when it ends."""
    emitted = _drain(sliding_signals(_mentions_of(_event_stream(spark, sf)), window, slide), "windows")
    return emitted.unionByName(open_windows(_mentions_of(I.timed_events(spark, sf)), emitted, window, slide))


@query("stream_late_rows")
def _stream_late_rows(spark, sf):
    """The second half of the events first, without and then with the newest, and the first half last: sums of windows
    that were closed by then are dropped, and counted. (Spark drops what the watermark of the trigger before rules out.)"""
    events, root = I.timed_events(spark, sf), scratch_path(spark, "late")
    middle, newest = events.agg(F.expr("CAST((min(time_us) + max(time_us)) / 2 AS LONG)"), F.max("time_us")).first()
    time = F.col("time_us")
    for part, rows in enumerate(((time > middle) & (time < newest), time == newest, time <= middle)):
        events.filter(rows).coalesce(1).write.parquet(f"{root}/in/{part}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    counter = counted_progress(spark)
    signals = sliding_signals(_mentions_of(stream), 3600)
    running = signals.writeStream.format("noop").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()
    running.awaitTermination()
    found = store_progress(spark, counter.of(running), f"{root}/progress")
    spark.streams.removeListener(counter)
    return found.select("input_rows", "late_rows")


@query("stream_state_size")
def _stream_state_size(spark, sf):
    """Five triggers in order of time; the ids since the window before the middle of the last one stay, older ones are removed."""
    events, root = I.timed_events(spark, sf).select("event_id", "user_id", "time_us"), scratch_path(spark, "state")
    first, last = events.agg(F.min("time_us"), F.max("time_us")).first()
    fifth = F.floor((F.col("time_us") - first) * 5 / F.lit(last - first + 1))
    for part in range(5):
        events.filter(fifth == part).coalesce(1).write.parquet(f"{root}/in/{part}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    day = 86_400_000_000
    options = {"order": ("event_id",), "window_us": day, "keep_us": 0, "bucket_us": day}
    dedup_ttl_stream(stream, f"{root}/out", f"{root}/c", "user_id", **options).awaitTermination()
    ids = KeptIds(spark, f"{root}/out/kept", "user_id", window_us=day, bucket_us=day)
    return ids.stored().agg(F.count(F.lit(1)).alias("stored_ids")).withColumn("open_ids", F.lit(ids.size(last)).cast("long"))


@query("run_stream")
def _run_stream(spark, sf):
    """The continuous job over message files in several triggers, drained; same rows as the batch job."""
    return read_mentions(spark, _streamed(spark, sf)).drop("batch_id", "processed_at")


@query("stream_batch_metrics")
def _stream_batch_metrics(spark, sf):
    """Counters of all micro-batches; ingested = duplicates + invalid + processed."""
    totals = stream_metrics(spark, _streamed(spark, sf))
    return totals.select("ingested", "duplicates", "invalid", "processed", "mentions")


def _streamed(spark, sf):
    root = scratch_path(spark, "stream")
    # First deliveries in shuffled files, then the second ones: three triggers, of which the second has some of both. A file is
    # a part of the input that one task can write.
    files = -(-splits_of(I.table(spark, sf, "documents")) // 3)
    I.messages(spark, sf).repartition(3 * files).write.text(f"{root}/in/1")
    I.messages(spark, sf, delay_us=10_000_000).repartition(2 * files).write.text(f"{root}/in/2")
    posts = parse_posts(read_envelopes_stream(spark, f"{root}/in/*", 2 * files), now=I.NOW)
    run_stream(posts, f"{root}/tables", f"{root}/checkpoint", available_now=True).awaitTermination()
    return f"{root}/tables"
