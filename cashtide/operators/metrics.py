"""Counters and rates of a run, and the small percentile and mean reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashtide.functions.common import stable_round
from cashtide.functions.relevance import is_financial
from cashtide.functions.text import epoch_micros

# Outcomes of an ingested post.
DUPLICATE, INVALID, PROCESSED = "duplicate", "invalid", "processed"
# How many recent samples the latency figures look at.
RECENT_PROCESSING, RECENT_WRITES = 200, 50
# Size of quantile sketches (about 45 KB for a million values), and a bound of their rank error far above the 0.2 % of 99 cases in 100.
SKETCH_K, RANK_ERROR = 2000, 0.005


def _rate(part: Column, whole: Column, places: int) -> Column:
    return stable_round(part / F.greatest(F.lit(1), whole), places)


def pipeline_metrics(outcomes: DataFrame, elapsed_s: float, outcome: str = "outcome") -> DataFrame:
    """One row of run counters from one row per post (``outcome``) or per outcome (``outcome, n``)."""
    weight = F.col("n") if "n" in outcomes.columns else F.lit(1)
    counted = lambda kind: F.coalesce(
        F.sum(F.when(F.col(outcome) == kind, weight)), F.lit(0)
    ).cast("long")
    counts = outcomes.agg(
        F.coalesce(F.sum(weight), F.lit(0)).cast("long").alias("ingested"),
        counted(DUPLICATE).alias("duplicates"),
        counted(INVALID).alias("invalid"),
        counted(PROCESSED).alias("processed"),
    )
    elapsed = F.lit(float(elapsed_s))
    return counts.select(
        F.round(elapsed, 1).alias("elapsed_s"),
        "ingested",
        "duplicates",
        "invalid",
        "processed",
        F.col("processed").alias("written"),
        stable_round(F.col("processed") / F.greatest(F.lit(1.0), elapsed) * 60, 1).alias("throughput_per_min"),
        _rate(F.col("processed"), F.col("ingested") - F.col("duplicates"), 3).alias("quality_pass_rate"),
    )


def outcome_counts(ingested: int, kept: int, processed: int) -> list[tuple[str, int]]:
    """Rows (outcome, n) from the observed row counts of the three stages."""
    return [(DUPLICATE, ingested - kept), (INVALID, kept - processed), (PROCESSED, processed)]


def funnel_metrics(
    posts: DataFrame, as_of: float, elapsed_s: float, in_order: str | None = None, body: str = "body"
) -> DataFrame:
    """Ingestion counters of parsed posts in one aggregation.

    ``in_order`` names a boolean column that is false for rows the order filter drops. ``idle_s``
    is the time since the last post was fetched, ``event_lag_s`` the age of the newest event.
    """
    ordered = F.coalesce(F.col(in_order), F.lit(False)) if in_order else F.lit(True)
    tagged = posts.select(
        ordered.alias("ordered"),
        F.when(ordered, is_financial(body)).alias("financial"),
        epoch_micros("created_utc").alias("event_us"),
        epoch_micros("fetched_at").alias("fetched_us"),
    )
    counts = tagged.agg(
        F.count_if("ordered").alias("received_total"),
        F.count_if("financial").alias("forwarded"),
        F.count_if(~F.col("financial")).alias("dropped_non_financial"),
        F.count_if(~F.col("ordered")).alias("dropped_out_of_order"),
        F.max(F.when(F.col("ordered"), F.col("event_us"))).alias("_event_us"),
        F.max(F.when(F.col("ordered"), F.col("fetched_us"))).alias("_fetched_us"),
    )
    now_us = F.lit(round(as_of * 1e6))
    received = F.col("received_total")
    return counts.select(
        "received_total",
        "forwarded",
        "dropped_non_financial",
        "dropped_out_of_order",
        stable_round(received / F.greatest(F.lit(1.0), F.lit(float(elapsed_s))), 2).alias("events_per_sec"),
        _rate(F.col("forwarded"), received, 4).alias("filter_pass_rate"),
        stable_round((now_us - F.col("_fetched_us")) / 1e6, 2).alias("idle_s"),
        stable_round((now_us - F.col("_event_us")) / 1e6, 2).alias("event_lag_s"),
    )


def _latest(df: DataFrame, order: Sequence[str], group: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows (per group) by ``order``; each map task keeps at most ``n`` of them."""
    newest = [F.desc(c) for c in order]
    if not group:
        return df.orderBy(*newest).limit(n)
    ranked = Window.partitionBy(*group).orderBy(*newest)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n).drop("_rank")


def percentile_nearest(
    df: DataFrame,
    value: str,
    percents: Sequence[int] = (50, 99),
    order: Sequence[str] = ("seq",),
    group: Sequence[str] = (),
    last_n: int = RECENT_PROCESSING,
) -> DataFrame:
    """``p<percent>`` of the last ``last_n`` values: the sorted value at ``floor(n * p / 100)``.

    The position is capped at the last value; with no values the result is 0.0. Only the recent
    samples are ever gathered, so a group's array stays small.
    """
    recent = _latest(df.filter(F.col(value).isNotNull()), order, group, last_n)
    gathered = recent.groupBy(*group).agg(F.array_sort(F.collect_list(value)).alias("_values"))
    size = F.size("_values")

    def pick(percent: int) -> Column:
        index = F.least(F.floor(size * percent / 100).cast("int"), size - 1)
        return F.coalesce(F.get("_values", index), F.lit(0.0)).alias(f"p{percent}")

    return gathered.select(*group, *[pick(p) for p in percents])


def quantile_sketches(df: DataFrame, value: str, group: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``samples`` and a mergeable ``quantiles`` sketch of all values (per group), of any number.

    Map tasks sketch what they have, so a group with a third of all rows reaches its task as a few kilobytes a map task. A table
    of sketches by a fine group (an hour, a batch) answers ``sketched_percentiles`` for any coarser one, and further
    groups are simply added. NULL and NaN count for nothing, a group without other values has no row.
    """
    number = F.col(value).cast("double")
    known = df.filter(number.isNotNull() & ~F.isnan(number))
    found = known.groupBy(*group).agg(F.count(F.lit(1)).alias("samples"), F.kll_sketch_agg_double(number, k).alias("quantiles"))
    return found.filter("samples > 0")


def sketched_percentiles(sketches: DataFrame, percents: Sequence[int] = (50, 99), group: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``samples`` and ``p<percent>`` of each ``group`` of the sketches, merged.

    The rank of a result is off by less than ``RANK_ERROR`` of the samples at the default ``k``; groups of at most ``k``
    values are exact. Which of the values within that error is returned may differ from run to run.
    """
    merged = sketches.groupBy(*group).agg(F.sum("samples").alias("samples"), F.kll_merge_agg_double("quantiles", k).alias("quantiles"))
    picked = [F.kll_sketch_get_quantile_double("quantiles", F.lit(p / 100)).alias(f"p{p}") for p in percents]
    return merged.filter("samples > 0").select(*group, "samples", *picked)


def last_n_mean(
    df: DataFrame,
    value: str,
    order: Sequence[str] = ("seq",),
    group: Sequence[str] = (),
    last_n: int = RECENT_WRITES,
    places: int = 2,
) -> DataFrame:
    """Mean of the last ``last_n`` values; 0.0 when there are none."""
    recent = _latest(df.filter(F.col(value).isNotNull()), order, group, last_n)
    mean = F.coalesce(stable_round(F.avg(value), places), F.lit(0.0))
    return recent.groupBy(*group).agg(mean.alias(f"avg_{value}"))
