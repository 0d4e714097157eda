"""Rolling per-ticker sentiment and mention windows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cashtide.functions.common import stable_round
from cashtide.functions.text import epoch_micros
from cashtide.operators.filters import time_range_filter
from cashtide.resources.vocabulary import SIGNAL_WINDOWS

# Fixed-point units per 1.0, and the type that holds their sums over any number of rows.
FIXED_POINT = 1e10
_EXACT = "decimal(38,0)"


def _since(as_of: float, seconds: int, created: str, partitioned: bool = False) -> Column:
    return time_range_filter(float(as_of - seconds), created=created, partitioned=partitioned)


def ticker_signals(
    mentions: DataFrame,
    as_of: float,
    tickers: DataFrame | None = None,
    windows: Mapping[str, int] = SIGNAL_WINDOWS,
    compound: str = "sentiment_compound",
    created: str = "created_utc",
    partitioned: bool = False,
) -> DataFrame:
    """Mean sentiment and mention count per ticker for every trailing window at ``as_of``.

    The lower bound is inclusive and there is no upper bound. All windows come from one
    aggregation, combined in the map tasks before its shuffle. Tickers without a mention in the
    largest window are absent; pass ``tickers`` (column ``ticker``) to list them with NULL and 0.
    ``partitioned`` prunes the stored table's hour folders to the largest window.
    """
    aggregates = []
    for label, seconds in windows.items():
        inside = F.when(_since(as_of, seconds, created), F.col(compound))
        aggregates.append(stable_round(F.avg(inside), 4).alias(f"sentiment_{label}"))
        aggregates.append(F.count(inside).alias(f"mentions_{label}"))
    recent = mentions.filter(_since(as_of, max(windows.values()), created, partitioned))
    signals = recent.groupBy("ticker").agg(*aggregates)
    if tickers is None:
        return signals
    listed = tickers.select("ticker").distinct().join(signals, "ticker", "left")
    return listed.fillna(0, subset=[f"mentions_{label}" for label in windows])


def top_tickers(
    mentions: DataFrame,
    as_of: float,
    window: str = "1h",
    n: int = 10,
    compound: str = "sentiment_compound",
    created: str = "created_utc",
    partitioned: bool = False,
) -> DataFrame:
    """The ``n`` most mentioned tickers of the window; ties go to the one seen first."""
    return (
        mentions.filter(_since(as_of, SIGNAL_WINDOWS[window], created, partitioned))
        .groupBy("ticker")
        .agg(
            F.count(F.lit(1)).alias("mentions"),
            stable_round(F.avg(compound), 4).alias("avg_sentiment"),
            F.min(created).alias("_first"),
        )
        .orderBy(F.desc("mentions"), "_first", "ticker")
        .limit(n)
        .drop("_first")
    )


def rolling_signals(
    mentions: DataFrame,
    windows: Mapping[str, int] = SIGNAL_WINDOWS,
    compound: str = "sentiment_compound",
    created: str = "created_utc",
    slot_seconds: int = 300,
) -> DataFrame:
    """Every mention with the trailing windows ending at its own time (peers included).

    There are few tickers, and one may hold most mentions, so a window per ticker would leave most
    of a cluster idle. A trailing window is put together from three additive parts instead:

    * the mention's own time slot up to its time,
    * whole slots, from a table of one row per ticker and slot,
    * the end of the slot where the window starts. A mention is copied to the slot one window
      later, where it counts for rows whose shifted start it reaches.

    The rows are therefore partitioned by ticker *and* slot, and every window must be a multiple
    of ``slot_seconds``. Mentions of one ticker and time are summed first, in the map tasks, so a
    burst is a single row there. Sums are decimals in fixed point (ten places): adding and taking
    away is exact in any order and cannot overflow. Mentions without a ticker are a ticker of their
    own; without a time they have NULL in all windows.
    """
    if any(seconds % slot_seconds for seconds in windows.values()):
        raise ValueError("each window must be a multiple of slot_seconds")
    slot_us = slot_seconds * 1_000_000
    slot = F.floor(F.col("_at") / F.lit(slot_us)).cast("long")
    units = F.round(F.col(compound).cast("double") * F.lit(FIXED_POINT)).cast(_EXACT)
    # Peers share their windows, so one row per ticker and time is enough, however many mentions it has.
    points = (
        mentions.select("ticker", epoch_micros(created).alias("_at"), units.alias("_units"))
        .filter(F.col("_at").isNotNull())
        .groupBy("ticker", "_at")
        .agg(F.coalesce(F.sum("_units"), F.lit(0)).cast(_EXACT).alias("_sum"), F.count("_units").alias("_n"))
        .withColumn("_slot", slot)
    )
    whole = _whole_slots(points.select("ticker", "_slot", "_sum", "_n"), windows, slot_seconds)

    # The point itself and one copy per window.
    parts = points.withColumn("_shift", _shifts({k: v * 1_000_000 for k, v in windows.items()})).select(
        "ticker", (F.col("_at") + F.col("_shift.by")).alias("_at"), "_sum", "_n", F.col("_shift.part").alias("_part")
    )
    parts = parts.withColumn("_slot", slot)
    cell = Window.partitionBy("ticker", "_slot").orderBy("_at")
    until_now = cell.rangeBetween(Window.unboundedPreceding, 0)
    before_now = cell.rangeBetween(Window.unboundedPreceding, -1)
    everything = cell.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def total(part: str, column: str, frame: WindowSpec) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_part") == part, F.col(column))).over(frame), F.lit(0)).cast(_EXACT)

    pieces = {"_own_sum": total("own", "_sum", until_now), "_own_n": total("own", "_n", until_now)}
    for label in windows:
        pieces[f"_edge_sum_{label}"] = total(label, "_sum", everything) - total(label, "_sum", before_now)
        pieces[f"_edge_n_{label}"] = total(label, "_n", everything) - total(label, "_n", before_now)
    rows = parts.select("*", *[c.alias(k) for k, c in pieces.items()]).filter(F.col("_part") == "own")
    same_slot = rows["ticker"].eqNullSafe(whole["_t"]) & (rows["_slot"] == whole["_s"])
    joined = rows.join(whole, same_slot)

    result = []
    for label in windows:
        number = F.col("_own_n") + F.col(f"_edge_n_{label}") + F.col(f"_full_n_{label}")
        units_sum = F.col("_own_sum") + F.col(f"_edge_sum_{label}") + F.col(f"_full_sum_{label}")
        mean = units_sum.cast("double") / F.lit(FIXED_POINT) / number.cast("double")
        result += [
            stable_round(F.when(number > 0, mean), 4).alias(f"sentiment_{label}"),
            number.cast("long").alias(f"mentions_{label}"),
        ]
    at_points = joined.select(F.col("ticker").alias("_t"), F.col("_at").alias("_p"), *result)
    same_point = F.col("ticker").eqNullSafe(F.col("_t")) & (F.col("_time") == F.col("_p"))
    timed = mentions.withColumn("_time", epoch_micros(created))
    return timed.join(at_points, same_point, "left").drop("_t", "_p", "_time")


def _shifts(distances: Mapping[str, int]) -> Column:
    """One row in place (``own``, 0) and one per window, moved by its length."""
    steps = {"own": 0, **distances}
    return F.explode(
        F.array(*[F.struct(F.lit(k).alias("part"), F.lit(v).cast("long").alias("by")) for k, v in steps.items()])
    )


def _whole_slots(points: DataFrame, windows: Mapping[str, int], slot_seconds: int) -> DataFrame:
    """Per ticker and slot: sum and count of the slots strictly inside each window.

    A slot enters every running total at its own time and leaves a window's total one window
    later. A ticker has one row per slot and window here, however many mentions it has.
    """
    slots = points.groupBy("ticker", "_slot").agg(F.sum("_sum").cast(_EXACT).alias("_sum"), F.sum("_n").alias("_n"))
    moves = slots.withColumn("_shift", _shifts({k: v // slot_seconds for k, v in windows.items()})).select(
        "ticker", (F.col("_slot") + F.col("_shift.by")).alias("_slot"), "_sum", "_n", F.col("_shift.part").alias("_part")
    )
    running = Window.partitionBy("ticker").orderBy("_slot").rangeBetween(Window.unboundedPreceding, 0)

    def net(column: str, label: str) -> Column:
        signed = F.when(F.col("_part") == "own", F.col(column)).when(F.col("_part") == label, -F.col(column))
        return F.sum(signed).over(running) - F.col(column)

    totals = {}
    for label in windows:
        totals[f"_full_sum_{label}"] = net("_sum", label).cast(_EXACT)
        totals[f"_full_n_{label}"] = net("_n", label)
    named = moves.select(F.col("ticker").alias("_t"), F.col("_slot").alias("_s"), "_part", *[c.alias(k) for k, c in totals.items()])
    return named.filter(F.col("_part") == "own").drop("_part")
