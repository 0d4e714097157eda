"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Every source is a queue of its documents in a shuffled order that depends on the ids alone, repeated up to
``max_repeats`` times. A copy finishes at the virtual time "words of its source up to and with this copy, divided
by the source's target". All copies are put in order of their finish times, range by range: the queues are served
at their weights, so equal ranges of virtual time hold about equally many words. The queue is cut at the total
budget, which is virtual time 1; of the copy a source is serving at that moment, the words before the cut count.

Running totals come in two levels (totals of ranges, then rows within a range), so a source or a moment with a
third of all rows is spread over tasks.

Defined cases: a null text has size 0. A null source is a source of its own, after all others. Repeated rows are
documents of their own; rows with equal ids and sizes may swap places, which changes no result. Without any
words all targets and takes are 0. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashtide.llm.common import WORD
from cashtide.session import staged

#: Documents that share one range of the shuffled order, and words that share one range of virtual time.
RANGE_ROWS, MAX_RANGES = 5_000, 1 << 20


def word_count(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_repeats: int = 3) -> DataFrame:
    """``source, weight, source_size, target``, one row a source (the table of weights, a configuration's size).

    Sources in code point order weigh 1, 2, 3, repeating. A source stops at ``max_repeats`` times its size: the
    sources are taken by rising size per weight, and all below the level that the rest can share stop there.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    by_level = Window.orderBy((F.col("source_size") * 6 / F.col("weight")).cast("double"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - max_repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = weighed.select(
        "*", left.alias("left"), weight_left.alias("weight_left"), F.row_number().over(by_level).alias("place")
    ).withColumn("full", max_repeats * F.col("source_size") * F.col("weight_left") <= F.col("left") * F.col("weight"))
    # The first source that does not fill up sets the level of all that follow.
    first = F.min(F.when(~F.col("full"), F.struct("place", "left", "weight_left"))).over(everything)
    level = ranked.withColumn("first", first)
    shared = (F.col("first.left") * F.col("weight")).cast("double") / F.col("first.weight_left")
    target = F.when(F.col("first").isNull() | (F.col("place") < F.col("first.place")), (max_repeats * F.col("source_size")).cast("double"))
    return level.select("source", "weight", "source_size", target.otherwise(shared).alias("target"))


def _running(df: DataFrame, group: list[str], order: list[Column | str], amount: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``amount`` over all earlier rows of the same ``group`` but its last column,
    a range number. Ranges are summed first, so a window never holds more than one range, or one row a range."""
    totals = df.groupBy(*group).agg(F.sum(amount).alias("_total"))
    outer = Window.partitionBy(*group[:-1]) if len(group) > 1 else Window.partitionBy(F.lit(0))
    earlier = outer.orderBy(group[-1]).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*(F.col(g).alias(f"_{g}") for g in group), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    inner = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = df.withColumn("_here", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    return here.join(base, same, "left").withColumn("before", F.col("_base") + F.col("_here")).drop(
        "_base", "_here", *(f"_{g}" for g in group)
    )


def served_copies(
    docs: DataFrame,
    max_repeats: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Copies in the order they are served: ``row, doc_id, source, size, source_size, target, copy, finish,
    position, taken``.

    ``row`` numbers the documents, ``finish`` is the virtual finish time, ``position`` the words of the mix before the
    copy, in the order of finish times. First copies at or after the total budget have ``taken`` 0, further ones are left
    out; of a copy that the cut runs through ``taken < size``. Columns in ``extra`` come along. Sizes are staged, so the call is eager up to there.
    """
    sizes = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(text_column).alias("size"),
        *extra,
    )
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # The texts are read once; everything below works on these narrow columns.
    sizes = staged(sizes.withColumn("shuffled", digest).withColumn("row", F.monotonically_increasing_id()), "sizes")
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(1, min(MAX_RANGES, rows // RANGE_ROWS))
    targets = source_targets(sizes, max_repeats).withColumnRenamed("source", "_source")
    # md5 is even over its first five digits, so equal shares of them hold about equally many documents.
    place = F.conv(F.substring("shuffled", 1, 5), 16, 10).cast("long")
    queued = _running(
        sizes.withColumn("range", F.shiftright(place * ranges, 20)), ["source", "range"], ["shuffled", "doc_id", "size", "row"], "size"
    )
    queued = queued.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source", "weight", "shuffled", "range")

    start = lambda copy: copy * F.col("source_size") + F.col("before")
    served = lambda copy: F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - start(copy))).cast("long")
    # The first copy of every document, and further ones that are served.
    numbers = F.filter(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda c: (c == 0) | (served(c) > 0))
    copies = queued.withColumn("copy", F.explode(numbers))
    ends = (start(F.col("copy")) + F.col("size")).cast("double")
    finish = F.when(F.col("target") > 0, ends / F.col("target")).otherwise(F.lit(0.0))
    copies = copies.select("*", finish.alias("finish"), served(F.col("copy")).alias("served")).drop("before")

    # Range sort by finish time, then the cut at the total budget. Copies that are not served come after all others, in
    # any order, spread evenly.
    slots = ranges * max_repeats
    slot = F.when(F.col("served") > 0, F.least(F.lit(slots), F.floor(F.col("finish") * slots))).otherwise(
        slots + 1 + F.pmod(F.xxhash64("row"), F.lit(ranges))
    )
    order = ["finish", F.col("source").asc_nulls_last(), "copy", "row"]
    ordered = _running(copies.withColumn("slot", slot), ["slot"], order, "served").withColumnRenamed("before", "position")
    inside = F.greatest(F.lit(0), F.least(F.col("served"), F.lit(total) - F.col("position")))
    return ordered.withColumn("taken", inside.cast("long")).drop("slot", "served")


def mix_sources(
    docs: DataFrame, max_repeats: int = 3, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source"
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every document, taken or not.

    ``taken`` counts the words of all its copies in the mix, ``copies`` the copies that are in it as whole.
    """
    served = served_copies(docs, max_repeats, id_column, text_column, source_column)
    same = [F.min(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    whole = F.sum(F.when(F.col("size") == 0, F.lit(max_repeats)).otherwise((F.col("taken") == F.col("size")).cast("int"))).alias("copies")
    return served.groupBy("row").agg(*same, F.sum("taken").alias("taken"), whole).drop("row")


def mixed_documents(
    docs: DataFrame, max_repeats: int = 3, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source"
) -> DataFrame:
    """The mix itself: ``docs`` with each document as often as it is in the mix, all columns.

    Only whole documents: a copy that the cut runs through is in if half of its words are. Documents of size 0 stay
    once. Rows that agree in id, source and text stand for each other.
    """
    source, key = F.col(source_column).cast("string"), F.xxhash64(F.col(text_column).cast("string"))
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_column).cast("long").alias("_id"), source.alias("_source"), key.alias("_key"))
    wide = docs.select(F.col(id_column).alias("doc_id"), source.alias("source"), F.col(text_column).alias("text"), key.alias("key"))
    served = served_copies(wide, max_repeats, extra=("key",))
    inside = F.when(F.col("size") == 0, F.col("copy") == 0).otherwise(2 * F.col("taken") >= F.col("size"))
    by_text = served.groupBy("doc_id", "source", "key").agg(F.sum(inside.cast("int")).alias("copies"), F.countDistinct("row").alias("rows"))
    by_text = staged(by_text.withColumnRenamed("rows", "_rows"), "copies").filter("copies > 0")
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_source").eqNullSafe(F.col("source")) & (F.col("_key") == F.col("key"))
    kept = keyed.join(by_text, same)
    if not by_text.filter("_rows > 1").isEmpty():
        kept = kept.filter("_rows = 1").unionAll(kept.filter("_rows > 1").dropDuplicates(["_id", "_source", "_key"]))
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
