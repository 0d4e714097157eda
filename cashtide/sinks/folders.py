"""Tables in folders by partition columns, written one batch at a time."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide.schemas import BATCH_COLUMN

#: Spark joins the parts of a shuffle up to this size, however many files a task then writes.
SMALLEST_PART = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def replace_batch(df: DataFrame, folder: str, columns: Sequence[str], **options: str) -> None:
    """The rows of one batch below ``columns`` and ``batch_id``, both of them columns of ``df``.

    Only the folders the batch has rows for are replaced. The rows are written beside the table first, and moved in when all
    are there: unlike Spark's own dynamic overwrite no folder is made one after the other on the driver, and nothing cached
    that reads the table is dropped. The rebalance hint lets adaptive execution merge small folders into few tasks
    and split a crowded one. Narrow rows are dealt to all cores too, since files cost more than their bytes.
    """
    spark, beside = df.sparkSession, f"{folder}/_writing-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        with _all_cores(spark):
            dealt = df.hint("rebalance", *[F.col(c) for c in columns])
            dealt.write.options(**options).partitionBy(*columns, BATCH_COLUMN).parquet(beside)
        _move_in(spark, store, beside, folder, len(columns))
    finally:
        store.delete(path(beside), True)


@contextmanager
def _all_cores(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SMALLEST_PART, None)
    spark.conf.set(SMALLEST_PART, "1b")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SMALLEST_PART)
        else:
            spark.conf.set(SMALLEST_PART, before)


def _move_in(spark: SparkSession, store, source: str, target: str, depth: int) -> None:
    """Merge ``source`` into ``target``, ``depth`` levels of folders above those of the batch.

    A folder that the table does not have is moved whole, in one step for all that is below it.
    """
    hadoop, arrays = spark._jvm.org.apache.hadoop.fs, spark._jvm.org.apache.commons.lang3.ArrayUtils
    batch: list[str] = []  # its folder has the same name everywhere

    def names(place: str) -> list[str]:
        whole = store.makeQualified(hadoop.Path(place))
        listed = arrays.toString(hadoop.FileUtil.stat2Paths(store.listStatus(whole)))  # all in one call: {path,path}
        return [name for name in f",{listed[1:-1]}".split(f",{whole.toString()}/")[1:] if "=" in name]

    def move(old: str, new: str) -> None:
        if not store.rename(hadoop.Path(old), hadoop.Path(new)):
            raise OSError(f"could not move {old} to {new}")

    def merge(source: str, target: str, depth: int) -> None:
        if not depth:
            batch[:] = batch or names(source)
            for name in batch:
                store.delete(hadoop.Path(f"{target}/{name}"), True)
                move(f"{source}/{name}", f"{target}/{name}")
            return
        there = set(names(target))
        for name in names(source):
            old, new = f"{source}/{name}", f"{target}/{name}"
            if name in there:
                merge(old, new, depth - 1)
                continue
            move(old, new)
            if store.exists(hadoop.Path(f"{new}/{name}")):  # someone else made it meanwhile: it was moved into theirs
                merge(f"{new}/{name}", new, depth - 1)
                store.delete(hadoop.Path(f"{new}/{name}"), True)

    merge(source, target, depth)
