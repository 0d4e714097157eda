"""Scans of the stored posts and mentions tables."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cashtide.operators.filters import time_range_filter
from cashtide.schemas import BATCH_COLUMN, MENTION, POST, with_partition_fields

TABLES = {"posts": POST, "mentions": MENTION}


#: Ranges up to this many days are read by naming their folders; a longer one lists the table.
NAMED_DAYS = 1000


def read_table(spark: SparkSession, root: str, table: str, since: float | None = None, until: float | None = None) -> DataFrame:
    """A stored table with its partition columns (an explicit schema: no inference, no footers).

    With a range of event times (epoch seconds, both ends included) only the folders of its hours
    are listed, so the cost of planning follows the range and not the age of the table.
    """
    schema = with_partition_fields(TABLES[table])
    base = f"{root.rstrip('/')}/{table}"
    if since is None:
        df = spark.read.schema(schema).parquet(base)
        return df if until is None else df.filter(F.col("created_utc") <= until)
    if until is None or until - since > NAMED_DAYS * 86400:
        df = spark.read.schema(schema).parquet(base).filter(time_range_filter(since, until))
        return df
    folders = hour_folders(spark, root, table, since, until)
    if not folders:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", base).parquet(*folders)
    return df.filter(F.col("created_utc").between(since, until))


def hour_folders(spark: SparkSession, root: str, table: str, since: float, until: float, batch: str | None = None) -> list[str]:
    """The hours of a range that exist, or the folders of one batch in them."""
    start, end = (datetime.fromtimestamp(t, timezone.utc) for t in (since, until))
    days = (start.date() + timedelta(days=n) for n in range((end.date() - start.date()).days + 1))
    below = "/hour=*" if batch is None else f"/hour=*/{BATCH_COLUMN}={batch}"
    found = existing_folders(spark, [f"{root.rstrip('/')}/{table}/year={d:%Y}/month={d:%m}/day={d:%d}{below}" for d in days])
    hour = lambda folder: "".join(re.findall(r"/(?:year|month|day|hour)=(\d+)", folder)[-4:])
    return [f for f in found if f"{start:%Y%m%d%H}" <= hour(f) <= f"{end:%Y%m%d%H}"]


def read_posts(spark: SparkSession, root: str, since: float | None = None, until: float | None = None) -> DataFrame:
    return read_table(spark, root, "posts", since, until)


def read_mentions(spark: SparkSession, root: str, since: float | None = None, until: float | None = None) -> DataFrame:
    return read_table(spark, root, "mentions", since, until)


def read_union_by_name(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    """Tables of several schema versions, one path each, matched by column name; missing columns are NULL.

    Partition columns stay columns and prune folders. With ``schema``, the union of the versions,
    no file has to be opened to plan the scan. Without it Spark merges the footers of all files,
    which is only advisable for small tables.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [reader.parquet(path) for path in paths])


def existing_folders(spark: SparkSession, patterns: list[str]) -> list[str]:
    """The folders that match; names only, nothing below them is listed."""
    found = []
    for pattern in patterns:
        place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        matches = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
        found += [status.getPath().toString() for status in matches or []]
    return found


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Use all cores for costly work on a scan that has fewer partitions than the cluster has cores.

    Such a scan is small by definition (at most one split per core), so the exchange is too. A
    larger scan is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def splits_of(df: DataFrame) -> int:
    """The tasks of a scan: a number of files that grows with the input."""
    return max(1, df.rdd.getNumPartitions())


def stored_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(key, bytes) of the Parquet files below ``paths``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(list(paths))
        .select(F.col("path").alias("key"), F.col("length").alias("bytes"))
    )
