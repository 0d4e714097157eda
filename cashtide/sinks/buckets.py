"""Tables in buckets by a key: joined on it, they need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def store_buckets(df: DataFrame, path: str, key: str = "post_id", buckets: int | None = None, name: str | None = None) -> DataFrame:
    """``df`` written to ``path`` as a catalog table in ``buckets`` buckets by ``key``, and read from there.

    One shuffle when it is written, with one sorted file a bucket; afterwards joins and aggregations by the key with tables
    of as many buckets have none. Choose the number so that a bucket of the largest table fits a task; the default
    is the session's number of shuffle partitions. The key should be nearly unique: all rows of a key are in one bucket. Rows
    without a key are kept, in one bucket. ``name`` is the table's in the catalog, a new one by default.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"buckets_{uuid.uuid4().hex}"
    # Spark deals rows to buckets by the hash it repartitions by, so that a task has the rows of one bucket.
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)
