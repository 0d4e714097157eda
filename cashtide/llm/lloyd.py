"""Centroid clustering by dimension-sharded Lloyd rounds.

Vectors become integers and are cut both ways: blocks of rows, and shards of columns. A table holds one row for each
block and shard, bucketed by both. In a round a task takes column blocks and computes their exact partial squared
distances to the slices of the centroids that belong to the shard. The partial distances of a block of rows are brought
together by its key, added, and the nearest centroid is taken. The labels, a few bytes a vector, go back to the
shards, where the column blocks have stayed (the bucketed side of the join is not exchanged); each shard sums its
columns by label and updates its own slice. The driver sees the centroids only, ``k`` times the dimensions.

All numbers are exact integers: partial distances are computed in doubles where no sum can reach 2^53, else in 64 bits.
Every round starts from the written table, so a lost executor costs tasks of one round.

Defined cases: a vector that is null, has another number of components, or a null, NaN or infinite one takes no part,
nor does a row without an id. Repeated rows and ids are vectors of their own. Ties go to the centroid with the smaller
number; equal hashes of the start are in order of the components. With fewer vectors than ``k`` there are as many
centroids as vectors. An empty centroid stays where it is. An empty table gives an empty result. Components so
large that squared distances might not fit in 64 bits are an error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import isqrt
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide.session import scratch_path, staged

#: Vectors of one block of rows, components of one shard.
BLOCK_ROWS, SHARD_DIMS = 4096, 32
#: Bytes of the table in one bucket, about.
BUCKET_BYTES = 64 << 20
#: Blocks handed to Python at once: a block may have half a megabyte.
BLOCKS_AT_ONCE = "32"


@dataclass(frozen=True)
class Clustering:
    """``centroids``: a row of integers each. ``assigned``: ``vec_id, cluster, distance`` of every vector."""

    centroids: np.ndarray
    assigned: DataFrame


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, weights``: floor(scale * x) of every component of the vectors that take part."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.coalesce((F.size("vector") == dims) & finite, F.lit(False))
    )
    limit = float(isqrt(((1 << 63) - 1) // dims) // 2)
    too_large = F.raise_error(F.lit("a component is too large for exact distances")).cast("int")
    whole = F.transform("vector", lambda x: F.when(F.abs(x * float(scale)) < limit, F.floor(x * float(scale)).cast("int")).otherwise(too_large))
    return kept.select("vec_id", whole.alias("weights"))


def column_blocks(kept: DataFrame, dims: int, shard_dims: int, block_rows: int) -> DataFrame:
    """``block, shard, ids, columns``: for each block of rows and shard of columns the numbers, row by row; the ids come with shard 0."""
    shards = range(0, dims, shard_dims)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, rows = TaskContext.get().partitionId() << 32, np.empty(0, np.int64), np.empty((0, dims), np.int32)

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal block, ids, rows
            while len(ids) >= (1 if last else block_rows):
                own, some, ids, rows = ids[:block_rows], rows[:block_rows], ids[block_rows:], rows[block_rows:]
                parts = [some[:, s : s + shard_dims].astype("<i4").tobytes() for s in shards]
                n = len(parts)
                columns = [[block] * n, range(n), [own.astype("<i8").tobytes(), *[None] * (n - 1)], parts]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["block", "shard", "ids", "columns"])
                block += 1

        for batch in batches:
            ids = np.append(ids, batch.column(0).to_numpy())
            rows = np.concatenate([rows, batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)])
            yield from blocks(False)
        yield from blocks(True)

    return kept.mapInArrow(cut, "block long, shard int, ids binary, columns binary")


def bucketed(spark: SparkSession, blocks: DataFrame) -> str:
    """The name of a table with the blocks, bucketed by block and shard in the shared folder."""
    placed = staged(blocks, "column-blocks")
    size = placed.agg(F.coalesce(F.sum(F.octet_length("columns")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    name = f"lloyd_{uuid4().hex}"
    writer = placed.repartition(buckets, "block", "shard").write.bucketBy(buckets, "block", "shard").sortBy("block", "shard")
    writer.option("path", scratch_path(spark, "lloyd")).saveAsTable(name)
    return name


def partial_distances(columns: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to slices of centroids, exact."""
    largest = max(int(np.abs(columns).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if columns.shape[1] * (2 * largest) ** 2 < 1 << 53:
        x, c = columns.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((columns - c) ** 2).sum(1) for c in centroids], axis=1)


def partials(blocks: DataFrame, centroids: np.ndarray, shard_dims: int) -> DataFrame:
    """``block, ids, partial`` of every column block: distances within its shard."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for shard, columns in zip(batch.column(1).to_pylist(), batch.column(3), strict=True):
                own = centroids[:, shard * shard_dims : (shard + 1) * shard_dims]
                numbers = np.frombuffer(columns.as_py(), "<i4").astype(np.int64).reshape(-1, own.shape[1])
                found.append(partial_distances(numbers, own).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["block", "ids", "partial"])

    return blocks.select("block", "shard", "ids", "columns").mapInArrow(compute, "block long, ids binary, partial binary")


def nearest(parts: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels and distances of one block of rows, from the partial distances of its shards."""
    total = sum(np.frombuffer(p.as_py(), "<i8") for p in parts["partial"]).reshape(-1, k)
    labels = total.argmin(1)
    return labels, total[np.arange(len(total)), labels]


def updated(blocks: DataFrame, centroids: np.ndarray, shards: int, shard_dims: int) -> DataFrame:
    """``shard, cluster, dim, value``: new components of the centroids that have vectors."""
    k = len(centroids)

    def label(parts: pa.Table) -> pa.Table:
        return pa.table({"block": parts["block"][:1], "labels": pa.array([nearest(parts, k)[0].astype("<i4").tobytes()], pa.binary())})

    labels = partials(blocks, centroids, shard_dims).groupBy("block").applyInArrow(label, "block long, labels binary")
    back = labels.select("block", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "labels")
    met = blocks.select("block", "shard", "columns").join(back, ["block", "shard"]).select("shard", "labels", "columns")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, labels, columns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                of = np.frombuffer(labels, "<i4")
                numbers = np.frombuffer(columns, "<i4").astype(np.int64).reshape(len(of), -1)
                order, found = np.argsort(of, kind="stable"), np.unique(of)
                own = np.zeros((k, numbers.shape[1]), np.int64)
                own[found] = np.add.reduceat(numbers[order], np.searchsorted(of[order], found))
                sums[shard] = sums.get(shard, 0) + own
                counts[shard] = counts.get(shard, 0) + np.bincount(of, minlength=k)
        rows = [(s, c, d, int(x), int(counts[s][c])) for s in sums for c in range(k) for d, x in enumerate(sums[s][c]) if counts[s][c]]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = {"shard": pa.int32(), "cluster": pa.int32(), "dim": pa.int32(), "total": pa.int64(), "n": pa.int64()}
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))

    summed = met.mapInArrow(add, "shard int, cluster int, dim int, total long, n long").groupBy("shard", "cluster", "dim")
    mean = summed.agg(F.sum(F.col("total").cast("decimal(30,0)")).alias("total"), F.sum("n").cast("decimal(19,0)").alias("n"))
    return mean.select("shard", "cluster", "dim", F.expr("(total - pmod(total, n)) div n").alias("value"))


def assigned(blocks: DataFrame, centroids: np.ndarray, shard_dims: int) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    k = len(centroids)

    def label(parts: pa.Table) -> pa.Table:
        labels, distances = nearest(parts, k)
        ids = next(i.as_py() for i in parts["ids"] if i.is_valid)
        return pa.table({"vec_id": np.frombuffer(ids, "<i8"), "cluster": labels.astype(np.int32), "distance": distances})

    return partials(blocks, centroids, shard_dims).groupBy("block").applyInArrow(label, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_dims: int = SHARD_DIMS,
    block_rows: int = BLOCK_ROWS,
) -> Clustering:
    """Lloyd's algorithm from the ``k`` vectors whose ids have the smallest hashes. Eager."""
    spark = vectors.sparkSession
    kept = whole_vectors(vectors, dims, scale, id_column, vector_column)
    start = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("hash"), "weights")
    first = [r["weights"] for r in start.orderBy("hash", "weights").limit(k).collect()]
    centroids = np.array(first, np.int64).reshape(-1, dims)
    if not first:
        return Clustering(centroids, spark.createDataFrame([], "vec_id long, cluster int, distance long"))
    name = bucketed(spark, column_blocks(kept, dims, shard_dims, block_rows))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BLOCKS_AT_ONCE)
        blocks, shards = spark.table(name), -(-dims // shard_dims)
        for _ in range(rounds):
            centroids = centroids.copy()
            for r in updated(blocks, centroids, shards, shard_dims).collect():  # at most k * dims rows
                centroids[r["cluster"], r["shard"] * shard_dims + r["dim"]] = r["value"]
        found = staged(assigned(blocks, centroids, shard_dims), "assigned")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return Clustering(centroids, found)


def with_inertia(found: Clustering) -> DataFrame:
    """``vec_id, cluster, distance``, with the sums of distances and a digest of the vector's centroid."""
    spark = found.assigned.sparkSession
    digests = [(i, sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(found.centroids.tolist())]
    sums = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = found.assigned.agg(F.sum("distance")).first()[0]
    names = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    about = sums.join(F.broadcast(names), "cluster").withColumn("inertia", F.lit(total).cast("long"))  # one row a centroid
    return found.assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
