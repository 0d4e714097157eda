import math
import random
from hashlib import sha256

import numpy as np
import pytest

from cashtide.llm.lloyd import bucketed, cluster, column_blocks, partial_distances, updated, whole_vectors, with_inertia

SCHEMA = "vec_id long, embedding array<float>, label int, block int, shard int, cluster string"


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0, 1, 2, "x") for i, v in rows], SCHEMA)


def plain_lloyd(rows, k, rounds, dims, scale):
    kept = []
    for i, v in rows:
        if i is None or v is None or len(v) != dims or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    start = sorted(kept, key=lambda r: (sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in start[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            own = [v for (_, v), o in zip(kept, of, strict=True) if o == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return centroids, sorted((i, near(v)[1], near(v)[0]) for i, v in kept)


def rows_of(found):
    return found.centroids.tolist(), sorted(tuple(r) for r in found.assigned.collect())


@pytest.mark.parametrize("shard_dims, block_rows", [(3, 7), (32, 4096)])
def test_equals_plain_lloyd(vectors, shard_dims, block_rows):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(8)]) for i in range(120)]
    got = cluster(vectors(rows), k=4, rounds=5, dims=8, scale=64, shard_dims=shard_dims, block_rows=block_rows)
    assert rows_of(got) == plain_lloyd(rows, 4, 5, 8, 64)


def test_vectors_that_take_no_part_and_repeats(vectors):
    good = [(1, [0.5, -0.5]), (1, [0.5, -0.5]), (2, [4.0, -7.25]), (3, [-3.0, 2.0]), (2, [9.0, 9.0])]
    odd = [(None, [1.0, 1.0]), (5, None), (6, [1.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 2.0, 3.0])]
    got = cluster(vectors(good + odd), k=3, rounds=3, dims=2, scale=4)
    assert rows_of(got) == plain_lloyd(good + odd, 3, 3, 2, 4) and got.assigned.count() == 5


def test_one_vector_on_most_rows(vectors):
    rows = [(i, [1.0, 1.0] if i % 3 else [float(i), 0.0]) for i in range(300)]
    got = cluster(vectors(rows), k=5, rounds=4, dims=2, scale=2, block_rows=16)
    assert rows_of(got) == plain_lloyd(rows, 5, 4, 2, 2)


def test_fewer_vectors_than_centroids_and_none(vectors):
    got = cluster(vectors([(4, [1.0, 2.0])]), dims=2)
    assert rows_of(got) == ([[1024, 2048]], [(4, 0, 0)])
    assert with_inertia(got).first().asDict() == {
        "vec_id": 4, "cluster": 0, "distance": 0, "cluster_inertia": 0, "inertia": 0, "centroid_sha256": sha256(b"1024,2048").hexdigest()
    }
    assert with_inertia(cluster(vectors([]), dims=2)).count() == 0


def test_too_large_components_are_an_error(vectors):
    with pytest.raises(Exception, match="too large"):
        cluster(vectors([(1, [1e30, 0.0]), (2, [0.0, 0.0])]), k=1, dims=2)


def test_distances_are_exact_beyond_doubles():
    rows = np.array([[2**30 - 1, 1], [-(2**30), 3]], np.int64)
    centroids = np.array([[-(2**30) + 1, 0]], np.int64)
    assert partial_distances(rows, centroids).tolist() == [[(2**31 - 2) ** 2 + 1], [1 + 9]]


def test_column_blocks_stay_where_they_are(spark, vectors):
    """In a round only partial distances and labels are exchanged."""
    kept = whole_vectors(vectors([(i, [float(i)] * 4) for i in range(50)]), 4, 2, "vec_id", "embedding")
    name = bucketed(spark, column_blocks(kept, 4, 2, 8))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = updated(spark.table(name), np.zeros((1, 4), np.int64), 2, 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")
    assert "SortMergeJoin" in plan
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanged) == 3 and not any("columns" in line for line in exchanged)
