import numpy as np
import pytest
from pyspark.sql import functions as F

from cashtide.llm.topk import best_places, postings, quantised, search_block, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, weights string, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, 0, "x", "y") for i, e in rows], SCHEMA)


def brute(rows, k, scale=64, every=20):
    known = []
    for i, e in rows:
        if i is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        known.append((i, [int(np.floor(scale * float(np.float32(x)))) for x in e]))
    out = []
    for place, (q, own) in enumerate(known):
        if q % every == 0:
            score = lambda v: sum(a * b for a, b in zip(own, v))
            best = sorted(((-score(w), i) for at, (i, w) in enumerate(known) if at != place))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_equals_brute_force_over_many_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.05, 6)]) for i in range(300)]
    rows[40] = (40, rows[60][1])  # ties
    rows += [(7, rows[7][1]), (9, [9.0] * 6), (20, [1.0] * 6), (40, rows[40][1])]  # repeated rows, repeated ids, also of queries
    got = top_k(quantised(vectors(spark, rows)), F.col("vec_id") % 20 == 0, k=5, query_block=6, row_block=50)
    assert found(got) == brute(rows, 5)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (5, [-1.0, 0.5]), (20, [0.0, 0.0]), (6, [])]
    got = top_k(quantised(vectors(spark, rows)), F.col("vec_id") % 20 == 0)
    assert found(got) == [(0, 1, 6, 0), (0, 2, 20, 0), (0, 3, 5, -4096), (20, 1, 0, 0), (20, 2, 5, 0), (20, 3, 6, 0)]


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    rows = [(0, [1.0]), (7, [2.0]), (7, [0.5]), (8, [1.0])]
    got = top_k(quantised(vectors(spark, rows)), F.col("vec_id") % 20 == 0, row_block=2)
    assert found(got) == [(0, 1, 7, 8192), (0, 2, 8, 4096), (0, 3, 7, 2048)]


@pytest.mark.parametrize("rows, message", [([(0, [3e16]), (1, [3e16])], "64 bits"), ([(0, [1e30]), (1, [1.0])], "64 bits")])
def test_numbers_beyond_64_bits_raise(spark, rows, message):
    with pytest.raises(Exception, match=message):
        found(top_k(quantised(vectors(spark, rows)), F.col("vec_id") % 20 == 0))


def test_empty_table(spark):
    assert found(top_k(quantised(vectors(spark, [])), F.col("vec_id") % 20 == 0)) == []


def test_postings_hold_each_weight_once():
    lists = postings([[0, 2], [3, 0, 5], []])
    assert {t: (p.tolist(), w.tolist()) for t, (p, w) in lists.items()} == {0: ([1], [3]), 1: ([0], [2]), 2: ([1], [5])}


def test_selection_prefers_small_places_in_ties():
    assert sorted(best_places(np.array([1, 5, 5, 5, 0]), 2)) == [1, 2]


def test_no_rows_on_one_side():
    import pandas as pd

    rows = pd.DataFrame({"row": [0], "vec_id": [1], "weights": [[1]]})
    assert search_block(rows.iloc[:0], rows, 3).empty and search_block(rows, rows.iloc[:0], 3).empty
