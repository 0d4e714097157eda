import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cashtide.operators.dedup import _split_by_key, dedup_on_read, dedup_ttl
from cashtide.operators.filters import drop_out_of_order, next_cursor, read_since_cursor

S = 1_000_000
WINDOW = 3600 * S


def brute(rows, window):
    kept, last = [], {}
    for key, t, seq in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or t > last[key] + window:
            last[key] = t
            kept.append((key, t, seq))
    return sorted(kept, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "post_id string, time_us long, seq int")
    out = dedup_ttl(df, window_us=WINDOW, order=("seq",), **options)
    assert out.columns == df.columns
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("fold_rows", [1000, 0])
def test_known_chain(spark, fold_rows):
    seconds = [0, 3000, 3600, 6000, 7200, 9601]
    rows = [("a", s * S, i) for i, s in enumerate(seconds)] + [("b", 10 * S, 9)]
    kept = run(spark, rows, fold_rows=fold_rows)
    assert [t // S for k, t, _ in kept if k == "a"] == [0, 6000, 9601]
    assert [t // S for k, t, _ in kept if k == "b"] == [10]


@pytest.mark.parametrize("fold_rows", [1000, 0, 40])
def test_random_rows(spark, fold_rows):
    rng = random.Random(fold_rows)
    rows = []
    for seq in range(1500):
        key = rng.choice(["hot", "hot", None, *"abcdefgh"])
        t = rng.randint(0, 40) * 1800 * S + rng.choice([0, 0, 1, 17, 999_999])
        rows.append((key, t, seq))
    assert run(spark, rows, fold_rows=fold_rows) == brute(rows, WINDOW)


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 8).map(lambda n: n * 1000 * S)), st.integers(0, 2)),
        max_size=14,
    )
)
def test_both_forms_agree_on_null_and_tied_input(spark, rows):
    small, crowded = run(spark, rows, fold_rows=100), run(spark, rows, fold_rows=0)
    timed = [r for r in rows if r[1] is not None]
    assert small == crowded == sorted([*brute(timed, WINDOW), *(r for r in rows if r[1] is None)], key=str)


def test_crowded_key_with_dense_times(spark):
    rng = random.Random(5)
    times = sorted(rng.sample(range(0, 30 * WINDOW), 6000))
    rows = [("hot", t, i) for i, t in enumerate(times)] + [("cold", 5, 0)]
    assert run(spark, rows, fold_rows=100) == brute(rows, WINDOW)


def test_exact_copies_of_a_crowded_key_leave_one(spark):
    rows = [("hot", 7, 1)] * 500
    assert run(spark, rows, fold_rows=100) == [("hot", 7, 1)]


def test_crowded_keys_are_set_apart(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "post_id string, time_us long")
    hot = spark.createDataFrame([("a",), (None,)], "_hot string")
    usual, crowded = _split_by_key(df, hot, "post_id")
    assert [r.time_us for r in usual.collect()] == [3] and sorted(r.time_us for r in crowded.collect()) == [1, 2]


def test_events_without_source_or_time(spark):
    rows = [(None, 0, 5), (None, 1, 4), (None, 2, 6), ("s", 3, 1), ("s", 4, None), ("s", 5, 2)]
    df = spark.createDataFrame(rows, "source string, offset long, time_us long")
    assert sorted(r.offset for r in drop_out_of_order(df, "offset", chunk=2).collect()) == [0, 2, 3, 5]


def test_new_repeat_and_other_id(spark):
    rows = [("post_1", 1 * S, 0), ("post_1", 2 * S, 1), ("post_2", 2 * S, 2)]
    assert run(spark, rows) == [("post_1", 1 * S, 0), ("post_2", 2 * S, 2)]


def test_on_read_keeps_first_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 1.0), ("b", 3.0)], "post_id string, processed_at double")
    out = dedup_on_read(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(map(tuple, out.collect())) == [("a", 1.0), ("b", 3.0)]


@pytest.mark.parametrize("chunk", [1, 2, 3, 1_000_000])
def test_out_of_order_known(spark, chunk):
    rows = [("s", i, t) for i, t in enumerate([10, 30, 20, 30, 40])]
    df = spark.createDataFrame(rows, "source string, offset long, time_us long")
    kept = drop_out_of_order(df, "offset", chunk=chunk).orderBy("offset").collect()
    assert [r.time_us for r in kept] == [10, 30, 40]


@pytest.mark.parametrize("chunk", [7, 50])
def test_out_of_order_random(spark, chunk):
    rng = random.Random(chunk)
    rows = [(rng.choice("xy"), i, rng.randint(0, 500) + i) for i in range(600)]
    cursor, want = defaultdict(lambda: -1), []
    for source, offset, t in rows:
        if t > cursor[source]:
            cursor[source] = t
            want.append((source, offset, t))
    df = spark.createDataFrame(rows, "source string, offset long, time_us long")
    assert sorted(map(tuple, drop_out_of_order(df, "offset", chunk=chunk).collect())) == sorted(want)


def test_cursor(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "time_us long")
    assert next_cursor(df).first().cursor == 9
    assert read_since_cursor(df, 5).count() == 1
    assert read_since_cursor(df, None).count() == 3
    assert next_cursor(df.filter(F.lit(False))).first().cursor is None
