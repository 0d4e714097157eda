import os

from pyspark.sql import functions as F

from cashtide.schemas import RAW_POST
from cashtide.operators.mentions import explode_mentions, to_processed
from cashtide.session import scratch_path
from cashtide.sinks.folders import replace_batch
from cashtide.sinks.tables import write_mentions
from cashtide.sources.tables import existing_folders, read_mentions
from cashtide.streaming.dedup import KeptIds

HOUR = 1_704_067_200.0  # 2024-01-01 00:00 UTC
S = 1_000_000


def placed(spark, *rows):
    return spark.createDataFrame(rows, "id string, day string, hour string, batch_id string")


def found(spark, folder):
    return sorted(tuple(r) for r in spark.read.schema("id string, day string, hour string, batch_id string").parquet(folder).collect())


def test_a_batch_replaces_its_own_folders_only(spark):
    folder = scratch_path(spark, "t")
    by = ("day", "hour")
    one = [("a", "1", "01", "x"), ("b", "1", "02", "x")]
    replace_batch(placed(spark, *one), folder, by)
    two = [("c", "1", "01", "y"), ("d", "1", "03", "y"), ("e", "2", "01", "y"), ("f", None, "01", "y")]
    replace_batch(placed(spark, *two), folder, by)  # into an hour there is, a new hour, a new day and no day
    assert found(spark, folder) == sorted([*one, *two], key=lambda r: r[0])
    again = [("g", "1", "01", "x")]
    replace_batch(placed(spark, *again), folder, by)
    assert found(spark, folder) == sorted([one[1], *two, *again], key=lambda r: r[0])
    odd = [("h", "1", "01", "a, b/c=d")]
    replace_batch(placed(spark, *odd), folder, by)
    replace_batch(placed(spark, *odd), folder, by)
    assert found(spark, folder) == sorted([one[1], *two, *again, *odd], key=lambda r: r[0])
    replace_batch(placed(spark, *odd).filter("false"), folder, by)
    assert len(found(spark, folder)) == 7 and not [n for n in os.listdir(folder) if "writing" in n]


def test_a_failed_write_leaves_the_table_as_it_was(spark):
    folder = scratch_path(spark, "t")
    rows = [("a", "1", "01", "x")]
    replace_batch(placed(spark, *rows), folder, ("day", "hour"))
    broken = placed(spark, ("b", "1", "01", "x")).withColumn("id", F.raise_error("broken").cast("string"))
    try:
        replace_batch(broken, folder, ("day", "hour"))
        raise AssertionError("it has to fail")
    except Exception as e:
        assert "broken" in str(e)
    assert found(spark, folder) == rows and os.listdir(folder) == ["day=1"]


def test_files_of_narrow_rows_are_written_by_many_tasks(spark):
    """The mentions of many hours are few bytes: one task wrote all their files."""
    root, before = scratch_path(spark, "t"), spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", None)
    rows = [(f"p{i}", "demo", "t", "$SPY is great", 0, 1.0, 0, HOUR + 3600 * i, "u", HOUR) for i in range(60)]
    write_mentions(explode_mentions(to_processed(spark.createDataFrame(rows, RAW_POST), now=HOUR)), root, 1)
    parts = {f.rsplit("/", 1)[1][:10] for f in read_mentions(spark, root).inputFiles()}
    assert len(parts) > 1 and read_mentions(spark, root).count() == 60
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", None) == before


def test_recording_ids_does_not_drop_what_is_cached(spark):
    """A batch is joined with the kept ids and cached, then its own ids are kept: it was computed, and scored, again."""
    ids = KeptIds(spark, scratch_path(spark, "kept"), window_us=3600 * S)
    at = int(HOUR) * S
    ids.record(spark.createDataFrame([("a", at)], "post_id string, time_us long"), 1)
    unseen = ids.unseen(spark.createDataFrame([("a", at + 1), ("b", at + 2)], "post_id string, time_us long"), 2).persist()
    others = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    assert [r.post_id for r in unseen.collect()] == ["b"]
    cached = set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) - others
    ids.record(unseen, 2)
    assert cached and cached <= set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    unseen.unpersist()
    assert len(existing_folders(spark, [f"{ids.path}/bucket=*/batch_id=*"])) == 2
