import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from cashtide.session import scratch_path
from tests.llm.test_langid import text as invented

RNG = random.Random(21)


@pytest.fixture
def folder(spark, documents):
    """A folder with documents and a benchmark."""

    def make(rows, items):
        path = scratch_path(spark, "tables")
        documents(rows).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        return path

    return make


def changed(text):
    words = text.split()
    words[len(words) // 2] = "changed"
    return " ".join(words)


def respaced(text):
    """The same words: an equal fingerprint."""
    return text.upper().replace(" ", "\n ")


def planted():
    rows = [(i, invented(lang, 120), lang, f"s{i % 3}") for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    item = invented("bb", 40)
    rows += [(200, rows[0][1], "aa", "s0"), (201, respaced(rows[1][1]), "bb", "s1"), (201, respaced(rows[1][1]), "bb", "s1")]
    rows += [(300, invented("aa", 60) + "\n" + item + " " + invented("aa", 60), "aa", "s2"), (301, changed(item), "bb", "s2")]
    rows += [(400, "12345 !!", "aa", "s0"), (401, None, None, None), (402, "", "bb", "s1")]
    return rows, [(1, item), (2, None)]


def test_stages_on_planted_cases(spark, folder):
    rows, items = planted()
    path = folder(rows, items)
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in P.STAGES:
        out = scratch_path(spark, name)
        stage(spark, docs, path).write.parquet(out)
        new = spark.read.parquet(out)
        kept[name] = new
        if name != "token_ids":
            assert new.columns == docs.columns
        docs = new
    ids = {name: sorted(r["doc_id"] for r in df.collect()) for name, df in kept.items()}
    clean = set(range(120))
    assert ids["language_id"] == [*range(120), 200, 201, 201, 300, 301]
    assert ids["near_dedup"] == [*range(120), 300, 301]
    assert ids["decontaminate"] == list(range(120))
    assert set(ids["mix"]) <= clean and max(map(ids["mix"].count, set(ids["mix"]))) <= 3
    assert ids["token_ids"] == ids["mix"]
    last = kept["token_ids"].orderBy("start").collect()
    assert [r["start"] for r in last][1:] == [r["start"] + r["n_tokens"] for r in last][:-1]


def test_empty_table(spark, folder):
    path = folder([], [(1, "some words of an item here")])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in P.STAGES:
        assert stage(spark, docs, path).count() == 0, name


def test_run_over_the_smallest_tables(spark):
    import os

    import __spark_entry__ as entry

    if not os.path.isdir(entry.SMOKE_DIR):
        pytest.skip("needs the generated tables")
    got = P.run(spark, entry.SMOKE_DIR)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100
    assert got.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
