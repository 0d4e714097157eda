import random

from pyspark.sql import functions as F

from cashtide.llm.mixing import mix_sources, mixed_documents, served_copies, source_targets, word_count

ROWS = [(i, " ".join(["w"] * ((i * 7) % 13 + 1)), None, f"s{i % 4}") for i in range(80)]


def test_sources_come_near_their_targets(documents):
    got = mix_sources(documents(ROWS)).collect()
    assert len(got) == len(ROWS)
    by_source = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source.setdefault(r["doc_id"] % 4, []).append(r)
    for rows in by_source.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) < 1
        assert sum(r["size"] for r in rows) == rows[0]["source_size"]
    assert round(sum(rows[0]["target"] for rows in by_source.values()), 6) == sum(r["size"] for r in got)


def test_targets_against_repeated_resharing(spark):
    rng = random.Random(4)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000]) for i in range(7)}
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()] + [(None, 30)], "source string, size long")
        sizes = {**dict(sorted(sizes.items())), None: 30}
        weights = {s: i % 3 + 1 for i, s in enumerate(sizes)}
        left, free, want = float(sum(sizes.values())), set(sizes), {}
        while free:
            share = left / sum(weights[s] for s in free)
            full = {s for s in free if share * weights[s] >= 3 * sizes[s]}
            want |= {s: 3.0 * sizes[s] for s in full} if full else {s: share * weights[s] for s in free}
            left, free = left - sum(3 * sizes[s] for s in full), free - full if full else set()
        got = {r["source"]: r["target"] for r in source_targets(df).collect()}
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_reruns_and_partitions_agree(documents):
    docs = documents(ROWS)
    runs = [sorted(map(tuple, mix_sources(d).collect())) for d in (docs, docs.repartition(7), docs.orderBy(F.desc("doc_id")))]
    assert runs[0] == runs[1] == runs[2]


def test_copies_are_in_order_of_their_finish_times(documents):
    got = [r for r in served_copies(documents(ROWS)).collect() if r["taken"]]
    got.sort(key=lambda r: r["position"])
    assert [r["finish"] for r in got] == sorted(r["finish"] for r in got)
    at = 0
    for r in got:
        assert r["position"] == at
        at += r["taken"]
    assert at <= sum(len(t.split()) for _, t, _, _ in ROWS)


def test_nulls_empty_texts_and_repeated_rows(documents):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (3, "x y", None, None), (None, "z", None, None), (4, "q", None, "b"), (4, "q", None, "b")]
    got = {(r["doc_id"], r["size"]): r for r in mix_sources(documents(rows)).collect()}
    assert got[1, 0]["taken"] == got[2, 0]["taken"] == 0 and got[1, 0]["target"] == 0
    assert got[3, 2]["source_size"] == 3 and mix_sources(documents(rows)).count() == 6


def test_no_words_and_empty_table(documents):
    assert [r["target"] for r in mix_sources(documents([(1, " ", None, "a")])).collect()] == [0.0]
    assert mix_sources(documents([])).count() == 0 and mixed_documents(documents([])).count() == 0


def test_mixed_documents_keep_columns_and_whole_texts(documents):
    docs = documents([*ROWS, ROWS[3], (500, None, None, "s1")])
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert max(c for i, c in counts.items() if i != 3) <= 3 and counts.get(3, 0) <= 6 and counts[500] == 1
    totals = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    sizes = docs.select("source", word_count("text").alias("size"))
    targets = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    assert all(abs(totals[s] - targets[s]) <= 13 for s in targets)
