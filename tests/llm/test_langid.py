import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cashtide.llm import langid
from cashtide.llm.common import fold

RNG = random.Random(2)
SYLLABLES = {"aa": "the and ing ion ent ".split(), "bb": "sch ung ein ich auf ".split(), "cc": "que eau oux les ment ".split()}


def text(lang, n=40):
    return " ".join("".join(RNG.choices(SYLLABLES[lang], k=3)) for _ in range(n))


ROWS = [(i, text(lang), lang, "s") for i, lang in enumerate(["aa", "bb", "cc"] * 60)]


@pytest.fixture(scope="module")
def net():
    windows = np.concatenate([langid.windows_of(t.encode())[:1] for _, t, _, _ in ROWS])
    return langid.train(windows, np.array([sorted(SYLLABLES).index(lang) for _, _, lang, _ in ROWS]), sorted(SYLLABLES))


def test_held_out_accuracy(spark, documents):
    docs = documents(ROWS)
    net = langid.learn(docs.select("doc_id", "text", "lang"), fold("doc_id", 4) != 2)
    held = langid.predict(docs, net).filter(fold(F.col("row.doc_id"), 4) == 2).collect()
    assert len(held) > 20 and np.mean([r["lang_pred"] == r["row"]["lang"] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in held)


def test_labels_of_held_out_rows_are_not_used(documents):
    usable = fold("doc_id", 4) != 2
    a = langid.learn(documents(ROWS).select("doc_id", "text", "lang"), usable)
    spoiled = documents(ROWS).select("doc_id", "text", "lang").withColumn("lang", F.when(usable, F.col("lang")).otherwise("zz"))
    b = langid.learn(spoiled, usable)
    assert b.languages == ["aa", "bb", "cc"] and all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables, strict=True))


def test_texts_without_letters(net):
    found, scores = langid.predict_texts(net, [b"", b"12 !? 34", "٣٤".encode(), "é".encode()])
    assert found[:3] == ["und"] * 3 and scores[:3] == [0.0] * 3 and found[3] != "und"


def test_whole_texts_count(net):
    long = (text("aa", 30) + " ") * 2 + (text("bb", 300) + " ") * 3
    assert langid.predict_texts(net, [long.encode()])[0] == ["bb"]


def test_both_forms_of_the_pooling_agree(net):
    windows = langid.windows_of(text("cc", 200).encode())
    assert np.allclose(net.highest(windows), net.pooled(windows)[0], atol=1e-5)


def test_windows_cover_the_text():
    data = bytes(RNG.randrange(97, 123) for _ in range(1000))
    assert langid.windows_of(data).tobytes().rstrip(b"\0") == data and len(langid.windows_of(b"")) == 1


def test_null_texts_labels_and_ids(documents):
    docs = documents([*ROWS, (900, None, "aa", None), (None, text("bb"), None, None), (901, "", "bb", None)])
    net = langid.learn(docs.select("doc_id", "text", "lang"), F.lit(True))
    got = langid.predict(docs, net)
    assert got.select("row.*").columns == docs.columns and got.count() == len(ROWS) + 3
    assert {r["lang_pred"] for r in got.filter("row.doc_id >= 900").collect()} == {"und"}
    assert got.filter("row.doc_id IS NULL").first()["lang_pred"] == "bb"


def test_nothing_to_learn_from_and_empty_table(documents):
    docs = documents([(1, "some text", None, None)])
    net = langid.learn(docs.select("doc_id", "text", "lang"), F.lit(True))
    assert net is None and langid.predict(docs, net).first()["lang_pred"] == "und"
    assert langid.predict(documents([]), None).count() == 0


def test_sample_is_bounded_for_repeated_rows(documents):
    """A third of all rows are one document: it is learned from once."""
    hot = (3, ROWS[3][1], "aa", "s")
    docs = documents(ROWS + [hot] * 90).select("doc_id", "text", "lang")
    windows = langid.sample_windows(docs, F.lit(True), 10, 2).groupBy("lang").count().collect()
    assert len(windows) == 3 and all(r["count"] <= 20 for r in windows)
    every = langid.sample_windows(docs, F.lit(True), 1000, 1)
    assert every.count() == len(ROWS)
