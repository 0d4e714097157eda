import math
import random
import re

import numpy as np
import pytest

from cashtide.llm import ranked
from cashtide.llm.ranked import Lists, Segment, Tables, build_index, search
from cashtide.session import scratch_path

WORDS = [f"w{i}" for i in range(40)]


def plain_terms(text):
    lowered = (text or "").translate(str.maketrans(ranked.UPPER, ranked.LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k):
    """All documents scored for all items, one by one."""
    counted = [(i, plain_terms(t)) for i, t in docs]
    counted = [(i, t) for i, t in counted if t]
    n, words = len(counted), sum(len(t) for _, t in counted)
    df = {}
    for _, terms in counted:
        for term in set(terms):
            df[term] = df.get(term, 0) + 1
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc_id, held in counted:
            slope = 100 - 50 + 50 * len(held) * n // words
            score = 0
            for term in terms.intersection(held):
                tf = held.count(term)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1))) * (1_000_000_000 * tf // (1000 * tf + 20 * slope))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture
def found(spark, documents):
    def run(docs, items, k=50, block_terms=ranked.BLOCK_TERMS, clash=True, **options):
        path = scratch_path(spark, "index")
        build_index(documents([(i, t, None, None) for i, t in docs], clash), path, **options)
        item_rows = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS term", "2 AS segment", "3 AS block")
        return sorted((tuple(r) for r in search(spark, path, item_rows, k, block_terms=block_terms).collect()), key=str)

    return run


def prose(rng, n):
    return " ".join(rng.choices(WORDS, weights=[1 / (i + 1) for i in range(len(WORDS))], k=n))


@pytest.mark.parametrize("segment_postings, block_terms", [(1 << 20, 1 << 14), (300, 12)])
def test_equals_scoring_all(found, segment_postings, block_terms):
    rng = random.Random(1)
    docs = [(i, prose(rng, rng.randint(1, 60))) for i in range(400)] + [(i, docs_text) for i, docs_text in ((5, "w1 w2"), (5, "w1 w2"), (7, "w39"))]
    items = [(i, prose(rng, 12)) for i in range(8)]
    got = found(docs, items, 10, block_terms, segment_postings=segment_postings)
    assert got == plain_search(docs, items, 10)


def test_nulls_ties_repeats_and_odd_characters(found):
    docs = [(3, "Ä b-C"), (1, "ä B c"), (None, "Ä b c"), (2, "Ä b c"), (2, "Ä b c"), (8, None), (9, ""), (10, " .!"), (4, "x" * 5000), (6, "z z z")]
    items = [(1, "Ä b"), (1, "c c"), (2, None), (3, "unknown"), (None, "C z"), (4, "x" * 5000)]
    got = found(docs, items, 4)
    assert got == plain_search(docs, items, 4)
    assert {r[0] for r in got} == {1, None, 4}


def test_one_text_on_most_rows(found):
    rng = random.Random(2)
    docs = [(i, "w0 w1 w2" if i % 3 else prose(rng, 20)) for i in range(600)]
    items = [(1, "w0 w1 w2 w3"), (2, "w2")]
    assert found(docs, items, 50, clash=False, segment_postings=200) == plain_search(docs, items, 50)


def test_very_long_texts_in_pieces(found, monkeypatch):
    monkeypatch.setattr(ranked, "PIECE_BYTES", 64)
    monkeypatch.setattr(ranked, "CHUNK_WORDS", 50)
    rng = random.Random(3)
    docs = [(i, prose(rng, 700)) for i in range(6)]
    segment = Segment()
    for i, text in docs:
        segment.add(i, text.encode())
    head, *lists = segment.rows(0)
    assert head["words"][0].as_py() == 6 * 700 and len(segment.chunks) > 10
    counts = {t: dict(zip(d, c, strict=True)) for b in lists for t, d, c in zip(*(b[x].to_pylist() for x in ("term", "docs", "counts")), strict=True)}
    assert counts == {w: {i: t.split().count(w) for i, t in docs if w in t.split()} for w in {w for _, t in docs for w in t.split()}}


def test_empty_tables(found):
    assert found([], [(1, "a")]) == [] and found([(1, "a")], []) == [] and found([(1, None)], [(1, "a")]) == []


def test_range_maxima():
    rng = np.random.default_rng(4)
    lengths = np.array([37, 16, 5, 1])
    values = rng.integers(0, 9, lengths.sum())
    tables = Tables(values, lengths)
    for first, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
        for a in range(n + 1):
            for b in range(a, n + 1):
                place, value = tables.best(np.array([first + a]), np.array([first + b]))
                part = values[first + a : first + b]
                assert value[0] == part.max(initial=0)
                if a < b:
                    assert place[0] == first + a + part.argmax()


def test_intervals_below_the_kth_score_are_left():
    """One document holds all rare terms; most of the common list is never touched."""
    rng = np.random.default_rng(5)
    n = 20_000
    common = np.arange(n, dtype=np.int32)
    docs = [common, np.array([70], np.int32), np.array([70, 15_000], np.int32)]
    counts = [np.ones(len(d), np.int32) for d in docs]
    lists = Lists(docs, counts, rng.integers(90, 110, n).astype(np.int32), n, 100 * n)
    touched = []
    whole = lists.bounded
    lists.bounded = lambda w, s, e: touched.append(len(s)) or whole(w, s, e)
    found, scores = lists.search(lists.number[[0, 1, 2]], np.array([1, 9000, 8000]), 2)
    assert found.tolist() == [70, 15_000] and scores[0] > scores[1] and sum(touched) < 20
