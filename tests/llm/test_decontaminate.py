import random
import time

import numpy as np
import pytest

from cashtide.llm.decontaminate import Items, align, contaminated, decontaminated, matches, rare_seeds, words_of

RNG = random.Random(5)
WORDS = ["".join(RNG.choices("abcdefghijklmnop", k=5)) for _ in range(400)]


def prose(n):
    return RNG.choices(WORDS, k=n)


ITEMS = {1: " ".join(prose(40)), 2: " ".join(prose(30)), 3: "two words", 4: None, 5: ""}


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(i, t, 0.5) for i, t in ITEMS.items()], "item_id long, text string, score double")


def inside(passage):
    return " ".join(prose(60)) + ".\n" + passage + ", " + " ".join(prose(60))


def edited(text, every):
    words = text.split()
    return " ".join("changed" if i % every == every - 1 else w for i, w in enumerate(words))


def pairs(df):
    return sorted(((r["doc_id"], r["item_id"]) for r in df.collect()), key=lambda p: (p[0] is None, p))


def test_whole_edited_and_clean(documents, benchmark):
    docs = documents([
        (1, inside(ITEMS[1]), None, None),
        (2, inside(ITEMS[2].upper().replace(" ", ",\n")), None, None),
        (3, inside(edited(ITEMS[1], 9)), None, None),
        (4, inside(" ".join(ITEMS[1].split()[:15])), None, None),  # less than half of an item
        (5, inside(ITEMS[3]), None, None),  # a short item, as it is
        (6, None, None, None), (7, "", None, None), (None, ITEMS[2], None, None),
        (8, inside(ITEMS[1]) + inside(ITEMS[2]) * 50, None, None),
        (8, inside(ITEMS[2]), None, None),
    ])
    found = contaminated(docs, benchmark)
    assert pairs(found) == [(1, 1), (2, 2), (3, 1), (5, 3), (8, 1), (8, 2), (8, 2), (None, 2)]
    whole = found.filter("doc_id = 1").first()
    assert whole["score"] == 1.0 and (whole["first_word"], whole["last_word"]) == (60, 100)
    assert 0.8 <= found.filter("doc_id = 3").first()["score"] < 1
    kept = decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 6, 7]
    assert pairs(contaminated(docs, benchmark, min_words=5)) == [p for p in pairs(found) if p != (5, 3)]


def test_blocks_of_items_give_the_same_rows(documents, benchmark):
    docs = documents([(i, inside(ITEMS[1 + i % 2]), None, None) for i in range(6)])
    assert pairs(contaminated(docs, benchmark, block_bytes=1)) == pairs(contaminated(docs, benchmark))
    assert decontaminated(docs, benchmark, block_bytes=1).count() == 0


def test_a_passage_that_most_documents_share_is_found(documents, benchmark):
    docs = documents([(i, inside(ITEMS[2]), None, None) for i in range(300)] + [(999, inside(""), None, None)])
    assert pairs(contaminated(docs, benchmark)) == [(i, 2) for i in range(300)]


def test_empty_tables(documents, benchmark):
    assert contaminated(documents([]), benchmark).count() == 0
    docs = documents([(1, "text", None, None)])
    assert contaminated(docs, benchmark.limit(0)).count() == 0 and decontaminated(docs, benchmark.limit(0)).count() == 1


def test_seeds_are_the_rarest_and_one_is_left_in_every_copy():
    items = Items([1], [" ".join(prose(50))])
    own, needed = items.grams[0], items.needed[0]
    frequency = np.zeros(len(items.keys), int)
    frequency[own[:needed]] = 100  # one of these is a seed too: the others may be those that are lost
    block = rare_seeds(items, frequency)
    chosen = [k for k in range(len(items.keys)) if len(block.candidates(np.array([k])))]
    assert needed > 1 and len(chosen) == len(own) - needed + 1
    assert not set(chosen) & set(own[1:needed].tolist()) and own[0] in chosen


def test_many_items_with_one_phrase():
    phrase = " ".join(prose(3))
    texts = [" ".join(f"w{i}x{k}" for k in range(20)) + f" {phrase} " + " ".join(f"w{i}y{k}" for k in range(20)) for i in range(8000)]
    items = Items(list(range(8000)), texts)
    frequency = np.ones(len(items.keys), int)
    frequency[np.bincount(np.concatenate(items.grams)).argmax()] = 1000
    block = rare_seeds(items, frequency)
    start = time.perf_counter()
    assert [(i, score) for i, score, _, _ in matches(block, f"{phrase} " * 100 + texts[77])] == [(77, 1.0)]
    assert time.perf_counter() - start < 1


def test_alignment_against_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(1, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 15))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i, j] = max(0, table[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
        assert align(a, b)[0] == table.max()


def test_words():
    assert words_of("Foo-bar “Été”, x_1") == [w.encode() for w in ("foo", "bar", "été", "x", "1")]


def brute_force(docs, items, min_score=0.8):
    out = []
    for i, text in docs:
        for item, passage in items.items():
            words = words_of(passage)
            if words:
                number = {w: k + 1 for k, w in enumerate(dict.fromkeys(words))}
                text_words = np.array([number.get(w, 0) for w in words_of(text)], np.int64)
                if align(np.array([number[w] for w in words]), text_words)[0] / (2 * len(words)) >= min_score:
                    out.append((i, item))
    return sorted(out)


def test_repeated_edited_copies_equal_brute_force(spark, documents):
    items = {1: " ".join(prose(40)), 2: " ".join(prose(30)), 3: " ".join(prose(59)), 4: " ".join(prose(7)), **{n + 4: " ".join(prose(n)) for n in range(1, 5)}, 9: ""}
    rows = []
    for item in filter(None, items.values()):
        eighth = " ".join("changed" if i % 8 == 4 else w for i, w in enumerate(item.split()))
        inserted = " ".join(w + (" more" if i % 3 == 2 else "") for i, w in enumerate(item.split()))
        rows += [inside(t) for t in [eighth] * 3 + [inserted] * 2 + [item] * 2 + [edited(item, 5)] * 2]
    rows = list(enumerate(rows))
    want = brute_force(rows, items)
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = documents([(i, t, None, None) for i, t in rows])
    assert len(want) >= 24 and pairs(contaminated(docs, benchmark)) == want
    for least in (0.5, 0.9):
        assert pairs(contaminated(docs, benchmark, min_score=least)) == brute_force(rows, items, least)
    assert sorted(r["doc_id"] for r in decontaminated(docs, benchmark).collect()) == sorted({i for i, _ in rows} - {i for i, _ in want})
