import random

import numpy as np
import pytest
import xxhash

from cashtide.llm.simhash import (
    BITS,
    choose_parts,
    close_pairs,
    group_bits,
    links,
    near_duplicates,
    one_of_each,
    text_fingerprint,
)

RNG = random.Random(11)
WORDS = ["".join(RNG.choices("abcdefghijklmnop", k=4)) for _ in range(500)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


def plain_fingerprint(text, n=3):
    words = [w for w in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split() if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(BITS) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits, linked=lambda a, b: True):
    """``{id: smallest reachable id}`` by comparing all pairs."""
    ids = sorted(fps)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if root[b] > root[a] and (fps[a] ^ fps[b]).bit_count() <= max_bits and linked(a, b):
                    root[b], changed = root[a], True
    return root


def test_fingerprint():
    for text in ("", "  ", "One", "one two", "A b C", "É é A", prose(300), "x " * 500):
        assert text_fingerprint(text.encode()) == plain_fingerprint(text)


def corpus():
    base = prose(400)
    texts = {i: prose(60) for i in range(10, 40)}
    for i in range(40, 70):  # near copies that form chains
        words = base.split()
        words[i * 5] = "changed"
        if i % 3 == 0:
            words[i * 2] = "again"
        texts[i] = " ".join(words)
    texts |= {70: base, 71: base.upper(), 72: base, 73: None, 74: "", 75: " \n", 76: "short", 77: "short"}
    return texts


@pytest.mark.parametrize("bucket_limit", [8192, 6])
def test_components_equal_brute_force(documents, bucket_limit):
    texts = corpus()
    docs = documents([(i, t, None, None) for i, t in texts.items()])
    got = {r["doc_id"]: r for r in near_duplicates(docs, bucket_limit=bucket_limit).collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = plain_components(fps, 3)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{fps[i]:016x}", want[i]) for i in texts}
    assert want[74] == want[75] == 73 and len(set(want.values())) < len(texts) - 8


def test_one_of_each_group_stays(documents):
    base = prose(200)
    rows = [(5, base, "en", "a"), (2, base, "en", "b"), (2, base, "en", "b"), (9, prose(50), "en", "a"), (None, base, "en", "c"),
            (8, None, None, None), (7, "", None, None)]
    docs = documents(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 9]


def test_null_ids(documents):
    base = prose(80)
    got = near_duplicates(documents([(None, base, None, None), (4, base, None, None), (None, prose(90), None, None)])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("4", "4"), ("None", "4"), ("None", "None")]


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0 and one_of_each(documents([])).count() == 0


def ball(n, flips, seed):
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    masks = [np.bitwise_xor.reduce(np.uint64(1) << rng.choice(64, k, replace=False).astype(np.uint64)) for k in rng.integers(0, flips + 1, n)]
    return np.unique(centre ^ np.array(masks, np.uint64))


@pytest.mark.parametrize("max_bits", [3, 7, 11])
def test_no_link_is_lost(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 63, 300, dtype=np.uint64), *(ball(12, 9, s) for s in range(20)), ball(300, 2, 99)]))
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    parent = {int(f): int(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links(df, max_bits).collect():
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        assert (a ^ b).bit_count() <= max_bits
        parent[find(a)] = find(b)
    for i, f in enumerate(fps):
        for g in fps[i + 1 :][np.bitwise_count(fps[i + 1 :] ^ f) <= max_bits]:
            assert find(int(f)) == find(int(g))


def test_dense_runs_leave_a_forest():
    fp = ball(400, 2, 7)
    a, _ = close_pairs(np.zeros(len(fp), int), fp, np.zeros(len(fp), bool), 4)
    assert len(a) == len(fp) - 1


def test_thresholds_add_up_and_keys_grow_with_the_data():
    for n in (10, 10**6, 10**9):
        both = np.full((BITS, BITS), n / 4)
        np.fill_diagonal(both, n / 2)
        for max_bits in (3, 11):
            parts = choose_parts(n, both, max_bits)
            assert sum(p.threshold + 1 for p in parts) == max_bits + 1
            assert len({b for p in parts for b in p.bits}) == sum(len(p.bits) for p in parts)
    assert min(len(p.bits) for p in parts) >= 16


def test_correlated_bits_are_grouped():
    n, both = 1000, np.full((BITS, BITS), 250.0)
    np.fill_diagonal(both, 500)
    both[3, 40] = both[40, 3] = 480
    assert any({3, 40} <= set(g) for g in group_bits(n, both, 4))
    assert sorted(b for g in group_bits(n, both, 5) for b in g) == list(range(BITS))


def test_columns_named_like_those_of_the_operator(documents):
    docs = documents([(1, "a b c d", "en", "s"), (2, "a b c d", "en", "s"), (3, "e f g h", "en", "s")])
    for name in ("head_id", "head_key", "rows", "id", "_head_id", "_head_key", "_rows", "component_id", "first_key", "fingerprint"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_one_text_on_a_third_of_the_rows(documents):
    base = prose(40)
    rows = [(i, base if i % 3 else prose(40), "en", "s") for i in range(900)]
    kept = sorted(r["doc_id"] for r in one_of_each(documents(rows, clash=False)).collect())
    assert kept == [0, 1, *range(3, 900, 3)]
