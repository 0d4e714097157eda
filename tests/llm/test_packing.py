import random
import zlib

import numpy as np
import pytest

from cashtide.llm import packing
from cashtide.llm.packing import placed_pieces, pieces_of, read_sequences, sum_of_squares, write_sequences
from cashtide.session import scratch_path

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.fixture
def written(spark, documents):
    def write(rows, clash=True, **options):
        folder = scratch_path(spark, "sequences")
        write_sequences(documents([(i, t, None, None) for i, t in rows], clash), folder, PATH, **options)
        return read_sequences(spark, folder)

    return write


def check(rows, sequences, plain, length):
    """All documents are there, cut as promised, and the sequences hold them without gaps."""
    held = {}
    for s in sequences.collect():
        ids = np.frombuffer(s["tokens"], "<u4").tolist()
        assert s["sequence_id"] not in held and 0 < len(ids) == sum(s["lengths"]) <= length
        held[s["sequence_id"]] = ids
    want = sorted(str((i, tuple(ids))) for i, ids in ((i, plain(t)) for i, t in rows))
    by_doc, found = {}, placed_pieces(sequences).collect()
    for r in found:
        ids = held[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], ids))
    for s, ids in held.items():
        at = sorted((r["offset"], r["length"]) for r in found if r["sequence_id"] == s)
        assert [o for o, _ in at] == np.cumsum([0, *[n for _, n in at]])[:-1].tolist() and sum(n for _, n in at) == len(ids)
    got = []
    for doc_id, parts in by_doc.items():
        if len({p for p, _, _ in parts}) == len(parts):  # one document of this id
            parts = [sorted(parts, key=lambda p: p[0])]
        else:
            parts = [[p] for p in parts]  # the tests repeat only short ones
        for document in parts:
            ids = [t for _, _, part in document for t in part]
            assert [(s, len(p)) for _, s, p in document] == list(pieces_of(len(ids), length))
            got.append(str((doc_id, tuple(ids))))
    assert sorted(got) == want
    return len(held)


def test_cuts():
    assert list(pieces_of(5, 4)) == [(0, 1), (1, 4)] and list(pieces_of(8, 4)) == [(0, 4), (4, 4)] and list(pieces_of(3, 4)) == [(0, 3)]


def test_documents_come_back(spark, written, plain):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["one", "Two,", "three.", "漢字"], k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(301, None), (302, ""), (None, "x y"), (303, "long " * 5000), (304, "a"), (304, "a"), (304, "b")]
    n = check(rows, written(rows, length=64), plain, 64)
    demand = -(-sum(len(plain(t)) for _, t in rows) // 64)
    assert n <= 1.02 * demand + 1


def test_groups_are_bounded(spark, written, plain):
    rows = [(i % 3, "word " * (i % 40)) for i in range(600)]
    sequences = written([(i, t) for i, (_, t) in enumerate(rows)], length=64, group_pieces=50)
    check([(i, t) for i, (_, t) in enumerate(rows)], sequences, plain, 64)


def test_one_text_on_most_rows(spark, written, plain):
    rows = [(i, "same text here" if i % 3 else f"other text {i}") for i in range(400)]
    check(rows, written(rows, clash=False, length=32, group_pieces=100), plain, 32)


def test_empty_table(spark, written):
    assert written([]).count() == 0


def plain_sum_of_squares(sizes, length, open_first):
    """The rule, with all squares added up anew for each choice."""
    ready = int(open_first * (sum(sizes) / length))
    gaps = [length] * ready
    squares = lambda: sum(gaps.count(g) ** 2 for g in set(gaps) if g)
    for size in sorted(sizes, reverse=True):
        choices = []
        for gap in sorted({g for g in gaps if g >= size}):
            at = gaps.index(gap)
            gaps[at] = gap - size
            choices.append((squares(), gap - size, at))
            gaps[at] = gap
        if choices:
            gaps[min(choices)[2]] = min(choices)[1]
        else:
            gaps.append(length - size)
    return sorted(length - g for g in gaps if g < length)


@pytest.mark.parametrize("seed", range(6))
def test_placement_follows_the_rule(seed):
    rng = random.Random(seed)
    sizes = np.array([rng.randint(1, 19) for _ in range(60)])
    bins, offsets = sum_of_squares(sizes, 20, packing.OPEN_FIRST)
    levels = np.bincount(bins, weights=sizes).astype(int)
    assert sorted(levels[levels > 0].tolist()) == plain_sum_of_squares(sizes.tolist(), 20, packing.OPEN_FIRST)


def test_few_sequences_more_than_the_tokens_demand():
    rng = np.random.default_rng(3)
    for sizes in (rng.integers(1, 1024, 8000), rng.integers(1, 300, 8000), np.clip(rng.exponential(400, 8000).astype(int) + 1, 1, 1023)):
        bins, _ = sum_of_squares(sizes, 1024)
        assert len(np.unique(bins)) <= 1.01 * -(-sizes.sum() // 1024)
    bins, _ = sum_of_squares(np.full(1000, 600), 1024)  # no two fit together
    assert len(np.unique(bins)) == 1000
