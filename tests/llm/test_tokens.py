import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cashtide.llm.tokens import PieceCache, read_tokens, with_crc32, write_tokens
from cashtide.session import scratch_path

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain(path):
    tokenizer = tokenizers.Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(path, plain):
    rng, cache = random.Random(3), PieceCache(path)
    parts = [" ", " ", " ", "\n", "\t", "a", "Foo", "'s", ".", "12", "é", "　", "\x1c", "<|endoftext|>", "\r\n", "漢", "$x"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)] + ["", " ", "word " * 3000]
    assert cache.encode(texts) == [np.array(plain(t), "<u4").tobytes() for t in texts]
    assert cache.encode(texts) == cache.encode(list(texts))  # pieces known by now


def test_known_pieces_survive_a_full_cache(path, plain, monkeypatch):
    monkeypatch.setattr("cashtide.llm.tokens.CACHE_PIECES", 50)
    rng, cache = random.Random(4), PieceCache(path)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randint(0, 60)}." for _ in range(30)) for _ in range(5)]
        assert cache.encode(texts) == [np.array(plain(t), "<u4").tobytes() for t in texts]


def test_new_words_of_letters_need_no_pretokenizer(path, plain, monkeypatch):
    rng, cache = random.Random(5), PieceCache(path)
    letters = [*"aeinorstAEXz", *"ÀÖØöøÿĀſƀɏ"]
    texts = ["\n".join(" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(6)) for _ in range(3)) for _ in range(300)]
    want = [np.array(plain(t), "<u4").tobytes() for t in texts]
    encoded = []
    monkeypatch.setattr(cache, "ids", lambda text: encoded.append(text))
    assert cache.encode(texts) == want and not encoded


def test_new_words_with_marks_need_no_pretokenizer(path, plain, monkeypatch):
    cache = PieceCache(path)
    texts = ["alpha!!! alpha$$$ (x) beta", "beta###\ngamma... gamma?! Été,!!\nÉté&&&"]
    want = [np.array(plain(t), "<u4").tobytes() for t in texts]
    whole, encoded = cache.ids, []
    monkeypatch.setattr(cache, "ids", lambda text: encoded.append(text) or whole(text))
    assert cache.encode(texts) == want and [t.strip() for t in encoded] == ["(x)"]


def test_pieces_at_hand_survive_a_full_cache(path, plain, monkeypatch):
    monkeypatch.setattr("cashtide.llm.tokens.CACHE_PIECES", 3)
    cache, told = PieceCache(path), []
    texts = ["alpha beta. gamma\ndelta", "beta epsilon\nalpha delta"]
    want = [np.array(plain(t), "<u4").tobytes() for t in texts]
    assert cache.encode(texts) == want
    monkeypatch.setattr(cache, "learn", told.append)
    assert cache.encode(texts) == want and not told


def test_texts_are_cut_in_groups(path, plain, monkeypatch):
    monkeypatch.setattr("cashtide.llm.tokens.AT_ONCE", 20)
    texts = ["", "one two", "a  b", "word " * 30, "tail.\nend", "x" * 50, " ", "déjà vu"]
    assert PieceCache(path).encode(texts) == [np.array(plain(t), "<u4").tobytes() for t in texts]
    assert PieceCache(path).encode(["", "  "]) == [b"", np.array(plain("  "), "<u4").tobytes()] and PieceCache(path).encode([]) == []


def test_other_tokenizers_encode_whole_texts():
    other = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, cache = tokenizers.Tokenizer.from_file(other), PieceCache(other)
    texts = ["Some words, and some.\nMore words", "", "one", "a  b"]
    assert not cache.cuts
    assert cache.encode(texts) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.fixture
def written(spark, documents, path):
    def write(rows, **options):
        folder = scratch_path(spark, "tokens")
        write_tokens(documents(rows), folder, path, **options)
        return folder

    return write


def test_round_trip_in_order_of_ids(spark, written, plain):
    texts = {9: "one two", 3: None, 5: "", 1: "a\nb  c", 7: "long " * 20_000}
    folder = written([(i, t, None, None) for i, t in texts.items()], shard_bytes=40_000)
    start, want = 0, []
    for i in sorted(texts):
        ids = [*plain(texts[i] or ""), 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in with_crc32(read_tokens(spark, folder)).collect()) == want
    assert read_tokens(spark, folder).filter("doc_id = 9").first()["tokens"] == [*plain("one two"), 2]


def test_null_and_repeated_ids(spark, written):
    folder = written([(None, "x", None, None), (1, "b", None, None), (1, "a", None, None), (1, "a", None, None)])
    rows = read_tokens(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 1] and [r["start"] for r in rows] == [0, 2, 4, 6]


def test_empty_table(spark, written):
    assert read_tokens(spark, written([])).count() == 0


def test_layout_allows_partial_reads(spark, written):
    folder = written([(i, f"text number {i}", None, None) for i in range(5000)])
    name = next(f for f in spark.read.parquet(f"{folder}/tokens").inputFiles())
    meta = pq.ParquetFile(name.removeprefix("file://")).metadata
    group = meta.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    tokens = next(c for p, c in columns.items() if p.startswith("tokens"))
    assert {"RLE_DICTIONARY"} <= set(tokens.encodings) and tokens.has_offset_index
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_column_index
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = read_tokens(spark, folder, tokens=False).filter(F.col("doc_id") == 7)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(doc_id,7)" in plan and "tokens:array" not in plan
