"""The registered queries: against SQL where there is some, else against plain Python, over whole small tables."""

import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of
from cashtide.llm import oracle
from cashtide.llm.queries import registered, tokenizer_path
from tests.llm.test_simhash import plain_components, plain_fingerprint

DATA = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the generated tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registered()) == list(range(1, 14))
    assert set(registered()) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert set(oracle.statements()) <= set(registered())


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_same_rows_as_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = entry.queries()[name](spark, DATA)
    result = db.execute(oracle.statements()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_token_files(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer, start = tokenizers.Tokenizer.from_file(tokenizer_path()), 0
    got = {r["doc_id"]: r for r in entry.queries()["op2_token_parquet"](spark, DATA).collect()}
    assert got.keys() == texts.keys()
    for doc_id in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[doc_id]["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        assert got[doc_id][1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_packed_sequences(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    got, tokens = entry.queries()["op13_sum_of_squares_packing"](spark, DATA).collect(), 0
    of = {(r["doc_id"], r["piece"]): r for r in got}
    for doc_id, row in texts.items():
        ids = np.array([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            r = of.pop((doc_id, piece))
            part = ids[start : start + (first if piece == 0 else 1024)]
            assert (r["start"], r["length"], r["ids_crc32"]) == (start, len(part), zlib.crc32(part.tobytes()))
        tokens += len(ids)
    assert not of
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist() and sum(n for _, n in parts) <= 1024
    assert len(places) <= 1.02 * -(-tokens // 1024)


def test_decontamination_finds_the_items_texts_hold(spark, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    flat = lambda t: " ".join((t or "").split())
    whole = {(d, i) for d, r in texts.items() for i, t in items.items() if flat(t) in flat(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in entry.queries()["op3_decontamination"](spark, DATA).collect()}
    assert whole and whole <= got
    grams = lambda t: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)}
    assert all(grams(flat(texts[d]["text"])) & grams(flat(items[i])) for d, i in got)


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = entry.queries()["op4_quality_bradley_terry"](spark, DATA).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= 0.9


def test_near_duplicates_equal_brute_force(spark, texts):
    fps = {i: plain_fingerprint(" ".join((r["text"] or "").split())) for i, r in texts.items()}
    want = plain_components(fps, 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in entry.queries()["op8_simhash_near_dedup"](spark, DATA).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in texts}


def test_language_of_held_out_documents(spark, texts):
    got = entry.queries()["op10_language_id"](spark, DATA).collect()
    assert len(got) == len(texts) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and texts[r["doc_id"]]["lang"]]
    assert np.mean([r["lang_pred"] == texts[r["doc_id"]]["lang"] for r in held]) >= 0.95
