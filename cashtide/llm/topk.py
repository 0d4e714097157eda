"""Exact top-k search by term-at-a-time accumulation over sparse rows.

Each vector is a sparse row: its non-zero components are terms with integer weights. Rows are dealt into blocks,
queries into blocks of their own; every query block meets every candidate block in one task. There the candidates
become postings (for each term the rows that have it and their weights), and each query scatters its weights times
the postings, term by term, into a dense array of scores. Every row has a score, also a negative one, so nothing
is skipped. A partition selection leaves the best of each block, and the blocks of a query are merged by rank.

Memory of a task: one block of each side. The scores are exact integers.

Defined cases: a vector that is null or has a null, NaN or infinite component takes no part, nor does a row without
an id. Rows with repeated ids are rows of their own: each is a candidate, of the others with its id too, and each that is
a query has its own ranks. Vectors of unequal lengths meet in their common terms. An empty vector has score 0 with all. Ties
go to the smaller id. An empty table gives an empty result. Other columns are ignored. Weights and scores are 64-bit
integers; a weight, or a score that may be, beyond them raises an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashtide.session import staged

QUERY_BLOCK, ROW_BLOCK = 2048, 8192
LIMIT = 2**63


def quantised(vectors: DataFrame, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, weights``: floor(scale * x) of every component of the vectors that take part."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    # A cast of the floor itself would saturate.
    fits = lambda x: F.abs(x * float(scale)) < float(LIMIT)
    weight = lambda x: F.when(fits(x), F.floor(x * float(scale))).otherwise(F.raise_error(F.lit("weight beyond 64 bits")).cast("long"))
    return kept.select("vec_id", F.transform("vector", weight).alias("weights"))


def postings(weights: pd.Series) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each term the places of the rows that have it, ascending, and their weights."""
    lengths = np.array([len(w) for w in weights], np.int64)
    values = np.concatenate([np.asarray(w, np.int64) for w in weights]) if lengths.sum() else np.empty(0, np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    terms = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    present = values != 0
    rows, terms, values = rows[present], terms[present], values[present]
    order = np.argsort(terms, kind="stable")
    rows, terms, values = rows[order], terms[order], values[order]
    starts = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.empty(0, int)
    ends = np.append(starts[1:], len(terms))[: len(starts)]
    return {int(terms[s]): (rows[s:e], values[s:e]) for s, e in zip(starts, ends, strict=True)}


def best_places(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; of equal ones the smaller places. Any order."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    rows = rows.sort_values(["vec_id", "row"], ignore_index=True)
    numbers, ids, lists = rows["row"].to_numpy(), rows["vec_id"].to_numpy(), postings(rows["weights"])
    largest = {term: float(np.abs(weights.astype(float)).max()) for term, (_, weights) in lists.items()}
    out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for number, query_id, weights in zip(queries["row"], queries["vec_id"], queries["weights"], strict=True):
        scores = np.zeros(len(ids), np.int64)
        bound = 0.0
        for term, weight in enumerate(weights):
            if weight and term in lists:
                places, postings_weights = lists[term]
                bound += abs(float(weight)) * largest[term]
                if bound >= LIMIT:
                    raise OverflowError(f"scores of query {query_id} may exceed 64 bits")
                scores[places] += weight * postings_weights
        # One more than k, in case the query itself is among them.
        places = best_places(scores, k + 1)
        places = places[numbers[places] != number]
        places = places[np.lexsort((ids[places], -scores[places]))][:k]
        out.append((number, query_id, ids[places], scores[places]))
    if not out:
        return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
    found = [len(i) for _, _, i, _ in out]
    return pd.DataFrame(
        {
            "query_row": np.repeat([n for n, _, _, _ in out], found),
            "query_id": np.repeat([q for _, q, _, _ in out], found),
            "vec_id": np.concatenate([i for _, _, i, _ in out]),
            "score": np.concatenate([s for _, _, _, s in out]),
        }
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    query_block: int = QUERY_BLOCK,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row of ``vec_id, weights`` for which ``is_query`` holds, against all others.

    Rows are numbered in a staged copy of the vectors, so a task that runs again sees the same numbers.
    """
    vectors = staged(vectors.select("vec_id", "weights").withColumn("row", F.monotonically_increasing_id()), "vectors")
    counts = vectors.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(is_query, True)).alias("queries")).first()
    row_blocks = max(1, -(-counts["rows"] // row_block))
    query_blocks = max(1, -(-counts["queries"] // query_block))
    place = lambda blocks: F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    columns = ("row", "vec_id", "weights")
    queries = vectors.filter(is_query).select(place(query_blocks).alias("q"), every(row_blocks).alias("r"), *columns)
    rows = vectors.select(every(query_blocks).alias("q"), place(row_blocks).alias("r"), *columns)

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        return search_block(queries, rows, k)

    schema = "query_row long, query_id long, vec_id long, score long"
    met = queries.groupBy("q", "r").cogroup(rows.groupBy("q", "r")).applyInPandas(search, schema)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
