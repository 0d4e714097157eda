"""Quality scores by Bradley-Terry ranking of document pairs.

Each document has features of its whole text: shares of byte classes, of single marks, of upper-case, repeated and marked
words, of repeated and short lines, and lengths. Labelled documents make preference pairs (a good one over a bad
one); the chance that the good one wins is the logistic function of the difference of their scores, which are linear in the
features, so the weights follow from a logistic regression on feature differences, with Newton steps.

Raw scores have no zero point. The cut is a quantile of the scores of the learned documents: the share of them that
is labelled bad lies below it. A score is the chance to win against a document at the cut, moved so that
a document at the cut has ``THRESHOLD``.

Every labelled document is learned from, and counts for the cut. Up to ``BLOCK_ROWS`` of them are ranked in one place. More are dealt
to blocks of about as many by the hash of their ids, which stay in Spark: each block makes pairs of its own, in which all of its documents
are, and a Newton step adds what the blocks have found. If one label is rare, its documents meet several blocks of the others.

Defined cases: null and empty texts have the features of an empty text and a score like others. A document with
several labels is learned from with each. Labels that are neither 0 nor 1, and labels without a document, count for
nothing. Without labels of both kinds all scores are 0.5. Repeated rows each have a row. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide.llm.common import small_batches, utf8
from cashtide.session import cut_lineage, staged

BLOCK_ROWS, PAIRS = 20_000, 20_000
#: Documents of the rarer label a block should have.
BLOCK_RARE = 200
#: Sums over blocks are of integers, so that their order does not matter.
FIXED = float(1 << 26)
RIDGE, STEPS = 1e-3, 12
THRESHOLD = 0.3

MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = np.zeros(256, np.int64)  # 0 control, 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 mark, 7 beyond ASCII
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58], CLASSES[32], CLASSES[10], CLASSES[128:] = 1, 2, 3, 4, 5, 7
CLASSES[list(MARKS)] = 6


def features(text: bytes) -> np.ndarray:
    """Shares and logarithms; all of them finite, also for an empty text."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(1, len(text))
    classes = np.bincount(CLASSES, weights=counts, minlength=8) / size
    marks = counts[list(MARKS)] / size
    words = text.split()
    n = max(1, len(words))
    distinct = len(set(words))
    lines = text.split(b"\n")
    filled = [line for line in lines if line.strip()]
    rows = max(1, len(filled))
    ends = np.bincount(np.fromiter((w[-1] for w in words), np.uint8, count=len(words)), minlength=256)[list(MARKS)] / n
    upper = sum(map(bytes.isupper, words)) / n
    shape = [
        np.log1p(len(text)),
        np.log1p(len(words)),
        size / n / 10,
        distinct / n,
        # Long texts repeat words anyway: distinct words against what the length lets expect.
        np.log1p(distinct) / np.log1p(n) if n > 1 else 1.0,
        len(set(filled)) / rows,
        np.log1p(size / rows),
        sum(len(line) < 40 for line in filled) / rows,
        upper,
        ends.sum(),
        float(not text.strip()),
    ]
    flat = np.concatenate([classes, marks, ends, shape])
    return np.concatenate([flat, np.sqrt(flat[: 8 + 2 * len(MARKS)])])


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        shifted = self.raw(rows) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(shifted, -60, 60)))


def _differences(even: np.ndarray, good: np.ndarray, bad: np.ndarray, pairs: int, seed: int) -> np.ndarray:
    """Every document of either kind is in a pair, as far as the number of pairs allows."""
    rng = np.random.default_rng(seed)
    left = np.concatenate([rng.permutation(good) for _ in range(-(-pairs // len(good)))])[:pairs]
    right = np.concatenate([rng.permutation(bad) for _ in range(-(-pairs // len(bad)))])[:pairs]
    return even[left] - even[right]


def _slopes(differences: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the pairs' log likelihood."""
    lost = 1 / (1 + np.exp(np.clip(differences @ weights, -60, 60)))
    return differences.T @ lost, (differences * (lost * (1 - lost))[:, None]).T @ differences


def _newton(ranking: Ranking, slopes: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], pairs: int) -> None:
    for _ in range(STEPS):
        first, second = slopes(ranking.weights)
        gradient, curve = first / pairs - RIDGE * ranking.weights, second / pairs + RIDGE * np.eye(len(ranking.weights))
        step = np.linalg.solve(curve, gradient)
        ranking.weights += step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break


def rank_pairs(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, seed: int = 0) -> Ranking | None:
    """The weights that make the good document of each pair likeliest to win."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = rows.mean(axis=0), rows.std(axis=0)
    ranking = Ranking(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(rows.shape[1]), 0.0)
    even = np.clip((rows - ranking.mean) / ranking.scale, -8, 8)
    differences = _differences(even, good, bad, pairs, seed)
    _newton(ranking, lambda weights: _slopes(differences, weights), pairs)
    raw = ranking.raw(rows)
    ranking.cut = float(np.quantile(raw, len(bad) / (len(good) + len(bad))))
    return ranking


def featured(docs: DataFrame) -> DataFrame:
    """``key, label, features`` of ``key, label, text`` rows."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["key", "label", "features"])

    return docs.select("key", "label", utf8("text").alias("text")).mapInArrow(compute, "key long, label int, features array<double>")


def _block_pairs(good: int, bad: int) -> int:
    return max(PAIRS, good, bad)


def rank_blocks(blocks: DataFrame, good: int, bad: int) -> Ranking:
    """``rank_pairs`` over ``block, part, rows, good, start, own, values``: rows of features, the first ``good`` of them of good documents.

    ``own`` rows of a block, from ``start``, are in no other one. What a pass returns is of the size of the features, for each task.
    """
    def over(work: Callable[[np.ndarray, dict], list[np.ndarray]], rows: DataFrame, fixed: bool = True) -> list[np.ndarray]:
        """The sums of ``work`` over all blocks; in integers, or exactly in the order of the blocks."""

        def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for row in batch.to_pylist():
                    found = [np.asarray(x, float) for x in work(np.frombuffer(row["values"]).reshape(row["rows"], -1), row)]
                    if fixed:
                        found = [np.rint(x * FIXED).astype(np.int64) for x in found]
                        total = found if total is None else [a + b for a, b in zip(total, found)]
                    else:
                        yield pa.RecordBatch.from_pydict({"at": [row["block"] * (1 << 20) + row["part"]], "found": [pickle.dumps(found)]})
            if total is not None:
                yield pa.RecordBatch.from_pydict({"at": [0], "found": [pickle.dumps(total)]})

        parts = [pickle.loads(r["found"]) for r in sorted(rows.mapInArrow(compute, "at long, found binary").collect(), key=lambda r: r["at"])]
        return [sum(column) / (FIXED if fixed else 1.0) for column in zip(*parts)]

    own = lambda values, row: values[row["start"] : row["start"] + row["own"]]
    n = good + bad
    mean = over(lambda values, row: [own(values, row).sum(axis=0)], blocks, fixed=False)[0] / n
    scale = np.sqrt(over(lambda values, row: [((own(values, row) - mean) ** 2).sum(axis=0)], blocks, fixed=False)[0] / n)
    ranking = Ranking(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(len(mean)), 0.0)

    def paired(values: np.ndarray, row: dict) -> np.ndarray:
        even = np.clip((values - ranking.mean) / ranking.scale, -8, 8)
        kinds = np.arange(len(values))
        return _differences(even, kinds[: row["good"]], kinds[row["good"] :], _block_pairs(row["good"], row["rows"] - row["good"]), row["block"])

    mixed = blocks.filter("good > 0 AND good < rows")  # by chance a block may have one kind only: that makes no pair
    pairs = mixed.select(F.sum(F.greatest(F.lit(PAIRS), "good", F.expr("rows - good")))).first()[0]
    if pairs:
        _newton(ranking, lambda weights: over(lambda values, row: list(_slopes(paired(values, row), weights)), mixed), pairs)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pydict({"raw": ranking.raw(own(np.frombuffer(row["values"]).reshape(row["rows"], -1), row))})

    # The cut lies between two neighbours in the order of all raw scores.
    ordered = blocks.mapInArrow(scored, "raw double").orderBy("raw")
    ordered = cut_lineage(ordered.select("raw", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).orderBy("part").collect()

    def at(rank: int) -> float:
        for part in sizes:
            if rank < part["n"]:
                return ordered.filter(F.col("place") == part["first"] + rank).first()["raw"]
            rank -= part["n"]

    place = bad / n * (n - 1)
    a, b = at(int(place)), at(min(n - 1, int(place) + 1))
    ranking.cut = a + (b - a) * (place - int(place))
    return ranking


def _blocks(rows: DataFrame, good: int, bad: int, block_rows: int) -> DataFrame:
    """The features of about ``block_rows`` documents in a row, as ``rank_blocks`` takes them."""
    common, rare = max(good, bad), min(good, bad)
    many = max(1, min((good + bad) // block_rows, rare // BLOCK_RARE))
    parts = -(-common // (many * block_rows))
    rare_label = int(good <= bad)

    def pack(table: pa.Table) -> pa.Table:
        labels, keys = table["label"].to_numpy(), table["key"].to_numpy()
        values = table["features"].combine_chunks().flatten().to_numpy().reshape(len(labels), -1)
        order = np.lexsort([*values.T[::-1], keys, -labels])  # the order of the rows must not depend on the tasks
        n, first, part = len(labels), int(labels.sum()), table["part"][0].as_py()
        start, own = (0, n) if part == 0 else (first, n - first) if rare_label else (0, first)
        found = {"block": table["block"][0].as_py(), "part": part, "rows": n, "good": first, "start": start, "own": own, "values": values[order].tobytes()}
        return pa.Table.from_pylist([found])

    places = F.when(F.col("label") == rare_label, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")))
    dealt = rows.select(F.pmod("key", F.lit(many)).alias("block"), F.explode(places).alias("part"), "key", "label", "features")
    return dealt.groupBy("block", "part").applyInArrow(pack, "block long, part long, rows long, good long, start long, own long, values binary")


def learn(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", sample_rows: int | None = None, block_rows: int = BLOCK_ROWS) -> Ranking | None:
    """``docs``: ``doc_id, text``; ``labels``: ``doc_id`` and ``label``; ``usable`` picks the labels to learn from.

    All of them, unless ``sample_rows`` asks for no more than so many.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(usable & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.distinct() if sample_rows is None else known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    # However many rows have a labelled id, one of them is learned from.
    # Labels grow with the documents, so they are merged by id at any size and never broadcast.
    texts = docs.select("doc_id", "text").join(known.hint("merge"), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = staged(featured(texts.withColumn("key", F.xxhash64("doc_id"))), "features")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    if not good or not bad:
        return None
    if good + bad > block_rows:
        return rank_blocks(staged(_blocks(rows, good, bad, block_rows), "blocks"), good, bad)
    few = rows.select("label", "features").toArrow()
    label_of = few["label"].to_numpy()
    values = few["features"].combine_chunks().flatten().to_numpy().reshape(len(label_of), -1)
    order = np.lexsort([*values.T[::-1], label_of])  # the order of the rows must not depend on the tasks
    return rank_pairs(values[order], label_of[order])


def score(docs: DataFrame, ranking: Ranking | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranking)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if sent.value is None:
                found = np.full(len(texts), 0.5)
            else:
                found = sent.value.scores(np.stack([features(t) for t in texts])) if texts else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), utf8(text_column).alias("text")).mapInArrow(compute, "doc_id long, score double")
