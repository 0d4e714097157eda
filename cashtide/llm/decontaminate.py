"""Benchmark decontamination: rare n-gram seeds, a counting filter, then Smith-Waterman alignment.

A copy that reaches the wanted score has few breaks, hence a least number of n-grams of its item left (``seed_size``:
three words or, in short items and for low scores, two or one). If at least L of G n-grams are left, then any G - L + 1 of
them hold one that is left. So the seeds of an item are its G - L + 1 rarest n-grams, by the number of documents that
hold each, counted over all documents; the L - 1 most frequent ones, usual phrases among them, are no seeds. A text that
holds a seed is held against the item: stretches with L different n-grams of it are aligned (match 2, mismatch and gap
-1); all others cannot reach the score. Hence the rows found are those of aligning each text with each item, however often a
passage, or an edited form of it, occurs. The score is the share of the best possible alignment score of the item.

Texts stay where they are read: nothing of them is shuffled. What travels are the items, in blocks of at most
``BLOCK_BYTES``, a bound that is checked by cutting, and a count for each of their n-grams. A block takes two passes, one that
counts and one that searches; more items only mean more passes. Words are lower-cased and end at punctuation and
blanks, which make no difference.

Defined cases: null and empty texts and items match nothing. Items of one or two words match where they occur as
they are; ``min_words`` leaves out items with fewer words. Repeated documents and items each have rows of their own. Rows with
null ids take part and show null. Very long texts are aligned only in the stretches around their n-grams. Empty tables
give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide.llm.common import small_batches, spread

#: Words of the shortest items that are searched.
MIN_WORDS = 1
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.8
#: Text of the items that is sent to the tasks at once.
BLOCK_BYTES = 4 << 20

#: Between words: all ASCII but letters and digits, and usual punctuation and blanks beyond ASCII.
BETWEEN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
MORE_BETWEEN = "\u00a0\u00ab\u00bb\u2013\u2014\u2018\u2019\u201c\u201d\u201e\u2026\u3000\u3001\u3002"
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    if not text:
        return []
    if not text.isascii():
        for mark in MORE_BETWEEN:
            text = text.replace(mark, " ")
    return text.lower().encode().translate(BETWEEN).split()


def seed_size(length: int, min_score: float) -> tuple[int, int]:
    """Words of the seeds of an item, and how many of its n-grams are left at least where ``min_score`` is reached.

    With m matching words in r runs the score is at most 2 m - (r - 1), and m - (n - 1) r n-grams are left. For n of 2 or
    more that is least at m = length.
    """
    wanted = ceil(MATCH * length * min_score - 1e-9)
    for n in (3, 2):
        runs = MATCH * length - wanted + 1
        if (left := length - (n - 1) * runs) >= 1:
            return n, left
    return 1, max(1, ceil(wanted / MATCH))


@dataclass
class Items:
    """A block of test items, with their words as numbers and their n-grams as keys."""

    ids: list[int | None]
    texts: list[str | None]
    min_score: float = MIN_SCORE
    min_words: int = MIN_WORDS
    vocabulary: dict[bytes, int] = field(init=False)
    words: list[np.ndarray] = field(init=False)
    sizes: list[int] = field(init=False)  # of n-grams
    needed: list[int] = field(init=False)  # n-grams that are left of each item
    keys: np.ndarray = field(init=False)  # all that occur, ascending
    grams: list[np.ndarray] = field(init=False)  # by place in each item, the number of the key

    def __post_init__(self) -> None:
        split = [words_of(t) for t in self.texts]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for s in split for w in s}))}
        self.words = [np.array([self.vocabulary[w] for w in s], np.int64) for s in split]
        seeds = [seed_size(len(w), self.min_score) for w in self.words]
        self.sizes = sorted({size for size, _ in seeds})
        self.needed = [left for _, left in seeds]
        keys = [
            ngram_keys(w, n) if len(w) >= max(n, self.min_words) else np.empty(0, np.uint64)
            for w, (n, _) in zip(self.words, seeds, strict=True)
        ]
        self.keys, number = np.unique(np.concatenate([np.empty(0, np.uint64), *keys]), return_inverse=True)
        self.grams = np.split(number, np.cumsum([len(k) for k in keys])[:-1]) if keys else []

    def slack(self, item: int) -> int:
        """Words that may be inserted into a copy."""
        return MATCH * len(self.words[item]) - ceil(MATCH * len(self.words[item]) * self.min_score - 1e-9)

    def numbers(self, text: str | None) -> np.ndarray:
        """The words of a text; 0 for words that no item has."""
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, count=len(words))

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the text where a key begins, and the number of the key; by that number, then by place."""
        unknown = np.append(0, np.cumsum(numbers == 0))
        starts, which = [np.empty(0, int)], [np.empty(0, int)]
        for n in self.sizes:
            if len(numbers) < n or not len(self.keys):
                continue
            start = np.flatnonzero(unknown[n:] == unknown[:-n])
            key = ngram_keys(numbers, n)[start]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            same = self.keys[found] == key
            starts.append(start[same])
            which.append(found[same])
        at, number = np.concatenate(starts), np.concatenate(which)
        order = np.argsort(number, kind="stable")
        return at[order], number[order]


@dataclass
class Searched:
    """A block of items and their seeds: of the key with number k, the items ``item[bounds[k]:bounds[k + 1]]``."""

    items: Items
    bounds: np.ndarray
    item: np.ndarray

    def candidates(self, numbers: np.ndarray) -> np.ndarray:
        """The items with a seed among the keys of these distinct numbers, ascending."""
        first = self.bounds[numbers]
        return np.unique(self.item[spread(first, self.bounds[numbers + 1] - first)])


def rare_seeds(items: Items, frequency: np.ndarray) -> Searched:
    """The rarest n-grams of each item, so many that one of them is left in every copy. ``frequency``: of each key."""
    number, item = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, own in enumerate(items.grams):
        rarest = own[np.argsort(frequency[own], kind="stable")][: max(0, len(own) - items.needed[i] + 1)]
        number.append(np.unique(rarest))
        item.append(np.full(len(number[-1]), i))
    key, item = np.concatenate(number), np.concatenate(item)
    bounds = np.append(0, np.cumsum(np.bincount(key, minlength=len(items.keys))))
    return Searched(items, bounds, item[np.argsort(key, kind="stable")])


def ngram_keys(numbers: np.ndarray, n: int) -> np.ndarray:
    """64-bit keys of the n-grams. A chance collision only starts an alignment that fails."""
    count = len(numbers) - n + 1
    key = np.full(count, n, np.uint64)
    for k in range(n):
        key = (key ^ numbers[k : k + count].astype(np.uint64)) * MIX
        key ^= key >> np.uint64(29)
    return key


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score and the place in the text after its last word.

    Rows run over the item. Gaps along a row are a running maximum, so each row is a few array operations.
    """
    width = len(text)
    row, best, end = np.zeros(width + 1, np.int64), 0, 0
    steps = -GAP * np.arange(width + 1)
    for word in item:
        new = np.zeros(width + 1, np.int64)
        new[1:] = np.maximum(row[:-1] + np.where(text == word, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + steps) - steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def distinct(ascending: np.ndarray) -> np.ndarray:
    return ascending[np.flatnonzero(np.diff(ascending, prepend=-1))]


def matches(block: Searched, text: str | None) -> list[tuple[int, float, int, int]]:
    """``(item, score, first word, last word + 1)``: the best alignment of each item that may reach the score in the text."""
    items = block.items
    numbers = items.numbers(text)
    at, which = items.hits(numbers)
    out = []
    for i in block.candidates(distinct(which)):
        own = items.grams[i]
        first = np.searchsorted(which, own)
        counts = np.searchsorted(which, own, "right") - first
        if np.count_nonzero(counts) < items.needed[i]:
            continue
        size, slack = len(items.words[i]), items.slack(i)
        places = np.repeat(np.arange(len(own)), counts)
        begin = at[spread(first, counts)] - places
        order = np.argsort(begin, kind="stable")
        begin, places = begin[order], places[order]
        # Stretches that overlap or touch are one.
        cuts = np.flatnonzero(np.diff(begin) > size + 2 * slack) + 1
        best = (-1, 0, 0)
        for starts, held in zip(np.split(begin, cuts), np.split(places, cuts), strict=True):
            if len(np.unique(held)) < items.needed[i]:
                continue
            a, b = max(0, int(starts[0]) - slack), min(len(numbers), int(starts[-1]) + size + slack)
            score, end = align(items.words[i], numbers[a:b])
            if score > best[0]:
                back, begun = align(items.words[i][::-1], numbers[a : a + end][::-1])
                best = (score, a + end - begun, a + end)
        if best[0] >= 0:
            out.append((int(i), best[0] / (MATCH * size), best[1], best[2]))
    return out


def blocks(
    benchmark: DataFrame, item_column: str, text_column: str, block_bytes: int, min_score: float, min_words: int
) -> Iterator[Items]:
    """The items in blocks of at most ``block_bytes`` of text (or of one item)."""
    wanted = benchmark.select(F.col(item_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text"))
    wanted = wanted.filter(F.length("text") > 0)
    ids: list[int | None] = []
    texts: list[str | None] = []
    held = 0
    for row in wanted.toLocalIterator():  # a partition at a time
        size = len(row["text"].encode())
        if ids and held + size > block_bytes:
            yield Items(ids, texts, min_score, min_words)
            ids, texts, held = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        held += size
    if ids:
        yield Items(ids, texts, min_score, min_words)


def frequencies(texts: DataFrame, items: Items) -> np.ndarray:
    """The number of ``texts`` with each key. Tasks count, the totals are added by key: a number for each key of the block."""
    sent = texts.sparkSession.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        seen = np.zeros(len(items.keys), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[distinct(items.hits(items.numbers(text))[1])] += 1
        present = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(present), pa.array(seen[present])], ["key", "n"])

    counted = texts.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    sent.unpersist()
    total = np.zeros(len(items.keys), np.int64)
    total[counted["key"].to_numpy()] = counted["n"].to_numpy()
    return total


def prepared(
    texts: DataFrame,
    benchmark: DataFrame,
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    min_score: float = MIN_SCORE,
    min_words: int = MIN_WORDS,
) -> Iterator[Broadcast[Searched]]:
    """The blocks of items with their seeds, chosen by counts over all ``texts``. Runs a job a block."""
    for items in blocks(benchmark, item_column, item_text_column, block_bytes, min_score, min_words):
        if len(items.keys):
            yield texts.sparkSession.sparkContext.broadcast(rare_seeds(items, frequencies(texts, items)))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word``: a row for each document and item it holds a copy of.

    Eager in the counts of n-grams. ``options`` are those of ``prepared``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    result = spark.createDataFrame([], schema)
    for block in prepared(texts, benchmark, min_score=min_score, **options):

        def find(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            b = block.value
            for batch in batches:
                out = [
                    (doc_id, b.items.ids[item], score, first, last)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for item, score, first, last in matches(b, text)
                    if score >= min_score
                ]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        result = result.unionAll(texts.mapInArrow(find, schema))
    return result


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, text_column: str = "text", **options) -> DataFrame:
    """The documents without a copy of a test item, all columns. Rows are judged where they are read, by their texts."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(text_column).cast("string").alias("text"))
    rows = docs.select(F.struct("*").alias("row"), F.col(text_column).cast("string").alias("text"))
    for block in prepared(texts, benchmark, min_score=min_score, **options):

        def keep(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            b = block.value
            for batch in batches:
                clean = [all(m[1] < min_score for m in matches(b, t)) for t in batch.column(1).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        rows = rows.mapInArrow(keep, rows.schema)
    return rows.select("row.*")
