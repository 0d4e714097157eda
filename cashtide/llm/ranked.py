"""Ranked lexical search over range-maximum tables.

``build_index`` writes an inverted index: every scan task gathers its documents into segments of a bounded number of
postings and writes for each segment one row a term (the places of the documents that hold it, ascending by id, and its
occurrences) and one row of the documents themselves. Nothing is shuffled, and a source that is hot is so many segments.
Rows of a segment are in order of terms, so a search for few terms reads few pages.

``search`` brings the lists of the items' terms together by segment and block of items. In a task each list becomes
a sparse table of range maxima of its impacts. An item starts with one interval, all documents of the segment; the
summed answers of its lists' tables bound every score inside. The intervals with the highest bounds go first: the
document of the greatest single impact is scored and the interval split there. Intervals of few documents are scored
out. What is bounded below the k-th score so far is left. The best of all segments are ranked.

Scores are exact 64-bit integers: no term, list or document is left out. Memory of a task is that of one segment's lists.

Defined cases: a null text has no terms, and documents without terms take no part and do not count. Repeated
rows and ids are documents of their own. Null ids rank after all others of the same score. Rows of one item id (also null)
are one item; items without a known term get no rows. Of ties the smaller id comes first. Very long texts are cut into words
piece by piece. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cashtide.llm.common import small_batches, spread, utf8
from cashtide.session import staged

#: Maximal runs that are terms, as a pattern of both Java and RE2. Only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same for UTF-8 bytes: what separates terms becomes a blank.
SPACED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Postings of one segment, words counted at once, bytes of text split at once.
SEGMENT_POSTINGS, CHUNK_WORDS, PIECE_BYTES = 1 << 21, 1 << 19, 1 << 20
#: Terms of the items of one block.
BLOCK_TERMS = 1 << 14
#: Intervals of at most so many documents are scored out; so many intervals are split at once.
LEAF, AT_ONCE = 64, 256

INDEX_SCHEMA = "segment long, term string, n int, words long, docs array<int>, counts array<int>, ids array<long>"


# --- the index ----------------------------------------------------------------


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces of a bounded size."""
    spaced = text.translate(SPACED)
    start = 0
    while len(spaced) - start > PIECE_BYTES:
        end = spaced.find(b" ", start + PIECE_BYTES)
        if end < 0:
            break
        yield spaced[start:end].split()
        start = end
    yield spaced[start:].split()


class Segment:
    """Documents of one segment, and how often each holds each term, chunk by chunk."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.postings = 0
        self.vocabularies: list[pa.Array] = []
        self.chunks: list[np.ndarray] = []  # document, code, count
        self.words: list[bytes] = []
        self.of: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, text: bytes) -> None:
        place, length = len(self.ids), 0
        for words in words_of(text):
            if words:
                self.words += words
                self.of.append((place, len(words)))
                length += len(words)
            if len(self.words) >= CHUNK_WORDS:
                self.count()
        if length:
            self.ids.append(doc_id)
            self.lengths.append(length)

    def count(self) -> None:
        """Turns the words gathered so far into counts."""
        if not self.words:
            return
        coded = pa.array(self.words, pa.large_binary()).dictionary_encode()
        places, lengths = np.array(self.of).T
        size = len(coded.dictionary)
        keys, counts = np.unique(np.repeat(places, lengths) * size + coded.indices.to_numpy(), return_counts=True)
        self.vocabularies.append(coded.dictionary)
        self.chunks.append(np.stack([keys // size, keys % size, counts]).astype(np.int32))
        self.postings += len(keys)
        self.words, self.of = [], []

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        self.count()
        if not self.ids:
            return
        terms = pa.concat_arrays(self.vocabularies).dictionary_encode()
        bases = np.cumsum([0] + [len(v) for v in self.vocabularies])
        # Documents by id, null last; terms in order.
        missing = np.array([i is None for i in self.ids])
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        by_id = np.lexsort((ids, missing))
        place_of = np.empty(len(ids), np.int64)
        place_of[by_id] = np.arange(len(ids))
        by_term = pc.sort_indices(terms.dictionary).to_numpy()
        rank_of = np.empty(len(by_term), np.int64)
        rank_of[by_term] = np.arange(len(by_term))
        code_of = rank_of[terms.indices.to_numpy()]
        doc = np.concatenate([place_of[c[0]] for c in self.chunks])
        term = np.concatenate([code_of[base + c[1]] for base, c in zip(bases, self.chunks, strict=False)])
        count = np.concatenate([c[2] for c in self.chunks])
        keys = term * len(ids) + doc
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))  # a long text may be in several chunks
        counts = np.add.reduceat(count[order], firsts).astype(np.int32)
        keys = keys[firsts]
        term, doc = keys // len(ids), (keys % len(ids)).astype(np.int32)
        offsets = np.searchsorted(term, np.arange(len(by_term) + 1)).astype(np.int32)
        lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
        n, none = len(by_term), pa.nulls
        lengths = np.array(self.lengths, np.int32)[by_id]
        schema = pa.schema(
            [("segment", pa.int64()), ("term", pa.string()), ("n", pa.int32()), ("words", pa.int64())]
            + [("docs", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64()))]
        )
        head = [[number], [None], [len(ids)], [int(lengths.sum())], [lengths], [None], [pa.array(ids[by_id], mask=missing[by_id])]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(head, schema, strict=True)], schema=schema)
        columns = [
            pa.array(np.full(n, number)),
            terms.dictionary.take(pa.array(by_term)).cast(pa.binary()).cast(pa.string()),
            pa.array(np.diff(offsets).astype(np.int32)),
            none(n, pa.int64()),
            lists(doc, pa.int32()),
            lists(counts, pa.int32()),
            none(n, pa.list_(pa.int64())),
        ]
        whole = pa.RecordBatch.from_arrays(columns, schema=schema)
        for start in range(0, n, 4096):
            yield whole.slice(start, 4096)


def build_index(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", segment_postings: int = SEGMENT_POSTINGS) -> None:
    """Writes the index of ``docs`` to the folder ``path``: ``INDEX_SCHEMA``, a row without a term for each segment's documents."""
    small_batches(docs.sparkSession)
    wanted = docs.select(F.col(id_column).cast("long").alias("doc_id"), utf8(text_column).alias("text"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, segment = TaskContext.get().partitionId() << 32, Segment()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                segment.add(doc_id, text.as_py())
                if segment.postings >= segment_postings:
                    yield from segment.rows(number)
                    number, segment = number + 1, Segment()
        yield from segment.rows(number)

    wanted.mapInArrow(gather, INDEX_SCHEMA).write.option("compression", "zstd").parquet(path)


# --- range maxima -------------------------------------------------------------


class Tables:
    """Sparse tables of range maxima over several lists, the longer lists first.

    Level j has for each place the place of the greatest value among 2^j from there; it covers the lists that are
    at least that long.
    """

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values = values
        levels, bases, base = [np.arange(len(values), dtype=np.int32)], [0], len(values)
        ends = np.cumsum(lengths)
        while (long := int(np.searchsorted(-lengths, -(2 << len(levels) - 1), "right"))) > 0:
            half, last = 1 << len(levels) - 1, levels[-1]
            n = int(ends[long - 1]) - 2 * half + 1
            left, right = last[:n], last[half : half + n]
            levels.append(np.where(values[left] >= values[right], left, right))
            bases.append(base)
            base += n
        self.places, self.bases = np.concatenate(levels), np.array(bases)
        longest = int(lengths[0]) if len(lengths) else 0
        self.level = np.zeros(longest + 1, np.int8)
        for j in range(1, len(levels)):
            self.level[1 << j :] = j

    def best(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the greatest value from start to before end, and the value; 0 for empty ranges."""
        empty = end <= start
        j = self.level[np.where(empty, 0, end - start)]
        base = self.bases[j]
        first = np.where(empty, 0, start)
        left, right = self.places[base + first], self.places[base + np.where(empty, 0, end - (1 << j.astype(np.int64)))]
        place = np.where(self.values[left] >= self.values[right], left, right)
        return place, np.where(empty, 0, self.values[place])


class Lists:
    """The lists of one segment that a block of items needs."""

    def __init__(self, docs: list[np.ndarray], counts: list[np.ndarray], lengths: np.ndarray, n_docs: int, n_words: int):
        order = np.argsort([-len(d) for d in docs], kind="stable")
        self.number = np.empty(len(docs), np.int64)
        self.number[order] = np.arange(len(docs))
        sizes = np.array([len(docs[i]) for i in order], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.size = len(lengths)
        self.docs = np.concatenate([docs[i] for i in order]).astype(np.int64)
        count = np.concatenate([counts[i] for i in order]).astype(np.int64)
        slope = 100 - 50 + 50 * lengths.astype(np.int64) * n_docs // n_words
        self.impacts = 1_000_000_000 * count // (1000 * count + 20 * slope[self.docs])
        self.keys = np.repeat(np.arange(len(sizes)), sizes) * self.size + self.docs
        self.tables = Tables(self.impacts, sizes)

    def bounded(self, weights: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals (rows) of some lists (columns): what no score inside exceeds, and the document of the greatest impact."""
        place, value = self.tables.best(start, end)
        value = value * weights
        top = value.argmax(1)
        return value.sum(1), self.docs[place[np.arange(len(place)), top]]

    def search(self, which: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best, best first; ties to the document that comes first."""
        lo, hi = np.array([0]), np.array([self.size])
        start, end = self.starts[which][None], self.ends[which][None]
        bound, split = self.bounded(weights, start, end)
        best_docs, best_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        sums = np.zeros(self.size, np.int64)
        while len(lo):
            take = np.argpartition(-bound, AT_ONCE)[:AT_ONCE] if len(lo) > AT_ONCE else np.arange(len(lo))
            rest = np.ones(len(lo), bool)
            rest[take] = False
            leaf = take[hi[take] - lo[take] <= LEAF]
            inner = take[hi[take] - lo[take] > LEAF]
            found = [best_docs]
            if len(leaf):
                lengths = (end[leaf] - start[leaf]).ravel()
                places = spread(start[leaf].ravel(), lengths)
                docs = self.docs[places]
                np.add.at(sums, docs, self.impacts[places] * np.repeat(np.tile(weights, len(leaf)), lengths))
                found.append(np.unique(docs))
            parts = [(lo[rest], hi[rest], start[rest], end[rest], bound[rest], split[rest])]
            if len(inner):
                at = split[inner]
                wanted = which[None] * self.size + at[:, None]
                place = np.searchsorted(self.keys, wanted)
                held = self.keys[np.minimum(place, len(self.keys) - 1)] == wanted
                sums[at] = (np.where(held, self.impacts[np.minimum(place, len(self.keys) - 1)], 0) * weights).sum(1)
                found.append(at)
                for a, b, s, e in ((lo[inner], at, start[inner], place), (at + 1, hi[inner], place + held, end[inner])):
                    some = (b > a) & (e > s).any(1)
                    a, b, s, e = a[some], b[some], s[some], e[some]
                    parts.append((a, b, s, e, *self.bounded(weights, s, e)))
            docs = np.concatenate(found)
            docs = docs[sums[docs] > 0]
            best_docs = docs[np.lexsort((docs, -sums[docs]))[:k]]
            best_scores = sums[best_docs]
            least, last = (best_scores[-1], best_docs[-1]) if len(best_docs) == k else (0, self.size)
            lo, hi, start, end, bound, split = (np.concatenate(c) for c in zip(*parts, strict=True))
            open_ = (bound > least) | ((bound == least) & (lo < last) & (bound > 0))
            lo, hi, start, end, bound, split = lo[open_], hi[open_], start[open_], end[open_], bound[open_], split[open_]
        return best_docs, best_scores


# --- search -------------------------------------------------------------------


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def item_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item_id, term``, each once."""
    found = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text_column).cast("string"), F.lit(""))), F.lit(TERM), 0)
    return items.select(F.col(id_column).cast("long").alias("item_id"), F.explode(F.array_distinct(found)).alias("term")).distinct()


def weighted_terms(index: DataFrame, items: DataFrame, block_terms: int) -> tuple[DataFrame, int, int, int]:
    """``block, term, weight, items`` of the terms the documents hold, and the numbers of documents, words and blocks."""
    totals = index.filter("term IS NULL").agg(F.sum("n").alias("docs"), F.sum("words").alias("words")).first()
    n_docs, n_words = totals["docs"] or 0, totals["words"] or 0
    terms = staged(items, "items")
    blocks = max(1, -(-terms.count() // block_terms))
    held = index.filter("term IS NOT NULL").select("term", "n").join(terms.select("term").distinct(), "term", "left_semi")
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.sum("n") + 1).cast("double"))).cast("long")
    weights = held.groupBy("term").agg(weight.alias("weight")).filter("weight > 0")
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    rows = terms.join(weights, "term").groupBy(block.alias("block"), "term", "weight").agg(F.collect_list(F.struct("item_id")).alias("items"))
    return staged(rows, "terms"), n_docs, n_words, blocks


def search(
    spark: SparkSession,
    path: str,
    items: DataFrame,
    k: int = 50,
    id_column: str = "item_id",
    text_column: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the index at ``path`` with the highest scores above 0, for each item."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(path)
    terms, n_docs, n_words, blocks = weighted_terms(index, item_terms(items, id_column, text_column), block_terms)
    columns = ["segment", "block", "weight", "items", "docs", "counts", "ids"]
    lists = index.filter("term IS NOT NULL").join(terms, "term").select(*columns)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    heads = index.filter("term IS NULL").select("segment", every.alias("block"), "docs", "ids")

    def best(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        of_docs = pc.is_valid(table["ids"])
        rows = table.filter(pc.invert(of_docs))
        out: dict[str, list] = {"item_id": [], "doc_id": [], "score": []}
        if rows.num_rows:
            head = table.filter(of_docs)
            arrays = lambda name: [x.values.to_numpy() for x in rows[name]]
            lists = Lists(arrays("docs"), arrays("counts"), head["docs"][0].values.to_numpy(), n_docs, n_words)
            ids, weights = head["ids"][0].as_py(), rows["weight"].to_numpy()
            lists_of: dict[int | None, list[int]] = {}
            for i, held in enumerate(rows["items"].to_pylist()):
                for item in held:
                    lists_of.setdefault(item["item_id"], []).append(i)
            for item, which in lists_of.items():
                docs, scores = lists.search(lists.number[which], weights[which], k)
                out["item_id"] += [item] * len(docs)
                out["doc_id"] += [ids[d] for d in docs]
                out["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    met = lists.unionByName(heads, allowMissingColumns=True).groupBy("segment", "block")
    found = met.applyInArrow(best, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
