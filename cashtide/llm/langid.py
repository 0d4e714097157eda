"""Language identification by a byte convolutional network, trained in numpy.

A text is cut into windows of a fixed number of bytes. Filters of several widths run over the bytes of a window (a
filter is one table of 256 weights for each of its places, so a convolution is a sum of look-ups), the maximum of
each filter over the window is kept, and a softmax layer gives the languages' probabilities. A text's prediction is
the mean over all its windows, weighted by their bytes.

Training uses a bounded sample: for each language the ``DOCS_PER_LANGUAGE`` documents with the smallest hash of
their ids, and of each up to ``WINDOWS_PER_DOC`` windows spread over its whole text. Prediction reads every window of
every text, in batches.

Defined cases: a text that is null or has no letter is ``und`` with score 0. Ties go to the language first in order.
Repeated rows each have a row. Rows with a null id are learned from and predicted like others (as fold of the empty
id). Without any labelled text all texts are ``und`` with score 0. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashtide.llm.common import small_batches, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bounds of the training sample.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 400, 4
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.02, 1e-4
#: Windows that go through the network at once.
PREDICT_BATCH = 64
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # for each width: place, byte, filter
    bias: np.ndarray  # of all filters
    weights: np.ndarray  # filter, language
    offset: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter over each window, and where it is."""
        n, length = windows.shape
        top, place = [], []
        for table in self.tables:
            span = length - len(table) + 1
            total = table[0][windows[:, :span]]
            for k in range(1, len(table)):
                total += table[k][windows[:, k : k + span]]
            at = total.argmax(axis=1)
            top.append(np.take_along_axis(total, at[:, None], axis=1)[:, 0])
            place.append(at)
        return np.concatenate(top, axis=1) + self.bias, np.concatenate(place, axis=1)

    def highest(self, windows: np.ndarray) -> np.ndarray:
        """``pooled`` without the places; one window after the other, so that what is summed stays in the cache."""
        n, length = windows.shape
        out, start = np.empty((n, len(self.bias)), np.float32), 0
        for table in self.tables:
            span, end = length - len(table) + 1, start + table.shape[2]
            total, more = np.empty((span, table.shape[2]), np.float32), np.empty((span, table.shape[2]), np.float32)
            for i, window in enumerate(windows):
                np.take(table[0], window[:span], axis=0, out=total, mode="clip")
                for k in range(1, len(table)):
                    np.take(table[k], window[k : k + span], axis=0, out=more, mode="clip")
                    total += more
                total.max(axis=0, out=out[i, start:end])
            start = end
        return out + self.bias

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled, 0) @ self.weights + self.offset
        share = np.exp(logits - logits.max(axis=1, keepdims=True))
        return share / share.sum(axis=1, keepdims=True)


def windows_of(text: bytes, window: int = WINDOW) -> np.ndarray:
    """The whole text as rows of bytes, the last one filled up with zeros."""
    text = text.lower()
    data = np.zeros((max(1, -(-len(text) // window)), window), np.uint8)
    data.reshape(-1)[: len(text)] = np.frombuffer(text, np.uint8)
    return data


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 0) -> Network:
    """Adam on the cross entropy. Of a filter only the place of its maximum gets a gradient."""
    rng = np.random.default_rng(seed)
    filters = len(WIDTHS) * FILTERS
    net = Network(
        languages,
        [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(filters, np.float32),
        rng.normal(0, 0.3, (filters, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    params = [*net.tables, net.bias, net.weights, net.offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    # Languages count alike, whatever their number of windows.
    counts = np.bincount(labels, minlength=len(languages))
    importance = (len(labels) / (len(languages) * np.maximum(counts, 1)))[labels].astype(np.float32)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            data, target = windows[rows], labels[rows]
            top, place = net.pooled(data)
            error = net.probabilities(top)
            error[np.arange(len(rows)), target] -= 1
            error *= importance[rows, None] / len(rows)
            hidden = np.maximum(top, 0)
            back = (error @ net.weights.T) * (top > 0)
            grads = []
            for i, table in enumerate(net.tables):
                grad, own = np.zeros_like(table), slice(i * FILTERS, (i + 1) * FILTERS)
                for k in range(len(table)):
                    at = np.take_along_axis(data, place[:, own] + k, axis=1)
                    np.add.at(grad[k], (at, np.arange(FILTERS)[None, :]), back[:, own])
                grads.append(grad)
            grads += [back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                g = g + DECAY * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def sample_windows(docs: DataFrame, usable: Column, docs_per_language: int, windows_per_doc: int) -> DataFrame:
    """``lang, window`` of the bounded sample of ``doc_id, text, lang`` rows for which ``usable`` holds."""
    known = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = known.select("lang", F.xxhash64("doc_id", "text").alias("key"))
    order = Window.partitionBy("lang").orderBy("key")
    chosen = hashed.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= docs_per_language).select("lang", "key").distinct()
    texts = known.withColumn("key", F.xxhash64("doc_id", "text")).join(F.broadcast(chosen), ["lang", "key"], "left_semi")
    # Rows with the same id and text count once, so the sample is bounded however often a document is repeated.
    texts = texts.groupBy("lang", "key").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, windows = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = windows_of(text)
                for i in np.unique(np.linspace(0, len(rows) - 1, windows_per_doc).astype(int)):
                    langs.append(lang)
                    windows.append(rows[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(windows, pa.binary())], ["lang", "window"])

    return texts.select("lang", utf8("text").alias("text")).mapInArrow(cut, "lang string, window binary")


def learn(docs: DataFrame, usable: Column, docs_per_language: int = DOCS_PER_LANGUAGE, windows_per_doc: int = WINDOWS_PER_DOC) -> Network | None:
    small_batches(docs.sparkSession)
    sample = sample_windows(docs, usable, docs_per_language, windows_per_doc)
    rows = sorted((r["lang"], bytes(r["window"])) for r in sample.collect())  # bounded by the sample
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    labels = np.array([languages.index(lang) for lang, _ in rows])
    windows = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(len(rows), -1)
    return train(windows, labels, languages)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def predict_texts(net: Network | None, texts: list[bytes]) -> tuple[list[str], list[float]]:
    lettered = [i for i, t in enumerate(texts) if t and has_letter(t)] if net else []
    found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not lettered:
        return found, scores
    totals = np.zeros((len(texts), len(net.languages)))
    for i in lettered:
        rows, size = windows_of(texts[i]), len(texts[i])
        weight = np.full(len(rows), WINDOW, float)
        weight[-1] = size - WINDOW * (len(rows) - 1)
        for start in range(0, len(rows), PREDICT_BATCH):
            part = slice(start, start + PREDICT_BATCH)
            totals[i] += weight[part] @ net.probabilities(net.highest(rows[part]))
        totals[i] /= size
    best = totals.argmax(axis=1)
    for i in lettered:
        found[i], scores[i] = net.languages[best[i]], min(1.0, float(totals[i, best[i]]))
    return found, scores


def predict(docs: DataFrame, net: Network | None, text_column: str = "text") -> DataFrame:
    """``row, lang_pred, score``: the rows of ``docs`` as they are, in a struct, and their prediction."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.struct("*").alias("row"), utf8(text_column).alias("text"))
    fields = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predict_texts(sent.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], fields.names)

    return rows.mapInArrow(compute, fields)
