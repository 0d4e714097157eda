"""Best-fit packing of documents into sequences by the sum-of-squares rule.

Documents are encoded where they are read; longer ones are cut into pieces of the sequence's length, only their first
piece may be shorter. Whole pieces are sequences already and stay where they are. The others, at most one a document, are dealt into
groups of a bounded number by a hash of their place, whatever their document or source, and each group is packed by a task.

There the bins are counted by their gap, and a piece goes where the sum of the squared counts becomes smallest: a gap
that few bins have is made from one that many have, and a gap that fits is closed. Pieces are placed from the longest to
the shortest. Most of the bins that the group's tokens need are open from the start, counted with their whole
length as gap, and another one is opened when a piece fits nowhere: opening bins by the rule itself
left 8 to 10 % more sequences than tokens demand, this order leaves about 0.1 %. Of equal choices the tightest is taken.

A folder holds ``pieces/whole=true`` and ``packed``: rows of ``sequence_id, doc_ids, pieces, starts, lengths, tokens``
(see ``read_sequences``); tokens are little-endian unsigned 32-bit ids.

Defined cases: a null text is empty; an empty text has the end id only. Null and repeated ids and repeated rows are documents of
their own. A very long text gives many pieces; it is encoded whole by one task. An empty table gives empty files.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide.llm.common import small_batches
from cashtide.llm.tokens import piece_cache

SEQUENCE_TOKENS, END_ID = 1024, 2
#: Pieces one task packs.
GROUP_PIECES = 16_384
#: Share of the bins that a group's tokens need at least which are open from the start.
OPEN_FIRST = 0.8
#: Rows handed over at once.
OUT_ROWS = 512

PIECE = {"key": pa.int64(), "whole": pa.bool_(), "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int32(), "tokens": pa.binary()}
SEQUENCE = "sequence_id long, doc_ids array<long>, pieces array<int>, starts array<long>, lengths array<int>, tokens binary"


def pieces_of(size: int, longest: int) -> Iterator[tuple[int, int]]:
    """Start and length of each piece of a document; the first one takes what the others leave."""
    first = size % longest or longest
    yield 0, first
    for start in range(first, size, longest):
        yield start, longest


def sum_of_squares(sizes: np.ndarray, length: int, open_first: float = OPEN_FIRST) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each size (above 0, below ``length``) and its offset there."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    ready = int(open_first * (int(sizes.sum()) / length))
    counts = np.zeros(length + 1, np.int64)
    counts[length] = ready
    with_gap: dict[int, list[int]] = {length: list(range(ready))[::-1]}
    opened = ready
    never = np.iinfo(np.int64).max
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        before, after = counts[size:], counts[: length + 1 - size]
        # What the sum of squares gains if a gap becomes smaller by the size; bins without a gap don't count.
        gain = 2 * (after - before) + 2
        gain[0] = 1 - 2 * before[0]
        gain = np.where(before > 0, gain, never)
        left = int(gain.argmin())
        gap = left + size
        if counts[gap]:
            counts[gap] -= 1
            chosen = with_gap[gap].pop()
        else:
            gap, left, chosen, opened = length, length - size, opened, opened + 1
        if left:
            counts[left] += 1
            with_gap.setdefault(left, []).append(chosen)
        bins[i], offsets[i] = chosen, length - gap
    return bins, offsets


def encoded_pieces(docs: DataFrame, tokenizer: str, longest: int, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """The pieces of all documents, with a key that no other piece has."""
    small_batches(docs.sparkSession)
    wanted = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, key = piece_cache(tokenizer), TaskContext.get().partitionId() << 36
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), cache.encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                for number, (start, length) in enumerate(pieces_of(len(ids) // 4, longest)):
                    rows.append((key, length == longest, doc_id, number, start, length, ids[4 * start : 4 * (start + length)]))
                    key += 1
            for at in range(0, len(rows), OUT_ROWS):
                columns = zip(*rows[at : at + OUT_ROWS], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PIECE.values(), strict=True)], list(PIECE))

    return wanted.mapInArrow(encode, "key long, whole boolean, doc_id long, piece int, start long, length int, tokens binary")


def packed(pieces: DataFrame, groups: int, length: int, open_first: float = OPEN_FIRST) -> DataFrame:
    """Sequences of the pieces, packed group by group."""

    def pack(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sizes = table["length"].to_numpy()
        bins, offsets = sum_of_squares(sizes, length, open_first)
        order = np.lexsort((offsets, bins))
        firsts = np.flatnonzero(np.append(True, np.diff(bins[order]) != 0))
        ends = np.append(firsts[1:], len(order))
        rows = table.take(pa.array(order))
        lists = lambda name: pa.ListArray.from_arrays(pa.array(np.append(firsts, len(order)), pa.int32()), rows[name].combine_chunks())
        tokens = rows["tokens"].to_pylist()
        numbers = key[0].as_py() * (1 << 25) + bins[order][firsts]
        return pa.table(
            {
                "sequence_id": pa.array(2 * numbers + 1),
                "doc_ids": lists("doc_id"),
                "pieces": lists("piece"),
                "starts": lists("start"),
                "lengths": lists("length"),
                "tokens": pa.array([b"".join(tokens[a:b]) for a, b in zip(firsts, ends, strict=True)], pa.binary()),
            }
        )

    group = F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group")
    return pieces.select(group, "doc_id", "piece", "start", "length", "tokens").groupBy("group").applyInArrow(pack, SEQUENCE)


def write_sequences(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    length: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_pieces: int = GROUP_PIECES,
) -> None:
    """Encodes and packs all documents and writes the folder ``path``. ``tokenizer`` is a file every executor can read."""
    spark = docs.sparkSession
    pieces = encoded_pieces(docs, tokenizer, length, end_id, id_column, text_column)
    # Both kinds are written as they come, without a sort.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "2")
    try:
        pieces.write.option("compression", "zstd").partitionBy("whole").parquet(f"{path}/pieces")
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    short = read_pieces(spark, path, whole=False)
    groups = max(1, -(-short.count() // group_pieces))
    packed(short, groups, length).write.option("compression", "zstd").parquet(f"{path}/packed")


def read_pieces(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    rows = spark.read.schema("key long, doc_id long, piece int, start long, length int, tokens binary, whole boolean").parquet(f"{path}/pieces")
    return rows.filter(F.col("whole") == whole)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """``sequence_id, doc_ids, pieces, starts, lengths, tokens``, a row a sequence; the arrays hold its pieces in order."""
    alone = read_pieces(spark, path, whole=True).select(
        (2 * F.col("key")).alias("sequence_id"),
        F.array("doc_id").alias("doc_ids"),
        F.array("piece").alias("pieces"),
        F.array("start").alias("starts"),
        F.array("length").alias("lengths"),
        "tokens",
    )
    return alone.unionByName(spark.read.schema(SEQUENCE).parquet(f"{path}/packed"))


def placed_pieces(sequences: DataFrame) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of each piece in the sequences."""
    small_batches(sequences.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(4).value_lengths().to_numpy()
            lengths = batch.column(4).flatten().to_numpy()
            numbers = np.repeat(np.arange(len(counts)), counts)
            ends = np.cumsum(lengths)
            firsts = np.cumsum(counts) - counts
            offsets = ends - lengths - np.repeat((ends - lengths)[firsts], counts) if len(lengths) else ends
            tokens = batch.column(5).to_pylist()
            crc = [zlib.crc32(memoryview(tokens[n])[4 * o : 4 * (o + k)]) for n, o, k in zip(numbers.tolist(), offsets.tolist(), lengths.tolist(), strict=True)]
            columns = [*(batch.column(i).flatten() for i in (1, 2, 3)), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())]
            columns += [batch.column(0).take(pa.array(numbers)), pa.array(offsets.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return sequences.select("sequence_id", "doc_ids", "pieces", "starts", "lengths", "tokens").mapInArrow(
        split, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
