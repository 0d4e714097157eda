"""Token ids as Parquet files that can be read in part.

A folder holds ``tokens`` (one row a document, ascending ids over the files: ``shard, place, doc_id, start, n_tokens,
tokens``) and ``shards`` (one row a file: ``shard, rows, n_tokens, start``). The token column is dictionary encoded,
the number columns have delta encoding; row groups and pages are small, and the files carry page indexes, so a
reader of ``doc_id`` and ``n_tokens`` fetches no tokens, and a reader of few documents few pages.

Documents are range partitioned by id before they are encoded, so the sampling of the ranges runs no tokenizer and
texts move once. ``start`` in a file counts from the file's own begin; the shard table has what to add.

Encoding uses the ``tokenizers`` library on whole texts. For plain byte-level BPE files pieces between single
blanks or line ends never share a token, so a worker encodes each piece once and keeps its ids (``PieceCache``); a text
where that may not hold goes to the tokenizer as a whole, and so do all texts if the file is of another kind.

Defined cases: a null text is empty; an empty text has only the end id. A null id comes first in order. Repeated
rows are documents of their own, ordered by text. Very long texts are one row. An empty table gives empty files. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cashtide.llm.common import small_batches, spread

ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2_000
#: Text bytes of one shard, about.
SHARD_BYTES = 64 << 20
#: Pieces a worker remembers; when they are more, it goes on with those of the texts at hand.
CACHE_PIECES = 1_000_000
#: Characters cut at a time, about: each different piece among them is looked up once.
AT_ONCE = 2_000_000
#: A piece (see ``PieceCache``) of letters that every version of Unicode takes for such only, and of marks after them; or any other one.
#: The usual pattern never splits these letters, nor these marks, and always splits between the two.
PARTS = re.compile("([ \n][A-Za-zÀ-ÖØ-öø-ɏ]++)([!-&(-/:-@\\[-`{-~]*+)(?![^ \n])|([ \n][^ \n]++)")


def plain_byte_level(path: str) -> bool:
    """Whether the file is a byte-level BPE that splits texts by the usual pattern and changes nothing before."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    before = parts.get("pre_tokenizer") or {}
    splits = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    return bool(splits and parts.get("normalizer") is None and parts["model"].get("type") == "BPE" and "\u010a" in parts["model"]["vocab"])


def byte_letters() -> str:
    """The letter a byte-level model has for each byte, those from U+0100 on for bytes that aren't printable; blanks stay."""
    shown = [32 < b < 127 or 160 < b < 173 or b > 173 for b in range(256)]
    return "".join(chr(b if shown[b] or b == 32 else 256 + shown[:b].count(False)) for b in range(256))


class Pieces:
    """Pieces by number, and their ids one after the other."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.ids, self.ends = bytearray(), array("q", [0])

    def find(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece, -1 for those not there."""
        return np.fromiter(map(self.numbers.get, pieces, repeat(-1)), np.int64, len(pieces))

    def add(self, pieces: list[str], ids: bytes, lengths: np.ndarray) -> None:
        """Pieces that aren't there, with their ids and how many each has."""
        n = len(self.numbers)
        self.numbers.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.ids += ids
        self.ends.frombytes((self.ends[-1] + np.cumsum(lengths, dtype=np.int64)).tobytes())

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece begin, and how many they are."""
        ends = np.frombuffer(self.ends, np.int64)
        return ends[numbers], ends[numbers + 1] - ends[numbers]

    def take(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.ids, "<u4")[spread(starts, lengths)]

    def one(self, piece: str) -> bytes:
        n = self.numbers[piece]
        return bytes(self.ids[4 * self.ends[n] : 4 * self.ends[n + 1]])


class PieceCache:
    """Token ids of texts, put together from pieces that were encoded before.

    A byte-level tokenizer attaches a blank to what follows it, takes a single line end by itself, and matches never cross the
    place before either, provided that the characters on both sides aren't white space. Texts in which all
    white space is of this kind are cut there, into pieces that begin with a blank or a line end. All other
    texts, and all texts of other tokenizers, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = plain_byte_level(path)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.known = Pieces()
        if self.cuts:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            size = max(vocabulary.values()) + 1
            self.after_blank, self.line_end = np.zeros(size, bool), np.zeros(size, bool)
            self.after_blank[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
            self.line_end[vocabulary["\u010a"]] = True
            self.model = self.tokenizer.model
            self.packed = [i.to_bytes(4, "little") for i in range(size)]
            self.packed_end = self.packed[vocabulary["\u010a"]]
            self.letters = byte_letters()

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def has_pieces(self, text: str) -> bool:
        """Whether a text can be cut into pieces, the first one as after a line end."""
        flat = text.replace("\n", " ")
        # Of all white space only the blank is printable; other marks that aren't printable need a closer look.
        plain = flat.isprintable() and "  " not in flat and flat[:1] not in ("", " ") and flat[-1] != " "
        return (plain or bool(flat) and " ".join(flat.split()) == flat) and not any(a in text for a in self.added)

    def spelled(self, parts: list[str]) -> list[str]:
        """Parts without white space in the letters of their bytes."""
        return " ".join(parts).encode().decode("latin-1").translate(self.letters).split(" ") if parts else []

    def learn(self, pieces: list[str]) -> None:
        """Encodes new pieces. Letters and marks go to the model, each part once, other pieces to the tokenizer."""
        parts, packed, tokenize = PARTS.findall("".join(pieces)), self.packed, self.model.tokenize
        heads = list(filter(None, dict.fromkeys([head for head, _, _ in parts])))
        heads = [head for head, number in zip(heads, self.known.find(heads).tolist(), strict=True) if number < 0]
        found = {}
        for head, letters in zip(heads, self.spelled([head[1:] for head in heads]), strict=True):
            if head[0] == " ":
                found[head] = b"".join([packed[token.id] for token in tokenize("\u0120" + letters)])
            else:
                found[head] = self.packed_end + b"".join([packed[token.id] for token in tokenize(letters)])
        tails = [*{tail for _, tail, _ in parts if tail}]
        marks = {tail: b"".join([packed[token.id] for token in tokenize(m)]) for tail, m in zip(tails, self.spelled(tails), strict=True)}
        for head, tail, _ in parts:
            if tail:
                found[head + tail] = (found.get(head) or self.known.one(head)) + marks[tail]
        others = [other for _, _, other in parts if other]
        for begin, opens in ((" ", self.after_blank), ("\n", self.line_end)):
            found |= self.encoded([p for p in others if p[0] == begin], opens)
        lengths = np.fromiter(map(len, found.values()), np.int64, len(found)) // 4
        self.known.add([*found], b"".join(found.values()), lengths)

    def encoded(self, pieces: list[str], opens: np.ndarray) -> dict[str, bytes]:
        """Ids of pieces by the tokenizer, as one text in which each begins with the one token that ``opens`` marks."""
        if not pieces:
            return {}
        ids = self.ids("".join(pieces))
        starts = np.flatnonzero(opens[ids])
        if len(starts) != len(pieces):
            return {p: self.ids(p).tobytes() for p in pieces}
        data, at = ids.tobytes(), (4 * np.append(starts, len(ids))).tolist()
        return {p: data[a:b] for p, a, b in zip(pieces, at, at[1:], strict=False)}

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """The numbers of pieces, each another one; new ones are encoded, and all others forgotten if they are too many."""
        numbers = self.known.find(pieces)
        if len(self.known.numbers) > CACHE_PIECES:
            kept, before, self.known = np.flatnonzero(numbers >= 0), self.known, Pieces()
            starts, lengths = before.places(numbers[kept])
            self.known.add([pieces[i] for i in kept.tolist()], before.take(starts, lengths).tobytes(), lengths)
            numbers[kept] = np.arange(len(kept))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            unknown = [pieces[i] for i in new.tolist()]
            self.learn(unknown)
            numbers[new] = self.known.find(unknown)
        return numbers

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not self.cuts:
            return [self.ids(t).tobytes() for t in texts]
        out, few, size = [], [], 0
        for text in texts:
            if few and size + len(text) > AT_ONCE:
                out += self.encode_few(few)
                few, size = [], 0
            few.append(text)
            size += len(text)
        return out + self.encode_few(few)

    def encode_few(self, texts: list[str]) -> list[bytes]:
        cut = [self.has_pieces(t) for t in texts]
        plain = [t.encode() for t, has in zip(texts, cut, strict=True) if has]
        data = np.frombuffer(b"".join(chain.from_iterable(zip(repeat(b"\n"), plain, strict=False))), np.uint8)
        begins = np.append(np.flatnonzero((data == 32) | (data == 10)), len(data))
        pieces = pa.Array.from_buffers(pa.large_string(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(data)]).dictionary_encode()
        numbers = self.look_up(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        starts, lengths = (a[pieces.indices.to_numpy()] for a in self.known.places(numbers))
        ids = self.known.take(starts, lengths)
        # Where the ids of each text end.
        sizes = np.fromiter(map(len, plain), np.int64, len(plain)) + 1
        ends = iter(np.append(0, np.cumsum(lengths))[np.searchsorted(begins, np.cumsum(sizes))].tolist())
        out, begin = [], 0
        for text, has in zip(texts, cut, strict=True):
            if has:
                end = next(ends)
                # The line end before the first piece is not part of the text.
                out.append(ids[begin + 1 : end].tobytes())
                begin = end
            else:
                out.append(self.ids(text).tobytes())
        return out


@lru_cache(maxsize=1)
def piece_cache(path: str) -> PieceCache:
    """One for all tasks of a worker."""
    return PieceCache(path)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encodes every document and writes the folder ``path``. ``tokenizer`` is a file every executor can read."""
    spark = docs.sparkSession
    small_batches(spark)
    wanted = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_bytes))
    dealt = wanted.repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    end = np.array([] if end_id is None else [end_id], "<u4").tobytes()
    item = pa.list_(pa.int32())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, shard, place, start = piece_cache(tokenizer), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            found = [ids + end for ids in cache.encode(batch.column(1).to_pylist())]
            counts = np.array([len(ids) // 4 for ids in found], np.int64)
            offsets = np.append(0, np.cumsum(counts))
            tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4"))).cast(item)
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, shard, np.int32)),
                    pa.array(np.arange(place, place + n)),
                    batch.column(0),
                    pa.array(start + offsets[:-1]),
                    pa.array(counts),
                    tokens,
                ],
                ["shard", "place", "doc_id", "start", "n_tokens", "tokens"],
            )
            place, start = place + n, start + int(offsets[-1])

    rows = dealt.mapInArrow(encode, "shard int, place long, doc_id long, start long, n_tokens long, tokens array<int>")
    writer = rows.write.option("compression", "zstd").option("parquet.writer.version", "v2")
    writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
    writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.enable.dictionary", "false")
    writer.option("parquet.enable.dictionary#tokens.list.element", "true").parquet(f"{path}/tokens")

    totals = spark.read.parquet(f"{path}/tokens").groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("n_tokens"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).write.parquet(f"{path}/shards")


def read_tokens(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens`` and, if wanted, ``tokens``; ``start`` counts over all files."""
    rows = spark.read.parquet(f"{path}/tokens")
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("base"))
    columns = ["doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", *(["tokens"] if tokens else [])]
    return rows.join(F.broadcast(shards), "shard").select(*columns)  # a few bytes for each file


def with_crc32(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: unsigned crc32 of the ids as little-endian 32-bit numbers."""
    small_batches(rows.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(3)
            ids = tokens.values.to_numpy(zero_copy_only=False).astype("<u4")
            at = tokens.offsets.to_numpy()
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
