"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits. The bits are grouped into partitions, correlated bits together, and each partition
gets its own threshold t: if two fingerprints differ in at most ``max_bits`` bits and the sum of (t + 1) over the
partitions is ``max_bits + 1``, they differ in at most t bits in one partition at least. Grouping and thresholds
are chosen by a dynamic program on the estimated rows and candidates of each choice, so the keys get longer as
the number of fingerprints grows.

Equal fingerprints collapse first. Each distinct fingerprint is sent to the buckets of its keys (and of the keys
a few flips away, where a partition has a threshold above 0); fingerprints that meet are compared as whole and a
spanning forest of the true links leaves the bucket, never all pairs. Crowded buckets are cut into cells of pairs
of chunks, so no task holds more than two chunks of one bucket. Components come from minimum hooking over the
links with reliable checkpoints.

Defined cases: a null or blank text has the fingerprint zero and links like any other. Repeated rows and repeated
ids keep a row each. Null ids keep their row and never name a component, unless no other id is in it (then null).
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide.llm.common import small_batches, utf8
from cashtide.session import cut_lineage, staged

BITS = 64
SEED = 42
#: Shingles whose bits are counted at once, to bound memory on very long texts.
SHINGLE_BLOCK = 1 << 16
#: Fingerprints of one bucket that one task compares; larger buckets are cut into cells.
BUCKET_ROWS = 8192
#: Relative costs for the dynamic program: a row sent to a bucket, a pair compared there.
ROW_COST, PAIR_COST = 400.0, 1.0
#: Runs up to this length are compared offset by offset, longer ones by a search over their links. So are runs with
#: more than so many links a row.
SHORT_RUN, DENSE_LINKS = 128, 8
#: Fingerprints handed to Python at once: narrow rows.
FP_ROWS = "65536"


def text_fingerprint(text: bytes, shingle_words: int = 3) -> int:
    words = text.lower().split()  # of bytes: only A-Z, and only the six ASCII blanks
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False)) if len(words) >= shingle_words else iter([b" ".join(words)])
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, SHINGLE_BLOCK):
        block = np.fromiter(hashes, np.uint64, count=min(SHINGLE_BLOCK, n - start))
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def text_key(text_column: str) -> Column:
    return F.xxhash64(utf8(text_column))


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, key, fp`` of every row; ``fp`` holds the 64 bits as a signed long, ``key`` is a hash of the text."""
    small_batches(docs.sparkSession)
    wanted = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_key(text_column).alias("key"), utf8(text_column).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], ["doc_id", "key", "fp"])

    return wanted.mapInArrow(compute, "doc_id long, key long, fp long")


# --- choice of partitions and thresholds --------------------------------------


@dataclass(frozen=True)
class Part:
    """Bits of one partition and its threshold."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def radius(self) -> int:
        """Flips each side makes, the larger one for odd thresholds."""
        return (self.threshold + 1) // 2

    def masks(self) -> list[tuple[int, bool]]:
        """Flips of the key, and whether rows under them only probe: two probing rows needn't meet."""
        out = []
        for flips in range(self.radius + 1):
            probe = self.threshold % 2 == 1 and flips == self.radius
            out += [(sum(1 << i for i in chosen), probe) for chosen in combinations(range(len(self.bits)), flips)]
        return out


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, how many have both set. 64 x 64 numbers, whatever the input."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch.column(0).to_numpy()
            bits = np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(fp)
        i, j = np.triu_indices(BITS)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i * BITS + j, -1)), pa.array(np.append(both[i, j].astype(np.int64), n))], ["cell", "n"]
            )

    cells = fps.select("fp").mapInArrow(compute, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = {r["cell"]: r["n"] for r in cells.collect()}
    both = np.zeros((BITS, BITS))
    for cell, n in found.items():
        if cell >= 0:
            both[divmod(cell, BITS)] = both[divmod(cell, BITS)[::-1]] = n
    return found.get(-1, 0), both


def group_bits(n: int, both: np.ndarray, groups: int) -> list[tuple[int, ...]]:
    """Groups of about equal width; each grows by the free bit that is most correlated with it."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, out = set(range(BITS)), []
    for g in range(groups):
        width = (BITS - sum(map(len, out))) // (groups - g)
        first = max(sorted(free), key=lambda b: related[b, sorted(free)].sum())
        chosen = [first]
        free.discard(first)
        while len(chosen) < width:
            best = max(sorted(free), key=lambda b: related[b, chosen].sum())
            chosen.append(best)
            free.discard(best)
        out.append(tuple(sorted(chosen)))
    return out


def within(bits: tuple[int, ...], share: np.ndarray) -> np.ndarray:
    """Estimated share of pairs that differ in 0, 1, ... bits of the group."""
    spread = np.ones(1)
    for b in bits:
        differ = 2 * share[b] * (1 - share[b])
        spread = np.append(spread * (1 - differ), 0) + np.append(0, spread * differ)
    return spread


def choose_parts(n: int, both: np.ndarray, max_bits: int) -> list[Part]:
    """The cheapest partitions and thresholds with the sum of (t + 1) equal to ``max_bits + 1``."""
    share, best = np.diag(both) / max(n, 1), (np.inf, [])
    units = max_bits + 1
    for groups in range(2, 9):
        split = group_bits(n, both, groups)
        table: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * units
        for bits in split:
            spread = np.cumsum(within(bits, share))
            costs = [0.0]
            for t in range(min(units, len(bits))):
                rows = sum(comb(len(bits), f) for f in range((t + 1) // 2 + 1))
                costs.append(ROW_COST * n * rows + PAIR_COST * n * n / 2 * float(spread[t]) * max(1, rows / 4))
            table = [
                min(((table[u - k][0] + costs[k], [*table[u - k][1], k - 1]) for k in range(min(u + 1, len(costs)))), key=lambda x: x[0])
                for u in range(units + 1)
            ]
        if table[units][0] < best[0]:
            best = table[units][0], [Part(b, t) for b, t in zip(split, table[units][1], strict=True) if t >= 0]
    return best[1]


# --- links ------------------------------------------------------------------------


def bucket_rows(fps: DataFrame, parts: list[Part]) -> DataFrame:
    """``bucket, probe, fp``: the buckets each fingerprint goes to. A bucket is the partition's number and the key."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for number, part in enumerate(parts):
                key = np.zeros(len(fp), np.uint64)
                for place, bit in enumerate(part.bits):
                    key |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
                masks = part.masks()
                flips = np.array([m for m, _ in masks], np.uint64)
                bucket = (key[:, None] ^ flips[None, :]).astype(np.int64) | (number << 40)
                probe = np.broadcast_to(np.array([p for _, p in masks]), bucket.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.ravel()), pa.array(probe.ravel()), pa.array(np.repeat(fp.view(np.int64), len(masks)))],
                    ["bucket", "probe", "fp"],
                )

    return fps.select("fp").mapInArrow(compute, "bucket long, probe boolean, fp long")


def in_cells(rows: DataFrame, limit: int) -> DataFrame:
    """Adds ``cell``: 0, or for a bucket above ``limit`` rows the number of a pair of its chunks."""
    crowded = rows.groupBy("bucket").count().filter(F.col("count") > limit)
    chunks = F.ceil(F.col("count") / F.lit(limit // 2)).cast("int")
    own = F.pmod(F.xxhash64("fp"), "chunks").cast("int")
    pair = lambda j: F.least("own", j) * F.col("chunks") + F.greatest("own", j)
    cells = F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), pair))
    joined = rows.join(crowded.select("bucket", chunks.alias("chunks")), "bucket", "left")
    return joined.withColumn("own", own).select("bucket", F.explode(cells).alias("cell"), "probe", "fp")


def spanning(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links of one run, found link by link from a root."""
    left, right, rest = [], [], fp
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            here = frontier.pop()
            near = np.bitwise_count(rest ^ here) <= max_bits
            hit = rest[near]
            if len(hit):
                left.append(np.full(len(hit), here))
                right.append(hit)
                frontier += list(hit)
                rest = rest[~near]
    none = np.empty(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def close_pairs(run: np.ndarray, fp: np.ndarray, probe: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows of one or more whole runs; in long or dense runs a spanning forest of the links."""
    starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    lengths = np.diff(np.append(starts, len(run)))
    of_row = np.repeat(lengths, lengths)
    first, second = [np.empty(0, int)], [np.empty(0, int)]
    short = np.flatnonzero((of_row > 1) & (of_row <= SHORT_RUN))
    r, f, p = run[short], fp[short], probe[short]
    i = np.arange(len(short))
    for d in range(1, SHORT_RUN):
        i = i[i + d < len(short)]
        i = i[r[i] == r[i + d]]
        if not len(i):
            break
        near = i[(np.bitwise_count(f[i] ^ f[i + d]) <= max_bits) & ~(p[i] & p[i + d])]
        first.append(near)
        second.append(near + d)
    a, b = np.concatenate(first), np.concatenate(second)
    # Dense runs: more links than a few for each row.
    place = np.searchsorted(starts, short[a], "right") - 1
    dense = np.bincount(place, minlength=len(starts)) > DENSE_LINKS * lengths
    sparse = ~dense[place]
    left, right = [f[a[sparse]]], [f[b[sparse]]]
    for k in np.flatnonzero(dense | (lengths > SHORT_RUN)):
        for side, found in zip((left, right), spanning(fp[starts[k] : starts[k] + lengths[k]], max_bits), strict=True):
            side.append(found)
    return np.concatenate(left), np.concatenate(right)


def links(fps: DataFrame, max_bits: int = 3, bucket_limit: int = BUCKET_ROWS) -> DataFrame:
    """``a, b``: links that span each component of distinct fingerprints at most ``max_bits`` bits apart.

    All links of sparse buckets, a spanning forest of each dense one.
    """
    fps.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", FP_ROWS)
    n, both = bit_counts(fps)
    parts = choose_parts(n, both, max_bits) if n else []
    rows = in_cells(bucket_rows(fps, parts), bucket_limit)
    dealt = rows.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            bucket, cell, probe, fp = columns
            run = np.cumsum(np.append(0, (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])))
            a, b = close_pairs(run, fp.view(np.uint64), probe, max_bits)
            a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else (a, b)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            held = [np.concatenate(pair) for pair in zip(held, new, strict=True)] if held else new
            same = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = int(np.argmax(same))  # the last run may go on in the next batch
            if cut:
                yield from found([c[:cut] for c in held])
                held = [c[cut:] for c in held]
        if held:
            yield from found(held)

    return dealt.mapInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link; one root for each component."""
    edges = cut_lineage(edges.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = None
    while not edges.isEmpty():
        around = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = around.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up"))
        higher = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        up = cut_lineage(up.join(higher, "up", "left").select("node", F.coalesce("top", "up").alias("up")))
        if roots is None:
            roots = up.select("node", F.col("up").alias("root"))
        else:
            moved = up.select(F.col("node").alias("root"), "up")
            roots = cut_lineage(roots.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        ends = edges
        for end in ("a", "b"):
            ends = ends.join(up.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up")), end).drop(end).withColumnRenamed(f"{end}_up", end)
        edges = cut_lineage(
            ends.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        )
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def hex_digits(fp: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 3,
    max_bits: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    bucket_limit: int = BUCKET_ROWS,
) -> DataFrame:
    """``doc_id, key, fingerprint, component_id, first_key`` of every row. Eager up to the components.

    ``first_key`` is the ``key`` of the document that names the component (the smallest one of its texts).
    """
    named_by = F.struct(F.col("doc_id").isNull().alias("open"), "doc_id", "key")
    marked = staged(fingerprints(docs, shingle_words, id_column, text_column), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min(named_by).alias("first")), "distinct")
    roots = components(links(distinct, max_bits, bucket_limit))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    named = rooted.join(heads, "root").select("fp", F.col("head.doc_id").alias("component_id"), F.col("head.key").alias("first_key"))
    return marked.join(named, "fp").select("doc_id", "key", hex_digits("fp").alias("fingerprint"), "component_id", "first_key")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` without near-duplicates: of each component the document that names it, once, all columns."""
    marks = near_duplicates(docs, id_column=id_column, text_column=text_column, **options)
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("first_key"))
    heads = staged(marks.filter(first).groupBy("doc_id", "key").count(), "heads").select(
        F.col("doc_id").alias("head_id"), F.col("key").alias("head_key"), F.col("count").alias("rows")
    )
    # The columns travel as one, so that none of their names can clash.
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_column).cast("long").alias("id"), text_key(text_column).alias("key"))
    kept = packed.join(heads, F.col("id").eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key")))
    if not heads.filter("rows > 1").isEmpty():
        # Rows that occur more than once: one of each id and text.
        several = kept.filter("rows > 1").dropDuplicates(["id", "key"])
        kept = kept.filter("rows = 1").unionAll(several)
    return kept.select("row.*")
