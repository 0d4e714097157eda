"""Texts that several accounts post: exact copies, and copies with edits.

Texts are compared as words: A-Z in lower case, whatever white space is between. Exact copies are one group by the
digest of their words; posts are counted per text and account first, in the map tasks, so a text that a third of all posts
have reaches a task as one row an account.

Edited copies share at least ``similarity`` of their distinct shingles (runs of ``words`` words). MinHash signatures are
aggregates: words are hashed once, shingles from their words' hashes, each permutation is an exclusive or with a constant, and
all minima come out of one aggregation by text, which the map tasks finish but for one row a text. ``rows`` minima in a row make a band. Texts with a band in common are candidates; at a similarity of 0.8 the default 20 bands of 4 rows miss a
pair with a probability of 3 in 100,000, above that of less. What counts is the exact share of common shingles, never the estimate.

All pairs of a crowded band would be its square. Two rounds therefore compare each text with one pivot of each of its bands
only, and what is linked becomes one component; only then are the pairs that are still in different components compared,
all of them. Joins on the band are split by the adaptive skew join where one band has many texts.

Texts without words take no part. Null ids are counted; null accounts are one account.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashtide.functions.common import ColumnOrName, as_col, let
from cashtide.operators.graph import connected
from cashtide.session import staged

#: White space that is more than a single blank.
GAP = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Odd constant that spreads the bits of the permutations' numbers.
SPREAD = 0x9E3779B97F4A7C15
PIVOT_ROUNDS = 2


def normal_words(text: ColumnOrName) -> Column:
    """The words of a text, in lower case, with single blanks between."""
    lowered = F.translate(F.coalesce(as_col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.btrim(F.regexp_replace(lowered, GAP, " "))


def _keyed(posts: DataFrame, text: str, account: str, post_id: str) -> DataFrame:
    """``text_key, account, post_id, normal`` of the posts with words.

    The words come out of a generator: as a plain column they would be normalised again for each use, and for the filter.
    """
    rows = posts.select(
        as_col(post_id).alias("post_id"), as_col(account).alias("account"), F.explode(F.array(normal_words(text))).alias("normal")
    )
    return rows.filter("normal <> ''").withColumn("text_key", F.md5("normal"))


def _per_account(rows: DataFrame, key: str) -> DataFrame:
    """Posts, accounts and the smallest id per key, counted per account first."""
    own = rows.groupBy(key, "account").agg(F.count(F.lit(1)).alias("n"), F.min("post_id").alias("first"))
    return own.groupBy(key).agg(F.sum("n").alias("posts"), F.count(F.lit(1)).alias("accounts"), F.min("first").alias("first_post"))


def copied_texts(posts: DataFrame, min_accounts: int = 2, text: str = "body", account: str = "source", post_id: str = "post_id") -> DataFrame:
    """``text_key, posts, accounts, first_post`` of the texts that at least ``min_accounts`` accounts have posted."""
    rows = _keyed(posts, text, account, post_id).drop("normal")
    return _per_account(rows, "text_key").filter(F.col("accounts") >= min_accounts)


def shingles(normal: ColumnOrName, words: int) -> Column:
    """The distinct shingles of normalised words, hashed; a shorter text is one shingle."""

    def cut(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(hashes) - words))
        # Past the end of a shorter text there is nothing, which the hash leaves out.
        return F.array_distinct(F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + w) for w in range(words)])))

    return let(F.transform(F.split(as_col(normal), " "), lambda word: F.xxhash64(word)), cut)


def banded(texts: DataFrame, count: int, rows: int) -> DataFrame:
    """``text_key, size, band`` for each band of ``text_key, shingles``: texts of which all minima in a band are the same have it in common.

    A text may come any number of times: its copies have the same size and minima.
    """

    def constant(i: int) -> int:
        value = (i + 1) * SPREAD % (1 << 64)
        return value - (1 << 64) if value >> 63 else value

    hashes = texts.select("text_key", F.posexplode("shingles").alias("at", "h"))
    least = [F.min(F.col("h").bitwiseXOR(F.lit(constant(i)))).alias(f"m{i}") for i in range(count * rows)]
    signatures = hashes.groupBy("text_key").agg((F.max("at") + 1).alias("size"), *least)
    numbers = [F.xxhash64(F.lit(b), *[f"m{b * rows + r}" for r in range(rows)]) for b in range(count)]
    return signatures.select("text_key", "size", F.explode(F.array(*numbers)).alias("band"))


def _similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose texts share so many shingles."""
    a, b = (texts.select(F.col("text_key").alias(end), F.col("shingles").alias(f"{end}_set")) for end in ("a", "b"))
    sets = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    sizes = F.size("a_set") + F.size("b_set")
    alike = let(F.size(F.array_intersect("a_set", "b_set")), lambda common: common >= F.lit(similarity) * (sizes - common))
    return sets.filter(alike).select("a", "b")


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the bands that more than one component is in, with their roots."""
    rooted = members.join(roots.withColumnRenamed("node", "text_key"), "text_key", "left").withColumn("root", F.coalesce("root", "text_key"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most").select("band")
    return rooted.join(mixed, "band").select("band", "text_key", "size", "root")


def similar_texts(posts: DataFrame, similarity: float = 0.8, words: int = 5, count: int = 20, rows: int = 4, text: str = "body",
                  account: str = "source", post_id: str = "post_id") -> DataFrame:
    """``post_id, account, text_key, group_key`` of every post with words: the group is that of the component of its text. Eager."""
    # Texts are normalised anew in each of three passes, and no copy of them is kept: only their bands are.
    keyed = _keyed(posts, text, account, post_id)
    sets = shingles("normal", words).alias("shingles")
    exploded = staged(banded(keyed.select("text_key", sets), count, rows), "bands")
    crowded = exploded.groupBy("band").count().filter("count > 1").select("band")
    # Neither bands nor sets are broadcast: keys of 20 bands, and what copies share, take far less in a file than in memory.
    members = staged(exploded.hint("merge").join(crowded, "band"), "members")
    # Only texts that share a band with another one are compared.
    alike = keyed.select("text_key", "normal").join(members.select("text_key").distinct(), "text_key", "left_semi")
    texts = staged(alike.dropDuplicates(["text_key"]).select("text_key", sets), "compared")
    links = members.select(F.col("text_key").alias("a"), F.col("text_key").alias("b")).limit(0)
    roots = members.select(F.col("text_key").alias("node"), F.col("text_key").alias("root")).limit(0)
    for step in range(PIVOT_ROUNDS + 1):
        met = staged(_rooted(members, roots), "met")
        if met.isEmpty():
            break
        if step < PIVOT_ROUNDS:
            order = F.xxhash64("text_key", F.lit(step))
            other = met.groupBy("band").agg(F.min_by(F.struct("text_key", "size", "root"), order).alias("p")).select("band", "p.*")
            apart = F.lit(True)
        else:
            other, apart = met, F.col("a") < F.col("b")
        other = other.select("band", F.col("text_key").alias("b"), F.col("size").alias("b_size"), F.col("root").alias("b_root"))
        # Sizes alone rule out most pairs, before sets are joined to them.
        possible = F.least("size", "b_size") >= F.lit(similarity) * F.greatest("size", "b_size")
        pairs = met.withColumnRenamed("text_key", "a").join(other, "band").filter((F.col("root") != F.col("b_root")) & possible & apart)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = staged(links.unionAll(_similar(pairs, texts, similarity)), "pairs")
        roots = connected(links)
    grouped = keyed.drop("normal").join(roots.withColumnRenamed("node", "text_key"), "text_key", "left")
    return grouped.select("post_id", "account", "text_key", F.coalesce("root", "text_key").alias("group_key"))


def near_copied_texts(posts: DataFrame, min_accounts: int = 2, **options) -> DataFrame:
    """``texts, posts, accounts, first_post`` of each group of similar texts that at least ``min_accounts`` accounts have posted."""
    found = staged(similar_texts(posts, **options), "similar")
    variants = found.groupBy("group_key", "text_key").count().groupBy("group_key").agg(F.count(F.lit(1)).alias("texts"))
    wide = _per_account(found, "group_key").filter(F.col("accounts") >= min_accounts)
    return wide.join(variants, "group_key").select("texts", "posts", "accounts", "first_post")
