"""Chat formatting by prefix-target expansion. DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are the context, its text is the target
and alone is trainable. A conversation that does not end with an assistant turn has a last example without a
target, so that the output holds every turn and can be read back.

A turn is formatted as ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts ``&`` is written ``&amp;``, ``<``
``&lt;`` and ``[`` ``&#91;``, so no control string of this template, nor of other usual ones (``</s>``, ``[INST]``),
can occur there; unescaping in reverse order gives back the text. The context of an example ends with the opened
turn (``<|turn|>assistant<|text|>``), the target is the escaped text, and ``<|end|>`` follows it outside the mask.

Turns of one conversation are gathered: the last example holds them all, so each row of the result is as large as
that. Conversations with equal turns (a third of all rows, say) spread by their ids.

Defined cases: a null text is empty, a null role is the empty role (never trainable), a null turn comes after all
others; equal turn numbers follow role, then text. Repeated rows are turns of their own. Rows with a null id make up one conversation. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: In the order of escaping; reading back takes them in reverse.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
TRAINED = "assistant"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def format_examples(conversations: DataFrame, trained: str = TRAINED) -> DataFrame:
    """``conv_id, example, context, target, close``: the examples of each conversation, numbered from 0.

    The formatted text is ``context || target || close``; only ``target`` is under the loss mask. The last example of a
    conversation that ends otherwise has a null target.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNull().alias("open"),
            F.col("turn").cast("long").alias("turn"),
            text("role").alias("role"),
            text("text").alias("text"),
        ).alias("t"),
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    written = gathered.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("text"), (t["role"] == trained).alias("own"))).alias("turns"),
    )
    # Places of the trained turns, and one after the end if the last turn is not trained.
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["own"])
    rest = F.when(F.element_at("turns", -1)["own"], F.array().cast("array<int>")).otherwise(F.array(F.size("turns") + 1))
    expanded = written.select("conv_id", "turns", F.posexplode(F.concat(places, rest)).alias("example", "place"))
    before = F.slice("turns", 1, F.col("place") - 1)
    whole = F.array_join(F.transform(before, lambda t: F.concat(t["head"], t["text"], F.lit(END))), "")
    here = F.when(F.col("place") <= F.size("turns"), F.element_at("turns", F.col("place")))
    return expanded.select(
        "conv_id",
        "example",
        F.concat(whole, F.coalesce(here["head"], F.lit(""))).alias("context"),
        here["text"].alias("target"),
        F.when(here.isNotNull(), F.lit(END)).otherwise(F.lit("")).alias("close"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from the formatted texts alone.

    The last example of a conversation has all its turns; the targets of all examples are what is trained.
    """
    formatted = F.concat("context", F.coalesce("target", F.lit("")), "close")
    last = F.max(F.struct("example", formatted.alias("all")))["all"]
    targets = F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("example", "target"))))
    joined = examples.groupBy("conv_id").agg(
        last.alias("all"),
        F.array_join(F.transform(targets, lambda t: unescape(t["target"])), "").alias("loss"),
        F.sum(F.length(formatted)).alias("formatted_chars"),
    )
    pieces = F.split(F.col("all"), F.lit(r"\Q" + END + r"\E"))
    turns = F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1),
        lambda p: F.concat(
            unescape(F.substring_index(F.substring(p, len(TURN) + 1, F.length(p)), TEXT, 1)), F.lit("\n"), unescape(F.substring_index(p, TEXT, -1)), F.lit("\n")
        ),
    )
    return joined.withColumn("turns", turns).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
