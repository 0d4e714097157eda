import random
import re

import pytest
from pyspark.sql import functions as F

from cashtide.functions.tickers import extract_bare_tickers, extract_cashtags, extract_tickers
from cashtide.functions.text import derive_title, score_text
from cashtide.operators.mentions import restrict_mentions
from cashtide.resources.vocabulary import BARE_WORD_BLACKLIST, TICKERS


@pytest.mark.parametrize(
    "text, expected",
    [
        ("$MSFT pays before $BA does", ["BA", "MSFT"]),
        ("QQQ closed flat, nobody cared", ["QQQ"]),
        ("IT IS ALL OR NOTHING FOR THE CEO", []),
        ("GME $GME gme GME", ["GME"]),
        ("$XOM then $AMD then $BA", ["AMD", "BA", "XOM"]),
        ("", []),
        (None, []),
        ("$QQQQX was never listed", []),
        ("a low tide, an open gap and a new home", []),
        ("LOW", ["LOW"]),
        ("sold my $nflx", ["NFLX"]),
        ("MAREGENERAL and SHAREGE hold no word of their own", []),
        ("SO", []),
        ("$SO", ["SO"]),
        ("C", []),
        ("$C", ["C"]),
        ("BRK.B", ["BRK"]),
        ("$TSLA2", []),
        ("TSLA2", ["TSLA"]),
        ("$TSLA²", []),
        ("$TSLAⅣ", []),
        ("$TSLAé", []),
    ],
)
def test_cases(one, text, expected):
    assert one(extract_tickers("text"), "text string", text) == expected


def test_cut_title_makes_a_second_ticker(one):
    body = "x" * 297 + " $COIN"
    both = score_text(derive_title("text"), F.col("text"))
    assert one(extract_tickers(both), "text string", body) == ["C", "COIN"]
    alone = score_text(derive_title("text"), F.col("text"), text_mode="body")
    assert one(extract_tickers(alone), "text string", body) == ["COIN"]


def test_random_texts_match_the_rule(spark):
    rng = random.Random(7)
    pieces = ["$", "A", "C", "BA", "SO", "spy", "SPY", "GME", "é", "²", "_", " ", "1", ".", "́", "Ⅳ", "ß", "\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(4000)]

    def cash(text):
        return [m.upper() for m in re.findall(r"\$([A-Za-z]{1,5})\b", text) if m.upper() in TICKERS]

    def bare(text):
        """Whole runs of ASCII letters, all capitals, not after a dollar sign; found by walking the characters."""
        words, run, start = [], "", " "
        for before, char in zip(" " + text, text + " "):
            if char.isascii() and char.isalpha():
                run, start = run + char, start if run else before
                continue
            if 2 <= len(run) <= 5 and run.isupper() and start != "$":
                words.append(run)
            run = ""
        return [w for w in words if w in TICKERS and w not in BARE_WORD_BLACKLIST]

    df = spark.createDataFrame([(t,) for t in texts], "text string")
    result = df.select(
        "text", extract_cashtags("text").alias("c"), extract_bare_tickers("text").alias("b")
    ).collect()
    for row in result:
        assert row.c == cash(row.text), repr(row.text)
        assert row.b == bare(row.text), repr(row.text)


def test_membership_tables(spark):
    mentions = spark.createDataFrame([("a", "SPY"), ("a", "SO"), ("b", "XX")], "post_id string, ticker string")
    universe = spark.createDataFrame([(t,) for t in TICKERS], "ticker string")
    banned = spark.createDataFrame([(t,) for t in BARE_WORD_BLACKLIST], "ticker string")
    assert [r.ticker for r in restrict_mentions(mentions, universe, banned).collect()] == ["SPY"]
