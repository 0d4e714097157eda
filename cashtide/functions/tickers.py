"""Ticker extraction as native regular-expression columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cashtide.functions.common import ColumnOrName, as_col
from cashtide.resources.vocabulary import BARE_WORD_BLACKLIST, TICKERS

# One to five letters after "$", then no letter, digit or underscore of any script
# (Java's \b disagrees with Unicode word boundaries); two to five capitals standing alone.
CASHTAG_PATTERN = r"\$([A-Za-z]{1,5})(?![\p{L}\p{N}_])"
BARE_PATTERN = r"(?<![A-Za-z$])([A-Z]{2,5})(?![A-Za-z])"


def in_universe(symbols: ColumnOrName, universe: Iterable[str] = TICKERS) -> Column:
    """Keep the array elements that are known tickers (a hash lookup per element)."""
    known = list(universe)
    return F.filter(as_col(symbols), lambda s: s.isin(known))


def not_blacklisted(symbols: ColumnOrName, blacklist: Iterable[str] = BARE_WORD_BLACKLIST) -> Column:
    banned = list(blacklist)
    return F.filter(as_col(symbols), lambda s: ~s.isin(banned))


def extract_cashtags(text: ColumnOrName, universe: Iterable[str] = TICKERS) -> Column:
    """``$TICKER`` in any case, uppercased, in order of appearance."""
    found = F.regexp_extract_all(as_col(text), F.lit(CASHTAG_PATTERN), F.lit(1))
    return in_universe(F.transform(found, F.upper), universe)


def extract_bare_tickers(
    text: ColumnOrName,
    universe: Iterable[str] = TICKERS,
    blacklist: Iterable[str] = BARE_WORD_BLACKLIST,
) -> Column:
    """Capitalised words that are known tickers and no common words, in order of appearance."""
    found = F.regexp_extract_all(as_col(text), F.lit(BARE_PATTERN), F.lit(1))
    return not_blacklisted(in_universe(found, universe), blacklist)


def extract_tickers(
    text: ColumnOrName,
    universe: Iterable[str] = TICKERS,
    blacklist: Iterable[str] = BARE_WORD_BLACKLIST,
) -> Column:
    """Sorted, distinct tickers of the text; an empty array for NULL or empty text."""
    content = F.coalesce(as_col(text), F.lit(""))
    both = F.concat(
        extract_cashtags(content, universe), extract_bare_tickers(content, universe, blacklist)
    )
    return F.array_sort(F.array_distinct(both))
