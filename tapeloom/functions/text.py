"""Column functions over news text. All are built-in expressions on whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Capitalised words that are not tickers.
TICKER_BLACKLIST = (
    "A", "I", "IT", "AT", "GO", "BE", "DO", "IS", "AS", "OR", "AN", "ON",
    "US", "UK", "EU", "CEO", "CFO", "IPO", "ETF", "GDP", "CPI", "FED",
    "NYSE", "NASDAQ", "SEC", "FDA", "DOW", "USD", "EUR", "GBP",
    "Q1", "Q2", "Q3", "Q4", "YTD", "YOY", "MOM", "WOW", "EPS", "PE",
    "BUY", "SELL", "HOLD", "NEW", "THE", "AND", "FOR", "ALL", "TOP",
    "INC", "LLC", "LTD", "CORP", "CO", "EST", "PM", "AM",
)
# Words that colour a headline.
POSITIVE_WORDS = ("strong", "surge", "rise", "climb", "rally", "bullish", "optimistic", "raise")
NEGATIVE_WORDS = ("weak", "drop", "fall", "slide", "tumble", "bearish", "skeptical", "cut")
# Python's \s on text: Unicode white space plus the four information separators.
_SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"


def clean_html(col: Column) -> Column:
    return F.regexp_replace(F.coalesce(col, F.lit("")), "<[^>]+>", "")


def clean_special(col: Column) -> Column:
    """Everything but letters, digits, underscore, space and basic punctuation to a space."""
    keep = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f.,!?;:'-]"
    return F.regexp_replace(F.coalesce(col, F.lit("")), keep, " ")


def collapse_space(col: Column) -> Column:
    one = F.regexp_replace(F.coalesce(col, F.lit("")), f"{_SPACE}+", " ")
    return F.trim(one)


def clean_text(col: Column) -> Column:
    return collapse_space(clean_special(clean_html(col)))


def extract_tickers(col: Column, valid: Column | None = None) -> Column:
    """Distinct tickers of a text, sorted: ``$`` names as they are, capitalised
    words of 2 to 5 letters unless blacklisted. Null text gives an empty list."""
    text = F.coalesce(col, F.lit(""))
    # word boundaries are Unicode-aware: no letter, digit or underscore beside the word
    explicit = F.regexp_extract_all(text, F.lit(r"(?U)\$([A-Z]{1,5})\b"), 1)
    words = F.regexp_extract_all(text, F.lit(r"(?U)\b([A-Z]{2,5})\b"), 1)
    kept = F.array_except(words, F.array(*[F.lit(w) for w in TICKER_BLACKLIST]))
    found = F.array_union(explicit, kept)
    if valid is not None:
        found = F.array_intersect(found, valid)
    return F.array_sort(found)


def parse_tickers(col: Column) -> Column:
    """A JSON array of names, else a comma list; trimmed and upper-cased, blanks dropped.
    Null gives an empty list, as does JSON that is not an array."""
    items = F.from_json(col, "array<string>")
    as_list = F.when(F.trim(col).startswith("["), items)
    as_object = F.when(F.trim(col).rlike(r"^(\{.*\}|-?\d+(\.\d+)?|true|false|null|\".*\")$"),
                       F.array().cast("array<string>"))
    names = F.coalesce(as_list, as_object, F.split(col, ","))
    tidy = F.transform(names, lambda x: F.upper(F.trim(x)))
    return F.coalesce(F.filter(tidy, lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))


def lexicon_sentiment(col: Column) -> Column:
    """positive, negative or neutral by which word list has more hits in the text."""
    text = F.lower(F.coalesce(col, F.lit("")))
    hits = lambda words: sum((text.contains(w).cast("int") for w in words), F.lit(0))
    pos, neg = hits(POSITIVE_WORDS), hits(NEGATIVE_WORDS)
    return F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")


def news_id(headline: Column, time: Column) -> Column:
    return F.substring(F.md5(F.concat(headline, time.cast("string")).cast("binary")), 1, 16)
