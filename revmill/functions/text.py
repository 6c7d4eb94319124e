"""Column expressions for review text and category lists. All but NFKC run in the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Every character other than U+0020 that counts as white space in text.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters beyond ASCII that NFKC leaves alone whatever stands beside them within this set: Latin, Greek
# and Cyrillic letters, dashes, quotes and other marks of those blocks, none of them combining.
NFKC_STABLE = "".join(
    chr(i)
    for i in [*range(0xA1, 0x300), *range(0x391, 0x460), *range(0x2010, 0x2028)]
    if unicodedata.normalize("NFKC", chr(i)) == chr(i)
)

# Characters a word may hold. The dotless i stays because case-insensitive matching pairs it with i.
WORD = "a-z0-9\u0131'"


@F.pandas_udf(StringType())
def _nfkc_batch(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


def nfkc(c: Column) -> Column:
    """Unicode NFKC. Every row passes the Arrow step, but only texts with a character NFKC may change are in it."""
    others = F.translate(c, NFKC_STABLE, "")
    return F.coalesce(_nfkc_batch(F.when(others.rlike("[^\\x00-\\x7f]"), c)), c)


def flatten_space(c: Column) -> Column:
    """Every white-space character becomes U+0020, so the patterns below need only test for a space."""
    return F.translate(c, SPACE_CHARS, " " * len(SPACE_CHARS))


def strip_urls(c: Column) -> Column:
    """Web addresses become one space. Expects flattened space. Texts without the marks of one skip the pattern."""
    may = c.contains("://") | F.lower(c).contains("www.")
    return F.when(may, F.regexp_replace(c, r"(?i)https?://[^ ]+|www\.[^ ]+", " ")).otherwise(c)


def strip_emails(c: Column) -> Column:
    """A blank-delimited token that holds x@y.z becomes one space. Expects flattened space.

    Anchoring at the token start keeps the match linear on long tokens without blanks. Texts without @ skip the pattern.
    """
    out = F.regexp_replace(c, r"(?<![^ ])(?=[^ ]+@[^ ]+\.[^ ])[^ ]+", " ")
    return F.when(c.contains("@"), out).otherwise(c)


def strip_symbols(c: Column) -> Column:
    """Runs of anything but letters, digits, apostrophes and blanks become one space, in any letter case."""
    return F.regexp_replace(c, "[^a-zA-Z0-9\u0130\u0131\u017f\u212a' ]+", " ")


def squeeze(c: Column) -> Column:
    """Collapse white space and trim both ends."""
    return F.trim(F.regexp_replace(flatten_space(c), " +", " "))


def words_only(c: Column) -> Column:
    """Lower-case words joined by one space: symbol stripping, collapsing and trimming in one scan."""
    return F.array_join(F.regexp_extract_all(F.lower(c), F.lit(f"[{WORD}]+"), F.lit(0)), " ")


def normalise_text(c: Column) -> Column:
    """The cleaned text before its length gate."""
    return words_only(strip_emails(strip_urls(flatten_space(nfkc(c)))))


def bound_text(c: Column, min_chars: int, max_chars: int | None = None) -> Column:
    """Null below the minimum; above the maximum, if there is one, cut there and drop the last, possibly broken, word."""
    if max_chars is None:
        return F.when(F.length(c) >= min_chars, c)
    cut = F.regexp_replace(F.substring(c, 1, max_chars), " [^ ]*$", "")
    return F.when(F.length(c) < min_chars, None).when(F.length(c) > max_chars, cut).otherwise(c)


def truncate_suffix(c: Column, limit: int = 5000, suffix: str = "... [truncated]") -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(suffix))).otherwise(c)


def normalise_categories(c: Column) -> Column:
    """Comma list to lower-case unique names in first-seen order, joined by ', '; null when none is left."""
    names = F.transform(F.split(c, ","), lambda p: F.lower(squeeze_ends(p)))
    joined = F.array_join(F.array_distinct(F.filter(names, lambda p: p != "")), ", ")
    return F.nullif(joined, F.lit(""))


def has_category(c: Column) -> Column:
    """True where a name is left after normalising: some character other than comma and white space."""
    return F.coalesce(c.rlike(f"[^, {SPACE_CHARS}]"), F.lit(False))


def squeeze_ends(c: Column) -> Column:
    """Trim any white space at both ends and leave the inside alone."""
    return F.trim(c, F.lit(" " + SPACE_CHARS))


def category_array(c: Column) -> Column:
    """The training split: exactly comma and blank."""
    return F.split(c, ", ")


def category_items(c: Column) -> Column:
    """The exploratory split: comma and any white space after it."""
    return F.split(c, r",\s*")


def tokens(c: Column) -> Column:
    """Words of cleaned text, as the ML tokenizer gives them."""
    return F.split(F.lower(c), r"\s")


def without(words: Column, stop_words: list[str]) -> Column:
    """Remove stop words, comparing in lower case."""
    return F.filter(words, lambda w: ~F.lower(w).isin(stop_words))


def bigrams(words: Column) -> Column:
    """Neighbouring word pairs joined by a space; empty below two words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def parse_json(c: Column, schema: str) -> Column:
    """JSON text to a typed record; null when malformed."""
    return F.from_json(c, schema)
