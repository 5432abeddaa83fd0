"""Text normalisation as native column expressions.

Everything here stays inside the JVM: a chain of ``regexp_replace`` calls that Catalyst keeps
in one generated stage with the scan, so cleaning needs no Python worker.

Java's ``\\w``, ``\\s`` and ``\\b`` are ASCII-only, so the classes below are written out to
cover Unicode letters, digits and blanks.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes, patterns and mask tokens.
WORD = r"\p{L}\p{N}_"
BLANK_BUT_SPACE = r"\t\n\r\f\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANK = " " + BLANK_BUT_SPACE
# The patterns start with one cheap test that most characters fail: the first letters of a URL,
# one code character before the look-behind, one range check before the long list of blanks.
URL_PATTERN = rf"(?=[hw])(?:https?://[^{BLANK}]+|www\.[^{BLANK}]+)"
MENTION_PATTERN = rf"@[{WORD}]+"
# Java steps back over a character outside the basic plane only if the look-behind names one.
_WORD_BEHIND = WORD + "\U0001d4b4"
CODE_PATTERN = rf"[A-Z0-9](?<![{_WORD_BEHIND}].)[A-Z0-9]{{9,}}+(?![{WORD}])"
DIGITS_PATTERN = rf"[0-9](?<![{_WORD_BEHIND}].)[0-9]{{9,}}+(?![{WORD}])"
CODE_NOT_MENTION_PATTERN = rf"[A-Z0-9](?<![{_WORD_BEHIND}@].)[A-Z0-9]{{9,}}+(?![{WORD}])"
# Runs of blanks other than a lone U+0020, which already is the wanted result.
_ONE_BLANK = rf"(?:(?![!-\x84])[{BLANK}])"
BLANK_RUN_PATTERN = (
    rf"(?=[ \x00-\x1f\x85-\x{{10ffff}}])(?: {_ONE_BLANK}++|[{BLANK_BUT_SPACE}]{_ONE_BLANK}*+)"
)
URL_TOKEN = "[URL]"
MENTION_TOKEN = "[USER]"
CODE_TOKEN = "[PRODUCT]"


def _column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def mask_urls(text) -> Column:
    return F.regexp_replace(_column(text), F.lit(URL_PATTERN), F.lit(URL_TOKEN))


def mask_mentions(text) -> Column:
    return F.regexp_replace(_column(text), F.lit(MENTION_PATTERN), F.lit(MENTION_TOKEN))


def mask_codes(text) -> Column:
    return F.regexp_replace(_column(text), F.lit(CODE_PATTERN), F.lit(CODE_TOKEN))


def squeeze_blanks(text) -> Column:
    """Every run of blanks (newlines included) becomes one space; outer blanks go."""
    return F.trim(F.regexp_replace(_column(text), F.lit(BLANK_RUN_PATTERN), F.lit(" ")))


def clean_text(text, mask_codes_before_lower: bool = False) -> Column:
    """Lower-case, mask URLs, mentions and product codes, squeeze blanks; null becomes ``""``.

    By default codes are masked after lower-casing, so only runs of ten or more digits can
    match. ``mask_codes_before_lower=True`` also masks upper-case alphanumeric codes first, and
    lower-cases what lies between the tokens.
    """
    source = _column(text)
    lowered = F.lower(source)
    if mask_codes_before_lower:
        # A text that holds the token itself is lower-cased there, like everywhere else.
        plain = F.replace(source, F.lit(CODE_TOKEN), F.lit(CODE_TOKEN.lower()))
        coded = F.regexp_replace(plain, F.lit(CODE_NOT_MENTION_PATTERN), F.lit(CODE_TOKEN))
        between = F.split(coded, re.escape(CODE_TOKEN))
        lowered = F.array_join(F.transform(between, F.lower), CODE_TOKEN)
    # Substring tests are much cheaper than a regular expression that finds nothing.
    may_have_url = F.contains(lowered, F.lit("://")) | F.contains(lowered, F.lit("www."))
    masked = F.when(may_have_url, mask_urls(lowered)).otherwise(lowered)
    masked = F.when(F.contains(source, F.lit("@")), mask_mentions(masked)).otherwise(masked)
    # What is left of upper-case letters are the short mask tokens, so codes are digits by now.
    masked = F.regexp_replace(masked, F.lit(DIGITS_PATTERN), F.lit(CODE_TOKEN))
    cleaned = squeeze_blanks(masked)
    return F.coalesce(cleaned, F.lit(""))


def has_text(text) -> Column:
    """Not null and not made of U+0020 only; a newline-only text passes and cleans to ``""``.

    True or false, never null; the null test reaches a Parquet scan as a pushed filter.
    """
    text = _column(text)
    return text.isNotNull() & (F.length(F.trim(text)) > 0)


def text_length(text) -> Column:
    """Characters of the raw text."""
    return F.length(_column(text))
