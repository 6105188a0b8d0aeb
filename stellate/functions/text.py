"""Text functions. Every function takes and returns a Spark ``Column``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
OTHER_BLANKS = WHITESPACE.replace(" ", "")

# Break tags that become a blank, the suffix separator, the registry address.
BREAK_TAGS = ("<br>", "<BR>")
SUFFIX = " - "
STUDY_URL = "https://clinicaltrials.gov/study/"

# Digits with at most one point and a leading minus sign.
NUMERIC_TEXT = r"^-?(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)$"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode blanks included."""
    return F.btrim(c, F.lit(WHITESPACE))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_whitespace(c: Column, remove_html: bool = True) -> Column:
    """Break tags to blanks, whitespace runs to one blank, strip, empty text to NULL.

    Other blanks become plain ones first: a pattern of one character is several times faster
    over long texts than one with the whole set.
    """
    text = c.cast("string")
    if remove_html:
        for tag in BREAK_TAGS:
            text = F.replace(text, F.lit(tag), F.lit(" "))
    text = F.translate(text, OTHER_BLANKS, " " * len(OTHER_BLANKS))
    return empty_to_null(F.trim(F.regexp_replace(text, " {2,}", " ")))


def before_first(c: Column, separator: str = SUFFIX) -> Column:
    """Text before the first separator; the whole text when there is none."""
    return F.substring_index(c, separator, 1)


def before_last(c: Column, separator: str = SUFFIX) -> Column:
    """Text before the last separator; the whole text when there is none."""
    tail = F.length(F.substring_index(c, separator, -1)) + len(separator)
    return F.when(c.contains(separator), F.substring(c, F.lit(1), F.length(c) - tail)).otherwise(c)


def after_first(c: Column, separator: str = SUFFIX) -> Column:
    """Text after the first separator; NULL when there is none."""
    at = F.instr(c, separator)
    return F.when(at > 0, F.substring(c, at + len(separator), F.length(c)))


def collapse_to_parent(c: Column, child: Column, separator: str = SUFFIX) -> Column:
    """``parent - child`` becomes ``parent``, only if the tail equals ``child``."""
    return F.when(after_first(c, separator) == child, before_first(c, separator)).otherwise(c)


def registry_link(c: Column) -> Column:
    """Keep web addresses, turn the first NCT number of a list into one, drop anything else."""
    text = strip(c)
    numbers = F.filter(
        F.transform(F.split(text, "\n"), strip), lambda t: F.upper(t).startswith("NCT")
    )
    return F.when(text.startswith("http"), text).otherwise(
        F.concat(F.lit(STUDY_URL), F.get(numbers, F.lit(0)))
    )


def sentinel_to_null(c: Column, sentinels: list[str]) -> Column:
    return F.when(~c.isin(sentinels), c)


def numeric_text_to_null(c: Column) -> Column:
    """Drop values that are nothing but a number, such as ``5001``."""
    numeric = strip(c.cast("string")).rlike(NUMERIC_TEXT)
    return F.when(F.coalesce(~numeric, F.lit(True)), c)


def iso_date_prefix(c: Column) -> Column:
    """First ten characters; NULL when shorter."""
    return F.when(F.length(c) >= 10, F.substring(c, 1, 10))


def year_of(c: Column) -> Column:
    """First four characters as a year; NULL when they are not a number."""
    return F.when(F.length(c) >= 4, F.substring(c, 1, 4).try_cast("int"))


def split_parts(c: Column, delimiter: str = ";") -> Column:
    """Array of the stripped, non-empty parts of a delimited text."""
    parts = F.transform(F.split(c, rf"\Q{delimiter}\E"), strip)
    return F.filter(parts, lambda p: p != "")
