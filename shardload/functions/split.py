"""Java ``String.split`` semantics as Column expressions.

Java drops trailing empty strings, returns ``[""]`` for an empty input and
``[]`` for an input made only of separators.  Spark's ``split`` keeps trailing
empties, so the trailing run of separators is stripped first.  Separators are
literal strings here (quoted for the regex engine).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_STR_ARRAY = "array<string>"


REGEX_META = ".$|()[{^?*+\\"


def quote(sep: str) -> str:
    """Quote a literal separator for Java regex.  A single character keeps the
    form that ``String.split`` handles without the regex engine."""
    if len(sep) == 1:
        return "\\" + sep if sep in REGEX_META else sep
    if "\\E" in sep:
        return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return "\\Q" + sep + "\\E"


def strip_trailing(c: Column, sep: str) -> Column:
    if len(sep) == 1:
        return F.rtrim(c, F.lit(sep))
    return F.regexp_replace(c, f"(?:{quote(sep)})+\\z", "")


def strip_leading(c: Column, sep: str) -> Column:
    if len(sep) == 1:
        return F.ltrim(c, F.lit(sep))
    return F.regexp_replace(c, f"\\A(?:{quote(sep)})+", "")


def java_split(c: Column, sep: str) -> Column:
    """``c.split(sep)`` with Java's rules; null stays null."""
    t = strip_trailing(c, sep)
    return (F.when(F.length(c) == 0, F.array(F.lit("")))
            .otherwise(F.when(F.length(t) == 0, F.array().cast(EMPTY_STR_ARRAY))
                       .otherwise(F.split(t, quote(sep), -1))))
