"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def reversed_text(text: Column) -> Column:
    return F.reverse(text.cast("string"))


def register_reverse_string(spark: SparkSession, name: str = "reverse_string") -> None:
    """Make ``name(x)`` available to SQL of this session. A SQL function is inlined into the plan, so it costs nothing."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS STRING RETURN reverse(x)")


def is_multibyte(text: Column) -> Column:
    """True where some character takes more than one byte in UTF-8."""
    return F.octet_length(text) != F.char_length(text)


def words_in(text: Column, words: str) -> Column:
    """All occurrences of ``words`` (a regular expression) as whole words in any case, in order and in lower case."""
    pattern = rf"(?i)(?<![A-Za-z0-9_])({words})(?![A-Za-z0-9_])"
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lower)


#: Comments and quoted texts of SQL, whichever begins first; an unfinished one runs to the end. A doubled quote inside a text
#: ends one and begins the next, which takes out the same. Every repetition is of one character, so that long texts do
#: not fill the stack.
NO_CODE = r"""'[^']*(?:'|\z)|"[^"]*(?:"|\z)|--[^\n]*|(?s:/\*.*?(?:\*/|\z))"""


def code_of(script: Column) -> Column:
    """``script`` with a blank in place of every comment and quoted text."""
    return F.regexp_replace(script, NO_CODE, " ")
