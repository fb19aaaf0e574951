"""Column expressions for tokenising and normalising text.

Everything here is a built-in Spark expression (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of Python's ``str.split()`` (characters with
# ``str.isspace()``), written as one regex character class.  Java and RE2 read it
# the same way, so the DuckDB oracle uses the identical pattern text.
WHITESPACE_CLASS = (
    "\\t\\n\\x0b\\f\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)
WHITESPACE_RUN = f"[{WHITESPACE_CLASS}]+"
# A letter is any character of Unicode category L (Python's ``str.isalpha()``).
NON_LETTER = "[^\\p{L}]"
# Neither a letter nor whitespace: removed from a whole text before splitting.  A letter, the usual character, is
# settled by the first test; in one negated class it would pass through every range of the whitespace set.
NON_LETTER_NON_SPACE = f"[\\P{{L}}&&[^{WHITESPACE_CLASS}]]+"
NON_LETTER_RUN = "\\P{L}+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text: str | Column) -> Column:
    """Array of whitespace-separated pieces (may hold empty strings at the ends)."""
    return F.split(F.coalesce(_col(text), F.lit("")), WHITESPACE_RUN)


def normalise(word: str | Column) -> Column:
    """Lowercase, then keep letters only ('Ba,Na:Na.123' -> 'banana')."""
    return F.regexp_replace(F.lower(_col(word)), NON_LETTER, "")


def split_terms(text: str | Column) -> Column:
    """Normalised terms of a whole text as one array (may hold empty strings).

    Equal to splitting first and normalising each token: lowercasing never turns a
    character into whitespace, and keeping whitespace while removing every other
    non-letter leaves token boundaries where they were.  One regex pass per text
    instead of one per token.  What is left is letters and whitespace, so a run of
    non-letters is a run of whitespace.
    """
    cleaned = F.regexp_replace(F.lower(F.coalesce(_col(text), F.lit(""))), NON_LETTER_NON_SPACE, "")
    return F.split(cleaned, NON_LETTER_RUN)
