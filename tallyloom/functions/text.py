"""String expressions. Everything here is ``Column -> Column`` and stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that count as whitespace, for stripping and for collapsing runs.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# The same set as a regular expression. Single low characters become one bit test; everything else is only looked at inside
# the one range that holds it, so an ordinary letter costs two tests.
WHITESPACE_CLASS = (
    r"[ \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x{85}\x{a0}"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
)
# Whitespace that is not already one plain space: a longer run, or a single character other than the space.
_UNTIDY_RUN = f"{WHITESPACE_CLASS}(?:{WHITESPACE_CLASS}++|(?<! ))"
# Fixed value: a word is a run of letters, numbers and underscores in any script.
WORD = r"[\p{L}\p{N}_]+"


def text_or_empty(col: Column) -> Column:
    """A missing text counts as the empty string."""
    return F.coalesce(col.cast("string"), F.lit(""))


def strip(col: Column) -> Column:
    """Remove Unicode whitespace at both ends (Spark's plain ``trim`` only removes the space character)."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    return strip(col) == ""


def joined_length(*parts: Column) -> Column:
    """Length in code points of the newline-joined parts, stripped after joining."""
    return F.length(strip(F.concat_ws("\n", *parts)))


def normalise(col: Column) -> Column:
    """Strip, lower, and collapse every whitespace run to one space."""
    return F.regexp_replace(F.lower(strip(col)), _UNTIDY_RUN, " ")


def norm_key(col: Column) -> Column:
    """Hex SHA-256 of the normalised text."""
    return F.sha2(normalise(col), 256)


def norm_key_bytes(col: Column) -> Column:
    """The same key as 32 raw bytes: half the shuffle volume of the hex form."""
    return F.unhex(norm_key(col))


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Without this an array used inside another higher-order function's lambda may be re-evaluated per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trigram_repetition(col: Column) -> Column:
    """Share of word-trigram occurrences whose trigram occurs more than once in the text; 0.0 below three words.

    Sorting puts equal trigrams side by side, so an occurrence is repeated exactly when a neighbour equals it. The work
    is local to the row: no explode, no shuffle.
    """

    def repeated_share(sorted_trigrams: Column) -> Column:
        repeated = F.filter(
            sorted_trigrams,
            lambda t, i: (t == F.get(sorted_trigrams, i - 1)) | (t == F.get(sorted_trigrams, i + 1)),
        )
        return F.size(repeated) / F.size(sorted_trigrams)

    def score(words: Column) -> Column:
        trigrams = F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1), F.lit(" "), F.get(words, i + 2)),
        )
        return F.when(F.size(words) < 3, F.lit(0.0)).otherwise(_bind(F.sort_array(trigrams), repeated_share))

    return _bind(F.regexp_extract_all(F.lower(col), F.lit(WORD), F.lit(0)), score)


def truncate(col: Column, max_chars: int) -> Column:
    """The first ``max_chars`` code points."""
    return F.substring(col, 1, max_chars)


def shares_whole_prefix(a: Column, b: Column) -> Column:
    """True when neither text is empty and the shorter one opens the longer one."""
    return (a != "") & (b != "") & (F.startswith(a, b) | F.startswith(b, a))


def passage(title: Column, text: Column) -> Column:
    """Title and text joined by a space, or the text alone under a blank title."""
    head, body = strip(text_or_empty(title)), strip(text_or_empty(text))
    return F.when(head == "", body).otherwise(strip(F.concat(head, F.lit(" "), body)))
