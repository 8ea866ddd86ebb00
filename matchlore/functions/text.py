"""Text columns: cleaning, tokens, quoting and result texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a token loses, besides digits.
TOKEN_STRIP = ".-:;!@#$%^&*(){}"
TOKEN_DROP = "[0-9" + "".join("\\" + mark for mark in TOKEN_STRIP) + "]+"
# White space as Unicode has it, line ends included.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind (plain ``trim`` drops blanks only)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def count_filled_lines(text: Column) -> Column:
    """How many lines of a text are not blank."""
    return F.size(F.filter(lines(text), lambda line: strip(line) != ""))


def strip_each_line(text: Column) -> Column:
    return F.array_join(F.transform(lines(text), strip), "\n")


def tokenize(text: Column) -> Column:
    """Lower-cased words without digits and punctuation; commas and quotes stay.

    Works on a line or on a whole text: a line break ends a word as well.
    """
    bare = F.regexp_replace(F.lower(text), TOKEN_DROP, "")
    words = F.transform(F.split(bare, "[ \n]"), strip)
    return F.filter(words, lambda word: word != "")


def unquote(text: Column) -> Column:
    """Strip up to two layers of quotes, outer first, then unescape ``\\'``.

    A layer is a leading ``'``, a trailing ``'``, a leading ``"`` and a
    trailing ``"``, each optional and taken in this order.
    """
    for _ in range(2):
        for edge in ("^'", "'$", '^"', '"$'):
            text = F.regexp_replace(text, edge.replace("$", r"\z"), "")
    return F.replace(text, F.lit("\\'"), F.lit("'"))


def unwrap_result(text: Column) -> Column:
    """Strip, take off one pair of square brackets, strip again."""
    clean = strip(text)
    inner = F.substring(clean, F.lit(2), F.greatest(F.length(clean) - 2, F.lit(0)))
    wrapped = clean.startswith("[") & clean.endswith("]")
    return F.when(wrapped, strip(inner)).otherwise(clean)


def first_line(text: Column) -> Column:
    return F.substring_index(strip(text), "\n", 1)


def last_word(text: Column) -> Column:
    """What follows the last blank (the whole text if there is none)."""
    return F.substring_index(text, " ", -1)


def minute_line(minute: Column, sentence: Column) -> Column:
    return F.concat(minute.cast("string"), F.lit(": "), strip(sentence))


def position(needle: Column, text: Column, start: Column | None = None) -> Column:
    """1-based position of ``needle`` from ``start`` on, 0 if absent."""
    return F.position(needle, text, start) if start is not None else F.position(needle, text)
