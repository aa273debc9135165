"""Counts over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white-space characters and the four information separators.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_ENDS = r"\r\n|\r|\n"


def characters(text: Column) -> Column:
    """Length in code points."""
    return F.length(text)


def words(text: Column) -> Column:
    """Runs of non-blank characters.

    All blanks are made spaces first: splitting at one plain character needs no
    regular expression, which takes about half as long.
    """
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.size(F.array_remove(F.split(spaced, " "), ""))


def lines(text: Column) -> Column:
    """The lines of a text, as an array: ends at LF, CR LF or a lone CR."""
    return F.split(text, LINE_ENDS)


def without(text: Column, *marks: str) -> Column:
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def line_characters(text: Column) -> Column:
    """Characters of all lines of a text together, which is all but the line ends."""
    return F.length(without(text, "\n", "\r"))


def line_count(text: Column) -> Column:
    """Number of lines: one more than line ends, where CR LF is one end, not two."""
    ends = F.length(text) - line_characters(text)
    pairs = F.shiftright(F.length(text) - F.length(without(text, "\r\n")), 1)
    return F.lit(1) + ends - pairs
