"""Characters, words and lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.text import characters, line_characters, line_count, lines, words


def lines_of(texts: DataFrame, column: str) -> DataFrame:
    """Texts held in a column as one row per line in ``value``."""
    return texts.select(F.explode(lines(F.col(column))).alias("value"))


def line_measures(line: Column) -> dict[str, Column]:
    return {"chars": characters(line), "words": words(line), "lines": F.lit(1)}


def text_measures(text: Column) -> dict[str, Column]:
    """The sums of the line measures over all lines of one text."""
    return {"chars": line_characters(text), "words": words(text), "lines": line_count(text)}


def line_pairs(text: DataFrame) -> DataFrame:
    """Three ``key, value`` rows per line."""
    pairs = [
        F.struct(F.lit(key).alias("key"), count.cast("bigint").alias("value"))
        for key, count in line_measures(F.col("value")).items()
    ]
    return text.select(F.inline(F.array(*pairs)))


def sum_by_key(pairs: DataFrame) -> DataFrame:
    """Sum per key. Tasks add up their own rows first, so a hot key is no load."""
    return pairs.groupBy("key").agg(F.sum("value").alias("total"))


def text_totals(text: DataFrame) -> DataFrame:
    """The same totals as ``sum_by_key(line_pairs(text))``, without tripling the rows."""
    return side_by_side(text, line_measures(F.col("value")))


def column_totals(texts: DataFrame, column: str) -> DataFrame:
    """The totals over the lines of texts in a column, without making rows of lines.

    Line ends are blanks, so words can be counted in the whole text.
    """
    return side_by_side(texts, text_measures(F.col(column)))


def side_by_side(rows: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Sum each count, then turn the sums into ``key, total`` rows. No input, no rows."""
    totals = rows.agg(*[F.sum(count).cast("bigint").alias(key) for key, count in counts.items()])
    pairs = [F.struct(F.lit(key).alias("key"), F.col(key).alias("total")) for key in counts]
    return totals.filter(F.col("lines").isNotNull()).select(F.inline(F.array(*pairs)))
