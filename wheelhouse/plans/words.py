"""Word statistics over a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelhouse.functions.text import clean_word, first_letter, words_of
from wheelhouse.operators.layout import spread


def lines_of(documents: DataFrame, text: str) -> DataFrame:
    """One row per line of every document, in column ``value``."""
    return spread(documents.select(text)).select(F.explode(F.split(F.col(text), r"\r\n|\r|\n")).alias("value"))


def words(lines: DataFrame, text: str) -> DataFrame:
    """One row per word; empty strings between neighbouring blanks are left out."""
    separated = lines.select(F.explode(words_of(F.col(text))).alias("word"))
    return separated.where(F.col("word") != "")


def word_counts(lines: DataFrame, text: str) -> DataFrame:
    return words(lines, text).groupBy("word").agg(F.count(F.lit(1)).alias("amount"))


def letter_counts(counted: DataFrame) -> DataFrame:
    """Occurrences per first letter, added up from word counts."""
    return counted.groupBy(first_letter(F.col("word")).alias("letter")).agg(F.sum("amount").alias("amount"))


def top_words(lines: DataFrame, text: str, count: int = 20) -> DataFrame:
    """The most frequent words in lower case; ties go by the alphabet."""
    cleaned = words(lines, text).select(clean_word(F.col("word")).alias("word")).where(F.col("word") != "")
    counted = cleaned.groupBy("word").agg(F.count(F.lit(1)).alias("amount"))
    return counted.orderBy(F.desc("amount"), "word").limit(count)
