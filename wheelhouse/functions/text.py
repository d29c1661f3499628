"""Words, labels and SQL literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words_of(text: Column) -> Column:
    return F.split(text, " ")


def clean_word(word: Column) -> Column:
    return F.lower(F.trim(word))


def first_letter(word: Column) -> Column:
    return F.substring(word, 1, 1)


def street_line(street: Column, number: Column) -> Column:
    """Street and house number; the number is left away when missing or empty."""
    return F.concat(street, F.when(F.coalesce(number, F.lit("")) != "", F.concat(F.lit(" "), number)).otherwise(F.lit("")))


def prefixed(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), key.cast("string"))


def sql_text(column: Column) -> Column:
    """A quoted SQL literal with inner quotes doubled; NULL becomes the word NULL."""
    quoted = F.concat(F.lit("'"), F.replace(column.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(quoted, F.lit("NULL"))


def sql_number(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("NULL"))


def sql_timestamp(column: Column) -> Column:
    stamp = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(F.concat(F.lit("TO_TIMESTAMP('"), stamp, F.lit("','YYYY-MM-DD HH24:MI:SS')")), F.lit("NULL"))


def sql_date(column: Column) -> Column:
    day = F.date_format(column, "yyyy-MM-dd")
    return F.coalesce(F.concat(F.lit("TO_DATE('"), day, F.lit("','YYYY-MM-DD')")), F.lit("NULL"))


def sql_point(x: Column, y: Column) -> Column:
    return F.coalesce(F.concat(F.lit("POINT("), x.cast("string"), F.lit(","), y.cast("string"), F.lit(")")), F.lit("NULL"))
