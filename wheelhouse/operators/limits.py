"""Row selections that depend on other rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_watermark(loaded: DataFrame, key: str) -> Column:
    """The greatest key loaded so far, or 0, as a scalar subquery."""
    return loaded.agg(F.coalesce(F.max(key), F.lit(0)).alias(key)).scalar()


def above_watermark(source: DataFrame, loaded: DataFrame, source_key: str, loaded_key: str) -> DataFrame:
    """Source rows that come after everything already loaded."""
    return source.where(F.col(source_key) > high_watermark(loaded, loaded_key))


def widening_window(
    df: DataFrame, date_column: str, first_day: str, day_spans: Sequence[int], min_rows: int
) -> DataFrame:
    """Keep the shortest of the growing windows that holds ``min_rows`` rows, else the longest.

    One count per window, all in one pass over the longest window, decides; the static bound on the
    longest window still reaches the scan.
    """
    spans = sorted(day_spans)
    start = F.lit(first_day).cast("date")
    day = F.to_date(F.col(date_column))
    lower = F.col(date_column) >= start.cast("timestamp_ntz")
    within = F.col(date_column) < F.date_add(start, spans[-1]).cast("timestamp_ntz")
    widest = df.where(lower & within)
    chosen = F.coalesce(
        *(F.when(F.count_if(day < F.date_add(start, n)) >= min_rows, F.lit(n)) for n in spans[:-1]),
        F.lit(spans[-1]),
    )
    days = widest.agg(chosen.alias("days")).scalar()
    return widest.where(F.datediff(day, start) < days)


def first_rows(df: DataFrame, order: Sequence[str | Column], count: int) -> DataFrame:
    """The first ``count`` rows in a total order; each task keeps only its own first rows."""
    return df.orderBy(*order).limit(count)
