"""Result files and console previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def export_csv(
    df: DataFrame,
    path: str,
    head: int | None = None,
    order: Sequence[Column | str] = (),
    single_file: bool = False,
) -> None:
    """Write a result as CSV with a header.

    ``head`` keeps the first rows in ``order`` for results that are too long for a report.
    ``single_file`` is for report tables of a few rows; anything else stays one file per task.
    """
    if head is not None:
        df = df.orderBy(*order).limit(head)
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, n: int = 20) -> None:
    """Print the first rows."""
    df.show(n, truncate=False)
