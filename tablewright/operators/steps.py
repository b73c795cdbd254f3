"""Ordered steps over a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def run_steps(df: DataFrame, steps: Mapping[int, Step]) -> DataFrame:
    """Apply the steps from the lowest number to the highest."""
    for number in sorted(steps):
        df = df.transform(steps[number])
    return df
