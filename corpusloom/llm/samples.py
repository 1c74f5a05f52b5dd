"""Bounded samples of rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1 << 30


def about(df: DataFrame, key: Column | str, rows: int, seed: int) -> DataFrame:
    """Some ``rows`` rows of a table, the same ones at every run.

    Rows are taken by a hash of their key, so no task and no sort sees them all. The
    number may miss ``rows`` by a few percent; a table that is smaller is taken whole.
    """
    total = df.count()
    if total <= rows:
        return df
    drawn = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(SCALE))
    return df.where(drawn < int(SCALE * rows / total))
