"""Outer joins that stay splittable when one key of the many-row side is hot.

Spark can split a skewed partition of an inner join on either side, but of an
outer join only on the side it preserves, and of a full join on neither. These
joins are therefore put together from an inner or left part, whose hot side can
be split, and an anti part, which needs the distinct keys only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_null(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in columns]


def left_join_many(one: DataFrame, many: DataFrame, keys: list[str]) -> DataFrame:
    """``one`` left join ``many`` where keys of ``many`` may be hot."""
    extra = [c for c in many.columns if c not in keys]
    matched = one.join(many, keys, "inner").select(*one.columns, *extra)
    lonely = one.join(many.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lonely.select(*one.columns, *_as_null(many, extra)))


def full_join_many(one: DataFrame, many: DataFrame, keys: list[str]) -> DataFrame:
    """Full join where keys of ``many`` may be hot; key columns come from ``one``.

    A row that exists only in ``many`` has NULL in every column of ``one``, the
    keys included, as a join of two differently named keys leaves it.
    """
    extra = [c for c in many.columns if c not in keys]
    inside = one.select(*one.columns, F.lit(True).alias("_inside"))
    kept = many.join(inside, keys, "left")
    rows = kept.select(
        *[F.when(F.col("_inside"), F.col(c)).alias(c) for c in one.columns], *extra
    )
    lonely = one.join(many.select(*keys).distinct(), keys, "left_anti")
    return rows.unionByName(lonely.select(*one.columns, *_as_null(many, extra)))
