"""Generated ids and appends that can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Buckets by the first hex digits of the key's MD5, and rows they should hold.
HEX_DIGITS = 3
MAX_HEX_DIGITS = 5
BUCKET_ROWS = 250_000


def digits_for(rows: int) -> int:
    """Hex digits that keep the buckets of a table of this size small."""
    digits = HEX_DIGITS
    while digits < MAX_HEX_DIGITS and rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def assign_ids(
    df: DataFrame, keys: list[str], existing: DataFrame | None = None, hex_digits: int = HEX_DIGITS
) -> DataFrame:
    """Add contiguous unique ids, following those of ``existing``.

    Ids follow the MD5 of the unique key. Rows are numbered inside buckets of its first
    digits, and every bucket starts where the ones before it end. No sort runs over the
    whole table, the buckets are even however the keys are spread, and neither a rerun nor
    another number of digits gives other ids.
    """
    key = F.concat_ws("\x01", *[F.col(c).cast("string") for c in keys])
    hashed = df.withColumn("_digest", F.md5(key))
    bucketed = hashed.withColumn("_bucket", F.substring("_digest", 1, hex_digits))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    # One row per bucket, 16 ** hex_digits at most.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    if existing is not None:
        top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()["top"]
        offsets = offsets.withColumn("_offset", F.col("_offset") + top)
    inside = Window.partitionBy("_bucket").orderBy("_digest", *keys)
    return (
        bucketed.withColumn("_number", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("id", F.col("_offset") + F.col("_number"))
        .select("id", *df.columns)
    )


def new_rows(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet, so that a repeated append adds nothing.

    NULLs are equal as keys. Of several rows with one key, one is new.
    """
    held = stored.select(*(F.col(c).alias(f"_held_{c}") for c in keys))
    same = [F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in keys]
    return rows.dropDuplicates(keys).join(held, same, "left_anti")


def append_new(rows: DataFrame, table: str, keys: list[str]) -> None:
    """Append to a table only what it does not hold; creates it if need be."""
    spark = rows.sparkSession
    if spark.catalog.tableExists(table):
        stored = spark.table(table)
        rows = new_rows(rows, stored, keys).select(*stored.columns)
    else:
        rows = rows.dropDuplicates(keys)
    rows.write.mode("append").saveAsTable(table)
