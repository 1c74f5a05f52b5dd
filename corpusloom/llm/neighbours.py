"""Every row and the one that follows it in ascending order, without a global sort task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PART = 4_000


def with_successors(docs: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Rows ``(doc_id, text)`` dealt out so that a task can pair each with the next one.

    Parts are ranges of doc_id, and the first rows of a part are sent to the part
    before it as well, marked ``extra``; the first rows of all go to the last part too.
    Within a partition rows are in order, so that the row after the last own one is the
    extra. Rows with a null doc_id come first; equal ids follow each other by a hash of
    their text. Only the bounds of the parts travel to the tasks.
    """
    narrow = docs.select("doc_id")
    rows = narrow.count()
    parts = max(1, -(-rows // rows_per_part))
    cuts: list[int] = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        accuracy = max(10_000, 4 * parts)
        found = narrow.agg(F.percentile_approx("doc_id", at, accuracy).alias("cuts")).first()["cuts"]
        cuts = sorted(set(found or []))
    bounds = np.array(cuts, "int64")

    @F.arrow_udf("int")
    def part_of(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(np.iinfo("int64").min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(bounds, known, side="right").astype("int32"))

    # One row per part.
    heads = (
        narrow.withColumn("part", part_of("doc_id"))
        .groupBy("part")
        .agg(F.min("doc_id").alias("head"), F.max(F.col("doc_id").isNull()).alias("open"))
        .orderBy("part")
        .collect()
    )
    least = np.iinfo("int64").min
    head_of = np.full(len(cuts) + 1, least, "int64")
    before = np.full(len(cuts) + 1, -1, "int64")
    for place, row in enumerate(heads):
        head_of[row["part"]] = least if row["open"] else row["head"]
        before[row["part"]] = heads[place - 1]["part"] if place else heads[-1]["part"]

    @F.arrow_udf("array<struct<part: int, extra: boolean>>")
    def places(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(least).to_numpy(zero_copy_only=False)
        part = np.searchsorted(bounds, known, side="right")
        head = known == head_of[part]
        ends = np.cumsum(np.concatenate([[0], 1 + head]))
        own = np.zeros(ends[-1], "int32")
        extra = np.zeros(ends[-1], bool)
        own[ends[:-1]] = part
        twice = ends[:-1][head] + 1
        own[twice], extra[twice] = before[part[head]], True
        items = pa.StructArray.from_arrays([pa.array(own), pa.array(extra)], names=["part", "extra"])
        return pa.ListArray.from_arrays(pa.array(ends.astype("int32")), items)

    return (
        docs.select("doc_id", "text", F.explode(places("doc_id")).alias("to"))
        .select("doc_id", "text", "to.part", "to.extra")
        .repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("part", "extra", "doc_id", F.xxhash64("text"))
    )
