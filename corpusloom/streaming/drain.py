"""Drain-and-stop streams: read what is new, append it, stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from corpusloom.session import setting

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _lookups(spark):
    """By default every new file is looked up in a task of its own."""
    return setting(spark, LISTING_TASKS, 4 * spark.sparkContext.defaultParallelism)


def drain(stream: DataFrame, checkpoint: str, path: str | None = None, table: str | None = None):
    """Append everything new to a folder or a table and wait for the end.

    With both, the table is made in that folder if it is not there. The checkpoint folder belongs to this one query. A second run with it
    continues where the first ended; a batch that was cut off is repeated and
    committed once.
    """
    if path is None and table is None:
        raise ValueError("give a path or a table")
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
    )
    with _lookups(stream.sparkSession):
        if table is None:
            query = writer.start(path)
        else:
            query = (writer if path is None else writer.option("path", path)).toTable(table)
        query.awaitTermination()
    return query


def drain_batches(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> int:
    """Hand everything new to ``apply(rows, batch number)``, batch by batch; gives their number.

    A batch that was cut off comes again under its number, so ``apply`` must be able to
    repeat itself.
    """
    done = []

    def one(rows: DataFrame, number: int) -> None:
        apply(rows, number)
        done.append(number)

    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    with _lookups(stream.sparkSession):
        writer.foreachBatch(one).start().awaitTermination()
    return len(done)
